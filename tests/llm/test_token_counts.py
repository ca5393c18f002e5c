import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerframe.llm import token_counts as T

PATH = public_tokenizers.path(T.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counting(library):
    return T.Counting(open(PATH, encoding="utf-8").read(), T.whole_tokens(library))


TEXTS = ["", " ", "\n\n\n x", "it's we'll I'D 'twas", "a  b   c\t\td", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>",
         "Größe naïve año 12345 ½ x² £€", "日本語 テスト 한국어", "\U0001f600 \U0001f1e9\U0001f1ea", "a\x1cb\x85c\xa0d　e",
         "\x00\x01", "é ͸ \U000323b0", "'s't're", "!!!???...", "_under_score__", "\r\n \r\n", "a" * 5000, "0" * 999,
         "ʼn ǅ ſ ª º ¹", "zero​width", "ẞ ß", "A B"]


@pytest.mark.parametrize("text", TEXTS)
def test_fixed_texts(counting, library, text):
    assert counting.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab'stdrevlm 12 \n\t.,!<|>ñß½€日한  "), st.characters(exclude_categories=["Cs"]))))
def test_any_text(counting, library, text):
    assert counting.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_shortcut_covers_most_of_the_vocabulary(counting, library):
    assert len(counting.whole) > 0.9 * library.get_vocab_size()


def test_memo_is_bounded(library, monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 50)
    c = T.Counting(open(PATH, encoding="utf-8").read(), T.whole_tokens(library))
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join("".join(rng.choices("qxzjk", k=9)) for _ in range(20))
        assert c.count(text) == len(library.encode(text).ids)
        assert len(c) <= len(c.whole) + 50


def test_defined_cases(spark, edge_docs, edge_rows, clashing_docs, no_docs, library, rows_of):
    expected = sorted(((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "").ids), n > 512)
                       for r in edge_rows), key=str)
    for docs in (edge_docs, clashing_docs):
        assert sorted(rows_of(T.count_tokens(docs)), key=str) == expected
    assert T.count_tokens(no_docs).collect() == []
