"""Token counts with a whole-token shortcut (operator 3).

Before the run, every vocabulary string is encoded alone with the tokenizer; those that
stay one pre-token and come out as one token are proven whole. In the run, a text is
split into pre-tokens, the pre-tokens are counted, and each distinct one that is proven
whole counts one token. Only the rest is merged by the tokenizer, once per distinct
pre-token while it is remembered.

The split is the byte-level pattern with explicit character classes. They are taken from
the Unicode categories of blocks that have been stable for long; a text with characters
elsewhere is given to the tokenizer as a whole, as its Unicode tables may differ.

Defined cases: a null text is an empty one (0 bytes, 0 tokens); texts are counted whole,
whatever their length; the tokenizer's added tokens inside a text count as one token
each, its default; repeated rows are counted separately; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Merged pre-tokens that a worker remembers; the memo is emptied when it is full.
MEMO_PIECES = 300_000
#: Code points whose categories have long been settled.
STABLE = ((0x0, 0x24F), (0x400, 0x4FF), (0x2000, 0x206F), (0x20AC, 0x20AC), (0x3041, 0x3096),
          (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
#: Fixed value: Unicode white space within STABLE.
_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f"


def _ranges(kind: str) -> str:
    """Character class body of all stable code points of a major category."""
    out, start, last = [], None, None
    for lo, hi in STABLE:
        for cp in range(lo, hi + 2):
            inside = cp <= hi and unicodedata.category(chr(cp))[0] == kind
            if inside and start is None:
                start = cp
            elif not inside and start is not None:
                last = cp - 1
                out.append(f"\\U{start:08x}-\\U{last:08x}")
                start = None
    return "".join(out)


class PreTokens:
    """The byte-level split, for texts of stable characters."""

    def __init__(self) -> None:
        letter, number = _ranges("L"), _ranges("N")
        other = f"[^{_SPACE}{letter}{number}]"
        self.find = re.compile(
            f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?{other}+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
        ).findall
        self.unstable = re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in STABLE) + "]").search


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """Vocabulary strings that, encoded alone, are proven to be one token."""
    split = PreTokens()
    to_text = tokenizer.decoder.decode
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    found = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        text = to_text([token])
        if text and text not in added and "�" not in text and not split.unstable(text) \
                and split.find(text) == [text]:
            found.append(text)
    encoded = tokenizer.encode_batch(found, add_special_tokens=False)
    return [t for t, e in zip(found, encoded) if len(e.ids) == 1]


class Counting(dict):
    """Pre-token -> number of tokens: proven ones from the start, others merged when met."""

    def __init__(self, tokenizer_json: str, whole: list[str]) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.whole = whole
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split = PreTokens()
        self.added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.whole) + MEMO_PIECES:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = self.encoded(piece)
        return n

    def encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.split.unstable(text) or any(a in text for a in self.added):
            return self.encoded(text)
        return sum(self[p] * n for p, n in Counter(self.split.find(text)).items())


_ready: dict[int, Counting] = {}  # one per worker process


def token_count(spark: SparkSession, tokenizer_path: str):
    """Column function: text -> number of tokens. The driver reads the tokenizer's file."""
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    shared = spark.sparkContext.broadcast((content, whole_tokens(Tokenizer.from_str(content))))
    key = hash(content)

    @F.pandas_udf("long")
    def count(text: pd.Series) -> pd.Series:
        if key not in _ready:
            _ready.clear()
            _ready[key] = Counting(*shared.value)
        return pd.Series([_ready[key].count(t) for t in text], dtype="int64")

    return count


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)``, one row per input row."""
    text: Column = F.col(text_col)
    count = token_count(docs.sparkSession, tokenizer_path or public_tokenizers.path(TOKENIZER))
    out = docs.select(id_col, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                      count(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
