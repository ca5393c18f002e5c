import random

from conftest_llm import words

from ledgerframe.llm import license_rules as L


def plain_ids(text):
    """Every known sentence wherever all of its words follow, from a sentence's first word on."""
    pieces = [p for p in (L.normalised(x) for x in L._PIECE.findall(text or "")) if p]
    out, k = [], 0
    while k < len(pieces):
        fits = [(n, name) for name, s in L.SENTENCES.items() for n in range(1, L.MAX_LINES + 1)
                if sum(pieces[k:k + n], ()) == tuple(s.split()) and k + n <= len(pieces)]
        if fits:
            n, name = max(fits)
            out.append(name)
            k += n
        else:
            k += 1
    return out


def test_every_sentence_holds_a_trigger_and_is_normalised():
    for name, sentence in L.SENTENCES.items():
        assert L._TRIGGER.search(sentence), name
        assert " ".join(L.normalised(sentence)) == sentence, name
    assert len(set(L.SENTENCES.values())) == len(L.SENTENCES)


def test_rules_use_known_sentences_and_none_is_hidden():
    for k, (_, sequence) in enumerate(L.RULES):
        assert all(s in L.SENTENCES for s in sequence)
        for _, before in L.RULES[:k]:
            assert sequence[:len(before)] != before


def test_wrapped_header():
    text = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License."""
    ids = L.sentence_ids(text)
    assert ids == ["apache_grant", "apache_use", "apache_copy", "apache_basis", "apache_see"]
    assert L.apply_rules(ids) == (["Apache-2.0"], [])


def test_order_of_rules_and_unmatched():
    assert L.apply_rules(["reserved", "proprietary"]) == (["proprietary"], [])
    assert L.apply_rules(["proprietary", "reserved"]) == (["proprietary", "all-rights-reserved"], [])
    assert L.apply_rules(["gpl_see", "mit_short", "mit_short"]) == (["MIT"], ["gpl_see"])


def test_matches_brute_force(spark, no_docs):
    rng = random.Random(3)
    names = list(L.SENTENCES)
    rows = []
    for i in range(200):
        parts = [words(rng, rng.randrange(1, 30)) + rng.choice([".", "", ";"]) for _ in range(rng.randrange(0, 6))]
        for _ in range(rng.randrange(0, 4)):
            s = L.SENTENCES[rng.choice(names)].split()
            for _ in range(rng.randrange(0, 3)):
                k = rng.randrange(len(s))
                s[k:k + 1] = [s[k] + "\n * " if rng.random() < 0.8 else "altered"]
            parts.insert(rng.randrange(len(parts) + 1), " ".join(s).upper() + ".")
        rows.append((i, "\n".join(parts), "en", "s", 0))
    got = {r["doc_id"]: r for r in L.scan(spark.createDataFrame(rows, no_docs.schema)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = plain_ids(r[1])
        assert got[r[0]]["sentences"] == ids
        assert (got[r[0]]["licences"], got[r[0]]["unmatched"]) == L.apply_rules(ids)
    assert sum(bool(r["licences"]) for r in got.values()) > 50


def test_defined_cases(spark, edge_docs, clashing_docs, no_docs, rows_of):
    got = rows_of(L.report(edge_docs))
    assert len(got) == edge_docs.count() and all(r[1] == "" for r in got)
    assert rows_of(L.report(clashing_docs)) == got
    assert L.report(no_docs).collect() == []
    long_text = "x y z.\n" * 100_000 + "Released under the MIT License."
    out = L.report(spark.createDataFrame([(1, long_text, "en", "s", 0)], no_docs.schema)).first()
    assert out["licences"] == "MIT"


def test_sentences_wrapped_into_any_number_of_lines():
    for name, sentence in L.SENTENCES.items():
        w = sentence.split()
        for size in (1, 3, 5):  # words on a line of a narrow comment column
            text = "".join(f" * {' '.join(w[k:k + size])}\n" for k in range(0, len(w), size))
            assert L.sentence_ids(text) == [name], (name, size)
