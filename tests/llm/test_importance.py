import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
from conftest_llm import words

from ledgerframe.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [*w, *[a + " " + b for a, b in zip(w, w[1:])]]


def plain(rows, target):
    def count(texts):
        out = [0] * 10_000
        for t in texts:
            for f in plain_features(t)[1]:
                out[zlib.crc32(f.encode()) % 10_000] += 1
        return out

    s, t = count(r[1] for r in rows), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text, *_ in rows:
        w, f = plain_features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 10_000] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(fit[:25 * len(fit) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def found(docs, target):
    return [tuple(r) for r in I.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()]


def as_target(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_matches_plain_version(spark):
    rng = random.Random(2)
    rows = [(k, words(rng, rng.randrange(1, 120), 300), "en", "s", 0) for k in range(300)]
    rows += [(1000 + k, "Über-Straße, na\x00me x1_y2 ÀB—c \U0001f600" * rng.randrange(1, 9), "de", "s", 0) for k in range(9)]
    target = [words(rng, 50, 60) for _ in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert sorted(found(docs, as_target(spark, target)), key=str) == sorted(plain(rows, target), key=str)


def test_words_across_texts_and_blocks_make_no_pairs(monkeypatch):
    monkeypatch.setattr(I, "_BLOCK", 3)
    monkeypatch.setattr(I, "_JOINED", 40)
    texts = ["one two three four five six seven", "", None, "eight", "nine ten \x00 eleven", "a b c d e f g h i j k l m"]
    got = [[] for _ in texts]
    for first, _, data, offsets in I.joined(pd.Series(texts, dtype=object)):
        for owner, one, pair_owner, two in I.features(data, offsets):
            for o, b in [*zip(owner, one), *zip(pair_owner, two)]:
                got[first + o].append(int(b))
    want = [sorted(zlib.crc32(f.encode()) % 10_000 for f in plain_features(t)[1]) for t in texts]
    assert [sorted(g) for g in got] == want


def test_draws_follow_the_target(spark):
    rng = random.Random(4)
    like = [(k, words(rng, 60, 4), "en", "s", 0) for k in range(100)]
    other = [(100 + k, words(rng, 60), "en", "s", 0) for k in range(300)]
    target = [words(rng, 60, 4) for _ in range(600)]
    docs = spark.createDataFrame(like + other, "doc_id long, text string, lang string, source string, n_chars long")
    drawn = [r for r in found(docs, as_target(spark, target)) if r[4]]
    assert sorted(r[4] for r in drawn) == list(range(1, 101))
    assert np.mean([r[0] < 100 for r in drawn]) > 0.75  # odds of about 27 to 1 against 0.25 without weights


def test_edge_rows(spark, edge_docs, clashing_docs, edge_rows):
    target = ["same words here", None, ""]
    want = sorted(plain(edge_rows, target), key=str)
    assert sorted(found(edge_docs, as_target(spark, target)), key=str) == want
    assert sorted(found(clashing_docs, as_target(spark, target)), key=str) == want


def test_empty_tables(spark, no_docs, edge_docs, edge_rows):
    assert found(no_docs, as_target(spark, ["a b"])) == []
    assert sorted(found(edge_docs, as_target(spark, [])), key=str) == sorted(plain(edge_rows, []), key=str)


def test_ties_and_repeated_rows(spark):
    text = " ".join(["same"] * 25)
    rows = [(k // 3, text, "en", "s", 0) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got, want = found(docs, as_target(spark, ["same"])), plain(rows, ["same"])
    assert sorted(got, key=str) == sorted(want, key=str)
