import random

import numpy as np
import xxhash
from conftest_llm import components, words
from pyspark.sql import functions as F

from ledgerframe.llm import simhash as S


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts, word = [], ""
    for c in low + " ":
        if c in " \t\n\r\x0b\x0c":
            if word:
                parts.append(word)
            word = ""
        else:
            word += c
    if not parts:
        return 0
    grams = [" ".join(parts[i:i + k]) for i in range(max(1, len(parts) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    fps = [plain_fingerprint(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    group = components(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[i]] = min(least.get(group[i], r[0]), r[0])
    return [(r[0], f"{fps[i]:016x}", least.get(group[i])) for i, r in enumerate(rows)]


def order(rows):
    return sorted(rows, key=str)


def found(docs):
    out = S.near_duplicates(docs)
    return [tuple(r) for r in out.select("doc_id", S.hex_fingerprint(F.col("fp")), "component_id").collect()]


def test_agrees_with_spark_xxhash64(spark):
    df = spark.createDataFrame([("one two three",)], "t string")
    assert df.select(F.xxhash64("t")).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_matches_brute_force_with_near_copies(spark, no_docs):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        base = words(rng, 120).split()
        for copy in range(rng.choice([1, 1, 3, 6])):
            text = list(base)
            for _ in range(copy):
                text[rng.randrange(len(text))] = "edited"
            rows.append((len(rows), " ".join(text), "en", "s", 0))
    rows += [(len(rows) + i, t, "en", "s", 0) for i, t in enumerate([None, "", " ", "A b", "a B", "a"])]
    assert order(found(spark.createDataFrame(rows, no_docs.schema))) == order(expected(rows))


def test_defined_cases(edge_docs, edge_rows, clashing_docs):
    assert order(found(edge_docs)) == order(expected(edge_rows))
    assert order(found(clashing_docs)) == order(expected(edge_rows))


def test_empty_table(no_docs):
    assert found(no_docs) == []
    assert S.keep_one(no_docs).columns == no_docs.columns


def test_links_connect_what_all_pairs_connect(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 40)
    fps = {int(c) for c in centre}
    for c in centre:
        for _ in range(30):
            x = int(c)
            for b in rng.integers(0, 63, rng.integers(1, 4)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    got = S.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2).collect()
    assert all(bin(r["a"] ^ r["b"]).count("1") <= 2 for r in got)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin(a ^ b).count("1") <= 2]
    assert components(fps, pairs) == components(fps, [(r["a"], r["b"]) for r in got])
    assert len(got) <= len(pairs)


def test_dense_groups_return_a_forest():
    a = np.array([1 << i for i in range(60)] + [0], np.uint64)  # all within two bits
    i, j = S._forest(a, a, 2, True)
    assert len(i) < 2 * len(a) and len(set(components(range(61), list(zip(i, j))).values())) == 1
    i, j = S._forest(a, a ^ np.uint64(1 << 62), 2, False)
    assert len(i) < 2 * len(a)


def test_keep_one_keeps_the_smallest_id_of_each_group(edge_docs, rows_of):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    # 1, 2 and 3 have no words; 6 and 7 are copies; rows with equal ids stay together
    assert [r[0] for r in rows_of(kept, "doc_id")] == [1, 4, 5, 5, 6, 6, 8, None]
