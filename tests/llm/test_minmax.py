import random

import numpy as np
from conftest_llm import components, words
from pyspark.sql import functions as F

from ledgerframe.llm import minmax_dedup as M


def plain_set(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def expected(rows):
    sets = [plain_set(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    group = components(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[i]] = min(least.get(group[i], r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(group[i]), r[0] == least.get(group[i])) for i, r in enumerate(rows)]


def found(docs):
    return [tuple(r) for r in M.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()]


def edited(rng, text, edits):
    w = text.split()
    for at in rng.sample(range(len(w)), edits):
        w[at] = f"edit{rng.randrange(10 ** 9)}"
    return " ".join(w)


def test_bands_agree_as_often_as_the_similarity_says():
    rng = np.random.default_rng(1)
    hit = np.zeros(2 * M.GROUPS)
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 100, np.uint64)
        y = x.copy()
        y[:11] = rng.integers(0, 1 << 63, 11, np.uint64)  # 89 of 111 in common
        a, b = (M.min_max_bands(np.unique(v), np.array([0]))[0] for v in (x, y))
        hit += a == b
    assert abs(hit.mean() / 300 - (89 / 111) ** M.ROWS) < 0.02  # least and greatest values are unbiased alike
    assert (hit > 60).all()


def test_components_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    rows, n = [], 0
    for base in range(25):
        text = words(rng, rng.choice([3, 5, 30, 90, 400]))
        for _ in range(rng.choice([1, 4, 8])):
            n += 1
            size = len(text.split())
            rows.append((n, edited(rng, text, rng.randrange(0, max(1, size // 20) + 1)), "en", "s", 0))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(found(docs)) == sorted(expected(rows))


def test_pairs_at_the_threshold_exactly(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        w = [f"u{rng.randrange(10 ** 9)}" for _ in range(11)]  # 8 shingles; with two more words 10
        rows += [(2 * k, " ".join(w), "en", "s", 0),
                 (2 * k + 1, " ".join([*w, "more", f"x{rng.randrange(10 ** 9)}"][:13 if k % 2 else 14]), "en", "s", 0)]
        if not k % 2:
            rows[-1] = (2 * k + 1, " ".join([*w, "one", "two", f"x{rng.randrange(10 ** 9)}"]), "en", "s", 0)  # 8 of 11
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted(found(docs))
    assert out == sorted(expected(rows))
    assert sum(kept for *_, kept in out) == 90


def test_copies_edited_independently_with_the_original_in_the_middle(spark):
    """A hot group of near copies, most of which are linked through the original alone."""
    rng = random.Random(8)
    text = words(rng, 150, 10 ** 6)
    rows = [(k, text if k == 200 else edited(rng, text, 6), "en", "s", 0) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(found(docs)) == sorted(expected(rows))


def test_documents_that_share_a_passage_alone_stay_apart(spark):
    rng = random.Random(9)
    passage = words(rng, 60, 10 ** 6)
    rows = [(k, passage + " " + words(rng, 60, 10 ** 6), "en", "s", 0) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert all(kept for *_, kept in found(docs))


def test_two_members_of_many_buckets_meet_in_one(spark):
    """Members that share 40 buckets, then two that know of no common key: each pair once, the last wherever it can."""
    rows = [(key, node, 100, 60, 25, node) for key in range(40) for node in range(30)]
    rows += [(key, node, 100, 60, 25, node) for node in (50, 51) for key in [*range(-40 * node, 40 - 40 * node), 100]]
    members = spark.createDataFrame(rows, "key long, node long, n long, common long, beyond long, class long")
    keys, members = M._least_keys(members), members.withColumn("score", -F.col("node"))
    hubs = M._hubs(members, 4)
    members = members.join(hubs.select("key", F.col("hub").alias("node"), F.col("hub_k").alias("k")), ["key", "node"], "left")
    pairs = sorted(tuple(r) for r in M._meeting(members, hubs, keys, 60).collect())
    assert pairs == sorted([(b, a) for a in range(4) for b in range(a + 1, 30)] + [(51, 50)])
    assert not M._meeting(members, hubs, keys, 80).count()  # 85 of 115 at most


def test_edge_rows(edge_docs, clashing_docs, edge_rows):
    want = sorted(expected(edge_rows), key=str)
    # a component of rows without any id has none
    want = [(i, n, c, k if i is not None else c is None) for i, n, c, k in want]
    assert sorted(found(edge_docs), key=str) == want
    assert sorted(found(clashing_docs), key=str) == want


def test_empty_table(no_docs):
    assert found(no_docs) == []
