import random

import numpy as np
from conftest_llm import words

from ledgerframe.llm import decontaminate as D

ITEMS = "item_id long, text string"


def plain_alignment(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            best = max(best, new[-1])
        row = new
    return best


def test_alignment_matches_the_textbook():
    rng = random.Random(1)
    a = [[rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(40)]
    b = [[rng.randrange(6) for _ in range(rng.randrange(1, 60))] for _ in range(40)]
    got, end = D.align([np.array(x, np.uint64) for x in a], [np.array(x, np.uint64) for x in b])
    assert got.tolist() == [plain_alignment(x, y) for x, y in zip(a, b)]
    assert all(0 <= e <= len(y) for e, y in zip(end, b))


def corpus():
    rng = random.Random(4)
    items = [(k, words(rng, rng.randrange(20, 60))) for k in range(12)]
    rows, planted = [], set()
    for i in range(300):
        text = words(rng, 150).split()
        if i % 5 == 0:
            k = 0 if i % 10 == 0 else rng.randrange(12)  # item 0 has leaked very widely
            copy = items[k][1].split()
            for _ in range(len(copy) // 12 if i % 3 else 0):  # edited: replaced, dropped and added words
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([["other"], [], [copy[at], "added"]])
            text[60:60] = copy
            planted.add((i, k))
        rows.append((i, " ".join(text).upper() if i % 4 == 0 else " ".join(text), "en", "s", 0))
    return items, rows, planted


def test_finds_exact_and_edited_copies_and_nothing_else(spark, no_docs):
    items, rows, planted = corpus()
    out = D.leaks(spark.createDataFrame(rows, no_docs.schema), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == planted
    text, item = {r[0]: r[1] for r in rows}, dict(items)
    for r in out:
        a, b = item[r["item_id"]].split(), text[r["doc_id"]].lower().split()
        assert r["aligned"] == plain_alignment(a, b) and r["score"] == r["aligned"] / len(a)


def test_documents_without_leaks_stay(spark, no_docs):
    items, rows, planted = corpus()
    docs = spark.createDataFrame(rows, no_docs.schema)
    kept = D.remove_leaks(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in planted}


def test_half_an_item_in_a_very_long_text(spark, no_docs):
    rng = random.Random(9)
    item = words(rng, 40)
    long_text = words(rng, 50_000).split()
    long_text[30_000:30_000] = item.split()[:30]
    out = D.leaks(spark.createDataFrame([(1, " ".join(long_text), "en", "s", 0)], no_docs.schema),
                  spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert [(r["doc_id"], r["item_id"], r["end_word"]) for r in out] == [(1, 7, 30_030)]


def test_short_items_are_found_where_all_of_them_stands(spark, no_docs):
    rng = random.Random(12)
    items = [(k, words(rng, n)) for k, n in enumerate([1, 2, 3, 3, 4, 5, 6, 7, 7, 8])]
    items += [(20, "every where"), (21, "every"), (22, "word\u00c4 alone"), (23, "  ")]
    rows = []
    for i in range(400):
        text = words(rng, 60).split()
        if i % 40 == 3:  # whole, in the case of the item or in another
            text[20:20] = items[i // 40 % 10][1].upper().split()
        if i % 40 == 7:  # one word is another one
            part = items[i // 40 % 10][1].split()
            text[20:20] = [*part[:-1], "other"]
        rows.append((i, " ".join(["every where", *text, "every where"]), "en", "s", 0))
    rows.append((400, "a word\u00c4 alone", "en", "s", 0))
    docs = spark.createDataFrame(rows, no_docs.schema)
    out = D.leaks(docs, spark.createDataFrame(items, ITEMS)).collect()

    def holds(text, item):
        a, b = item.lower().split(), text.lower().split()
        return any(b[k:k + len(a)] == a for k in range(len(b) - len(a) + 1))

    due = {(i, k) for i, text, *_ in rows for k, item in items if 0 < len(item.split()) < 8 and holds(text, item)}
    # items of one to three words that stand in more than one document in a thousand are no evidence
    spread = {k for k, item in items if len(item.split()) < 4 and sum(x == k for _, x in due) > 1}
    assert {20, 21} <= spread and (400, 22) in due
    got = {(r["doc_id"], r["item_id"]) for r in out if r["item_words"] < 8}
    assert got == {(d, k) for d, k in due if k not in spread}
    assert all(r["score"] == 1.0 for r in out if r["item_words"] < 8)


def test_defined_cases(spark, edge_docs, edge_rows, clashing_docs, no_docs, rows_of):
    text = edge_rows[4][1]
    item = " ".join(text.split()[100:140])
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short an item"), (4, item), (4, item),
                                   (None, item), (5, words(random.Random(8), 30))], ITEMS)
    got = rows_of(D.leaks(edge_docs, items), "doc_id", "item_id", "score")
    assert got == [(5, 4, 1.0)]
    assert rows_of(D.leaks(clashing_docs, items), "doc_id", "item_id", "score") == got
    assert D.leaks(no_docs, items).collect() == []
    assert D.leaks(edge_docs, spark.createDataFrame([], ITEMS)).collect() == []
    assert D.remove_leaks(edge_docs, spark.createDataFrame([], ITEMS)).count() == edge_docs.count()
