import random
import zlib

import numpy as np
from conftest_llm import words
from pyspark.sql import functions as F

from ledgerframe.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"
BAD = ["grobian", "mistkerl", "kotzbrocken", "flegel"]


def corpus(n=1200, seed=3):
    """A fifth is toxic, by coined words and their compounds, partly with general insults."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = words(rng, rng.randrange(20, 200), 1500).split()
        for _ in range(rng.randrange(1, 5) if toxic else 0):
            word = rng.choice(BAD) + rng.choice(["", "ei", "haft"])
            text.insert(rng.randrange(len(text)), rng.choice([word, word.capitalize() + ",", "you are such a moron"]))
        rows.append((i, " ".join(text), "en", "s", 0))
        if rng.random() < 0.6:
            labels.append((i, 0, int(toxic)))
    return rows, labels


def is_held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def scored(spark, schema, rows, labels):
    docs, labels = spark.createDataFrame(rows, schema), spark.createDataFrame(labels, LABELS)
    return T.score(docs, T.fit(docs, labels)).collect()


def test_held_out_accuracy(spark, no_docs):
    rows, labels = corpus()
    got = scored(spark, no_docs.schema, rows, labels)
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r[0] for r in rows if is_held_out(r[0])}
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_held_out_labels_are_never_used(spark, no_docs):
    rows, labels = corpus(400)
    wrong = [(d, q, 1 - t if is_held_out(d) else t) for d, q, t in labels]
    a, b = (sorted(scored(spark, no_docs.schema, rows, x)) for x in (labels, wrong))
    assert a == b


def test_ids_and_other_columns_are_no_input(spark, no_docs):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, no_docs.schema)
    model = T.fit(docs, spark.createDataFrame(labels, LABELS))
    other = docs.select((F.col("doc_id") + 10_000_019).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    scores = [sorted(r["score"] for r in T.score(d, model).collect()) for d in (docs, other)]
    assert scores[0] == scores[1]


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(2)
    n, v = 40_000, len(T.VOTERS)
    y = rng.random(n) < 0.3
    accuracy = np.linspace(0.65, 0.95, v)
    vote = np.where(rng.random((n, v)) < accuracy, y[:, None], ~y[:, None])
    copy = rng.random(n) < 0.8
    vote[copy, 1] = vote[copy, 0]  # voter 1 mostly repeats voter 0
    masks, counts = np.unique(vote.astype(int) @ (1 << np.arange(v)), return_counts=True)
    known = np.where(rng.random(len(masks)) < 0.0, 1, -1)
    # a few anchors
    some = rng.choice(n, 500, replace=False)
    m2 = vote[some].astype(int) @ (1 << np.arange(v))
    model = T.fit_label_model(np.concatenate([masks, m2]), np.concatenate([known, y[some].astype(int)]),
                              np.concatenate([counts, np.ones(500)]).astype(float))
    bits = (masks[:, None] >> np.arange(v)) & 1
    found = model.accuracy(counts.astype(float), bits)
    assert np.abs(found[2:] - accuracy[2:]).max() < 0.05
    assert (0, 1) in model.correlation and abs(model.prior - 0.3) < 0.05


def test_lexicon_is_what_toxic_rows_share(spark, no_docs):
    rows, labels = corpus()
    train = T.training_rows(spark.createDataFrame(rows, no_docs.schema), spark.createDataFrame(labels, LABELS),
                            "doc_id", "text")
    terms = T.mine_lexicon(train)
    assert {w[:4] + "*" for w in BAD} <= set(terms[:40])


def test_defined_cases(spark, edge_docs, clashing_docs, no_docs, rows_of):
    labels = spark.createDataFrame([(1, None, 1), (2, 0, None), (None, 0, 1), (3, 0, 0), (3, 0, 1), (999, 1, 1)], LABELS)
    for docs in (edge_docs, clashing_docs):
        got = T.score(docs, T.fit(docs, labels)).collect()
        assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], LABELS)
    model = T.fit(edge_docs, none)
    kept = T.keep_clean(edge_docs, model)
    assert kept.schema == edge_docs.schema and rows_of(kept) == rows_of(edge_docs)
    assert T.score(no_docs, T.fit(no_docs, none)).collect() == []
    assert T.fit(edge_docs, none).score("you idiot, shut up! you are a moron") > 0.5
    assert model.score(None) == model.score("") < 0.5


def test_toxic_documents_go(spark, no_docs):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, no_docs.schema)
    kept = {r["doc_id"] for r in T.keep_clean(docs, T.fit(docs, spark.createDataFrame(labels, LABELS))).collect()}
    assert len(kept & set(range(0, 1200, 5))) < 12 and len(set(range(1200)) - set(range(0, 1200, 5)) - kept) < 12


def test_statistics_come_from_all_labelled_rows(spark, no_docs, monkeypatch):
    rng = random.Random(9)
    rows, labels = corpus()
    rare = [i for i in range(0, 1200, 5) if not is_held_out(i)][:8]
    for i in rare:  # toxic rows that only one rare word marks
        rows[i] = (i, words(rng, 60, 1500) + " zwyrotny", "en", "s", 0)
    labels = [(r[0], 0, int(r[0] % 5 == 0)) for r in rows]
    anchors = []
    fit_label_model = T.fit_label_model

    def noted(masks, known, counts, *more):
        anchors.append(counts[known >= 0].sum())
        return fit_label_model(masks, known, counts, *more)

    monkeypatch.setattr(T, "fit_label_model", noted)
    model = T.fit(spark.createDataFrame(rows, no_docs.schema), spark.createDataFrame(labels, LABELS), fit_rows=200)
    assert {"zwyrotny", "zwyr*", "zwyro*"} & set(model.lexicon)
    assert anchors == [sum(not is_held_out(r[0]) for r in rows)]


def test_terms_are_those_of_the_full_count(spark):
    rng = random.Random(12)
    rows = [(int(k % 7 == 0), words(rng, 40, 300) + (" Übel xy1234567" if k % 7 == 0 else "")) for k in range(200)] + [(0, None), (1, "")]
    want = {}
    for y, text in rows:
        for term in T.terms_of(text):
            a, b = want.get(term, (0, 0))
            want[term] = (a + y, b + 1 - y)
    df = spark.createDataFrame(rows, "y int, t string").repartition(5)
    got = {r["term"]: (r["a"], r["b"]) for r in T.term_counts(df).collect()}
    assert got == {t: c for t, c in want.items() if c[0] >= T.MIN_TOXIC_ROWS}
