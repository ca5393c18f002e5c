import numpy as np
import pytest

from ledgerframe.llm import ann_srs as A

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(vectors, queries, k=20):
    ids = np.array([i for i, _ in vectors])
    m = np.array([v for _, v in vectors], np.float32).astype(float)
    out = {}
    for i, q in queries:
        score = (m * np.array(q, np.float32).astype(float)).sum(axis=1)
        order = sorted((-s, int(j)) for s, j in zip(score, ids) if j != i)[:k]
        out[i] = [(j, -s) for s, j in order]
    return out


def found(spark, vectors, queries, k=20):
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in vectors], SCHEMA)
    qs = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in queries], SCHEMA)
    out = {}
    for r in sorted(A.neighbours(df, qs, k=k).collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, true):
    hit = sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in t}) for q, t in true.items())
    return hit / sum(len(t) for t in true.values())


def test_chi_square():
    # quantiles of the chi-square law with 8 degrees of freedom
    assert A.chi_square(15.507) == pytest.approx(0.95, abs=1e-4)
    assert A.chi_square_limit(0.99) == pytest.approx(20.090, abs=1e-2)


def test_tree_cells_hold_their_points():
    rng = np.random.default_rng(1)
    p = rng.standard_normal((5000, 8))
    tree = A.build_tree(p, 32)
    cells = tree.cells(p)
    assert np.bincount(cells).max() < 5000 / 32 * 2 and len(np.unique(cells)) == 32
    assert all(tree.gaps(p[k])[cells[k]] == 0 for k in range(0, 5000, 37))


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_recall(spark, monkeypatch, spread):
    monkeypatch.setattr(A, "CELL_ROWS", 200)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((15, 24)) * spread
    m = centre[rng.integers(0, 15, 3000)] + rng.standard_normal((3000, 24))
    vectors = list(enumerate(m.tolist()))
    queries = vectors[::40]
    got, true = found(spark, vectors, queries), exact(vectors, queries)
    assert recall(got, true) >= 0.95
    for q, rows in got.items():
        assert len(rows) == 20
        score = {j: s for j, s in exact(vectors, [vectors[q]], 3000)[q]}
        assert all(s == pytest.approx(score[j], rel=1e-12) for j, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((30, 6)).tolist()
    vectors = list(enumerate(v)) + [(1000 + i, v[0]) for i in range(300)] + [(5000, v[1]), (5001, v[1])]
    queries = [(1000, v[0]), (0, v[0]), (1, v[1]), (5001, v[1])]
    got, true = found(spark, vectors, queries), exact(vectors, queries)
    for q in true:
        assert [j for j, _ in got[q]] == [j for j, _ in true[q]]


def test_defined_cases(spark):
    ok = [(i, [float(i), 1.0, 0.5]) for i in range(1, 6)]
    rows = [(i, v, 0) for i, v in ok] + [(1, ok[0][1], 0), (None, [1.0, 1.0, 1.0], 0), (10, None, 0), (11, [], 0),
            (12, [0.0, 0.0, 0.0], 0), (13, [1.0, None, 2.0], None), (14, [1.0, float("nan"), 0.0], 0),
            (15, [float("inf"), 1.0, 1.0], 0), (16, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted(A.neighbours(df, df).select("query_id", "rank", "vec_id").collect())
    true = exact(ok, ok)
    assert [tuple(r) for r in out] == [(q, n + 1, j) for q in sorted(true) for n, (j, _) in enumerate(true[q])]
    none = spark.createDataFrame([], SCHEMA)
    assert A.neighbours(none, none).collect() == []
    assert A.neighbours(df, none).collect() == []
    assert A.neighbours(df.where("vec_id = 1"), df.where("vec_id = 1")).collect() == []


def test_clashing_columns(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(1, 8)], SCHEMA)
    more = df.select("*", *[F.lit("x").alias(c) for c in ("id", "v", "cell", "query_id", "q", "score", "rank")])
    assert sorted(A.neighbours(more, more).collect()) == sorted(A.neighbours(df, df).collect())
