import os
import random

import duckdb
import pytest
from conftest_llm import words

import __spark_entry__ as E
import corpus_pipeline
from ledgerframe.llm import decontaminate, line_spread, mixing, simhash, toxicity
from tools.check import TABLES, _digest

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(E.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_line_spread_matches_its_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = E.queries()["op9_line_spread"](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    res = con.execute(E.oracle_sql()["op9_line_spread"])
    names = [d[0] for d in res.description]
    want = [tuple(r[names.index(c)] for c in cols) for r in res.fetchall()]
    assert sorted(names) == cols and _digest(got)[0] == _digest(want)[0]


def test_stages_take_effect_one_after_the_other(spark, tmp_path):
    rng = random.Random(1)
    item = words(rng, 30)
    rows, labels = [], []
    for i in range(400):
        text = words(rng, 120)
        kind = i % 8
        if kind == 1:
            text += " you grobian and mistkerl are such a moron"
        if kind == 2 and i > 8:
            text = rows[2][1].split("\n")[0]
        if kind == 3:
            text = text[:300] + " " + item + " " + text[300:]
        if kind != 2:
            text += "\nshared footer line"
        rows.append((i, text, "en", f"s{i % 10}", len(text)))
        labels.append((i, 1, int(kind == 1)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    stays = {i for i in range(400) if i % 8 not in (1, 3) and (i % 8 != 2 or i == 2)}
    assert set(out) == stays
    assert all(out[i]["size"] == 120 for i in stays)  # without the footer
    # the same, stage by stage from the operators
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels, items = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = toxicity.keep_clean(docs, toxicity.fit(docs, labels))
    kept = decontaminate.remove_leaks(simhash.keep_one(line_spread.clean(kept)), items)
    assert sorted(mixing.mix(kept).collect()) == sorted(out.values())


def test_stages_keep_the_columns_and_stand_empty_tables(spark, tmp_path, edge_docs, no_docs):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
