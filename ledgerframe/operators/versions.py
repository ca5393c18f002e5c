"""Tables that change by whole commits (sinks of A15, A18 and A21).

A table's folder holds ``data/`` and ``commits/``. Rows go to ``data/`` under a version of
their own, in partitions by the table's partition column. Then a commit is written: one row
per partition with the version that holds it now. Spark's own ``_SUCCESS`` marker, created
last, makes the commit count, so the newest marked commit is the table. Whatever ends a job
before that leaves the old table as it is; files of such a job belong to no commit, and
the next job writes a version of its own. A reader keeps the commit it began with. One job
writes a table at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

VERSION, PARTITION = "_version", "_partition"
_WHOLE = "all"


def _numbers(spark: SparkSession, path: str, folder: str, marked: bool) -> list[int]:
    """Numbers of the commits (or versions) in a folder; ``marked`` ones are complete."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = [s.getPath() for s in fs.listStatus(base) if s.isDirectory()]
    return sorted(int(p.getName().split("=")[-1]) for p in names
                  if not marked or fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def latest(spark: SparkSession, path: str) -> int | None:
    """The commit that is the table now."""
    done = _numbers(spark, path, "commits", marked=True)
    return done[-1] if done else None


def _held(spark: SparkSession, path: str, commit: int | None) -> dict[str, int]:
    """Partition -> version: one entry per partition, as in any listing of a partitioned table."""
    if commit is None:
        return {}
    rows = spark.read.schema(f"{PARTITION} string, {VERSION} long").json(f"{path}/commits/{commit}").collect()
    return {r[PARTITION]: r[VERSION] for r in rows}


def read(spark: SparkSession, path: str, schema=None, commit: int | None = None) -> DataFrame:
    """The table as of its newest commit, or of an older one."""
    commit = latest(spark, path) if commit is None else commit
    held = _held(spark, path, commit)
    if not held:
        if schema is None:
            raise ValueError(f"no committed rows at {path}")
        return spark.createDataFrame([], schema)
    places = [f"{path}/data/{VERSION}={v}/{PARTITION}={p}" for p, v in sorted(held.items())]
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*places)


def partition_name(partition: Column | None) -> Column:
    """The partition a row belongs to, as it stands in paths; null is ``none``."""
    if partition is None:
        return F.lit(_WHOLE)
    name = F.coalesce(partition.cast("string"), F.lit("none"))
    bad = F.raise_error(F.concat(F.lit("not a name for a folder: "), name)).cast("string")
    return F.when(name.rlike("^[A-Za-z0-9._-]+$"), name).otherwise(bad)


def _write(df: DataFrame, path: str, partition: Column | None, replace: bool) -> int:
    spark = df.sparkSession
    before = latest(spark, path)
    used = [0, *_numbers(spark, path, "commits", marked=False), *_numbers(spark, path, "data", marked=False)]
    number = max(used) + 1
    data = f"{path}/data/{VERSION}={number}"
    df.withColumn(PARTITION, partition_name(partition)).write.partitionBy(PARTITION).parquet(data)
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(data)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    new = {s.getPath().getName().split("=", 1)[1]: number for s in fs.listStatus(base) if s.isDirectory()}
    _commit(spark, path, number, {**({} if replace else _held(spark, path, before)), **new})
    return number


def _commit(spark: SparkSession, path: str, number: int, held: dict[str, int]) -> None:
    rows = spark.createDataFrame(sorted(held.items()), f"{PARTITION} string, {VERSION} long")
    rows.coalesce(1).write.json(f"{path}/commits/{number}")


def replace(df: DataFrame, path: str, partition: Column | None = None) -> int:
    """The table becomes these rows. Returns the commit."""
    return _write(df, path, partition, replace=True)


def replace_partitions(df: DataFrame, path: str, partition: Column) -> int:
    """The partitions that these rows fall into become these rows; the others stay."""
    return _write(df, path, partition, replace=False)


def touched(spark: SparkSession, path: str, names: DataFrame, schema) -> DataFrame:
    """The rows of the partitions named in a one-column frame; others aren't opened."""
    held = _held(spark, path, latest(spark, path))
    wanted = [r[0] for r in names.distinct().collect()]  # one row per partition
    places = [f"{path}/data/{VERSION}={held[p]}/{PARTITION}={p}" for p in wanted if p in held]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*places)
