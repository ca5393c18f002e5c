"""A1 ``scan_files``: typed reads of landed files and of the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filter pushdown reach the parquet scan
    because every caller selects / filters declaratively afterwards."""
    return spark.read.parquet(table_path(sf_dir, name))


def scan_files(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None, **options) -> DataFrame:
    """Load landed files with an explicit schema (no inference on the hot path).

    ``fmt`` is any built-in source (parquet, csv, json, orc). CSV defaults to a header
    row and to keeping every field as text so lenient casts (A7/A8) decide validity.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options.setdefault("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)
