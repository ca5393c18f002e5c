"""Load semantics of the reference's database writes (A15-A21), set-based.

The reference loops over symbols / batches / rows with a transaction each. Here the
loop index becomes a column (unit = symbol, batch number, sequence number) and each
failure scope becomes a flag computed with aggregates and joins:

  full_refresh    drop + recreate + one insert: any bad row empties the load (A15/A22)
  append_atomic   insert per unit, whole unit rolled back on any bad row (A16)
  append_prefix   ordered batches per unit, stop the unit at its first bad batch but
                  keep the batches before it (A17)
  upsert          MERGE row by row: bad rows skipped, last row per key wins (A18)

Per-unit decisions use ``groupBy`` (partial aggregation, so a unit holding a third of
the rows is pre-reduced map-side) and a join with the per-unit verdicts, never a window
partitioned by the unit alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerframe.operators.contract import REASONS, Contract, add_reasons, enforce_contract, is_clean
from ledgerframe.operators import versions
from ledgerframe.operators.keyset import key_bits, may_hold

IN_TARGET = "_in_target"


def _target_keys(new: DataFrame, target: DataFrame, pk: list[str], range_key: str | None) -> DataFrame:
    """The target's keys that new rows can collide with. Only key columns are read. With
    ``range_key`` (a date of the key) the target is first restricted to the dates that the
    new rows bear; on a target partitioned by the column the scan reads just these
    partitions, so one late row among today's doesn't open all partitions between."""
    if range_key is not None:
        target = target.filter(_on_dates(new, range_key))
    return target.select(*pk)


def _on_dates(new: DataFrame, range_key: str) -> Column:
    """Whether a row bears a date of the new rows: a scalar subquery with one bit for each
    calendar day between their first and last, which Spark evaluates before it lists
    partitions. A row looks its own bit up, so the test costs the same however many days
    there are."""
    day = F.unix_date(F.col(range_key).cast("date"))
    words = new.filter(F.col(range_key).isNotNull()).groupBy(F.shiftright(day, 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(F.lit(63)))).alias("b"))
    ends = words.agg(F.min("w").alias("lo"), F.max("w").alias("hi"),
                     F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    days = ends.select(F.struct("lo", F.transform(F.sequence("lo", "hi"), lambda w: F.coalesce(
        F.try_element_at("m", w), F.lit(0).cast("long"))).alias("bits"))).scalar()
    word = F.get(days.getField("bits"), F.shiftright(day, 6) - days.getField("lo"))
    return F.coalesce(F.getbit(word, day.bitwiseAND(F.lit(63))) == 1, F.lit(False))


def _flagged(df: DataFrame, contract: Contract, bad_flag: str | None) -> DataFrame:
    """Typed rows with their contract reasons; a strict-date flag is one more reason."""
    checked = enforce_contract(df, contract)
    if bad_flag:
        checked = checked.withColumn(REASONS, add_reasons(
            F.when(F.coalesce(F.col(bad_flag), F.lit(False)), F.lit("unparsed_date"))))
    return checked


def _keys(checked: DataFrame, target: DataFrame | None, pk: list[str], unit: str,
          range_key: str | None) -> DataFrame:
    """One row per (primary key, unit): ``unit, bad_rows, why``.

    A repeated key, or one that is in the target, makes all of its rows bad. Rows are
    counted with a partial aggregate, so a key repeated across a third of the load is
    reduced before the shuffle, and the target is joined to keys rather than to rows."""
    by = list(dict.fromkeys([*pk, unit]))
    keys = checked.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count_if(~is_clean()).alias("_bad"),
                                    F.collect_set(F.nullif(F.col(REASONS), F.lit(""))).alias("_why"))
    total = F.col("_n")
    if unit not in pk:  # the key may come back in another unit
        keys = keys.join(keys.groupBy(*pk).agg(F.sum("_n").alias("_total")), pk, "left")
        total = F.coalesce(F.col("_total"), F.col("_n"))
    complete = F.lit(True)
    for c in pk:
        complete = complete & F.col(c).isNotNull()
    again = complete & (total > 1)
    if target is None:
        keys = keys.withColumn(IN_TARGET, F.lit(False))
    else:
        there = _target_keys(checked, target, pk, range_key).withColumn(IN_TARGET, F.lit(True))
        keys = keys.join(there, pk, "left").withColumn(IN_TARGET, F.coalesce(IN_TARGET, F.lit(False)))
    reasons = F.concat(F.flatten(F.transform("_why", lambda w: F.split(w, ";"))),
                       F.when(again, F.array(F.lit("duplicate_key"))).otherwise(F.array().cast("array<string>")),
                       F.when(F.col(IN_TARGET), F.array(F.lit("key_in_target")))
                       .otherwise(F.array().cast("array<string>")))
    return keys.select(unit, F.when(again | F.col(IN_TARGET), F.col("_n")).otherwise(F.col("_bad")).alias("bad_rows"),
                       reasons.alias("why"))


def full_refresh_rows(df: DataFrame, contract: Contract, strict_flag: str | None = None) -> DataFrame:
    """A15 / A22 semantics: the load is all-or-nothing. Returns the typed rows when no row
    violates the contract or the primary key, otherwise an empty frame: the insert failed
    after the table was emptied. A row that ``strict_flag`` marks (an unparsed date) raises
    when the plan runs, as parsing comes before the table is touched; the old table stays
    (``full_refresh`` stages the rows first)."""
    if strict_flag is not None:
        failure = F.raise_error(F.lit(f"strict parsing failed ({strict_flag}): the table is left as it is"))
        df = df.filter(F.when(F.col(strict_flag), failure.cast("boolean")).otherwise(F.lit(True)))
    bad = full_refresh_rejects(df, contract).select(F.count(F.lit(1))).scalar()
    return enforce_contract(df, contract).filter(bad == 0).select(*contract.columns)


def full_refresh_rejects(df: DataFrame, contract: Contract) -> DataFrame:
    """The keys that make a full refresh fail: primary key, ``bad_rows``, ``reasons``."""
    pk = contract.pk
    keys = enforce_contract(df, contract).groupBy(*pk).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~is_clean()).alias("_bad"),
        F.collect_set(F.nullif(F.col(REASONS), F.lit(""))).alias("_why"))
    repeated = F.col("_n") > 1
    why = F.concat(F.col("_why"), F.when(repeated, F.array(F.lit("duplicate_key")))
                   .otherwise(F.array().cast("array<string>")))
    return keys.filter(repeated | (F.col("_bad") > 0)).select(
        *pk, F.when(repeated, F.col("_n")).otherwise(F.col("_bad")).alias("bad_rows"),
        F.array_join(F.array_sort(why), ";").alias("reasons"))


def full_refresh(df: DataFrame, path: str, staging: str) -> None:
    """A15 sink: replace the plain folder at ``path`` (which nobody reads meanwhile). The rows
    are written to ``staging`` first, so a plan that raises leaves the old table in place;
    ``refresh_commit`` also stands a job that ends while the table is replaced."""
    df.write.mode("overwrite").parquet(staging)
    df.sparkSession.read.parquet(staging).write.mode("overwrite").parquet(path)


def refresh_commit(df: DataFrame, path: str) -> int:
    """A15 sink: the versioned table at ``path`` becomes these rows in one commit. A job that
    ends before it, a plan that raises included, leaves the old table; readers keep theirs."""
    return versions.replace(df, path)


def append_atomic(new: DataFrame, target: DataFrame | None, contract: Contract, unit: str,
                  bad_flag: str | None = None, range_key: str | None = None):
    """Insert-only load committed per ``unit``; a unit with any bad row (contract
    violation, strict-date failure, key already in target, key repeated within the
    load) is rolled back whole. Returns (accepted rows, failed units with reasons).

    The verdict takes one pass over the feed, the accepted rows another."""
    checked = _flagged(new, contract, bad_flag)
    failed = (_keys(checked, target, contract.pk, unit, range_key).filter(F.col("bad_rows") > 0)
              .groupBy(unit).agg(F.sum("bad_rows").alias("bad_rows"),
                                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("why")))).alias("reasons")))
    accepted = checked.join(failed.select(unit), unit, "left_anti")
    return accepted.select(*contract.columns), failed


def append_prefix(new: DataFrame, target: DataFrame | None, contract: Contract, unit: str,
                  order: str, batch_size: int = 1000, block_rows: int = 1 << 20,
                  range_key: str | None = None):
    """Rows of each unit in ``order``, cut into batches of ``batch_size``; every
    batch commits on its own; the first bad batch is rolled back and ends the unit,
    earlier batches stay. A repeated key fails in the batch of its second occurrence.
    Returns (accepted rows, failed (unit, first_bad_batch, dropped_rows)).

    The feed's keys are read once for the bad rows and, of units that have one, once more for
    their counts; the rows themselves are read once. A key's first two rows tell where it comes back; all other rows are
    dropped before the shuffle (a row limit per key), so a key repeated across a third of
    the load is no task's work. Rows are counted per (unit, block of ``order`` values) and the
    blocks' counts carried on, in units that have a bad row alone: the blocks before the
    bad row's give its position by their sums, and of one block rows are numbered to find
    the ``order`` value that the last kept batch ends with."""
    pk = contract.pk
    checked = _flagged(new, contract, None)
    keys = checked.select(unit, *[c for c in pk if c != unit], F.col(order).alias("_o"),
                          (~is_clean()).alias("_bad"))
    by = list(dict.fromkeys([*pk, unit]))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_o"))
    marked = keys.withColumn("_n", place).filter(F.col("_n") <= 2)
    again = F.col("_n") > 1
    if unit not in pk:  # the key may come back in another unit
        again = F.col("_o") > F.min("_o").over(Window.partitionBy(*pk))
    marked = marked.withColumn("_bad", F.col("_bad") | again)
    if target is not None:
        there = _target_keys(keys, target, pk, range_key).distinct().withColumn(IN_TARGET, F.lit(True))
        marked = marked.join(there, pk, "left").withColumn("_bad", F.col("_bad") | F.col(IN_TARGET).isNotNull())
    block = F.floor(F.col("_o") / F.lit(block_rows))
    stops = (marked.filter("_bad").groupBy(unit).agg(F.min("_o").alias("_stop"))
             .withColumn("_stop_block", F.floor(F.col("_stop") / F.lit(block_rows))))
    rows = keys.select(unit, "_o", block.alias("_block")).join(stops, unit)
    counts = rows.groupBy(unit, "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("_o") < F.col("_stop")).alias("_before"))
    # one row per (unit, block): what the unit holds up to the block, and how much of it stays
    ahead = Window.partitionBy(unit).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(unit)
    counts = counts.select(
        unit, "_block", "_rows", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"),
        F.floor(F.sum("_before").over(whole) / batch_size).alias("first_bad_batch"),
        F.sum("_rows").over(whole).alias("_all"))
    keep = F.col("first_bad_batch") * batch_size
    last = counts.filter((F.col("_ahead") < keep) & (keep <= F.col("_ahead") + F.col("_rows"))) \
        .select(unit, "_block", (keep - F.col("_ahead")).alias("_at"))
    inside = Window.partitionBy(unit, "_block").orderBy("_o")
    ends = (rows.select(unit, "_block", "_o").join(last, [unit, "_block"])
            .withColumn("_rn", F.row_number().over(inside)).filter(F.col("_rn") == F.col("_at"))
            .select(unit, F.col("_o").alias("_last")))
    failed = counts.groupBy(unit).agg(F.first("first_bad_batch").alias("first_bad_batch"),
                                      F.first("_all").alias("_all"))
    verdict = failed.join(ends, unit, "left").select(unit, "_last", F.lit(True).alias("_stopped"))
    accepted = (checked.join(verdict, unit, "left")
                .filter(F.col("_stopped").isNull() | (F.col(order) <= F.col("_last"))).select(*contract.columns))
    return accepted, failed.select(
        unit, "first_bad_batch", (F.col("_all") - F.col("first_bad_batch") * batch_size).alias("dropped_rows"))


def upsert(target: DataFrame | None, src: DataFrame, contract: Contract, seq: str | list[str],
           range_key: str | None = None):
    """MERGE on the primary key applied row by row in ``seq`` order: a row that
    violates the contract is skipped (and reported), otherwise the last row per key
    replaces the target row or is inserted. The winner per key is a ``max_by`` over
    ``seq`` (partial aggregation, no sort of a whole key group). Target rows whose key the
    winners' key filter rules out pass as they are read; only the others are joined, and
    with ``range_key`` (a date of the key) those on the winners' dates alone. Returns (new target, rejected rows with reason)."""
    checked = enforce_contract(src, contract)
    rejects = checked.filter(~is_clean()).withColumnRenamed(REASONS, "reason")
    pk = contract.pk
    rest = [c for c in contract.columns if c not in pk]
    order = F.struct(*seq) if isinstance(seq, list) else F.col(seq)
    # skipped rows have no order, so they never win. A filter would do the same, but the
    # optimiser restates its long condition for every subset of the typed columns.
    win = (checked.groupBy(*pk).agg(F.max_by(F.struct(*rest), F.when(is_clean(), order)).alias("_w"))
           .filter(F.col("_w").isNotNull()))
    winners = win.select(*pk, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*contract.columns)
    if target is None:
        return winners, rejects
    typed = target.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields])
    hit = may_hold(key_bits(winners, pk), pk)
    if range_key is not None:
        hit = _on_dates(win, range_key) & hit
    kept = typed.filter(hit).join(winners.select(*pk), pk, "left_anti")
    return typed.filter(~hit).unionByName(kept).unionByName(winners), rejects


def merge_into_path(spark: SparkSession, path: str, src: DataFrame, contract: Contract, seq: str | list[str],
                    partition: Column, staging: str) -> DataFrame:
    """A18 sink: MERGE ``src`` into the table at ``path``, partitioned by the column that
    ``partition`` names (an expression over key columns, with an alias). Only partitions
    that the rows of ``src`` fall into are read and rewritten. The merged rows go to
    ``staging`` first (never overwrite the path being read), then replace the matching
    partitions. Returns the rejected rows. For a plain partitioned folder; ``merge_commit``
    does the same in one commit."""
    valid = enforce_contract(src, contract).filter(is_clean())
    touched = valid.select(partition).distinct()
    name = touched.columns[0]
    # a join on the partition column: Spark prunes the scan to the partitions on the other side
    in_scope = spark.read.parquet(path).join(touched, name, "left_semi")
    merged, rejects = upsert(in_scope, src, contract, seq)
    merged.withColumn(name, partition).write.mode("overwrite").partitionBy(name).parquet(staging)
    (spark.read.parquet(staging).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path))
    return rejects


def merge_commit(spark: SparkSession, path: str, src: DataFrame, contract: Contract, seq: str | list[str],
                 partition: Column) -> DataFrame:
    """A18 sink: MERGE ``src`` into the versioned table at ``path`` in one commit.

    ``partition`` is an expression over key columns. Partitions that the rows of ``src`` fall
    into are read and written anew, the others belong to the new commit as they are. A
    job that ends before the commit leaves the old table, so it may just run again.
    Returns the rejected rows."""
    names = enforce_contract(src, contract).filter(is_clean()).select(versions.partition_name(partition).alias("p"))
    in_scope = versions.touched(spark, path, names, contract.schema)
    merged, rejects = upsert(in_scope, src, contract, seq)
    versions.replace_partitions(merged, path, partition)
    return rejects


def load_report(offered: DataFrame, inserted: DataFrame, unit: str) -> DataFrame:
    """Per unit the rows that the load offered, inserted and rejected."""
    one, none = F.lit(1), F.lit(0)
    both = (offered.select(unit, one.alias("o"), none.alias("i"))
            .unionByName(inserted.select(unit, none.alias("o"), one.alias("i"))))
    return both.groupBy(unit).agg(F.sum("o").alias("offered"), F.sum("i").alias("inserted"),
                                  F.sum(F.col("o") - F.col("i")).alias("rejected"))


def on_list(feed: DataFrame, codes: DataFrame | None, code: str = "code") -> DataFrame:
    """The feed's rows whose code is on the vendor's list (all, without a list)."""
    return feed if codes is None else feed.join(codes.select(code).distinct(), code, "left_semi")


def listed_without_data(codes: DataFrame, feed: DataFrame, code: str = "code") -> DataFrame:
    """Listed codes for which the feed has no row."""
    return codes.select(code).distinct().join(feed.select(code).distinct(), code, "left_anti")


def report_periods(y0: int = 2009, y1: int = 2025) -> list[str]:
    """The half-year report dates requested by the dividend load, as parameters."""
    return [f"{y}{md}" for y in range(y0, y1 + 1) for md in ("0630", "1231")]


def period_spine(spark: SparkSession, y0: int = 2009, y1: int = 2025) -> DataFrame:
    """Half-year report dates (yyyyMMdd text, June 30 and December 31) for y0..y1."""
    years = spark.range(y0, y1 + 1).select(F.col("id").cast("int").alias("y"))
    return years.select(F.explode(F.array(
        F.concat(F.col("y").cast("string"), F.lit("0630")),
        F.concat(F.col("y").cast("string"), F.lit("1231")))).alias("report_date"))


def missing_periods(present: DataFrame, spine: DataFrame, col: str = "report_date") -> DataFrame:
    """Spine periods with no data (the reference skips them)."""
    return spine.join(present.select(col).distinct(), col, "left_anti")


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a derived table in one commit and continue from the written copy (cuts lineage)."""
    commit = versions.replace(df, path)
    return versions.read(df.sparkSession, path, commit=commit, schema=df.schema)
