"""A14 ``enforce_contract``: what the target database's DDL enforces at insert time
(type / precision, NOT NULL, VARCHAR length), evaluated as columns instead."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

REASONS = "_reasons"


@dataclass
class Contract:
    """Target table: typed schema (nullability = NOT NULL), primary key, text lengths."""
    schema: StructType
    pk: list[str]
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def enforce_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast every contract column with ``try_cast`` and collect violations per row in
    ``_reasons`` (';'-separated text, '' when the row is acceptable; ``concat_ws``
    skips the NULL checks and stays inside generated code):

    * ``invalid:<col>`` value present but not representable (bad text, decimal
      overflow, NaN / infinity into a decimal)
    * ``null:<col>``    NULL in a NOT NULL column (primary-key columns included)
    * ``length:<col>``  text longer than the declared VARCHAR length

    Columns outside the contract are kept untouched (load-unit ids, sequence numbers).
    Primary-key collisions depend on the load's failure scope and are handled by the
    load operators.
    """
    checks, typed = [], {}
    for f in contract.schema.fields:
        src = F.col(f"`{f.name}`")
        t = F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})")
        typed[f.name] = t
        checks.append(F.when(src.isNotNull() & t.isNull(), F.lit(f"invalid:{f.name}")))
        if not f.nullable or f.name in contract.pk:
            checks.append(F.when(src.isNull(), F.lit(f"null:{f.name}")))
        if f.name in contract.lengths:
            checks.append(F.when(F.length(src) > contract.lengths[f.name], F.lit(f"length:{f.name}")))
    reasons = F.concat_ws(";", *checks)
    return df.withColumn(REASONS, reasons).withColumns(typed)


def is_clean() -> F.Column:
    return F.col(REASONS) == F.lit("")


def add_reasons(*extra: F.Column) -> F.Column:
    """The row's reasons with further optional (NULL = absent) reason texts appended."""
    return F.concat_ws(";", F.nullif(F.col(REASONS), F.lit("")), *extra)


def split_contract(df: DataFrame, contract: Contract):
    """(good, rejects): typed rows that pass, and rows with a ``reason`` text."""
    checked = enforce_contract(df, contract)
    good = checked.filter(is_clean()).drop(REASONS)
    rejects = checked.filter(~is_clean()).withColumnRenamed(REASONS, "reason")
    return good, rejects
