"""Column-level cleaning of vendor frames (A4-A13). All are native column
expressions, so they run inside whole-stage codegen; no Python per row."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

# Exchange code prefixes (first three digits of a six-digit code).
SSE_PREFIXES = ("600", "601", "603", "605", "688", "689")   # -> "sh" + code
SZSE_PREFIXES = ("000", "001", "002", "003", "300", "301")  # -> "sz" + code


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """A4: vendor header -> schema name; unknown headers are left as they are."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def positional_rename(df: DataFrame, names: list[str]) -> DataFrame:
    """A4: rename by position (the index feed has no usable headers)."""
    return df.toDF(*names)


def venue_symbol(code: str | Column) -> Column:
    """A5: 'sh'/'sz' + code for listed prefixes, NULL for anything else."""
    c = F.col(code) if isinstance(code, str) else code
    p = F.substring(c, 1, 3)
    return (F.when(p.isin(*SSE_PREFIXES), F.concat(F.lit("sh"), c))
            .when(p.isin(*SZSE_PREFIXES), F.concat(F.lit("sz"), c)))


def venue_symbols(df: DataFrame, code_col: str = "code", out: str = "symbol") -> DataFrame:
    """A5: tag each code with its venue symbol and drop unlisted codes."""
    return df.withColumn(out, venue_symbol(code_col)).filter(F.col(out).isNotNull())


def distinct_codes(df: DataFrame, code_col: str = "code") -> DataFrame:
    """One row per code."""
    return df.dropDuplicates([code_col])


def lenient_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text -> double; text that is not a number becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as double)") for c in cols})


def lenient_date(df: DataFrame, cols: list[str]) -> DataFrame:
    """A8 lenient: text -> date, unparseable text becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as date)") for c in cols})


def strict_date(df: DataFrame, cols: list[str], flag: str = "_bad_date") -> DataFrame:
    """A8 strict: parse like ``lenient_date`` but mark rows whose non-null text did not
    parse; the load operators turn the mark into a failure of the row's load unit."""
    bad = F.lit(False)
    for c in cols:
        parsed = F.expr(f"try_cast(`{c}` as date)")
        bad = bad | (F.col(c).isNotNull() & parsed.isNull())
    return df.withColumn(flag, bad).withColumns({c: F.expr(f"try_cast(`{c}` as date)") for c in cols})


def per_share(df: DataFrame, cols: list[str], per: int = 10) -> DataFrame:
    """A9: 'per 10 shares' ratios -> per share."""
    return df.withColumns({c: F.col(c) / F.lit(per) for c in cols})


def round_to_scale(df: DataFrame, scales: dict[str, int]) -> DataFrame:
    """A10: half-even rounding (the vendor side rounds half to even); scale 0 gives an
    integral value for share counts."""
    return df.withColumns({c: F.bround(F.col(c), s) for c, s in scales.items()})


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN -> SQL NULL."""
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols})


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose key did not parse."""
    return df.dropna(subset=keys)


def stamp(df: DataFrame, ts: _dt.datetime | str | None = None, col: str = "update_time") -> DataFrame:
    """Load timestamp; pass ``ts`` for reproducible output."""
    if ts is None:
        return df.withColumn(col, F.current_timestamp())
    return df.withColumn(col, F.lit(str(ts)).cast("timestamp"))
