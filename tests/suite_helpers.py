"""Plain helpers of the tests; not in conftest.py, of which each test folder has its own."""


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
