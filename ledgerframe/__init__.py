"""ledgerframe: market-data ETL and portfolio / sales analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers for landed files and the bridge from the driver's test tables
functions  column-level cleaning helpers (rename, lenient casts, rounding, symbols)
operators  reusable multi-step operators (ordered prefix windows, contracts, loads, panels)
plans      the named analytics and load jobs, one function per registered query
streaming  intentionally empty: nothing in the reference is a stream
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
