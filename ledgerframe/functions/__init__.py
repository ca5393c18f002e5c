"""Column-level helpers: cleaning (A4-A13) and output normalisation."""
