"""Readers: landed vendor files (A1) and the bridge from the driver's test tables."""
