"""CTE assembly for the oracles."""

from __future__ import annotations


def with_ctes(ctes: dict[str, str], names: list[str], body: str, **extra: str) -> str:
    """``WITH <named bridge ctes>, <extra ctes> <body>`` (order of ``names`` kept)."""
    parts = [f"{n} AS ({ctes[n]})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
