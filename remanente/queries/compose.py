"""Put the common table expressions a statement reads in front of it."""

from __future__ import annotations

import re
from collections.abc import Mapping

_SOURCES = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)", re.IGNORECASE)


def with_tables(statement: str, *catalogues: Mapping[str, str]) -> str:
    """``statement`` with every table it reads, directly or not, from the catalogues."""
    known = {name: sql for c in catalogues for name, sql in c.items()}
    ordered: dict[str, str] = {}

    def visit(sql: str) -> None:
        for name in _SOURCES.findall(sql):
            if name in known and name not in ordered:
                visit(known[name])
                ordered[name] = known[name]

    visit(statement)
    if not ordered:
        return statement
    tables = ",\n".join(f"{n} AS (\n{sql.strip()}\n)" for n, sql in ordered.items())
    return f"WITH {tables}\n{statement.strip()}"
