"""Run a query in Spark and its SQL in DuckDB over the same files and compare the rows."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _types(con, name: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {name}").fetchall()}


def compare(spark_df, sql: str, con) -> dict:
    """Row counts, type differences and rows found on one side only, compared as text."""
    got = spark_df.toArrow()
    con.register("got_arrow", got)
    con.execute("CREATE OR REPLACE TEMP TABLE got AS SELECT * FROM got_arrow")
    con.unregister("got_arrow")
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    have, expect = _types(con, "got"), _types(con, "want")
    out = {
        "rows": con.execute("SELECT count(*) FROM got").fetchall()[0][0],
        "want_rows": con.execute("SELECT count(*) FROM want").fetchall()[0][0],
        "types": {
            c: (have.get(c), expect.get(c))
            for c in sorted(set(have) | set(expect))
            if have.get(c) != expect.get(c)
        },
    }
    if set(have) != set(expect):
        out["columns"] = sorted(set(have) ^ set(expect))
        return out
    cols = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in sorted(have))
    a, b = f"SELECT {cols} FROM got", f"SELECT {cols} FROM want"
    out["extra"] = con.execute(f"SELECT count(*) FROM ({a} EXCEPT ALL {b})").fetchall()[0][0]
    out["missing"] = con.execute(f"SELECT count(*) FROM ({b} EXCEPT ALL {a})").fetchall()[0][0]
    if out["extra"] or out["missing"]:
        out["sample_extra"] = con.execute(f"({a} EXCEPT ALL {b}) ORDER BY ALL LIMIT 3").fetchall()
        out["sample_missing"] = con.execute(f"({b} EXCEPT ALL {a}) ORDER BY ALL LIMIT 3").fetchall()
    return out


def matches(result: dict) -> bool:
    return (
        not result["types"]
        and "columns" not in result
        and not result.get("extra")
        and not result.get("missing")
    )
