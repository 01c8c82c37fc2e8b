"""A parameter table as one value: an array of buckets, each a map from key to value.

The table reaches every task as a scalar subquery, so a look-up is an expression and not a join:
nothing is read while the plan is built, rows are neither shuffled nor multiplied, and any number
of look-ups costs one pass over the table. Its size is checked when it is built; larger tables are
refused and have to be joined.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a bucket, on average.
ENTRIES = 4
#: A dictionary of more entries than this is refused: where a step runs without generated code, rows
#: carry it from one step to the next.
MOST_ENTRIES = 5_000
#: Between the parts of a key; a control character that codes do not hold.
SEPARATOR = "\x1f"


def key(*parts: Column) -> Column:
    """One text of all parts; null if any is null, so that it matches nothing, as in a join."""
    texts: list[Column] = []
    for part in parts:
        texts += [F.lit(SEPARATOR), part.cast("string")]
    return F.concat(*texts[1:]) if texts else F.lit("")


def dictionary(rows: DataFrame, k: Column, value: Column, what: str) -> Column:
    """The rows as one value, a scalar subquery. Keys must differ; null keys are left out."""
    n = f"cast(greatest(size(es) div {ENTRIES}, 1) AS int)"
    filled = (
        f"transform(sequence(0, {n} - 1), b -> map_from_entries(filter(es, "
        f"e -> pmod(xxhash64(e.k), {n}) = b)))"
    )
    refused = f"raise_error('{what} has more than {MOST_ENTRIES} entries; join it instead')"
    return (
        rows.select(k.alias("k"), value.alias("v"))
        .filter("k IS NOT NULL")
        .agg(F.expr("collect_list(struct(k, v)) AS es"))
        .select(F.expr(f"CASE WHEN size(es) <= {MOST_ENTRIES} THEN {filled} ELSE {refused} END"))
        .scalar()
    )


def look_up(df: DataFrame, entries: Column, keys: Mapping[str, Column]) -> DataFrame:
    """Add a column for each key: its value in a dictionary, null where it has none or is null.

    Keys become columns of their own first, so that each is made once and is no common part of
    larger expressions, for which generated code can fail on wide rows. The dictionary is a column
    between two steps of generated code only, and is as small as its table.
    """
    own = {c: f"_llave_{c}" for c in keys}
    ready = df.withColumns({"_diccionario": entries, **{own[c]: k for c, k in keys.items()}})
    found = {
        c: F.expr(
            f"element_at(get(_diccionario, cast(pmod(xxhash64({k}), size(_diccionario)) AS int)), {k})"
        )
        for c, k in own.items()
    }
    return ready.withColumns(found).drop("_diccionario", *own.values())
