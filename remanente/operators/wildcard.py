"""Best rule per row from a table whose key columns may hold ``'*'`` for any value.

A rule's shape says which of its key columns are wildcards. Within one shape a rule matches by
equality, so all rules of all shapes fit one dictionary keyed by shape and values, and the shapes
that occur are the bits of one number. Both reach the rows as scalar subqueries: a row looks up one
key per shape that occurs. There is no join, no row id, no fan-out, and nothing is read while the
plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.operators.dictionary import dictionary, key, look_up
from remanente.vocabulary import WILDCARD

#: A shape is a bit of one long number, so at most 2 ** 6 shapes.
MOST_WILD = 6


def wildcard_count(columns: Sequence[str]) -> Column:
    return sum((F.when(F.col(c) == WILDCARD, 1).otherwise(0) for c in columns), F.lit(0))


def _shape(columns: Sequence[str]) -> Column:
    """Number whose bit i says that column i holds a value to match."""
    bits = (F.when(F.col(c) != WILDCARD, 1 << i).otherwise(0) for i, c in enumerate(columns))
    return sum(bits, F.lit(0))


def best_rule(
    base: DataFrame,
    rules: DataFrame,
    exact: Sequence[str],
    wild: Sequence[str],
    choice: Column,
    into: str,
    highest: bool = False,
) -> DataFrame:
    """Add struct column ``into``: the lowest (or highest) ``choice`` among the matching rules.

    ``choice`` is a struct over the rule columns; its first fields rank the rules. Null matches
    nothing but a wildcard.
    """
    if len(wild) > MOST_WILD:
        raise ValueError(f"at most {MOST_WILD} columns may hold wildcards, not {len(wild)}")
    pick, extreme = (F.max, F.greatest) if highest else (F.min, F.least)
    shaped = rules.withColumn("_forma", _shape(wild))
    values = [F.when(F.col(c) == WILDCARD, WILDCARD).otherwise(F.col(c).cast("string")) for c in wild]
    per_key = (
        shaped.select(
            "_forma", key(F.col("_forma"), *[F.col(c) for c in exact], *values).alias("_k"), choice.alias("_v")
        )
        .filter(F.col("_k").isNotNull())
        .groupBy("_forma", "_k")
        .agg(pick("_v").alias("_v"))
    )
    occurring = per_key.agg(F.expr("bit_or(shiftleft(1L, _forma))")).scalar()
    buckets = dictionary(per_key, F.col("_k"), F.col("_v"), "a rule table")
    ready = base.withColumn("_formas", F.coalesce(occurring, F.lit(0).cast("long")))
    keys = {}
    for shape in range(1 << len(wild)):
        parts = [F.col(c) if shape >> i & 1 else F.lit(WILDCARD) for i, c in enumerate(wild)]
        occurs = F.getbit(F.col("_formas"), F.lit(shape)) == 1
        keys[f"_regla_{shape}"] = F.when(occurs, key(F.lit(shape), *[F.col(c) for c in exact], *parts))
    found = look_up(ready, buckets, keys)
    best = F.col("_regla_0") if len(keys) == 1 else extreme(*[F.col(c) for c in keys])
    # As the row of a generator, so that a later filter on the rule's values is not rewritten into
    # the look-ups of all shapes, whose implied conditions take the optimizer for ever to list.
    return found.select(*base.columns, F.explode(F.array(best)).alias(into))
