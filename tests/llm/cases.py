"""Documents with the awkward cases that every operator must take, and small helpers."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and onha tion reer stan inwh thea bleou edan orsh quemi étre für niñ zu la".split()


def prose(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def rows(n: int = 60, seed: int = 1) -> list[tuple[int, str | None]]:
    """(doc_id, text): prose, copies, near copies, null, empty, blank and one very long text."""
    draw = random.Random(seed)
    out: list[tuple[int, str | None]] = []
    for k in range(n):
        text: str | None = prose(draw, draw.randrange(1, 160))
        if k % 7 == 3:
            text = out[draw.randrange(len(out))][1]
        elif k % 7 == 5 and out[-1][1]:
            words = out[-1][1].split(" ")
            words[draw.randrange(len(words))] = "changed"
            text = " ".join(words)
        out.append((3 * k - 20, text))
    return [*out, (1000, None), (1001, ""), (1002, " \n\t "), (1003, prose(draw, 20_000))]


def documents(spark: SparkSession, found: list[tuple[int, str | None]]) -> DataFrame:
    """With the columns of the given table; in three partitions."""
    full = [(d, t, "en", f"src{(d or 0) % 3}", len(t or "")) for d, t in found]
    return spark.createDataFrame(full, COLUMNS).repartition(3, "doc_id")


def crowded(docs: DataFrame, *names: str) -> DataFrame:
    """With more columns, named like those that operators add."""
    return docs.withColumns({n: F.lit(n) for n in names})


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)


def as_dict(df: DataFrame) -> dict:
    found = [r.asDict() for r in df.collect()]
    out = {r["doc_id"]: r for r in found}
    assert len(out) == len(found)
    return out
