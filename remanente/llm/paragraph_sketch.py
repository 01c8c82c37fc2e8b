"""Document fingerprints that tell how far two versions differ: invertible Bloom lookup sketches.

A sketch has three parts of ``width`` cells. Each distinct paragraph digest goes to one cell of every
part; a cell keeps how many digests it holds and the exclusive-or of them and of their checks. The
sketches of two versions subtract cell by cell, what both hold cancels out, and peeling recovers the
digests that only one of them has: a cell with one digest gives it away, and taking it out of its
other cells frees further ones. Pairs whose cells do not peel are sketched again, WIDER times wider.
Likeness is the share of common paragraphs among all paragraphs of both.

A paragraph is a line with more than blanks. Null text counts as empty, without paragraphs; two texts
without paragraphs have likeness 1. A single document is its own next one. Null doc_ids come last in
descending order; rows that share a doc_id follow the hash of their texts, and each gives its row.
Only doc_id and text are used, so other columns cannot clash. An empty table gives no rows. Only
DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remanente.llm.common import texts, written

PARTS = 3
#: Cells of a part of the fingerprint, factor of each retry, and rounds of peeling in each try.
WIDTH, WIDER, ROUNDS = 32, 8, 6

_LEAST = -(2**63)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.trim(line)) > 0)
    return F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))


def check_of(key: Column) -> Column:
    return F.hash(key, F.lit("check"))


def cell_of(key: Column, part: int, width: int) -> Column:
    return (part * width + F.pmod(F.xxhash64(key, F.lit(part), F.lit(width)), F.lit(width))).cast(
        "int"
    )


def ranges(docs: DataFrame) -> tuple[list[int], list[int | None]]:
    """Lower bounds of ranges of ids with about as many rows each, and the largest id of each.

    The number of ranges follows the number of shuffle partitions, not the data.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n for k in range(1, n)]
    found = docs.agg(F.percentile_approx("k", shares, 100 * n)).first()[0] or []
    bounds = sorted(set(found))
    most = docs.groupBy(range_of(F.col("k"), bounds).alias("r")).agg(F.max("k").alias("k"))
    largest: list[int | None] = [None] * (len(bounds) + 1)
    for row in most.collect():
        largest[row["r"]] = row["k"]
    return bounds, largest


def range_of(k: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``k``, by halving."""
    if not bounds:
        return F.lit(0)
    steps = [1 << s for s in range(len(bounds).bit_length() - 1, -1, -1)]
    every = F.lit(bounds)

    def further(at: Column, step: Column) -> Column:
        to = at + step
        fits = (to <= len(bounds)) & (F.get(every, to - 1) <= k)
        return F.when(fits, to).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), further)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, paragraphs, and those of the next document in descending doc_id.

    Each range of ids is sorted on its own. It also gets the first documents of the next range, as
    what its last one continues with; the lowest range gets those of the highest.
    """
    keyed = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("k"),
    )
    bounds, largest = ranges(keyed.select("k"))
    full = [r for r, k in enumerate(largest) if k is not None]
    above: list[int | None] = [None] * len(largest)
    for place, r in enumerate(full):
        above[r] = full[(place + 1) % len(full)]  # the highest one leads to the lowest
    row = keyed.withColumns(
        {
            "r": range_of(F.col("k"), bounds),
            "paragraphs": digests(F.col("text")),
            "h": F.xxhash64("text"),
        }
    )
    is_first = F.get(F.lit([k if k is not None else _LEAST for k in largest]), F.col("r")) == F.col("k")
    target = F.get(F.lit([r or 0 for r in above]), F.col("r"))
    own = F.struct(F.col("r").alias("r"), F.lit(False).alias("lent"))
    lent = F.struct(target.alias("r"), F.lit(True).alias("lent"))
    dealt = row.withColumn("to", F.explode(F.when(is_first, F.array(own, lent)).otherwise(F.array(own))))
    order = Window.partitionBy("to.r").orderBy(F.col("to.lent"), F.col("k").desc(), "h")
    following = F.lead(F.struct("text", "paragraphs")).over(order)
    return (
        dealt.withColumn("following", following)
        .where(~F.col("to.lent"))
        .select("doc_id", "text", "paragraphs", "following")
    )


def versions(docs: DataFrame) -> DataFrame:
    """rid, doc_id, n_chars, edited_sha256, and the paragraphs of the text, its edit and the next."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"),
        F.col("following.text").substr(F.lit(1), cut),
    )
    found = with_next(docs).withColumn("edited", edited)
    return written(
        found.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            n.cast("long").alias("n_chars"),
            F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
            F.col("paragraphs").alias("own"),
            digests(F.col("edited")).alias("edited"),
            F.col("following.paragraphs").alias("next"),
        ),
        "versions",
    )


SIDES = ("own", "edited", "next")


def sketches(rows: DataFrame, width: int, sides: tuple[str, ...] = SIDES) -> DataFrame:
    """rid, cell, and for each side n_, key_, check_: one row for each cell in use."""
    items = (
        rows.select("rid", F.posexplode(F.array(*sides)).alias("side", "keys"))
        .select("rid", "side", F.explode("keys").alias("key"))
        .select(
            "rid",
            "side",
            "key",
            check_of(F.col("key")).alias("check"),
            F.explode(
                F.array(*[cell_of(F.col("key"), p, width) for p in range(PARTS)])
            ).alias("cell"),
        )
    )
    sums = []
    for k, side in enumerate(sides):
        mine = F.col("side") == k
        sums += [
            F.count(F.when(mine, 1)).alias(f"n_{side}"),
            F.coalesce(F.bit_xor(F.when(mine, F.col("key"))), F.lit(0)).alias(f"key_{side}"),
            F.coalesce(F.bit_xor(F.when(mine, F.col("check"))), F.lit(0)).alias(f"check_{side}"),
        ]
    return items.groupBy("rid", "cell").agg(*sums)


def differences(cells: DataFrame) -> DataFrame:
    """rid, pair (0: own and edited, 1: own and next) and the cells in which they differ."""
    pairs = [
        F.struct(
            F.lit(k).alias("pair"),
            (F.col("n_own") - F.col(f"n_{side}")).alias("n"),
            F.col("key_own").bitwiseXOR(F.col(f"key_{side}")).alias("key"),
            F.col("check_own").bitwiseXOR(F.col(f"check_{side}")).alias("check"),
        )
        for k, side in enumerate(SIDES[1:])
    ]
    found = cells.select("rid", "cell", F.explode(F.array(*pairs)).alias("x"))
    return found.select("rid", "x.pair", "cell", "x.n", "x.key", "x.check").where(
        "n <> 0 OR key <> 0 OR check <> 0"
    )


def peeled(cells: DataFrame, width: int, rounds: int = ROUNDS) -> DataFrame:
    """rid, pair, left (cells that did not peel), only_own, only_other.

    A row is a cell (tag 0) or a recovered digest (tag 1). In each round cells with one digest give
    it away, once each; then it is taken out of all its cells. All rows of a pair stay in one place.
    """
    plain = ["tag", "id", "n", "key", "check", "fresh"]

    def row(*values: Column | int) -> Column:
        kinds = ("int", "long", "long", "long", "int", "int")
        return F.struct(
            *[
                (v if isinstance(v, Column) else F.lit(v)).cast(kind).alias(name)
                for name, v, kind in zip(plain, values, kinds, strict=True)
            ]
        )

    n, key, check = F.col("n"), F.col("key"), F.col("check")
    rows = cells.select("rid", "pair", row(0, F.col("cell"), n, key, check, 0).alias("x"))
    rows = rows.select("rid", "pair", "x.*")
    same = row(*[F.col(c) for c in plain])
    group = ["rid", "pair", "tag", "id"]
    for _ in range(rounds):
        single = (F.col("tag") == 0) & (F.abs(n) == 1) & (check == check_of(key))
        given = F.array(same, row(1, key, n, key, check, 1))
        rows = (
            rows.select("rid", "pair", F.explode(F.when(single, given).otherwise(F.array(same))).alias("x"))
            .select("rid", "pair", "x.*")
            .groupBy(*group)
            .agg(*[F.max(c).alias(c) for c in plain[2:]])
        )
        taken = [row(0, cell_of(key, p, width), -n, key, check, 0) for p in range(PARTS)]
        out = F.array(row(1, F.col("id"), n, key, check, 0), *taken)
        rows = (
            rows.select(
                "rid", "pair", F.explode(F.when(F.col("fresh") == 1, out).otherwise(F.array(same))).alias("x")
            )
            .select("rid", "pair", "x.*")
            .groupBy(*group)
            .agg(
                F.sum("n").alias("n"),
                F.bit_xor("key").alias("key"),
                F.bit_xor("check").alias("check"),
                F.max("fresh").alias("fresh"),
            )
            .where("tag = 1 OR n <> 0 OR key <> 0 OR check <> 0")
        )
    return rows.groupBy("rid", "pair").agg(
        F.count(F.when(F.col("tag") == 0, 1)).alias("left"),
        F.count(F.when((F.col("tag") == 1) & (n > 0), 1)).alias("only_own"),
        F.count(F.when((F.col("tag") == 1) & (n < 0), 1)).alias("only_other"),
    )


def compared(rows: DataFrame) -> DataFrame:
    """rid, pair, only_own, only_other for all pairs that differ; wider sketches where peeling fails."""
    width, todo, done = WIDTH, rows.select("rid", *SIDES), []
    while True:
        dealt = todo.repartition("rid")
        tried = written(peeled(differences(sketches(dealt, width)), width), "peeled")
        done.append(tried.where("left = 0").drop("left"))
        failed = tried.where("left > 0").select("rid", "pair")
        if failed.isEmpty():
            break
        # A pair that has peeled is left out by giving it no other side.
        each = failed.groupBy("rid").agg(F.collect_set("pair").alias("pairs"))
        again = todo.join(each, "rid")
        for k, side in enumerate(SIDES[1:]):
            open_ = F.array_contains("pairs", k)
            again = again.withColumn(side, F.when(open_, F.col(side)).otherwise(F.col("own")))
        todo = written(again.drop("pairs"), "unpeeled")
        width *= WIDER
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def as_text(cells: DataFrame) -> DataFrame:
    """rid, fingerprint, edited_fingerprint: the cells in use, in order, as text."""

    def shown(side: str) -> Column:
        cell = F.struct("cell", f"n_{side}", f"key_{side}", f"check_{side}")
        used = F.array_sort(F.collect_list(F.when(F.col(f"n_{side}") > 0, cell)))
        parts = F.transform(
            used,
            lambda c: F.concat_ws(
                ".", c["cell"], c[f"n_{side}"], F.hex(c[f"key_{side}"]), F.hex(c[f"check_{side}"])
            ),
        )
        return F.concat_ws(":", F.lit(str(WIDTH)), F.array_join(parts, ","))

    return cells.groupBy("rid").agg(
        shown("own").alias("fingerprint"), shown("edited").alias("edited_fingerprint")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = versions(texts(docs))
    found = written(compared(rows), "compared")
    dealt = rows.repartition("rid")
    only = found.groupBy("rid").agg(
        *[
            F.sum(F.when(F.col("pair") == k, F.col(c))).alias(f"{c}_{k}")
            for k in (0, 1)
            for c in ("only_own", "only_other")
        ]
    )
    prints = as_text(sketches(dealt, WIDTH, SIDES[:2]))

    def likeness(k: int) -> Column:
        own = F.size("own").cast("double")
        gone, more = (F.coalesce(f"only_{c}_{k}", F.lit(0)) for c in ("own", "other"))
        return F.when(own + more == 0, 1.0).otherwise((own - gone) / (own + more))

    empty = F.lit(f"{WIDTH}:")
    return dealt.join(prints, "rid", "left").join(only, "rid", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", empty).alias("fingerprint"),
        F.coalesce("edited_fingerprint", empty).alias("edited_fingerprint"),
        likeness(0).alias("near_edited"),
        likeness(1).alias("near_next"),
    )
