"""Row numbers over a whole table and exact shares of strata, spread over tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import pin
from .joins import small_side

IN_PARTITION = (1 << 33) - 1
# Copies written out by one task at a time.
CHUNK = 1_000_000


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "seq") -> DataFrame:
    """1, 2, 3, ... over the whole table in ``order``.

    The table is range-sorted once and kept in the shared folder; a row's number
    is its position in its partition plus the sizes of the partitions before.
    The last sort key is a seeded random number, so that equal rows, however
    many, can be cut between partitions.
    """
    numbered = (
        df.withColumn("_tie", F.rand(17))
        .orderBy(*order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    numbered = pin(numbered)
    part = F.shiftright(F.col("_at"), 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition of the sort: a few thousand at most.
    before = F.coalesce(
        F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = small_side(pin(sizes.select("_part", before.alias("_offset"))))
    return (
        numbered.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, F.col("_offset") + F.col("_at").bitwiseAND(F.lit(IN_PARTITION)) + 1)
        .drop("_part", "_at", "_offset")
    )


def hash_order(key: Sequence[str], columns: Sequence[str]) -> Column:
    """md5 text of the key columns: a fixed, random-like order of rows.

    Rows without a single key are ordered by all their ``columns``, so that
    they spread over hashes like other rows and none is without a place.
    """
    whole = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    if len(key) == 1:
        return F.coalesce(F.md5(F.col(key[0]).cast("string")), whole)
    return F.md5(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}))


def quota_split(
    df: DataFrame,
    strata: Sequence[str],
    fractions: Mapping[str, float],
    rest: str = "train",
    key: Sequence[str] | None = None,
    out: str = "part",
) -> DataFrame:
    """Split every stratum into parts of exact size, in hash order of ``key``.

    With n rows in a stratum, the first round(f1 * n) rows in md5 order go to
    the first part, the next up to round((f1 + f2) * n) to the second, and so
    on; the remaining rows are ``rest``. ``key`` should identify a row (by
    default it is the whole row).

    A stratum is never sorted. Two passes over strata and key alone find the
    hash at which each boundary falls: rows are counted per 16-bit hash prefix,
    then per hash inside the prefix that holds the boundary. The full rows are
    only compared with those hashes. A boundary inside a group of equal hashes
    is settled by ``_split_ties``.
    """
    strata, columns, names = list(strata), df.columns, list(fractions)
    keyed = df.withColumn("_hash", hash_order(list(key or columns), columns))
    slim = keyed.select(*strata, "_hash", F.substring("_hash", 1, 4).alias("_prefix"))
    numbers = range(len(names))
    cumulative = [sum(list(fractions.values())[: i + 1]) for i in numbers]

    group = Window.partitionBy(*strata)
    counts = pin(slim.groupBy(*strata, "_prefix").agg(F.count(F.lit(1)).alias("_n")))
    ranked = counts.withColumns({
        "_upto": F.sum("_n").over(group.orderBy("_prefix")),
        "_rows": F.sum("_n").over(group),
    })
    cuts = [F.round(F.lit(c) * F.col("_rows")).cast("bigint") for c in cumulative]

    def holds(cut: Column) -> Column:
        return (cut > F.col("_upto") - F.col("_n")) & (cut <= F.col("_upto"))

    # No hash is empty, so an empty one stands for a cut before the first row.
    nowhere = F.struct(F.lit("").alias("at"), F.lit(0).cast("bigint").alias("take"), F.lit(0).cast("bigint").alias("size"))

    def place(cut: Column, name: str) -> Column:
        """Where a cut falls: a prefix or hash, and its rows before the cut."""
        here = F.struct(F.col(name).alias("at"), (cut - F.col("_upto") + F.col("_n")).alias("take"), F.col("_n").alias("size"))
        return F.coalesce(F.max(F.when(holds(cut), here)), nowhere)

    prefixes = ranked.groupBy(*strata).agg(*[place(cut, "_prefix").alias(f"_p{i}") for i, cut in enumerate(cuts)])
    prefixes = _per_stratum(prefixes, strata)
    near = _with_stratum(slim, prefixes, strata)
    near = near.where(reduce(lambda a, b: a | b, [F.col("_prefix") == F.col(f"_p{i}.at") for i in numbers]))
    # One value of the prefix columns per stratum, so any of them will do.
    hashes = near.groupBy(*strata, "_prefix", "_hash").agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(f"_p{i}").alias(f"_p{i}") for i in numbers]
    )
    inside = Window.partitionBy(*strata, "_prefix").orderBy("_hash")
    hashes = hashes.withColumn("_upto", F.sum("_n").over(inside))
    takes = [F.when(F.col("_prefix") == F.col(f"_p{i}.at"), F.col(f"_p{i}.take")) for i in numbers]
    found = hashes.groupBy(*strata).agg(*[place(take, "_hash").alias(f"_b{i}") for i, take in enumerate(takes)])
    # Every stratum has bounds, also one in which all cuts fall before the first row.
    same = reduce(lambda a, b: a & b, [F.col(f"_of_{s}").eqNullSafe(F.col(s)) for s in strata])
    bounds = pin(prefixes.join(found, same, "left").select(
        *[f"_of_{s}" for s in strata], *[F.coalesce(f"_b{i}", nowhere).alias(f"_b{i}") for i in numbers]
    ))

    located = _with_stratum(keyed, bounds, strata)
    part, tied = F, F.lit(False)
    for i, name in enumerate(names):
        b = F.col(f"_b{i}")
        whole = b["take"] == b["size"]
        part = part.when((F.col("_hash") < b["at"]) | ((F.col("_hash") == b["at"]) & whole), F.lit(name))
        tied = tied | ((F.col("_hash") == b["at"]) & ~whole)
    settled = located.withColumn(out, part.otherwise(F.lit(rest)))
    split_groups = reduce(lambda a, b: a | b, [F.col(f"_b{i}.take") != F.col(f"_b{i}.size") for i in numbers])
    if bounds.where(split_groups).isEmpty():
        return settled.select(*columns, out)
    return settled.where(~tied).select(*columns, out).unionByName(
        _split_ties(located.where(tied), columns, strata, [*names, rest], out)
    )


def _per_stratum(table: DataFrame, strata: Sequence[str]) -> DataFrame:
    """A table with one row per stratum, written once, its keys renamed for the join."""
    return pin(table.withColumnsRenamed({s: f"_of_{s}" for s in strata}))


def _with_stratum(rows: DataFrame, per_stratum: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Add a stratum's columns to its rows; NULL is a stratum like any other."""
    same = reduce(lambda a, b: a & b, [F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in strata])
    return rows.join(small_side(per_stratum), same).drop(*[f"_of_{s}" for s in strata])


def _split_ties(tied: DataFrame, columns: Sequence[str], strata: Sequence[str], names: Sequence[str], out: str) -> DataFrame:
    """Divide rows of equal hash between the parts.

    Copies of a row are equal, so the rows are reduced to distinct rows with a
    number of copies, divided as numbers, and written out again in chunks: a row
    that makes up a third of the table costs one counter, not one task.
    """
    cuts = len(names) - 1
    copies = tied.groupBy("_hash", *columns).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.any_value(f"_b{i}").alias(f"_b{i}") for i in range(cuts)]
    )
    order = Window.partitionBy(*strata, "_hash").orderBy(F.xxhash64(*columns))
    upto = copies.withColumn("_upto", F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start, end = F.col("_upto") - F.col("_copies"), F.col("_upto")

    def edge(i: int) -> Column:
        """Rows of this hash group that come before cut i."""
        b = F.col(f"_b{i}")
        return F.when(F.col("_hash") < b["at"], end).when(F.col("_hash") > b["at"], F.lit(0)).otherwise(b["take"]).cast("bigint")

    edges = [F.lit(0).cast("bigint"), *[edge(i) for i in range(cuts)], end]
    pieces = []
    for i, name in enumerate(names):
        size = F.least(edges[i + 1], end) - F.greatest(edges[i], start)
        pieces.append(F.struct(F.lit(name).alias("name"), F.greatest(size, F.lit(0)).alias("size")))
    shares = upto.select(*columns, F.explode(F.array(*pieces)).alias("_piece")).where("_piece.size > 0")
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_piece.size") - 1) / CHUNK))
    spread = shares.withColumn("_chunk", F.explode(chunks)).repartition("_chunk", *columns)
    last = F.least(F.col("_piece.size") - F.col("_chunk") * CHUNK, F.lit(CHUNK)).cast("bigint")
    again = spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), last)))
    return again.select(*columns, F.col("_piece.name").alias(out))
