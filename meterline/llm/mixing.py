"""Mixing sources to target weights over a domain, language and source tree.

Token budgets go down the tree. Among siblings, a node that has fewer tokens
than its share gives the rest to its siblings by their weights; only what no
sibling can use is missing higher up, because a node never gets more than its
subtree holds. Each leaf then takes whole epochs and the token prefix of one
more, in an order seeded for each epoch. All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin

LEVELS = ("domain", "lang", "source")
# Weights of the nodes by level; others weigh 1.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
BUDGET_SHARE = 1.0   # of all tokens
MAX_EPOCHS = 3
SEED = 17
BUCKET_ROWS = 2048   # documents of a leaf that are ordered in one task
WORD = r"[^\x20\x09-\x0D]+"


def domain_of(source: Column) -> Column:
    """The test documents' domain: the source's number by four; 'd?' without a number."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % 4).cast("string"))).otherwise("d?")


def _name(value: Column) -> Column:
    """A node's name that keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for node, w in weights.get(level, {}).items():
        if w < 0:
            raise ValueError("weights must not be negative")
        out = F.when(F.col(level) == f"={node}", float(w)).otherwise(out)
    return out


def budgets(leaves: DataFrame, weights: dict[str, dict[str, float]], budget_share: float, max_epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, n, tokens)`` with ``budget``, in tokens.

    The root has ``budget_share`` of all tokens. Fractions are rounded down at
    each level. A weight of 0 gives nothing. What all leaves together cannot
    fill within ``max_epochs`` stays unspent.
    """
    root = leaves.agg(F.floor(F.sum("tokens") * F.lit(float(budget_share))).cast("long").alias("budget"))
    parents = root.withColumn("path", F.lit(""))
    for depth in range(len(LEVELS)):
        level, above = LEVELS[depth], LEVELS[:depth]
        nodes = leaves.groupBy(*LEVELS[:depth + 1]).agg((F.sum("tokens") * max_epochs).alias("cap"))
        nodes = nodes.withColumn("w", _weight(level, weights)).withColumn("path", F.concat_ws("\x01", F.lit(""), *above))
        nodes = nodes.join(parents, "path")
        order = Window.partitionBy("path").orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).asc_nulls_last(), level)
        before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        nodes = (
            nodes.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("w_left", F.sum("w").over(rest))
            .withColumn("full", (F.col("w") > 0) & (F.col("cap") * F.col("w_left") <= F.col("left") * F.col("w")))
        )
        ends = Window.partitionBy("path")
        first = F.min(F.when(~F.col("full"), F.struct(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf"))).alias("at"), F.col(level).alias("name"), "left", "w_left"))).over(ends)
        share = F.when(F.col("first.w_left") > 0, F.floor(F.col("first.left").cast("double") * F.col("w") / F.col("first.w_left"))).otherwise(0)
        nodes = nodes.withColumn("first", first).withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(F.greatest(share, F.lit(0))).cast("long"))
        parents = nodes.select(F.concat_ws("\x01", F.lit(""), *LEVELS[:depth + 1]).alias("path"), F.col("given").alias("budget"))
    return leaves.withColumn("path", F.concat_ws("\x01", F.lit(""), *LEVELS)).join(parents, "path").drop("path")


def plan_of(rows: DataFrame, weights: dict | None = None, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row for each leaf of ``rows``: how many whole epochs it takes, and where the prefix of one more ends.

    A leaf of T tokens and budget B takes B div T whole epochs and has room for
    B mod T more tokens. The leaf is cut into buckets by the order of that
    epoch; the sums of buckets tell in which of them (``end``) the room runs
    out, and how many tokens are ``before`` it. Leaves without tokens take nothing.
    """
    leaves = pin(rows.groupBy(*LEVELS).agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")).where("tokens > 0"))
    plan = budgets(leaves, WEIGHTS if weights is None else weights, budget_share, max_epochs).withColumnRenamed("tokens", "total")
    plan = pin(plan.select(*LEVELS, F.expr("budget div total").alias("epochs"), F.expr("budget % total").alias("room"),
                           F.ceil(F.col("n") / BUCKET_ROWS).cast("long").alias("buckets"), F.lit(seed).alias("seed")))
    sums = _placed(rows, plan).groupBy(*LEVELS, "room", "bucket").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = sums.withColumn("upto", upto).where("upto > room").groupBy(*LEVELS).agg(F.min("bucket").alias("end"), F.min(F.col("upto") - F.col("tokens")).alias("before"))
    return pin(plan.join(ends, list(LEVELS), "left"))


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their leaf's plan, their place in its last epoch, and the bucket of that."""
    joined = rows.join(plan, list(LEVELS))
    hashed = F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    joined = joined.withColumn("place", F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long"))
    return joined.withColumn("bucket", F.expr("shiftright(place, 30) * buckets div 1073741824"))


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``copies``; rows not taken are left out.

    The last epoch is ordered by a hash of seed, epoch and doc_id, then by
    doc_id, tokens and tag; its longest prefix within the room is taken. Only
    the bucket in which the prefix ends is ordered, so nothing else is shuffled.
    """
    placed = _placed(rows, plan)
    inside = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("place", "doc_id", "tokens", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = placed.where("bucket = end").withColumn("more", (F.col("before") + inside <= F.col("room")).cast("long"))
    plain = placed.where("end is null or bucket <> end").withColumn("more", F.coalesce((F.col("bucket") < F.col("end")).cast("long"), F.lit(1)))
    out = plain.select(*rows.columns, "epochs", "more").unionByName(edge.select(*rows.columns, "epochs", "more"))
    return out.withColumn("copies", F.col("epochs") + F.col("more")).where("copies > 0").select(*rows.columns, "copies")


def tree_rows(docs: DataFrame, domain: Column | None = None, with_row: bool = False) -> DataFrame:
    """doc_id, tag (hash of the text), node names and tokens (words) of each row, and the row itself if asked for."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"),
        _name(domain_of(F.col("source")) if domain is None else domain).alias("domain"), _name(F.col("lang")).alias("lang"), _name(F.col("source")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"), *([F.struct("*").alias("row")] if with_row else []),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """A row for each taken copy: doc_id, domain, lang, source, epoch (from 0), tokens.

    Null languages and sources are nodes of their own. Rows that repeat are
    taken apart. A document without tokens is taken where its leaf's epoch is.
    """
    rows = pin(tree_rows(docs))
    out = taken(rows, plan_of(rows, **options))
    plain = lambda c: F.when(F.col(c) != "-", F.substr(c, F.lit(2))).alias(c)  # noqa: E731
    epoch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("epoch")
    return out.select("doc_id", *(plain(c) for c in LEVELS), epoch, "tokens")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as they are taken, with their columns."""
    plan = plan_of(pin(tree_rows(docs)), **options)
    out = taken(tree_rows(docs, with_row=True), plan)
    out = out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(*[F.col("row")[n].alias(n) for n in docs.columns])


def check_sql(weights: dict | None = None, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for ``mixture`` over documents."""
    weights = WEIGHTS if weights is None else weights
    ctes = [rf"""docs as (select doc_id, case when regexp_matches(source, '[0-9]{{1,9}}$') then 'd' || (cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) as bigint) % 4) else 'd?' end as domain,
    lang, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) as tokens from documents)""",
        "leaves as (select domain, lang, source, sum(tokens) as tokens from docs group by all having sum(tokens) > 0)",
        f"b0 as (select cast(floor(sum(tokens) * {float(budget_share)}) as bigint) as budget from leaves)"]
    for depth, level in enumerate(LEVELS):
        cols = ", ".join(LEVELS[:depth + 1])
        cases = " ".join(f"when {level} = '{k}' then {float(v)}" for k, v in weights.get(level, {}).items())
        w = f"case {cases} else 1.0 end" if cases else "1.0"
        part = f"partition by {', '.join(LEVELS[:depth])}" if depth else ""
        on = " and ".join(f"n.{c} is not distinct from p.{c}" for c in LEVELS[:depth]) or "true"
        order = f"{part} order by cap / w nulls last, {level} nulls first"
        ctes += [
            f"n{depth} as (select n.*, p.budget from (select {cols}, sum(tokens) * {max_epochs} as cap, cast({w} as double) as w from leaves group by all) n join b{depth} p on {on})",
            f"""s{depth} as (select *, budget - coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0) as room_left,
    sum(w) over ({order} rows between current row and unbounded following) as w_left, row_number() over ({order}) as k from n{depth})""",
            f"f{depth} as (select *, cap * w_left <= room_left * w as saturated from s{depth})",
            f"""g{depth} as (select *, min(k) filter (not saturated) over ({part}) as first from f{depth})""",
            f"""h{depth} as (select *, max(case when k = first then room_left end) over ({part}) as fl, max(case when k = first then w_left end) over ({part}) as fw from g{depth})""",
            f"b{depth + 1} as (select {cols}, case when saturated then cap else cast(greatest(floor(cast(fl as double) * w / fw), 0) as bigint) end as budget from h{depth})",
        ]
    same = lambda a, b: " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in LEVELS)  # noqa: E731
    ctes += [
        f"plan as (select l.*, cast(budget // tokens as bigint) as epochs, budget % tokens as room from leaves l join b{len(LEVELS)} b on {same('l', 'b')})",
        f"""placed as (select d.*, p.epochs, p.room, sum(d.tokens) over (partition by d.domain, d.lang, d.source
      order by cast('0x' || substr(md5(concat_ws('|', '{seed}', p.epochs, coalesce(cast(d.doc_id as varchar), '-'))), 1, 15) as bigint), d.doc_id rows between unbounded preceding and current row) as upto
    from docs d join plan p on {same('d', 'p')})""",
    ]
    return "with " + ",\n".join(ctes) + """
select doc_id, domain, lang, source, unnest(range(0, epochs + case when upto <= room then 1 else 0 end)) as epoch, cast(tokens as bigint) as tokens from placed"""
