"""Grouped summaries, caps, histograms, profiles and parity of aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import pin
from .joins import small_side
from .quantiles import exact_quantiles, quantiles_from_histogram, running_total, value_histogram

CAP_COLUMNS = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration_min"}
ALL = "All"
CAP_SKETCH_K = 8192  # ranks off by 0.0005 at most, about 100 KB a sketch


# --- counts ---------------------------------------------------------------

def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """G1: rows, per group when keys are given."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_matrix(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of values that occurs."""
    return count_by(df, a, b)


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One count per named condition, in one pass."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def key_audit(df: DataFrame, key: str = "tripid", service: str = "service_type") -> DataFrame:
    """Rows, distinct ids, distinct (service, id) pairs.

    Pairs are counted first, so a repeated id shrinks before each shuffle; the
    three numbers then need no distinct count at all.
    """
    pairs = df.groupBy(key, service).agg(F.count(F.lit(1)).alias("_rows"))
    ids = pairs.groupBy(key).agg(
        F.sum("_rows").alias("_rows"),
        F.count_if(F.col(service).isNotNull()).alias("_pairs"),
    )
    has_id = F.col(key).isNotNull()
    return ids.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.count_if(has_id).alias("n_distinct_id"),
        F.coalesce(F.sum(F.when(has_id, F.col("_pairs"))), F.lit(0)).alias("n_distinct_service_id"),
    )


def distinct_months(df: DataFrame, col: str = "year_month") -> DataFrame:
    """Distinct values in order."""
    return df.select(col).distinct().orderBy(col)


def share(df: DataFrame, condition: Column, metric: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of ``metric`` on rows where ``condition`` holds."""
    return df.groupBy(*by).agg(F.try_divide(F.sum(F.when(condition, metric)), F.sum(metric)).alias("share"))


# --- location and spread -----------------------------------------------------

def _medians(rows: DataFrame, keys: Sequence[str], col: str, groups: DataFrame) -> DataFrame:
    """Add the exact ``median`` of ``col`` to a table with a row per group; NULL where a group has no value."""
    renamed = {k: f"_of_{k}" for k in keys}
    medians = exact_quantiles(rows, keys, col, {"median": 0.5}).drop("tot").withColumnsRenamed(renamed)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return groups.join(medians, same, "left").drop(*renamed.values())


def duration_summary(df: DataFrame, key: str, col: str = "trip_duration_min") -> DataFrame:
    """Mean and median per group, the median exact (the smallest value that half of the rows do not exceed)."""
    rows = pin(df.select(key, col))
    return _medians(rows, [key], col, rows.groupBy(key).agg(F.avg(col).alias("mean")))


def median_by_hour(df: DataFrame, by: str = "vendorid", col: str = "trip_duration_min") -> DataFrame:
    """Exact median duration in minutes per pickup hour and vendor."""
    keys = ["pickup_hour", by]
    rows = pin(df.select(*keys, col))
    return _medians(rows, keys, col, rows.select(*keys).distinct())


def describe_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, min and max; a row per column."""
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    one = df.agg(*[
        F.struct(*[(f(c) if name == "count" else f(c).cast("double")).alias(name) for name, f in stats.items()]).alias(c)
        for c in cols
    ])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("s")) for c in cols])
    return one.select(F.explode(rows).alias("r")).select("r.column_name", "r.s.*")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, rows, and percent, from one pass."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])
    return one.select("_total", F.explode(pairs).alias("p")).select(
        "p.column_name", "p.null_count", F.col("_total").alias("total_rows"),
        F.try_divide(F.col("p.null_count") * 100.0, F.col("_total")).alias("null_pct"),
    )


def percentile_markers(df: DataFrame, col: str) -> DataFrame:
    """Interpolated 50th, 75th and 95th percentile."""
    return exact_quantiles(df, [], col, {"p50": 0.5, "p75": 0.75, "p95": 0.95}, interpolate=True).drop("tot")


def box_stats(df: DataFrame, key: str, col: str) -> DataFrame:
    """Quartiles, and the extreme values within 1.5 IQR of them."""
    quartiles = exact_quantiles(df, [key], col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, interpolate=True)
    q = small_side(pin(quartiles.withColumnRenamed(key, "_key")))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col(col) >= F.col("q1") - reach) & (F.col(col) <= F.col("q3") + reach)
    return (
        df.where(F.col(col).isNotNull())
        .join(q, F.col(key).eqNullSafe(F.col("_key")))
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(col))).alias("whisker_low"),
            F.max(F.when(inside, F.col(col))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


# --- caps ----------------------------------------------------------------------

def compute_caps(df: DataFrame, accuracy: int = 1000, keep: Column | None = None) -> DataFrame:
    """Sketched p99 of fare and distance per service, of duration overall.

    The sketches merge, so the per-service row and the overall row come from one
    pass. Service ``All`` carries the duration cap. With ``keep`` only rows that
    meet it enter the sketches; ``all_rows`` and ``kept_rows`` count both kinds.
    """
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    p99 = [
        F.percentile_approx(F.when(kept, F.col(c)), F.lit(0.99), F.lit(accuracy)).alias(f"{m}_p99")
        for m, c in CAP_COLUMNS.items()
    ]
    counts = [F.count(F.lit(1)).alias("all_rows"), F.count_if(kept).alias("kept_rows")]
    both = df.groupingSets([["service_type"], []], "service_type").agg(
        F.grouping("service_type").alias("_overall"), *p99, *counts
    )
    overall = F.col("_overall") == 1
    return both.select(
        F.when(overall, F.lit(ALL)).otherwise(F.col("service_type")).alias("service_type"),
        F.when(~overall, F.col("fare_p99")).alias("fare_p99"),
        F.when(~overall, F.col("distance_p99")).alias("distance_p99"),
        F.when(overall, F.col("duration_p99")).alias("duration_p99"),
        "all_rows", "kept_rows",
    )


def cap_sketches(df: DataFrame, keep: Column | None = None, ts: str = "pickup_datetime", k: int = CAP_SKETCH_K) -> DataFrame:
    """What ``compute_caps`` needs, per month and service, as sketches that merge.

    Stored beside the mart (``sources.live``), they answer for any set of months
    without its trips; a new month adds its own rows only.
    """
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    sketches = [F.kll_sketch_agg_double(F.when(kept, F.col(c).cast("double")), F.lit(k)).alias(m) for m, c in CAP_COLUMNS.items()]
    counts = [F.count(F.lit(1)).alias("all_rows"), F.count_if(kept).alias("kept_rows")]
    counts += [F.count(F.when(kept, F.col(c))).alias(f"{m}_rows") for m, c in CAP_COLUMNS.items()]
    return df.groupBy(F.trunc(F.to_date(ts), "month").alias("pickup_month"), "service_type").agg(*counts, *sketches)


def caps_from_sketches(sketches: DataFrame, k: int = CAP_SKETCH_K) -> DataFrame:
    """The caps of the months whose sketches are given, in the shape of ``compute_caps``.

    A rank of 0.99 is met within 0.001, whatever the months.
    """
    metrics = list(CAP_COLUMNS)
    merged = [F.kll_merge_agg_double(m, F.lit(k)).alias(m) for m in metrics]
    sums = [F.sum(c).alias(c) for c in ("all_rows", "kept_rows", *[f"{m}_rows" for m in metrics])]
    services = sketches.groupBy("service_type").agg(*sums, *merged)
    overall = services.agg(*sums, *merged).withColumn("service_type", F.lit(ALL)).where(F.col("all_rows").isNotNull())
    both = services.withColumn("_overall", F.lit(False)).unionByName(overall.withColumn("_overall", F.lit(True)))
    p99 = {m: F.when(F.col(f"{m}_rows") > 0, F.kll_sketch_get_quantile_double(m, F.lit(0.99))) for m in metrics}
    return both.select(
        "service_type",
        *[F.when(F.col("_overall") == (m == "duration"), p99[m]).alias(f"{m}_p99") for m in metrics],
        "all_rows", "kept_rows",
    )


def cap_histogram(df: DataFrame) -> DataFrame:
    """Rows per (metric, group, value): three metrics per service, plus duration overall."""
    service, minutes = F.col("service_type"), F.col("trip_duration_min")
    entries = [F.struct(F.lit(m).alias("metric"), service.alias("grp"), F.col(c).cast("double").alias("v")) for m, c in CAP_COLUMNS.items()]
    entries.append(F.struct(F.lit("duration").alias("metric"), F.lit(ALL).alias("grp"), minutes.cast("double").alias("v")))
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.metric", "e.grp", "e.v")
    return long.where("v is not null").groupBy("metric", "grp", "v").agg(F.count(F.lit(1)).alias("n"))


def exact_caps(df: DataFrame) -> DataFrame:
    """Exact discrete p99 per metric and group."""
    return quantiles_from_histogram(cap_histogram(df), ["metric", "grp"], "v", {"p99": 0.99}).withColumnRenamed(
        "tot", "guarded_rows"
    )


def cap_band(df: DataFrame, observed: DataFrame) -> DataFrame:
    """p98.9, p99, p99.1, and the share of rows at or below an observed cap.

    ``observed`` has columns metric, grp and cap, one row per cap to judge.
    """
    hist = pin(cap_histogram(df))
    bands = quantiles_from_histogram(hist, ["metric", "grp"], "v", {"p989": 0.989, "p99": 0.99, "p991": 0.991})
    caps = small_side(observed.select(F.col("metric").alias("_metric"), F.col("grp").alias("_grp"), "cap"))
    judged = hist.join(caps, F.col("metric").eqNullSafe(F.col("_metric")) & F.col("grp").eqNullSafe(F.col("_grp")))
    below = judged.groupBy("metric", "grp", "cap").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.sum(F.when(F.col("v") <= F.col("cap"), F.col("n")).otherwise(0)).alias("_below"),
    )
    below = below.withColumnsRenamed({"metric": "_metric", "grp": "_grp"})
    same = F.col("metric").eqNullSafe(F.col("_metric")) & F.col("grp").eqNullSafe(F.col("_grp"))
    return bands.join(below, same).select(
        "metric", "grp", F.col("tot").alias("guarded_rows"), "distinct_values", "p989", "p99", "p991", "cap",
        (F.col("_below") / F.col("tot")).alias("cdf_at_cap"),
    )


def apply_caps(df: DataFrame, caps: DataFrame) -> DataFrame:
    """Winsorise fare, distance and duration; NULL or missing caps change nothing.

    ``caps`` has the shape of ``compute_caps``. It is one row per service and is
    joined, not collected.
    """
    per_service = small_side(
        caps.where(F.col("service_type") != ALL).select(F.col("service_type").alias("_service"), "fare_p99", "distance_p99")
    )
    minutes = caps.where(F.col("service_type") == ALL).select(F.max("duration_p99")).scalar()

    def at_most(value: str, cap: Column) -> Column:
        v = F.col(value)
        return F.when(v.isNull(), v).otherwise(F.least(v, cap))

    return (
        df.join(per_service, F.col("service_type") == F.col("_service"), "left")
        .withColumns({
            "fare_capped": at_most("fare_amount", F.col("fare_p99")),
            "distance_capped": at_most("trip_distance", F.col("distance_p99")),
            "trip_duration_min": at_most("trip_duration_min", minutes),
        })
        .drop("_service", "fare_p99", "distance_p99")
    )


# --- relations between columns ---------------------------------------------------

def feature_correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each column with the target, strongest first."""
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("r")) for c in cols])
    return (
        one.select(F.explode(pairs).alias("p")).select("p.feature", "p.r", F.abs("p.r").alias("abs_r"))
        .orderBy(F.desc("abs_r"), "feature")
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """All pairs of columns, rows with a NULL left out."""
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown method: {method}")
    cols = list(cols)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    pairs = [(a, b) for a in cols for b in cols]
    if method == "pearson":
        one = complete.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
        cells = F.array(*[
            F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"_{i}").alias("r")) for i, (a, b) in enumerate(pairs)
        ])
        return one.select(F.explode(cells).alias("c")).select("c.*")
    return _rank_correlations(complete, cols)


def _rank_correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r of average ranks, over distinct rows weighted by their copies.

    The rank of a value follows from its running count, so no column is sorted
    in one task, and tied values, however many, are one histogram row.
    """
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_w"))
    for c in cols:
        running = running_total(value_histogram(df, [], c), [], c)
        # Centred on the mean rank (total + 1) / 2, which ties leave unchanged.
        centred = F.col("cum_n") - F.col("n") / 2.0 - F.col("tot") / 2.0
        ranks = pin(running.select(F.col(c).alias("_v"), centred.alias(f"_rank_{c}")))
        rows = rows.join(small_side(ranks), F.col(c) == F.col("_v")).drop("_v")
    pairs = [(a, b) for a in cols for b in cols]
    w = F.col("_w")
    sums = rows.agg(*[F.sum(w * F.col(f"_rank_{a}") * F.col(f"_rank_{b}")).alias(f"_{a}_{b}") for a, b in pairs])
    cells = F.array(*[
        F.struct(
            F.lit(a).alias("row"), F.lit(b).alias("col"),
            F.try_divide(F.col(f"_{a}_{b}"), F.sqrt(F.col(f"_{a}_{a}")) * F.sqrt(F.col(f"_{b}_{b}"))).alias("r"),
        )
        for a, b in pairs
    ])
    return sums.select(F.explode(cells).alias("c")).select("c.*")


def trend_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept of ``y`` over ``x``, per group."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(yd, xd).alias("slope"), F.regr_intercept(yd, xd).alias("intercept"), F.regr_count(yd, xd).alias("n")
    )


# --- histograms -------------------------------------------------------------------

def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Zero-based bin of equal width; the upper end belongs to the last bin."""
    if high == low:
        return F.lit(0)
    position = (value - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low)
    return F.least(F.floor(position), F.lit(bins - 1)).cast("int")


def _edge(low: float, high: float, index: Column, bins: int) -> Column:
    return F.lit(low) + F.lit(high - low) * index / F.lit(float(bins))


def _range(df: DataFrame, *cols: str) -> list[tuple[float, float]]:
    """Smallest and largest value of each column, the only numbers the driver gets."""
    row = df.agg(*[f(c) for c in cols for f in (F.min, F.max)]).first()
    return [(row[2 * i] or 0.0, row[2 * i + 1] or 0.0) for i in range(len(cols))]


def histogram(df: DataFrame, col: str, bins: int, log: bool = False) -> DataFrame:
    """Rows per equal-width bin, on a log10 scale if asked.

    Empty bins are not listed. On the log scale only positive values count.
    """
    v = F.col(col).cast("double")
    values = df.where((v > 0) if log else v.isNotNull()).select((F.log10(v) if log else v).alias("v"))
    [(low, high)] = _range(values, "v")
    counts = values.groupBy(_bin(F.col("v"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    left, right = _edge(low, high, F.col("bin"), bins), _edge(low, high, F.col("bin") + 1, bins)
    if log:
        left, right = F.pow(F.lit(10.0), left), F.pow(F.lit(10.0), right)
    return counts.select("bin", left.alias("bin_left"), right.alias("bin_right"), "n")


def histogram2d(df: DataFrame, x: str, y: str, nx: int, ny: int) -> DataFrame:
    """Rows per cell of a grid over log10(x), log10(y); positive values only."""
    positive = df.where((F.col(x) > 0) & (F.col(y) > 0))
    pairs = positive.select(F.log10(F.col(x)).alias("x"), F.log10(F.col(y)).alias("y"))
    (x0, x1), (y0, y1) = _range(pairs, "x", "y")
    cell = _bin(F.col("x"), x0, x1, nx).alias("x_bin"), _bin(F.col("y"), y0, y1, ny).alias("y_bin")
    return pairs.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))


def hexbins(df: DataFrame, x: str, y: str, size: int, log: bool = True) -> DataFrame:
    """Rows per hexagon, ``size`` of them across, over log10(x) and log10(y) unless ``log`` is off.

    Hexagon centres form two grids, the second half a step off in both
    directions; a point belongs to the nearer of the next centre in either,
    the first on a tie. Only positive values count on the log scale. Returned
    are grid, column and row, the centre, and the count of each hexagon met.
    """
    rows_up = max(int(size / 3 ** 0.5), 1)
    given = df.where((F.col(x) > 0) & (F.col(y) > 0)) if log else df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = given.select(*[(F.log10(F.col(c)) if log else F.col(c).cast("double")).alias(n) for c, n in ((x, "x"), (y, "y"))])
    (x0, x1), (y0, y1) = _range(pairs, "x", "y")
    steps = (x1 - x0) / size or 1.0, (y1 - y0) / rows_up or 1.0
    u, v = (F.col("x") - x0) / steps[0], (F.col("y") - y0) / steps[1]
    first = F.floor(u + 0.5), F.floor(v + 0.5)
    second = F.floor(u), F.floor(v)

    def away(a: Column, b: Column) -> Column:
        return (u - a) * (u - a) + 3 * (v - b) * (v - b)

    near = away(*first) <= away(second[0] + 0.5, second[1] + 0.5)
    cell = [F.when(near, 0).otherwise(1).alias("grid"), *[F.when(near, a).otherwise(b).cast("int").alias(n) for a, b, n in zip(first, second, ("column", "row"))]]
    counts = pairs.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    middle = [F.lit(low) + F.lit(step) * (F.col(n) + F.col("grid") * 0.5) for low, step, n in zip((x0, y0), steps, ("column", "row"))]
    return counts.select("grid", "column", "row", middle[0].alias("x_centre"), middle[1].alias("y_centre"), "n")


# --- checksums and parity ------------------------------------------------------------

def table_checksum(df: DataFrame, method: str = "xxhash64") -> DataFrame:
    """Rows and an order-free checksum of the whole table.

    ``xxhash64`` folds row hashes with XOR; ``md5`` adds up 32-bit prefixes,
    which other engines can reproduce, in a number that no table overflows.
    Columns are taken in name order.
    """
    names = sorted(df.columns)
    if method == "xxhash64":
        row = F.xxhash64(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("checksum"))
    if method != "md5":
        raise ValueError(f"unknown method: {method}")
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    row = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("checksum"))


def compare_groups(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Groups of two aggregate tables that differ or exist on one side only.

    Numbers may differ by ``tolerance``; NULL equals NULL, in keys as well.
    """
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*values).alias("_a"))
    right = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.struct(*values).alias("_b"))
    same_key = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])

    def equal(name: str) -> Column:
        x, y = F.col(f"_a.{name}"), F.col(f"_b.{name}")
        if tolerance and dict(a.dtypes)[name] in ("float", "double"):
            return x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
        return x.eqNullSafe(y)

    state = (
        F.when(F.col("_a").isNull(), "right only")
        .when(F.col("_b").isNull(), "left only")
        .when(reduce(lambda p, q: p & q, [equal(v) for v in values]), "equal")
        .otherwise("differs")
    )
    joined = left.join(right, same_key, "full_outer")
    return joined.select(*[F.coalesce(k, f"_r_{k}").alias(k) for k in keys], state.alias("state"))
