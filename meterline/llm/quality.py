"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

Everything is a column expression. Counts are taken within each row, so no
text is shuffled. Sketches are merged from tasks into (language, source)
groups, from groups into languages and from languages into one; a group with
few rows takes the sketch of its language, or of all rows.

Fences follow the tails. Where a feature varies, its tail goes out rank by
rank until a gap, and the fence lies REACH times the tail's length beyond; what
lies behind a gap, as junk does, moves nothing. Where most rows have none of a
feature, the rows that have some decide: if they stand apart from zero by more
than their lowest differ among themselves, the fence cuts the gap in half, and else it
lies beyond their tail. Every fence scales with the values it is taken from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

MIN_WORDS = 10       # base rule
MAX_REPEATED = 20    # base rule, percent of words in repeated windows
SKETCH_K = 2048      # a sketch of fewer values is exact
MIN_ROWS = 100       # a smaller group takes the sketch above it
MIN_SOME = 30        # as MIN_ROWS, for the rows that have some of a feature
FEATURES = {"symbol_share": "upper", "capital_share": "upper", "dup_line_share": "upper", "word_length": "both"}  # sides on which a row can fail
BODY = 0.2                        # share of a group that may be junk at an end before its spread is
TAIL_RANKS = (0.1, 0.05, 0.02)    # further out, as far as the values go on without a gap
GAP = 2.0                         # spreads without a value that end a tail
REACH = 2.0                       # lengths of the tail beyond its end
SOME_LOW, SOME_NEXT = 0.05, 0.25  # ranks of the rows that have some, within whose GAP distances zero must not lie
SOME_REACH = 4.0                  # else: their spreads beyond the middle one
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with the base counts, the features and ``base_failed`` added.

    Words are runs without ASCII white space. A line counts if it has a word,
    and is a duplicate if an earlier line of the text is equal. A null text has
    no words. The columns added start with ``_`` while they are intermediate.
    """
    at = lambda array, i: F.get(array, i)
    out = rows.withColumn("_text", F.coalesce(text.cast("string"), F.lit("")))
    out = out.withColumn("_words", F.filter(F.split("_text", SPACE_RUN), lambda w: w != ""))
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: _without(line, SPACES) > 0))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*(at(F.col("_words"), i + j) for j in range(WINDOW))),
    )
    out = out.withColumn("_windows", F.when(F.size("_words") >= WINDOW, windows))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_ordered", F.when(repeats, ordered))
    same = lambda s, i: at(F.col("_ordered"), i)["h"] == s["h"]
    found = F.filter("_ordered", lambda s, i: (F.when(i > 0, same(s, i - 1)).otherwise(False)) | F.coalesce(same(s, i + 1), F.lit(False)))
    out = out.withColumn("_places", F.array_sort(F.transform(found, lambda s: s["i"])))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    out = (
        out.withColumn("word_chars", _without(F.col("_text"), SPACES).cast("long"))
        .withColumn("n_symbols", (F.length("_text") - _without(F.col("_text"), SYMBOLS)).cast("long"))
        .withColumn("_capitals", (F.length("_text") - _without(F.col("_text"), CAPITALS)).cast("long"))
        .withColumn("_n_lines", F.size("_lines"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    )
    out = (
        out.withColumn("symbol_share", _share(F.col("n_symbols"), F.col("word_chars")))
        .withColumn("capital_share", _share(F.col("_capitals"), F.col("word_chars")))
        .withColumn("dup_line_share", _share(F.col("n_dup_lines"), F.col("_n_lines")))
        .withColumn("word_length", _share(F.col("word_chars"), F.col("n_words")))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    )
    return out.drop("_text", "_words", "_lines", "_windows", "_ordered", "_places", "_capitals", "_n_lines")


def _tail_end(at, f: str, spread: Column, upper: bool) -> Column:
    """The value of the outermost rank that no gap parts from the body."""
    rank = lambda q: at(f, 1 - q if upper else q)
    values = F.array(*(rank(q) for q in (BODY, *TAIL_RANKS)))
    joined = lambda a, v: a["on"] & (F.abs(v - a["end"]) <= GAP * spread)
    start = F.struct(rank(BODY).alias("end"), F.lit(True).alias("on"))
    return F.aggregate(values, start, lambda a, v: F.struct(F.when(joined(a, v), v).otherwise(a["end"]).alias("end"), joined(a, v).alias("on")), lambda a: a["end"])


def _fences(at, some) -> list[Column]:
    """``<feature>_hi`` and ``<feature>_lo``; ``at(feature, q)`` is a quantile, ``some(feature, q)`` one of the rows that have some, or null."""
    out = []
    for f, sides in FEATURES.items():
        middle = at(f, 0.5)
        end = _tail_end(at, f, at(f, 1 - BODY) - middle, True)
        high = end + REACH * (end - middle)
        if sides == "upper":
            low, near, half = (some(f, q) for q in (SOME_LOW, SOME_NEXT, 0.5))
            apart = F.when(low > GAP * (near - low), low / 2).otherwise(half + SOME_REACH * (half - low))
            high = F.when(at(f, 1 - BODY) > 0, high).otherwise(apart)
        out.append(high.alias(f"{f}_hi"))
        end = _tail_end(at, f, middle - at(f, BODY), False)
        out.append((end - REACH * (middle - end) if sides == "both" else F.lit(None).cast("double")).alias(f"{f}_lo"))
    return out


def thresholds(measures: DataFrame, min_rows: int = MIN_ROWS, min_some: int = MIN_SOME) -> DataFrame:
    """Per (lang, source) of the rows that pass the base rules: ``<feature>_lo`` and ``<feature>_hi``.

    Null languages and sources are groups of their own. A group of fewer than
    ``min_rows`` rows (``min_some`` with some of a feature) takes the sketch of
    its language, or of all rows; where those are too few as well, the sketch
    of all rows serves, and rows with some of a feature have no fence of it.
    """
    shares = [f for f, sides in FEATURES.items() if sides == "upper"]
    columns = {**{f: F.col(f) for f in FEATURES}, **{f"{f}_some": F.when(F.col(f) > 0, F.col(f)) for f in shares}}
    passed = measures.where(~F.col("base_failed")).select("lang", "source", *(c.alias(n) for n, c in columns.items()))
    counts = [F.count("*").alias("n"), *(F.count(f"{f}_some").alias(f"n_{f}") for f in shares)]
    leaf = pin(passed.groupBy("lang", "source").agg(*counts, *(F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(c) for c in columns)))
    sums = ["n", *(f"n_{f}" for f in shares)]
    merged = lambda rows, *by: rows.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums), *(F.kll_merge_agg_double(c, F.lit(SKETCH_K)).alias(c) for c in columns))
    langs = pin(merged(leaf, "lang"))
    renamed = lambda rows, level: [F.col(c).alias(f"{c}{level}") for c in (*sums, *columns)]
    everything = merged(langs).select(*renamed(langs, 2))
    langs = langs.select(F.col("lang").alias("lang1"), *renamed(langs, 1))
    groups = leaf.join(langs, F.col("lang").eqNullSafe(F.col("lang1"))).join(everything, F.lit(True))
    quantile = lambda c, q: F.kll_sketch_get_quantile_double(F.col(c), F.lit(q))

    def at(f: str, q: float) -> Column:
        return F.when(F.col("n") >= min_rows, quantile(f, q)).when(F.col("n1") >= min_rows, quantile(f"{f}1", q)).otherwise(quantile(f"{f}2", q))

    def some(f: str, q: float) -> Column:
        out = F.when(F.col(f"n_{f}") >= min_some, quantile(f"{f}_some", q))
        for level in (1, 2):
            out = out.when(F.col(f"n_{f}{level}") >= min_some, quantile(f"{f}_some{level}", q))
        return out

    return groups.select("lang", "source", *_fences(at, some))


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with ``kept``: the base rules hold and every feature lies within its group's fences."""
    limits = limits.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *(F.col(f"{f}_{s}") for f in FEATURES for s in ("lo", "hi")))
    joined = measures.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    within = F.lit(True)
    for f in FEATURES:  # a fence that is null holds for every row
        within = within & F.coalesce((F.col(f) <= F.col(f"{f}_hi")) & (F.col(f) >= F.coalesce(F.col(f"{f}_lo"), F.lit(float("-inf")))), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & within)


def judge(docs: DataFrame, **limits) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, source, the base counts, base_failed and kept, by the fences of ``thresholds``.

    Equal rows count as often as they come and share their verdict. A null
    doc_id is returned as null. Null, empty and very short texts fail the base
    rules; very long ones are measured whole. An empty table gives no rows.
    Columns other than doc_id, lang, source and text are not looked at.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text)
    measures = pin(measured(rows, text).drop("text"))
    return judged(measures, pin(thresholds(measures, **limits))).select("doc_id", "lang", "source", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    Rows and measures are written together once, so that no text is shuffled
    to meet its verdict.
    """
    row = docs.select(F.struct("*").alias("row"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    measures = pin(measured(row, F.col("row.text")))
    return judged(measures, pin(thresholds(measures))).where("kept").select(*[F.col("row")[n].alias(n) for n in docs.columns])


def check_sql() -> str:
    """DuckDB SQL for ``judge`` over documents, exact where no group has more values than a sketch holds."""
    shares = [f for f, sides in FEATURES.items() if sides == "upper"]
    ranks = sorted({0.5, *(q for r in (BODY, *TAIL_RANKS) for q in (r, round(1 - r, 6)))})
    name = lambda f, q: f"{f}_{round(q * 100)}"

    def per(by: list[str]) -> str:
        out = [*by, "count(*) as n", *(f"quantile_disc({f}, {q}) as {name(f, q)}" for f in FEATURES for q in ranks)]
        for f in shares:
            out += [f"count(*) filter (where {f} > 0) as n_{f}", *(f"quantile_disc({f}, {q}) filter (where {f} > 0) as {name(f + '_some', q)}" for q in (SOME_LOW, SOME_NEXT, 0.5))]
        return ", ".join(out)

    chosen, fences, tests = [], [], []
    for f in FEATURES:
        chosen += [f"case when g.n >= {MIN_ROWS} then g.{name(f, q)} when l.n >= {MIN_ROWS} then l.{name(f, q)} else a.{name(f, q)} end as {name(f, q)}" for q in ranks]
    for f in shares:
        for q in (SOME_LOW, SOME_NEXT, 0.5):
            c = name(f + "_some", q)
            chosen.append(f"case when g.n_{f} >= {MIN_SOME} then g.{c} when l.n_{f} >= {MIN_SOME} then l.{c} when a.n_{f} >= {MIN_SOME} then a.{c} end as {c}")

    def end(f: str, upper: bool) -> str:
        rank = lambda q: name(f, round(1 - q, 6) if upper else q)
        reach = f"{GAP} * abs({rank(BODY)} - {name(f, 0.5)})"
        steps = [rank(BODY), *(rank(q) for q in TAIL_RANKS)]
        cases, joined = [], []
        for before, after in zip(steps, steps[1:]):
            joined.append(f"abs({after} - {before}) <= {reach}")
            cases.insert(0, f"when {' and '.join(joined)} then {after}")
        return f"case {' '.join(cases)} else {steps[0]} end"

    for f, sides in FEATURES.items():
        middle, high = name(f, 0.5), end(f, True)
        fence = f"({high}) + {REACH} * (({high}) - {middle})"
        if sides == "upper":
            low, near, half = (name(f + "_some", q) for q in (SOME_LOW, SOME_NEXT, 0.5))
            fence = f"case when {name(f, 1 - BODY)} > 0 then {fence} when {low} > {GAP} * ({near} - {low}) then {low} / 2 else {half} + {SOME_REACH} * ({half} - {low}) end"
        fences.append(f"{fence} as {f}_hi")
        tests.append(f"coalesce(m.{f} <= t.{f}_hi, true)")
        if sides == "both":
            fences.append(f"({end(f, False)}) - {REACH} * ({middle} - ({end(f, False)})) as {f}_lo")
            tests.append(f"coalesce(m.{f} >= t.{f}_lo, true)")
    return rf"""
with raw as (select doc_id, lang, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
spots as (select doc_id, unnest(range(0, len(words) - {WINDOW - 1})) as i, words from raw where len(words) >= {WINDOW}),
wins as (select doc_id, i, count(*) over (partition by doc_id, array_to_string(words[i + 1:i + {WINDOW}], ' ')) as copies from spots),
reps as (select doc_id, sum(least({WINDOW}, step)) as n from (
    select doc_id, coalesce(i - lag(i) over (partition by doc_id order by i), {WINDOW}) as step from wins where copies > 1) group by doc_id),
counts as (select raw.doc_id, lang, source, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) as capitals, len(lines) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(reps.n, 0) as bigint) as n_repeat_words
  from raw left join reps on raw.doc_id = reps.doc_id),
m as (select *, case when word_chars > 0 then n_symbols / word_chars else 0.0 end as symbol_share,
    case when word_chars > 0 then capitals / word_chars else 0.0 end as capital_share,
    case when n_lines > 0 then n_dup_lines / n_lines else 0.0 end as dup_line_share,
    case when n_words > 0 then word_chars / n_words else 0.0 end as word_length,
    n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed from counts),
passed as (select * from m where not base_failed),
g as (select {per(['lang', 'source'])} from passed group by lang, source),
l as (select {per(['lang'])} from passed group by lang),
a as (select {per([])} from passed),
c as (select g.lang, g.source, {', '.join(chosen)} from g join l on g.lang is not distinct from l.lang cross join a),
t as (select lang, source, {', '.join(fences)} from c)
select m.doc_id, m.lang, m.source, {', '.join(f'm.{c}' for c in BASE)}, m.base_failed,
  not m.base_failed and {' and '.join(tests)} as kept
from m left join t on m.lang is not distinct from t.lang and m.source is not distinct from t.source"""
