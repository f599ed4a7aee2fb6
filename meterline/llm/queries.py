"""One query for each operator, over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import elias_fano, max_sketch, mixing, odd_sketch, packing, phrase_automata, pitman_yor, quality, suffix_dedup, token_transducer, tool_calls, variants, voronoi_knn
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_elias_fano_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elias_fano.round_trip(table(spark, sf_dir, "documents"))


@query("op10_sum_of_squares_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op2_odd_sketch_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op7_adaptive_quality", quality.check_sql())  # both names, one rule
@query("op7_tail_quality", quality.check_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op9_hierarchical_mixing", mixing.check_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op3_phrase_automata")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.remove_passages(table(spark, sf_dir, "documents"))


@query("op5_token_transducer")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_transducer.token_counts(table(spark, sf_dir, "documents"))


@query("op8_voronoi_knn", voronoi_knn.check_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op4_tool_call_events")
def op4_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tool_calls.link(tool_calls.table_messages(table(spark, sf_dir, "conversations")))
    return events.withColumn("errors", F.array_join("errors", ","))


@query("op4_tool_call_linking", tool_calls.check_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tool_calls.link(tool_calls.table_messages(table(spark, sf_dir, "conversations")))
    # What the SQL has: no pos, and no text of results. op4_tool_call_events returns both.
    canonical = F.when(F.col("kind") == "call", F.col("canonical")).alias("canonical")
    return events.select("conv_id", "stage", "turn", "kind", "call_id", "name", "status", F.array_join("errors", ",").alias("errors"), "copies", canonical)


@query("op11_max_sketch_search", max_sketch.check_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_pitman_yor_scores")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
