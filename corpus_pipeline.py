"""The training-data pipeline: documents through the stages, each written and read again.

Quality rules drop rejected documents, near-dedup keeps one document of each
group, suffix-array dedup cuts repeated bytes out of texts, mixing takes each
source as often as its target weight asks, and packing turns what is left into
sequences of token pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import mixing, odd_sketch, packing, quality, suffix_dedup
from meterline.llm.ship import ship
from meterline.session import collecting, pin, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_tables: dict[int, list[str]] = {}  # intermediate tables of the stages, by number


def stage(number: int) -> Callable[[Stage], Stage]:
    """A stage that first deletes the intermediate tables of the stages before it.

    Their outputs have been written and ``docs`` was read from that; a table
    that ``docs`` reads after all stays.
    """
    def wrap(fn: Stage) -> Stage:
        @wraps(fn)
        def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for earlier in [n for n in _tables if n < number]:
                release(spark, _tables.pop(earlier), docs)
            with collecting() as made:
                out = fn(spark, docs, sf_dir)
            _tables.setdefault(number, []).extend(made)
            return out
        return call
    return wrap


@stage(1)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive thresholds keep."""
    return quality.keep_good(docs)


@stage(2)
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each near-duplicate group."""
    ship(spark)
    return odd_sketch.drop_near_duplicates(docs)


@stage(3)
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur twice or more."""
    ship(spark)
    return suffix_dedup.without_repeats(docs)


@stage(4)
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them."""
    return mixing.mix(docs)


@stage(5)
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", repeated_strings),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Sketches, suffix arrays and tokenization are not expressible in SQL; tests/llm/test_pipeline.py has a direct version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        rows = stage(spark, docs, sf_dir)
        with collecting() as made:
            docs = pin(rows)
        release(spark, written)
        written = made
    return STAGES[-1][1](spark, docs, sf_dir)
