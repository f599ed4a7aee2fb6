"""Ranked lexical search by hashed max-sketches.

A document's impact of a term grows with the term's share of the document and
does not depend on any query. The impacts fold into a vector of SLOTS
coordinates: each term has a coordinate by its hash, which keeps the greatest
impact that falls there. The product of an item's term weights with those
coordinates bounds its score from above, for a block of documents at a time.
Documents are then scored exactly in the order of falling bounds, until the
next bound lies below the item's lowest kept score.

Two passes read the texts: one counts documents, words and document
frequencies, one folds, bounds and scores. No text and no posting is shuffled;
tasks return their best documents of each item.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .arrow import record_batch, text_blocks

SLOTS = 4096           # coordinates of a document's sketch
BLOCK_DOCS = 1024      # documents that are bounded together
CHUNK = 16             # documents scored exactly before the threshold is looked at again
ITEM_TERMS = 200_000   # terms of the items that one pass over the documents answers
COUNTED = 500_000      # terms that a task counts before it sends the counts on
FOUND = "item_id long, doc_id long, score long"
# Fixed values of the contract: ASCII characters that are no letter or digit part terms; A-Z are lowered.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return text.translate(_TABLE).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score for each unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def statistics(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(term, df) over all documents, the number of documents with a term, and all their terms with repeats."""
    schema = pa.schema([("term", pa.string()), ("df", pa.int64()), ("n_docs", pa.int64()), ("n_words", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        n_docs = n_words = 0

        def out() -> pa.RecordBatch:
            names = [t.decode("utf-8", "replace") for t in found]
            return record_batch(schema, term=names, df=list(found.values()), n_docs=[0] * len(names), n_words=[0] * len(names))

        for _, texts in text_blocks(batches, "text"):
            for text in texts:
                words = terms(text)
                n_docs += bool(words)
                n_words += len(words)
                found.update(set(words))
            if len(found) > COUNTED:
                yield out()
                found.clear()
        yield out()
        yield record_batch(schema, term=[None], df=[0], n_docs=[n_docs], n_words=[n_words])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term string, df long, n_docs long, n_words long")
    counts = pin(parts.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("df", "n_docs", "n_words"))))
    totals = counts.where("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("l")).first()
    return counts.where("term is not null").select("term", "df"), totals["n"] or 0, totals["l"] or 0


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of each item, once each; rows that share an item_id are one item."""
    schema = pa.schema([("item_id", pa.int64()), ("term", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            for item, text in zip(batch.column("item_id").to_pylist(), texts):
                own = sorted({t.decode("utf-8", "replace") for t in terms(text)})
                yield record_batch(schema, item_id=[item] * len(own), term=own)

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "item_id long, term string").distinct()


class _Items:
    """A bounded block of items: their terms' weights, as a task needs them."""

    def __init__(self, rows: list) -> None:
        self.ids = [r["item_id"] for r in rows]
        names = sorted({t["term"] for r in rows for t in r["terms"]})
        self.vocabulary = {t.encode(): i for i, t in enumerate(names)}
        coordinate = np.array([_slot(t) for t in self.vocabulary], np.int64)
        self.terms = [np.array([self.vocabulary[t["term"].encode()] for t in r["terms"]], np.int64) for r in rows]
        self.weights = [np.array([t["weight"] for t in r["terms"]], np.int64) for r in rows]
        self.slots = [coordinate[t] for t in self.terms]


def _slot(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) % SLOTS


class _Words(dict):
    """Word to a number; numbers below the vocabulary's size are the items' terms."""

    def __init__(self, vocabulary: dict[bytes, int], limit: int = 1_000_000) -> None:
        super().__init__(vocabulary)
        self.slots = [_slot(t) for t in vocabulary]
        self.vocabulary, self.limit = vocabulary, limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self.slots)
        self.slots.append(_slot(word))
        return value

    def full(self) -> bool:
        return len(self.slots) > self.limit + len(self.vocabulary)


class DocumentBlock:
    """Folded and exact impacts of some documents."""

    def __init__(self, texts: list[bytes], words: _Words, n_docs: int, n_words: int) -> None:
        found = [terms(t) for t in texts]
        lengths = np.array([len(f) for f in found], np.int64)
        flat = np.fromiter((words[w] for f in found for w in f), np.int64, int(lengths.sum()))
        span = len(words.slots)
        key, tf = np.unique(np.repeat(np.arange(len(texts)), lengths) * span + flat, return_counts=True)
        doc, word = np.divmod(key, span)
        m = 10 + (90 * lengths * n_docs) // max(n_words, 1)
        value = impact(tf, m[doc])
        slot = np.array(words.slots, np.int64)[word]
        # One row a coordinate, so that an item's coordinates are read as whole rows.
        self.sketch = np.zeros((SLOTS, len(texts)))
        np.maximum.at(self.sketch, (slot, doc), value.astype(np.float64))
        self.size = len(words.vocabulary)
        own = word < self.size
        self.keys, self.values = doc[own] * self.size + word[own], value[own]

    def bounds(self, slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No less than each document's score; whole numbers below 2**53, so sums are exact."""
        return weights.astype(np.float64) @ self.sketch[slots]

    def scores(self, docs: np.ndarray, which: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        wanted = (docs[:, None] * self.size + which).ravel()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        value = np.where(self.keys[at] == wanted, self.values[at], 0)
        return value.reshape(len(docs), -1) @ weights


def _better(pairs: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    """The k best of (score, doc_id), equal scores by ascending doc_id, null last."""
    return sorted(pairs, key=lambda p: (-p[0], p[1] is None, p[1] or 0))[:k]


def improve(best: list[tuple[int, int | None]], block: DocumentBlock, ids: list, slots, which, weights, k: int) -> tuple[list, int]:
    """``best`` after the documents of a block, and how many of them were scored exactly."""
    bounds = block.bounds(slots, weights)
    lowest = lambda: max(best[-1][0] if len(best) == k else 1, 1)
    able = np.flatnonzero(bounds >= lowest())
    able = able[np.argsort(-bounds[able], kind="stable")]
    scored = 0
    for start in range(0, len(able), CHUNK):
        some = able[start:start + CHUNK]
        if bounds[some[0]] < lowest():
            break
        exact = block.scores(some, which, weights)
        scored += len(some)
        good = exact >= lowest()
        if good.any():
            best = _better(best + [(int(s), ids[d]) for s, d in zip(exact[good], some[good])], k)
    return best, scored


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_terms_at_once: int = ITEM_TERMS) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    Only scores above 0 count; equal scores go by ascending doc_id, null last.
    A null or empty text has no terms and is never found; an item without
    terms has no rows. Rows that share an item_id (null too) are one item;
    every row of ``docs`` is a document, also if it repeats another. Very long
    texts are scored whole. Empty tables give no rows. Other columns of the
    tables are not looked at.

    Items are answered in blocks of bounded size, each by one pass over ``docs``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    df, n_docs, n_words = statistics(docs)
    ratio = F.lit(2.0 * n_docs + 2.0) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(1000 * F.log(ratio)).cast("long").alias("weight")
    weighted = item_terms(items).join(df, "term").select("item_id", "term", weight).where("weight > 0")
    asked = pin(weighted.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("terms")))
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def answer(block: _Items) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = _Words(block.vocabulary)
            best: list[list] = [[] for _ in block.ids]
            for batch, texts in text_blocks(batches, "text"):
                ids = batch.column("doc_id").to_pylist()
                for lo in range(0, len(texts), BLOCK_DOCS):
                    if words.full():
                        words = _Words(block.vocabulary)
                    part = DocumentBlock(texts[lo:lo + BLOCK_DOCS], words, n_docs, n_words)
                    if not len(part.keys):
                        continue
                    for q in range(len(best)):
                        best[q], _ = improve(best[q], part, ids[lo:lo + BLOCK_DOCS], block.slots[q], block.terms[q], block.weights[q], k)
            rows = [(item, doc, score) for item, own in zip(block.ids, best) for score, doc in own]
            yield record_batch(schema, item_id=[r[0] for r in rows], doc_id=[r[1] for r in rows], score=[r[2] for r in rows])

        return docs.mapInArrow(scan, FOUND)

    found, held, size = spark.createDataFrame([], FOUND), [], 0
    for row in asked.toLocalIterator():
        held.append(row)
        size += len(row["terms"])
        if size >= item_terms_at_once:
            found = found.unionByName(pin(answer(_Items(held))))
            held, size = [], 0
    if held:
        found = found.unionByName(answer(_Items(held)))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def check_sql(k: int = 10) -> str:
    """DuckDB SQL for ``search`` of the benchmark items in documents."""
    cut = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with words as (select doc_id, unnest({cut.format("text")}) as term from documents),
lengths as (select doc_id, count(*) as n from words group by doc_id),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_words from lengths),
counts as (select doc_id, term, count(*) as tf from words group by doc_id, term),
frequencies as (select term, count(*) as df from counts group by term),
wanted as (select distinct item_id, unnest({cut.format("text")}) as term from benchmark),
weights as (select item_id, term, cast(floor(1000 * ln((2.0 * n_docs + 2.0) / (2 * df + 1))) as bigint) as w from wanted join frequencies using (term), totals),
scores as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) as bigint) as score
  from weights join counts using (term) join lengths using (doc_id), totals group by item_id, doc_id),
ranked as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= {k}"""
