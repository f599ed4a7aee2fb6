"""Removal of passages that an earlier document has, located by Aho-Corasick automata.

A passage recurs if each run of WIDTH words in it also starts in a document
with a smaller doc_id. Two rounds of counting confirm that. The first counts
anchors: in each window the least hashed run of ANCHOR words, which depends on
the window alone, so that windows without a recurring anchor are out. The
second counts the remaining windows by digest and keeps the least doc_id of
each. Both merge what a block of texts has in common before the shuffle, and
read their rows in order with constant memory, so no group is ever gathered.

The confirmed passages are then compiled into automata, one for each shard of
documents and so many characters of passages, and the shard's documents run
through them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .arrow import record_batch, text_blocks
from .hashing import WordHashes, leftmost_minima, mix, odd_numbers, runs, word_windows

WIDTH = 13
ANCHOR = 5
BLOCK_BYTES = 1 << 23         # text within which equal anchors and windows are merged
PIECE_WORDS = 400             # longer passages are compiled in pieces
AUTOMATON_CHARS = 1_500_000   # characters of passages in one automaton
_NO_DOC = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its stand-in (for null, a hash of the text), whether there is an id, a short hash of the text, and the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.xxhash64(text)).alias("doc"), doc.isNotNull().alias("known"), F.hash(text).alias("tag"), doc.alias("doc_id"), text.alias("text"))


def _windows(texts: list[bytes], hashes: WordHashes, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of the texts' words: word hashes, where each text's words begin; and per window, which stays inside its text,
    the anchor's hash, the text, the first word and the anchor's word."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.split()
        counts[i] = len(own)
        words += own
    every = hashes.of(words)
    ends = np.cumsum(counts)
    if len(every) < width:
        return every, ends - counts, *(np.empty(0, np.int64) for _ in range(4))
    grams = word_windows(every, anchor)
    least = leftmost_minima(grams, width - anchor + 1)
    owner = np.repeat(np.arange(len(texts)), counts)[:len(least)]
    at = np.flatnonzero(np.arange(len(least)) + width <= ends[owner])
    return every, ends - counts, grams[least[at]].view(np.int64), owner[at], at, least[at]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


_ROW = "kind int, key long, doc long, tag int, lo int"
_ROW_SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("tag", pa.int32()), ("lo", pa.int32())])


def _elsewhere(rows: DataFrame, partitions: int, with_first_row: bool) -> DataFrame:
    """Rows ``(kind, key, doc, tag, lo)`` whose key a smaller doc has.

    Rows of kind 0 are known to recur and pass. The first row of a key comes
    out as well if asked for, once there is another (or its ``lo`` says that
    its block has others). Rows come in order, so one row is all that is held.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last key's first row, and whether it is out
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in _ROW_SCHEMA.names]
            fresh = columns[0] != 0
            out = [[x[~fresh] for x in columns]]
            columns = [x[fresh] for x in columns]
            if len(columns[0]):
                done = False
                if held is not None:
                    row, done = held
                    columns = [np.insert(x, 0, v) for x, v in zip(columns, row)]
                _, key, doc, _, lo = columns
                start = np.maximum.accumulate(np.where(_changes(key), np.arange(len(key)), 0))
                if with_first_row:
                    take = (np.bincount(start, minlength=len(key))[start] > 1) | (lo == 1)
                    take[0] &= not (held is not None and done)
                else:
                    take = doc > doc[start]
                out.append([x[take] for x in columns])
                at = int(start[-1])
                held = ([x[at] for x in columns], bool(take[at]) or (at == 0 and done))
            yield record_batch(_ROW_SCHEMA, **dict(zip(_ROW_SCHEMA.names, (np.concatenate(x) for x in zip(*out)))))

    # Known rows need no company, so the copies of a frequent key spread by doc.
    ordered = rows.repartition(partitions, F.when(F.col("kind") == 0, F.col("doc")).otherwise(F.col("key"))).sortWithinPartitions("kind", "key", "doc")
    return ordered.mapInArrow(read, _ROW)


def _anchor_rows(keyed: DataFrame, width: int, anchor: int) -> DataFrame:
    """Per block and anchor a row for its least doc, and known ones for its other docs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in text_blocks(batches, "text", BLOCK_BYTES):
            _, _, key, owner, _, place = _windows(texts, hashes, width, anchor)
            begin, _ = runs(place)
            key, doc = key[begin], batch.column("doc").to_numpy()[owner[begin]]
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            fresh = _changes(key, doc)
            key, doc = key[fresh], doc[fresh]
            least = _changes(key)
            several = np.append(~least[1:], False) if len(key) else least
            yield record_batch(_ROW_SCHEMA, kind=least.astype(np.int32), key=key, doc=doc, tag=np.zeros(len(key), np.int32), lo=several.astype(np.int32))

    return keyed.where("known").select("doc", "text").mapInArrow(cut, _ROW)


def _window_rows(texts: DataFrame, width: int, anchor: int) -> DataFrame:
    """Windows whose anchor is among the row's ``hits``: per block and window a row for its least doc, known ones for others."""
    factors = odd_numbers(width, 77)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, block in text_blocks(batches, "text", BLOCK_BYTES):
            every, first_word, key, owner, at, _ = _windows(block, hashes, width, anchor)
            hits = batch.column("hits")
            offsets = hits.offsets.to_numpy()
            # A window is a candidate if its anchor is a hit of its own row.
            row_of = np.repeat(np.arange(len(block)), np.diff(offsets))
            own = lambda h, row: mix(h.view(np.uint64) ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            chosen = np.flatnonzero(np.isin(own(key, owner), own(hits.values.to_numpy()[offsets[0]:offsets[-1]], row_of)))
            at, owner = at[chosen], owner[chosen]
            digest = np.zeros(len(at), np.uint64)
            for j in range(width):
                digest += every[at + j] * factors[j]
            key = mix(digest).view(np.int64)
            doc, tag, lo = batch.column("doc").to_numpy()[owner], batch.column("tag").to_numpy()[owner], at - first_word[owner]
            order = np.lexsort((doc, key))
            key, doc, tag, lo = key[order], doc[order], tag[order], lo[order]
            least = doc[np.maximum.accumulate(np.where(_changes(key), np.arange(len(key)), 0))]
            # The key of a known row is of no more use.
            yield record_batch(_ROW_SCHEMA, kind=(doc == least).astype(np.int32), key=np.where(doc > least, 0, key), doc=doc, tag=tag, lo=lo)

    return texts.mapInArrow(cut, _ROW)


def _passages(found: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal runs of windows as (first word, end word), in pieces of bounded length."""
    lo = np.sort(found)
    cut = np.flatnonzero(np.diff(lo) > 1) + 1
    out = []
    for begin, last in zip(lo[np.append(0, cut)].tolist(), lo[np.append(cut, len(lo)) - 1].tolist()) if len(lo) else []:
        while begin <= last:
            end = min(last, begin + PIECE_WORDS)
            out.append((begin, end + width))
            begin = end + 1
    return out


def locate(words: list[list[str]], docs: list[int], passages: dict[str, int]) -> list[np.ndarray]:
    """Which words of each document lie in an occurrence of a passage that is confirmed for it.

    ``passages`` maps words, with one space before, between and behind them, to
    the least doc for which they are confirmed; larger docs have the same
    earlier ones. Automata are compiled for a bounded number of characters each.
    """
    marks = [np.zeros(len(w) + 1, np.int64) for w in words]
    normal = [" " + " ".join(w) + " " for w in words]
    ends = [np.cumsum([len(x) + 1 for x in w]) for w in words]  # place of the space behind each word
    todo = sorted(passages)
    at = 0
    while at < len(todo):
        automaton, size = ahocorasick.Automaton(ahocorasick.STORE_ANY), 0
        while at < len(todo) and (not size or size + len(todo[at]) <= AUTOMATON_CHARS):
            automaton.add_word(todo[at], (todo[at].count(" ") - 1, passages[todo[at]]))
            size += len(todo[at])
            at += 1
        automaton.make_automaton()
        for i, text in enumerate(normal):
            found = [(e, n) for e, (n, least) in automaton.iter(text) if least <= docs[i]]
            if found:
                place, n = np.array(found).T
                last = np.searchsorted(ends[i], place) + 1
                np.add.at(marks[i], last - n, 1)
                np.add.at(marks[i], last, -1)
    return [np.cumsum(m[:-1]) > 0 for m in marks]


def remove_passages(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words with one space between).

    A word goes if a window of ``width`` words that covers it also starts in a
    row with a smaller doc_id; windows are judged on the input. A null text has
    no words. Rows with a null doc_id are neither earlier nor later than
    others and stay whole; rows with equal ids do not affect each other.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = _keyed(docs)
    # Only rows that share a doc_id and differ in text need their tag; all others do without its bytes.
    shared = pin(source.groupBy("doc").agg(F.min("tag").alias("lo"), F.max("tag").alias("hi")).where("lo <> hi").select(F.col("doc").alias("s_doc")))
    if shared.isEmpty():
        source = source.withColumn("tag", F.lit(0))
    else:
        tagged = source.join(shared, F.col("doc") == F.col("s_doc"), "left").withColumn("tag", F.when(F.col("s_doc").isNull(), 0).otherwise(F.col("tag")))
        source = tagged.drop("s_doc")
    texts = source.repartition(partitions, "doc")
    recurring = _elsewhere(_anchor_rows(source, width, anchor), partitions, True)
    hits = recurring.groupBy("doc").agg(F.collect_set("key").alias("hits"))
    candidates = texts.join(hits, "doc").select("doc", "known", "tag", "doc_id", "text", "hits")
    found = _elsewhere(_window_rows(candidates, width, anchor), partitions, False)
    # The row's tag and the window's first word in one number; joined by doc alone, as the texts are dealt.
    place = F.shiftleft(F.col("tag").cast("long"), 32) + F.col("lo")
    found = found.groupBy("doc").agg(F.collect_set(place).alias("found"))
    joined = texts.join(found, "doc", "left").select("doc", "known", "tag", "doc_id", "text", "found")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in text_blocks(batches, "text"):
            # Latin-1 keeps bytes and characters alike, so that words are matched byte by byte.
            words = [[w.decode("latin-1") for w in text.split()] for text in block]
            # Rows without an id are no document's later ones.
            ids = [_NO_DOC if d is None else d for d in batch.column("doc_id").to_pylist()]
            passages: dict[str, int] = {}
            for doc, tag, own, found in zip(ids, batch.column("tag").to_pylist(), words, batch.column("found")):
                if doc == _NO_DOC or not found.is_valid:
                    continue
                places = found.values.to_numpy()
                for a, b in _passages(places[places >> 32 == tag] & 0xFFFFFFFF, width):
                    text = " " + " ".join(own[a:b]) + " "
                    passages[text] = min(doc, passages.get(text, doc))
            gone = locate(words, ids, passages)
            left = [hashlib.sha256(" ".join(w for w, g in zip(own, flags) if not g).encode("latin-1")).hexdigest() if flags.any() else hashlib.sha256(" ".join(own).encode("latin-1")).hexdigest() for own, flags in zip(words, gone)]
            yield record_batch(schema, doc_id=batch.column("doc_id"), n_words=[len(w) for w in words], n_removed=[int(g.sum()) for g in gone], kept_sha256=left)

    return joined.mapInArrow(stream, "doc_id long, n_words long, n_removed long, kept_sha256 string")
