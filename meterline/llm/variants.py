"""Spelling variants by a trie over letter counts.

A word's vector counts its letters by letter group. One inserted, deleted or
replaced letter raises at most one count by one and lowers at most one by one.
Words are arranged in a trie by successive counts: the first levels are a few
coarse groups, the others single letters. The coarse levels deal the words to
cells (one for each path), and a word is also sent to the cells that one
surplus and one deficit reach; of two cells only the smaller sends to the
larger, so each pair of words meets once. Inside a cell a depth-first search
takes all words that are still within their budgets down the trie together;
words that reach a leaf are compared letter by letter.

A word of these alphabets is held as Latin-1 bytes, one for each code point.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .arrow import record_batch

LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGE = 31            # one run in so many, by checksum, loses a letter
DOMINANCE = 10         # a form is so many times as frequent
COUNTED = 500_000      # words that a task counts before it sends the counts on
CELL_WORDS = 2_000     # words for which a further coarse group pays
LEAF = 8               # words of a trie node that are compared without going further down
PAIRS = 1 << 18        # pairs compared at once
# Fixed values of the contract: A-Z are lowered, a-z and U+00C0 to U+00FF stay, all else parts runs.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
# Columns of the vectors: a to z, then the other letters by eights.
_COLUMN = np.array([c - 97 if 97 <= c <= 122 else 26 + (c - 0xC0) // 8 if c >= 0xC0 else 0 for c in range(256)])
COLUMNS = 34


def runs(text: str) -> list[bytes]:
    """Lower-cased letter runs of a text, as Latin-1."""
    return text.encode("latin-1", "replace").translate(_TABLE).split()


def damaged(run: bytes, prefix: int) -> bytes:
    """The run, without one letter where the checksum of ``<doc_id>:<run>`` says so; ``prefix`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough; a null doc_id counts as an empty one."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return record_batch(schema, word=[w.decode("latin-1") for w in found], n=list(found.values()))

        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text")):
                prefix = zlib.crc32(doc.as_py().encode() + b":")
                own = Counter(r for r in runs(text.as_py() or "") if len(r) >= LEAST_LENGTH)
                for run, n in own.items():
                    word = damaged(run, prefix)
                    if len(word) >= LEAST_LENGTH:
                        found[word] += n
                if len(found) > COUNTED:
                    yield out()
                    found.clear()
        yield out()

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("string").alias("text"))
    counts = named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def letter_counts(words: list[bytes], column: np.ndarray, columns: int) -> np.ndarray:
    """Count of each word's letters by column."""
    out = np.zeros((len(words), columns), np.int32)
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8)
    np.add.at(out, (np.repeat(np.arange(len(words)), lengths), column[letters]), 1)
    return out


def cells(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The path of each row through the coarse levels, and the greater paths one surplus and one deficit away.

    Paths are numbers in base 2**b with b bits a level; returned are the own
    path, the index of the row of each visit, and the path it goes to.
    """
    levels = counts.shape[1]
    bits = 62 // levels
    # A count beyond the base wraps; words of equal paths stay together and each step still differs by the same.
    scale = np.int64(1) << (bits * np.arange(levels - 1, -1, -1, dtype=np.int64))
    own = counts.astype(np.int64) @ scale
    steps = [(up, down) for up in range(-1, levels) for down in range(-1, levels) if up != down]
    who, where = [], []
    for up, down in steps:
        move = (scale[up] if up >= 0 else 0) - (scale[down] if down >= 0 else 0)
        if move <= 0:
            continue
        able = np.flatnonzero(counts[:, down] > 0) if down >= 0 else np.arange(len(counts))
        who.append(able)
        where.append(own[able] + move)
    return own, np.concatenate(who), np.concatenate(where)


def one_edit(a: np.ndarray, b: np.ndarray, short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters, padded by zeros, differ by exactly one letter inserted, deleted or replaced.

    ``short`` and ``long`` are the rows' lengths, and ``b`` is the longer one.
    """
    width = a.shape[1]
    place = np.arange(width)
    inside = place < short[:, None]
    same = (a == b) | ~inside
    replaced = (long == short) & ((~same).sum(axis=1) == 1)
    prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
    shifted = (a[:, :-1] == b[:, 1:]) | ~inside[:, :-1]
    from_end = shifted[:, ::-1]
    good_from = np.where(from_end.all(axis=1), 0, width - 1 - from_end.argmin(axis=1))
    inserted = (long == short + 1) & (prefix >= good_from)
    return replaced | inserted


class CellTrie:
    """The words at home in one cell, in the order of their letter counts, and the search through them."""

    def __init__(self, home: list[bytes], visitors: list[bytes]) -> None:
        counts = letter_counts(home, _COLUMN, COLUMNS)
        order = np.lexsort(counts.T[::-1])
        self.words = [home[i] for i in order.tolist()] + visitors
        self.n_home = len(home)
        self.counts = np.concatenate([counts[order], letter_counts(visitors, _COLUMN, COLUMNS)])
        self.lengths = np.array([len(w) for w in self.words])
        width = int(self.lengths.max()) + 1
        self.letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in self.words), np.uint8).reshape(-1, width)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word, word at home) that differ by one edit, each once."""
        everyone = np.arange(len(self.words))
        ones = np.ones(len(self.words), np.int32)
        self._descend(0, 0, self.n_home, everyone, ones, ones)
        self._verify()
        if not self.found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(side) for side in zip(*self.found))

    def _descend(self, depth: int, lo: int, hi: int, q: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        counts = self.counts
        while len(q):
            if hi - lo <= LEAF:
                for at in range(lo, hi):
                    self._leaf(depth, at, at + 1, q, surplus, deficit)
                return
            differ = counts[lo, depth:] != counts[hi - 1, depth:]
            if not differ.any():
                self._leaf(depth, lo, hi, q, surplus, deficit)
                return
            fork = depth + int(differ.argmax())
            if fork > depth:  # one path down to the fork
                q, surplus, deficit = self._spend(q, surplus, deficit, counts[lo, depth:fork], depth, fork)
                depth = fork
                continue
            values = counts[lo:hi, depth]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [hi - lo]]) + lo
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                self._descend(depth + 1, a, b, *self._spend(q, surplus, deficit, counts[a, depth:depth + 1], depth, depth + 1))
            return

    def _spend(self, q: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, path: np.ndarray, depth: int, end: int) -> tuple:
        """The words that can pay for the way down from ``depth`` to ``end``, with what they have left."""
        step = self.counts[q, depth:end] - path
        more, less = np.maximum(step, 0).sum(axis=1, dtype=np.int32), np.maximum(-step, 0).sum(axis=1, dtype=np.int32)
        able = (more <= surplus) & (less <= deficit)
        return q[able], (surplus - more)[able], (deficit - less)[able]

    def _leaf(self, depth: int, lo: int, hi: int, q: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """Hold the pairs of a leaf, whose words from ``lo`` to ``hi`` have equal counts, for comparison."""
        q, _, _ = self._spend(q, surplus, deficit, self.counts[lo, depth:], depth, COLUMNS)
        for at in range(lo, hi):
            who = q[(q > at)]  # words at home meet once; visitors come after them
            if len(who):
                self.held.append((who, np.full(len(who), at)))
                self.size += len(who)
                if self.size > PAIRS:
                    self._verify()

    def _verify(self) -> None:
        if not self.held:
            return
        a, b = (np.concatenate(side) for side in zip(*self.held))
        self.held, self.size = [], 0
        swap = self.lengths[a] > self.lengths[b]
        short, long = np.where(swap, b, a), np.where(swap, a, b)
        good = one_edit(self.letters[short], self.letters[long], self.lengths[short], self.lengths[long])
        if good.any():
            self.found.append((a[good], b[good]))


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n_near, best_n and best of each row of ``words`` (word, n) with a word one edit away.

    ``best`` is the most frequent near word, of equal ones the first in
    code-point order.
    """
    total = words.count()
    # Each coarse group more multiplies the number of cells by about three.
    levels = min(8, max(3, 2 + math.ceil(math.log(max(total, 1) / cell_words + 1, 3))))
    coarse = np.arange(256) % levels
    schema = pa.schema([("cell", pa.int64()), ("home", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, who, where = cells(letter_counts([w.encode("latin-1") for w in batch.column("word").to_pylist()], coarse, levels))
            yield record_batch(schema, cell=own, home=np.ones(len(own), bool), word=batch.column("word"), n=batch.column("n"))
            rows = batch.take(pa.array(who))
            yield record_batch(schema, cell=where, home=np.zeros(len(where), bool), word=rows.column("word"), n=rows.column("n"))

    out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def search(group: pa.Table) -> pa.Table:
        at_home = group.column("home").to_numpy()
        parts = group.filter(pa.array(at_home)), group.filter(pa.array(~at_home))
        home, visitors = ([w.encode("latin-1") for w in p.column("word").to_pylist()] for p in parts)
        if not home:
            return out.empty_table()
        trie = CellTrie(home, visitors)
        a, b = trie.search()
        if not len(a):
            return out.empty_table()
        n_of = dict(zip(home + visitors, np.concatenate([p.column("n").to_numpy() for p in parts]).tolist()))
        one, other = np.concatenate([a, b]), np.concatenate([b, a])
        n = np.array([n_of[w] for w in trie.words], np.int64)
        place = np.empty(len(trie.words), np.int64)
        place[sorted(range(len(place)), key=trie.words.__getitem__)] = np.arange(len(place))
        order = np.lexsort((place[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
        counts = np.diff(np.append(first, len(one)))
        name = lambda which: [trie.words[i].decode("latin-1") for i in which.tolist()]
        columns = [name(one[first]), counts, n[other[first]], name(other[first])]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    dealt = words.select("word", "n").mapInArrow(deal, "cell long, home boolean, word string, n long")
    found = dealt.groupBy("cell").applyInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows, whose words are followed to the last.

    Each step multiplies the frequency by ten, so chains are short; a round
    doubles the steps taken.
    """
    links = pin(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = pin(links.join(onward, "root", "left"))
        links = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return links


def spelling_variants(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word: n, n_near, form, form_n and root.

    A null or empty text has no words, nor has an empty table. Very long texts
    are taken whole, and equal rows count as often as they come. A null doc_id
    counts as an empty one where letters are deleted by checksum. Of near words
    with equal n the first in code-point order is the form. Columns other than
    doc_id and text are not looked at.
    """
    words = pin(vocabulary(docs))
    near = near_words(words, cell_words)
    dominant = F.col("best_n") >= DOMINANCE * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(dominant, F.col("best")).alias("form"), F.when(dominant, F.col("best_n")).alias("form_n"),
    )
    judged = pin(judged)
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
