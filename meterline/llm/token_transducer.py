"""Token counts by finite-state transducers.

The first transducer reads the characters' classes and tells where the
byte-level tokenizer's split pattern begins a pre-token; what the pattern
looks ahead for is settled one step late. Texts are cut into chunks, each
chunk's map from every state to the state behind it is made for all chunks at
once, and the maps are composed by a parallel prefix scan. That gives each
chunk its first state, and a second pass reads the emissions.

The second transducer reads pre-tokens. Each of its edges carries the number
of tokens that a pre-token emits; edges are compiled from the tokenizers
library when a pre-token is first met.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import record_batch, text_blocks
from .tokenizer import tokenizer_path

BYTE_FILE = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 64

# Character classes: letters by their part in the contractions, then the others.
LETTER, ONE, R, V, E, LL, NUMBER, BLANK, SPACE, QUOTE, OTHER, END = range(12)
LETTERS = {LETTER, ONE, R, V, E, LL}
# The pattern's contractions are 's 't 'm 'd, 're 've and 'll.
CONTRACTED = {ord(c): ONE for c in "stmd"} | {ord("r"): R, ord("v"): V, ord("e"): E, ord("l"): LL}
# States: at a pre-token's start; in letters, numbers or others; after one blank or other space, or several that
# end in it; after a quote that starts a pre-token, and after 'r, 'v or 'l behind it.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BLANK_1, SPACE_1, BLANKS, SPACES, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)
HERE, BEFORE = 1, 2  # emissions: a pre-token begins at this character; at the one before


def _transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state and class."""
    following, emits = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    starts = {c: IN_LETTERS for c in LETTERS} | {NUMBER: IN_NUMBERS, BLANK: BLANK_1, SPACE: SPACE_1, QUOTE: QUOTED, OTHER: IN_OTHERS, END: FRESH}
    inside = {IN_LETTERS: LETTERS, IN_NUMBERS: {NUMBER}, IN_OTHERS: {QUOTE, OTHER}}
    with_blank = starts | {QUOTE: IN_OTHERS}
    pairs = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: LL}

    def step(state: int, kind: int) -> tuple[int, int]:
        begin = (starts[kind], HERE)
        if state in inside:
            return (state, 0) if kind in inside[state] else begin
        if state in (BLANK_1, SPACE_1, BLANKS, SPACES):
            if kind in (BLANK, SPACE):
                return (BLANKS if kind == BLANK else SPACES), 0
            several = BEFORE if state in (BLANKS, SPACES) else 0
            if kind == END:
                return begin
            if state in (BLANK_1, BLANKS):  # the last blank belongs to what follows
                return with_blank[kind], several
            return starts[kind], HERE | several
        if state == QUOTED:
            if kind == ONE:
                return FRESH, 0
            if kind in (R, V, LL):
                return {R: QUOTED_R, V: QUOTED_V, LL: QUOTED_L}[kind], 0
            return (IN_OTHERS, 0) if kind in (QUOTE, OTHER) else begin
        if state in pairs:
            if kind == pairs[state]:
                return FRESH, 0
            following, emitted = step(IN_LETTERS, kind)  # the quote stood alone, letters began behind it
            return following, emitted | BEFORE
        return begin

    for state in range(12):
        for kind in range(12):
            following[state, kind], emits[state, kind] = step(state, kind)
    return following, emits


NEXT, EMITS = _transducer()


def first_states(kinds: np.ndarray) -> np.ndarray:
    """State before each chunk (row) of classes: all chunks' state maps, composed by a prefix scan."""
    maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (len(kinds), 12)).copy()
    for column in kinds.T:
        maps = NEXT[maps, column[:, None]]
    hop = 1
    while hop < len(maps):  # after each round a map spans twice as many chunks
        maps[hop:] = np.take_along_axis(maps[hop:], maps[:-hop], axis=1)
        hop *= 2
    return np.append(np.uint8(FRESH), maps[:-1, FRESH])


def begins(kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each character of the class array, which starts fresh."""
    n = len(kinds)
    chunks = np.append(kinds, np.full(-n % CHUNK, END, np.uint8)).reshape(-1, CHUNK)
    state = first_states(chunks)
    out = np.empty(chunks.shape, np.uint8)
    for j in range(CHUNK):
        out[:, j] = EMITS[state, chunks[:, j]]
        state = NEXT[state, chunks[:, j]]
    emitted = out.ravel()[:n]
    flags = (emitted & HERE) > 0
    flags[:-1] |= (emitted[1:] & BEFORE) > 0
    return flags


class TokenCounter:
    """Token counts of texts under a byte-level tokenizer."""

    def __init__(self, path: str, limit: int = 500_000) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_file(path)
        self.split = tokenizer.pre_tokenizer
        self.specials = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.kinds = np.full(0x110000, 255, np.uint8)
        self.edges = _Edges(tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False), limit)
        for code in range(128):
            self.kinds[code] = self._kind(chr(code))

    def _kind(self, c: str) -> int:
        """Class of a character, asked of the library's own pattern."""
        one = lambda s: len(self.split.pre_tokenize_str(s)) == 1
        if ord(c) in CONTRACTED:
            return CONTRACTED[ord(c)]
        if c in " '":
            return BLANK if c == " " else QUOTE
        return LETTER if one(f"a{c}a") else NUMBER if one(f"1{c}1") else OTHER if one(f"!{c}!") else SPACE

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Number of tokens of each text; a special token's string counts as one and splits the text."""
        parts, owner = [], []
        counts = np.zeros(len(texts), np.int64)
        for i, raw in enumerate(texts):
            pieces = [raw.decode("utf-8", "replace")]
            for special in self.specials:
                if special in pieces[0] or len(pieces) > 1:
                    pieces = [x for p in pieces for x in p.split(special)]
            counts[i] = len(pieces) - 1
            parts += pieces
            owner += [i] * len(pieces)
        joined = "\n".join(parts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = self.kinds[codes]
        if 255 in kinds:
            for code in np.unique(codes[kinds == 255]).tolist():
                self.kinds[code] = self._kind(chr(code))
            kinds = self.kinds[codes]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        kinds[ends] = END
        at = np.flatnonzero(begins(kinds))
        places = at.tolist()
        tokens = [joined[a:b] for a, b in zip(places, places[1:])]
        emitted = np.append(np.fromiter(map(self.edges.__getitem__, tokens), np.int64, len(tokens)), 0)
        emitted[np.searchsorted(at, ends)] = 0  # the marks between parts
        total = np.cumsum(emitted)[np.searchsorted(at, ends)]
        np.add.at(counts, np.array(owner), np.diff(total, prepend=0))
        return counts


class _Edges(dict):
    """Pre-token to the tokens it emits; starts anew when full."""

    def __init__(self, model, spell, limit: int) -> None:
        self.model, self.spell, self.limit = model, spell, limit

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = len(self.model.tokenize(self.spell.pre_tokenize_str(token)[0][0]))
        return value


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens). A null text is empty."""
    path = path or tokenizer_path(BYTE_FILE)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            n = counter(path).count(texts)
            yield record_batch(schema, doc_id=batch.column("doc_id"), n_bytes=[len(t) for t in texts], n_tokens=n, over_limit=n > limit)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
