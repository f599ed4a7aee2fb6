"""Whole-text encoding with the tokenizers library, each distinct word encoded once per worker.

The word tokenizer drops white space before it splits, so no token spans two
words and the ids of a text are those of its words in order. A worker keeps
the ids of the words it has met; the memory of that is bounded, and a full
table starts anew.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_FILE = "word_bpe_49k.json"
ENCODE_BYTES = 1 << 22  # text that is encoded together
# Fixed rule of byte-level vocabularies: bytes without a visible Latin-1 character stand as those from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTES = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}


def tokenizer_path(name: str) -> str:
    """The path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space and never merges across it."""

    # Pre-tokens of the vocabulary's split pattern over lower-case Latin-1 (fixed values: its contractions).
    _PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z0-9\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+")
    # Latin-1 without controls, white space, and digits that are no ASCII.
    _PLAIN = re.compile("[!-~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u00ff]+")

    def __init__(self, path: str, max_words: int = 1_500_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.max_words = max_words
        self._reset()

    def _reset(self) -> None:
        # Place of words and ASCII pieces (bytes) and of other pieces (text); place p has the ids from edges[p] to edges[p + 1].
        self.places: dict[bytes | str, int] = {}
        self.flat = array("H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "L")
        self.edges = array("q", [0])

    def _add(self, ids: list[int] | array) -> int:
        self.flat.extend(ids)
        self.edges.append(len(self.flat))
        return len(self.edges) - 2

    def _piece(self, piece: str) -> int:
        key = piece.encode() if piece.isascii() else piece
        at = self.places.get(key)
        if at is None:
            at = self.places[key] = self._add([t.id for t in self.model.tokenize(piece)])
        return at

    def _word(self, word: bytes) -> int:
        """Place of one new word without ASCII white space."""
        if word.isalpha():  # ASCII letters
            low = word.lower()
            return self._add([t.id for t in self.model.tokenize(word.decode())]) if low == word else self._piece(low.decode())
        text = word.decode("utf-8", "replace")
        if "<|" in text:  # may hold a special token's string, which the library finds before it splits
            return self._add(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self._PLAIN.fullmatch(text):
            pieces = self._PIECE.findall(text.lower())
            if not text.isascii():
                pieces = [p if p.isascii() else p.encode().decode("latin-1").translate(_BYTES) for p in pieces]
        else:
            pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]
        if len(pieces) == 1:
            return self._piece(pieces[0])
        out = array(self.flat.typecode)
        for at in map(self._piece, pieces):
            out += self.flat[self.edges[at]:self.edges[at + 1]]
        return self._add(out)

    def word_ids(self, word: bytes) -> array:
        """Ids of one word without ASCII white space."""
        at = self.places.get(word)
        if at is None:
            at = self.places[word] = self._word(word)
        return self.flat[self.edges[at]:self.edges[at + 1]]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and the number of ids of each text."""
        if len(self.places) > self.max_words:
            self._reset()
        whole = pa.array(texts, pa.binary()).cast(pa.string(), safe=False)
        split = pc.ascii_split_whitespace(whole)  # with empty words at the ends, which have no ids
        n_words = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        words = split.flatten().dictionary_encode()
        different = words.dictionary.cast(pa.binary()).to_pylist()
        place = list(map(self.places.get, different))
        for i, at in enumerate(place):
            if at is None:
                place[i] = self.places[different[i]] = self._word(different[i])
        at = np.array(place, np.int64)[words.indices.to_numpy()]
        known = np.frombuffer(self.edges, np.int64)
        starts = known[at]
        lengths = known[at + 1] - starts
        total = int(lengths.sum())
        ends = np.cumsum(lengths)
        if total:
            where = np.repeat(starts - (ends - lengths), lengths)
            where += np.arange(total)
            ids = np.frombuffer(self.flat, f"u{self.flat.itemsize}")[where]
        else:
            ids = np.empty(0, f"u{self.flat.itemsize}")
        del known  # the tables may grow again
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_words)])]
        return ids, np.diff(edges)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    return WordEncoder(path)
