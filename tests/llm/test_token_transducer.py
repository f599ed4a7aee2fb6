"""Token counts and pre-tokens against the tokenizers library."""

import random

import numpy as np
import pytest
from conftest import frame
from tokenizers import Tokenizer

from meterline.llm import token_transducer
from meterline.llm.tokenizer import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(token_transducer.BYTE_FILE))


def odd_texts():
    rng = random.Random(1)
    pieces = ["'s", "'re", "'r", "'ve", "'v", "'ll", "'l", "'", "''", " '", "!'s", "1's", "a", "B", "é", "ñ", "中", "1", "٣", " ", "  ", "\n", "\t", " ", "　", "!", "...", "😀", "<|endoftext|>", "<|", "the", " The", "\r\n"]
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 30))) for _ in range(3000)]


@pytest.mark.parametrize("limit", [20, 500_000])
def test_counts_are_the_library_s(library, odd_rows, limit):
    texts = odd_texts() + [t or "" for _, t in odd_rows]
    got = token_transducer.TokenCounter(tokenizer_path(token_transducer.BYTE_FILE), limit).count([t.encode() for t in texts])
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [(t, g, w) for t, g, w in zip(texts, got.tolist(), want) if g != w] == []


def test_begins_is_the_library_s_split(library):
    counter = token_transducer.counter(tokenizer_path(token_transducer.BYTE_FILE))
    for text in odd_texts()[:1000]:
        if text and "<|endoftext|>" not in text:
            counter.count([text.encode()])
            kinds = counter.kinds[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
            got = np.flatnonzero(token_transducer.begins(np.append(kinds, np.uint8(token_transducer.END)))).tolist()
            assert got == [a for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)] + [len(text)]


def test_state_maps_compose(monkeypatch):
    kinds = np.random.default_rng(3).integers(0, 12, 5000).astype(np.uint8)
    want = token_transducer.begins(kinds)
    for chunk in (1, 3, 5000, 8192):
        monkeypatch.setattr(token_transducer, "CHUNK", chunk)
        assert (token_transducer.begins(kinds) == want).all()


def test_token_counts(spark, library, odd_rows):
    rows = odd_rows + [(None, "no id"), (7, "again")]
    got = token_transducer.token_counts(frame(spark, rows, n_tokens="x", over_limit=1)).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    order = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got), key=order) == sorted(((*w, w[2] > 1024) for w in want), key=order)
    assert token_transducer.token_counts(frame(spark, [])).collect() == []


def test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_transducer.token_counts(docs).collect()}
    rows = docs.collect()
    want = library.encode_batch([r.text for r in rows], add_special_tokens=False)
    assert got == {r.doc_id: len(e.ids) for r, e in zip(rows, want)}
