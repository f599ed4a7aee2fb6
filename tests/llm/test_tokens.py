"""Token shards and packing against the tokenizers library, text by text."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import frame
from tokenizers import Tokenizer

from meterline.llm import elias_fano, packing
from meterline.llm.tokenizer import WORD_FILE, WordEncoder, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(WORD_FILE))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sample(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_word_encoder_is_the_library(spark, library, odd_rows):
    texts = [t or "" for _, t in odd_rows + sample(spark)]
    for limit in (3, 500_000):  # a table that is always full, and one that never is
        encoder = WordEncoder(tokenizer_path(WORD_FILE), limit)
        for part in (texts[:7], texts[7:]):
            ids, counts = encoder.encode([t.encode() for t in part])
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [ids_of(library, t) for t in part]


def test_elias_fano_lists():
    for values in ([], [0], [0, 0, 0], [5], [1, 1, 2, 3, 900, 900, 10**12], list(range(0, 5000, 3)), [2**62, 2**63 - 1]):
        coded, _ = elias_fano.EliasFano.from_bytes(memoryview(elias_fano.EliasFano.build(np.array(values, np.uint64)).to_bytes()))
        assert coded.all().tolist() == values
        assert [coded.select(i) for i in range(len(values))] == values


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_shards(spark, library, odd_rows, shard_ids):
    rows = odd_rows + [(None, "null id"), (None, None), (-5, "negative"), (30, odd_rows[30][1])]
    got = elias_fano.round_trip(frame(spark, rows, start=1, shard="x"), shard_ids=shard_ids).collect()
    assert len(got) == len(rows)
    at = 0
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, None, *sorted(i for i, _ in rows if i is not None)]
    want = defaultdict(list)
    for i, text in rows:
        want[i].append(crc(ids_of(library, text) + [1]))
    for r in order:
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove(r.ids_crc32)


def test_one_document_of_a_shard():
    shard = elias_fano.TokenShard(elias_fano.TokenShard.pack([None, 3, 9], np.array([1, 3, 2]), np.array([1, 70000, 2, 1, 8, 1])))
    assert shard.doc_ids() == [None, 3, 9]
    assert [shard.doc(i).tolist() for i in range(3)] == [[1], [70000, 2, 1], [8, 1]]


def packed_ok(rows, library, docs, capacity):
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for i, text in docs:
        ids = ids_of(library, text) + [0]
        cut = [(k, a, len(ids[a:a + capacity]), crc(ids[a:a + capacity])) for k, a in enumerate(range(0, len(ids), capacity))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == cut
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(bins)


def test_packing(spark, library, odd_rows):
    rows = packing.pack_documents(frame(spark, odd_rows, length=3, sequence_id="x")).collect()
    bins = packed_ok(rows, library, odd_rows, packing.CAPACITY)
    assert bins == -(-sum(r.length for r in rows) // packing.CAPACITY)


def test_packing_in_several_levels(spark, library, odd_rows):
    pieces = packing.token_pieces(frame(spark, odd_rows), capacity=100)
    rows = packing.pack(pieces, 100, group_rows=20).collect()
    bins = packed_ok(rows, library, odd_rows, 100)
    assert bins <= 1.02 * sum(r.length for r in rows) / 100 + 1


def test_packing_nothing(spark):
    assert packing.pack_documents(frame(spark, [])).collect() == []
    assert elias_fano.round_trip(frame(spark, [])).collect() == []


def test_equal_rows_are_packed_apart(spark, library):
    rows = packing.pack_documents(frame(spark, [(1, "one two three")] * 4)).collect()
    assert sorted(r.offset for r in rows) == [0, 4, 8, 12]


def test_few_sequences(spark):
    pieces = packing.pin(packing.token_pieces(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    total = pieces.groupBy().sum("length").first()[0]
    assert packing.pack(pieces).select("sequence_id").distinct().count() <= 1.002 * total / packing.CAPACITY + 1


def direct_sum_of_squares(lengths, capacity):
    """Every open sequence tried, by the sum over gaps of the squared number of open sequences."""
    gaps, out = [], []
    for size in lengths:
        def total(k):
            after = [g - size if i == k else g for i, g in enumerate(gaps)]
            return sum(n * n for g, n in Counter(after).items() if g)
        fitting = [k for k, g in enumerate(gaps) if g >= size]
        if fitting:
            k = min(fitting, key=lambda k: (total(k), gaps[k]))
        else:
            k = len(gaps)
            gaps.append(capacity)
        out.append(gaps[k])
        gaps[k] -= size
    return out


@pytest.mark.parametrize("seed", range(6))
def test_choice_equals_a_direct_search(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(1, 40, 120))[::-1] if seed % 2 else rng.integers(1, 40, 120)
    _, offsets = packing.sum_of_squares(lengths, 40)
    assert (40 - offsets).tolist() == direct_sum_of_squares(lengths.tolist(), 40)


def test_groups_stay_bounded_where_rows_repeat_or_nothing_fills_up(spark, monkeypatch):
    rows = [(None, "one two three " * 20)] * 90 + [(i, "word " * 55) for i in range(90)]
    pieces = packing.token_pieces(frame(spark, rows), capacity=100)
    packed = packing.pack(pieces, 100, group_rows=30).collect()
    assert len(packed) == 180
    groups = Counter((r.sequence_id >> 24) for r in packed)
    assert len(groups) >= 6 and max(groups.values()) <= 60
    assert sorted(r.length for r in packed) == sorted([61] * 90 + [56] * 90)
