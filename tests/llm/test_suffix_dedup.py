"""Suffix arrays and the removal of repeated bytes against direct counts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import frame, prose

from meterline.llm import hashing, suffix_dedup


@pytest.mark.parametrize("seed", range(30))
def test_suffix_order(seed):
    rng = random.Random(seed)
    symbols = rng.choice([1, 2, 3, 20, 256])
    text = [rng.randrange(symbols) + 1 for _ in range(rng.randrange(1, 400))]
    if seed % 3 == 0:
        text = text[:40] * 9
    if seed % 5 == 0:
        text = [9] * 70 + text + [9] * 70
    if seed % 4 == 0:
        text[len(text) // 2] = 0
    text.append(0)
    depth = rng.choice([8, 50, 1000])
    order = suffix_dedup.suffix_order(np.array(text), depth).tolist()
    assert sorted(order) == list(range(len(text)))
    keys = [tuple(text[i:i + depth]) for i in order]
    assert keys == sorted(keys)


def test_byte_windows_depend_on_content_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 3000).astype(np.uint8)
    for width in (1, 2, 7, 8, 9, 64, 100):
        seen = {}
        for i, h in enumerate(hashing.byte_windows(data, width).tolist()):
            assert seen.setdefault(h, data[i:i + width].tobytes()) == data[i:i + width].tobytes()
        assert len(seen) == len({data[i:i + width].tobytes() for i in range(len(data) - width + 1)})


def test_leftmost_minima():
    rng = np.random.default_rng(2)
    values = (rng.integers(0, 5, 500).astype(np.uint64)) << np.uint64(40)
    for width in (1, 2, 5, 64, 137):
        got = hashing.leftmost_minima(values, width)
        assert got.tolist() == [i + int(np.argmin(values[i:i + width])) for i in range(500 - width + 1)]


@pytest.mark.parametrize("seed", range(5))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    common = bytes(rng.choices(b"abc", k=60))
    contexts = list({bytes(rng.choices(b"abc", k=rng.randrange(0, 30))) + common[rng.randrange(20):rng.randrange(30, 61)] + bytes(rng.choices(b"ab", k=30)) for _ in range(40)})
    width = 20
    seen = Counter(c[i:i + width] for c in contexts for i in range(len(c) - width + 1))
    for by_hash in (False, True):
        got = suffix_dedup.repeated_windows(contexts, width, by_hash)
        assert [g.tolist() for g in got] == [[seen[c[i:i + width]] > 1 for i in range(len(c) - width + 1)] for c in contexts]


def brute(rows, width):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[i:i + width] for _, t in texts for i in range(len(t) - width + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for at in range(len(t) - width + 1):
            if seen[t[at:at + width]] > 1:
                gone[at:at + width] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum()) if len(t) else 0
        out.append((i, len(t), int(gone[:len(t)].sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def check(spark, rows, width=200, **options):
    options = {"anchor": 64} | options
    got = [tuple(r) for r in suffix_dedup.remove_repeats(frame(spark, rows, h=1, spans="x", text_=2), width=width, **options).collect()]
    order = lambda r: (r[0] is None, r)
    assert sorted(got, key=order) == sorted(brute(rows, width), key=order)


def passages(rng):
    passage, line = prose(rng, 70), prose(rng, 12)
    rows = [(100 + i, prose(rng, rng.randrange(0, 40)) + " " + passage[rng.randrange(0, 60):] + prose(rng, rng.randrange(0, 30)) + line) for i in range(40)]
    return rows + [(200, passage), (200, passage), (200, "same id, other text " + passage), (None, passage), (None, None), (201, "é" * 400), (202, "x" * 199), (203, "x" * 200), (204, "x" * 201)]


def test_removal(spark, odd_rows):
    check(spark, odd_rows + passages(random.Random(1)))


def test_removal_in_small_batches_and_hot_anchors(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 500)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    check(spark, odd_rows + passages(random.Random(2)), batch_bytes=3000, hot=5)
    check(spark, odd_rows + passages(random.Random(2)), batch_bytes=300)


@pytest.mark.parametrize("hot", [200_000, 5])
def test_runs_and_common_lines(spark, hot):
    """Long runs of one and two characters, and lines of several lengths in very many rows."""
    rng = random.Random(8)
    lines = {n: prose(rng, 400)[:n] for n in (90, 150, 199, 200, 201, 260, 450)}
    rows = [(i, prose(rng, rng.randrange(0, 30)) + lines[n] + prose(rng, rng.randrange(0, 30))) for i, n in enumerate(sorted(lines) * 40)]
    rows += [(900, "a" * 20_000), (901, "x" + "a" * 300), (902, "ab" * 9_000), (903, "c" * 201), (904, "abc" * 70 + "ab" * 120)]
    check(spark, rows, hot=hot)


def test_a_run_is_one_context():
    for text, windows in ((b"a" * 20_000, 19_801), (b"ab" * 5_000, 9_801)):
        index, _, lo, n, places = suffix_dedup.anchored([b"xyz", text], 200, 64)
        assert (index.tolist(), lo.tolist(), n.tolist()) == ([1], [0], [windows]) and places[0] > 1


def test_other_widths(spark):
    check(spark, passages(random.Random(3)), width=50, anchor=20)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_table(spark):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def test_texts_without_repeats(spark, odd_rows):
    rows = odd_rows + passages(random.Random(4))
    out = suffix_dedup.without_repeats(frame(spark, rows, row=1, left="x"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "left"]
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert out.count() == len(rows)
    by_id = {i: t for i, t in rows}
    assert (2, by_id[2]) in got and (0, None) in got and (8, "") in got and (201, "") in got
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
