"""Removal of passages that an earlier document has, against direct comparison."""

import hashlib
import random

import pytest
from conftest import frame, prose

from meterline.llm import phrase_automata


def brute(rows, width):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, own in words:
        if i is not None:
            for at in range(len(own) - width + 1):
                key = tuple(own[at:at + width])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, own in words:
        gone = [False] * len(own)
        for at in range(len(own) - width + 1):
            if i is not None and least[tuple(own[at:at + width])] < i:
                gone[at:at + width] = [True] * width
        out.append((i, len(own), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(own, gone) if not g)).hexdigest()))
    return out


def check(spark, rows, **options):
    got = [tuple(r) for r in phrase_automata.remove_passages(frame(spark, rows, found=1, hits="x"), **options).collect()]
    order = lambda r: (r[0] is None, r)
    assert sorted(got, key=order) == sorted(brute(rows, options.get("width", 13)), key=order)


def passages(rng):
    passage = prose(rng, 60)
    words = passage.split()
    rows = [(100 + i, prose(rng, rng.randrange(20)) + " " + " ".join(words[rng.randrange(30):rng.randrange(31, 61)]) + "\n" + prose(rng, 5)) for i in range(60)]
    rows += [(90, passage), (300, passage), (300, "x " + passage), (300, passage), (None, passage), (301, "la " * 60), (302, "la " * 40), (303, passage.upper())]
    return rows


def test_removal(spark, odd_rows):
    check(spark, odd_rows + passages(random.Random(1)))


def test_removal_in_small_blocks_pieces_and_automata(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(phrase_automata, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(phrase_automata, "PIECE_WORDS", 5)
    monkeypatch.setattr(phrase_automata, "AUTOMATON_CHARS", 300)
    check(spark, odd_rows + passages(random.Random(2)))


def test_other_widths(spark):
    check(spark, passages(random.Random(3)), width=5, anchor=2)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_table(spark):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])


def test_locate_judges_the_first_document():
    words = [["a", "b", "c"], ["x", "a", "b", "c", "a", "b"]]
    got = phrase_automata.locate(words, [5, 9], {" a b ": 4, " b c ": 7})
    assert [g.tolist() for g in got] == [[True, True, False], [False, True, True, True, True, True]]
