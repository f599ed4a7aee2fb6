import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import frame
from meterline.llm import max_sketch as M

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def direct(docs, items, k=10):
    counts = [(d, Counter(cut(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_words = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    pooled = {}
    for item, text in items:
        pooled.setdefault(item, set()).update(cut(text))
    out = []
    for item, own in pooled.items():
        scored = []
        for d, c in counts:
            m = 10 + (90 * c.total() * n_docs) // n_words if c else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(odd_rows):
    texts = [t for _, t in odd_rows if t]
    return [(0, texts[4][:200]), (1, None), (2, ""), (3, "word ONE ab zzz"), (4, texts[30]), (4, "the same"), (None, "é hello 12345 line"), (6, "word word"), (7, texts[5])]


@pytest.mark.parametrize("at_once", [200_000, 5])
def test_search_equals_direct_scores(spark, odd_rows, items, at_once):
    rows = odd_rows + [(None, "word and one"), (None, None), (30, odd_rows[30][1]), (70, odd_rows[30][1])]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    got = M.search(frame(spark, rows, rank=1, term="x").repartition(3), asked, item_terms_at_once=at_once).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == direct(rows, items)


def test_empty_tables(spark, odd_rows, items):
    none, asked = frame(spark, odd_rows).limit(0), spark.createDataFrame(items, "item_id long, text string")
    assert M.search(none, asked).count() == 0
    assert M.search(frame(spark, odd_rows), asked.limit(0)).count() == 0
    assert M.search(frame(spark, [(1, None), (2, "")]), asked).count() == 0


def test_bounds_hold_and_spare_most_documents(odd_rows):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}".encode() for i in range(3000)]
    texts = [b" ".join(rng.choice(vocabulary, rng.integers(1, 300))) for _ in range(800)]
    wanted = rng.choice(3000, 30, replace=False)
    words = M._Words({f"w{i}".encode(): n for n, i in enumerate(wanted)})
    block = M.DocumentBlock(texts, words, len(texts), sum(len(t.split()) for t in texts))
    which, weights = np.arange(30), rng.integers(1, 7000, 30)
    slots = np.array(words.slots[:30])
    bounds, exact = block.bounds(slots, weights), block.scores(np.arange(800), which, weights)
    assert (bounds >= exact).all() and (bounds > exact).any()
    best, scored = M.improve([], block, list(range(800)), slots, which, weights, 10)
    order = sorted((-int(s), d) for d, s in enumerate(exact) if s > 0)[:10]
    assert best == [(-s, d) for s, d in order]
    assert scored < 200


def test_a_block_below_the_threshold_is_not_scored():
    words = M._Words({b"a": 0, b"b": 1})
    block = M.DocumentBlock([b"a c c c", b"b d", b""], words, 3, 6)
    slots = np.array(words.slots[:2])
    best, scored = M.improve([(10**12, 9)], block, [1, 2, 3], slots, np.arange(2), np.array([5, 7]), 1)
    assert best == [(10**12, 9)] and scored == 0
