import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import frame
from meterline.llm import pitman_yor as P


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def cut(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [None]


def direct_base(rows):
    trained = Counter(t for d, x in rows if not held(d) for t in cut(x))
    n, v = trained.total(), len(trained)
    out = []
    for d, x in rows:
        own = cut(x)
        out.append((d, held(d), len(own), sum(trained[t] > 0 for t in own), n, sum(math.log10((trained[t] + 1) / (n + v + 1)) for t in own)))
    return out


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))


@pytest.mark.parametrize("shard_bytes", [1 << 24, 3000])
def test_counts_and_base_equal_direct_ones(spark, odd_rows, shard_bytes):
    rows = odd_rows + [(None, "One two"), (None, None), (30, odd_rows[30][1]), (5, "again")]
    got = P.score(frame(spark, rows, held=1, score="x", kind=2).repartition(3), shard_bytes=shard_bytes).collect()
    assert len(got) == len(rows)
    got = by_row([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got])
    expected = by_row(direct_base(rows))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected])
    assert all(g[6] < 0 for g in got)


def test_score_by_hand_where_nothing_is_drawn(spark):
    """One trained text of different words: every pair has one customer, every dish one table."""
    train = next(i for i in range(100) if not held(i))
    ids = [i for i in range(200) if held(i)][:3]
    texts = {train: "a b c d", ids[0]: "a b", ids[1]: "z c", ids[2]: ""}
    got = {r["doc_id"]: r["score"] for r in P.score(frame(spark, list(texts.items()))).collect()}
    d1 = d0 = 0.95  # nothing occurs twice
    tables = known = 5
    pairs = {("<", "a"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", ">")}
    contexts = {u for u, _ in pairs}

    def parent(w):
        new = (1 + d0 * tables) / (known + 1)
        return ((1 - d0 if w in "abcd>" else 0) + new) / (1 + tables)

    strengths = [np.random.default_rng([12, turn, 2]).gamma(1) for turn in (2, 3)]  # no data beyond the prior

    def chance(u, w):
        visits = int(u in contexts)
        return np.mean([((1 - d1 if (u, w) in pairs else 0) + (s + d1 * visits) * parent(w)) / (s + visits) for s in strengths])

    for doc, text in texts.items():
        line = ["<", *text.split(), ">"]
        assert got[doc] == pytest.approx(sum(math.log10(chance(u, w)) for u, w in zip(line, line[1:])))
    assert sum(chance("a", w) for w in "abcd>z") == pytest.approx(1)


def chain(rng, texts):
    """Texts of a chain in which each of 60 words has four successors."""
    words = [f"w{i}" for i in range(60)]
    follow = {w: rng.sample(words, 4) for w in words}
    rows = []
    for i in range(texts):
        w, out = rng.choice(words), []
        for _ in range(rng.randrange(20, 60)):
            out.append(w)
            w = rng.choice(follow[w])
        rows.append((i, " ".join(out)))
    return rows


def held_out(scores):
    return scores.where("held_out").agg(F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()


def test_pairs_beat_single_words_on_held_out_texts(spark):
    rows = chain(random.Random(4), 250)
    df = frame(spark, rows)
    sharded = P.score(df, shard_bytes=8000)
    n, base, score = held_out(sharded)
    assert -score / n < math.log10(4) * 1.25 < -base / n / 2
    assert score == pytest.approx(held_out(P.score(df))[2], rel=0.01)
    assert sorted(sharded.collect()) == sorted(sharded.collect())
    fewer = [r for r in rows if held(r[0])] + [r for r in rows if not held(r[0])][:50]
    assert held_out(P.score(frame(spark, fewer)))[2] < score


def test_words_without_order_stay_near_the_base(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words[:1 + rng.randrange(300)]) for _ in range(80))) for i in range(300)]
    n, base, score = held_out(P.score(frame(spark, rows).repartition(2), shard_bytes=5000))
    assert score == pytest.approx(base, rel=0.05)


def test_empty_and_untrained_tables(spark):
    assert P.score(frame(spark, [(1, "x")]).limit(0)).count() == 0
    only = next(i for i in range(100) if held(i))
    row = P.score(frame(spark, [(only, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def partitions(n):
    """Numbers of tables and sizes of all ways to seat n customers."""
    def grow(sizes, left):
        if not left:
            yield sizes
            return
        for i in range(len(sizes)):
            yield from grow([*sizes[:i], sizes[i] + 1, *sizes[i + 1:]], left - 1)
        yield from grow([*sizes, 1], left - 1)
    return grow([1], n - 1)


@pytest.mark.parametrize("customers,others,parent", [(2, 3, 0.1), (5, 0, 0.5), (6, 40, 0.2)])
def test_draws_follow_the_exact_conditional(customers, others, parent):
    strength, discount = 1.5, 0.6
    weight = np.zeros(customers + 1)
    for sizes in partitions(customers):
        t = len(sizes)
        seated = math.prod(math.prod(k - discount for k in range(1, s)) for s in sizes)
        opened = math.prod(parent * (strength + discount * (others + j)) for j in range(t))
        weight[t] += seated * opened
    exact = weight / weight.sum()
    draws = 200_000
    one = np.ones(draws)
    t = P.seats(np.random.default_rng(1), (customers * one).astype(np.int64), (others * one).astype(np.int64), parent * one, strength, discount)
    assert np.abs(np.bincount(t, minlength=customers + 1) / draws - exact).max() < 0.005


def test_leaps_seat_like_single_customers():
    rng = np.random.default_rng(2)
    customers, others, parent, strength, discount = 400, 50, 0.05, 1.0, 0.7
    drawn = P.seats(rng, np.full(4000, customers), np.full(4000, others), np.full(4000, parent), strength, discount)
    slow = np.ones(4000)
    for seated in range(1, customers):
        new = parent * (strength + discount * (others + slow))
        slow += rng.random(4000) < new / (new + seated - discount * slow)
    assert drawn.mean() == pytest.approx(slow.mean(), rel=0.03)


def test_packed_arrays_return():
    arrays = [np.array([], np.int64), np.array([0, 255, 256, 1 << 47]), np.array([-1.5, np.inf, 0.0]), np.array([-3, 2]).view(np.uint64)]
    for a, b in itertools.zip_longest(arrays, P.unpack(P.pack(*arrays))):
        assert a.view(np.int64).tolist() == b.view(np.int64).tolist()
