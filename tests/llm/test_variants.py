import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import frame, prose
from meterline.llm import variants as V


def direct_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda c: c[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            if len(low) >= 7:
                n[low] += 1
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def direct(rows):
    n = direct_words(rows)
    out = {}
    for w in n:
        own = [x for x in n if near(w, x)]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        out[w] = [best if best and n[best] >= 10 * n[w] else None, len(own)]
    found = set()
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        found.add((w, form, root, n[w], n_near, n[form] if form else None))
    return found


def typos(rng, word):
    at = rng.randrange(len(word))
    letter = rng.choice("abeéñÿÀ")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]])


@pytest.fixture(scope="module")
def rows(odd_rows):
    rng = random.Random(11)
    words = [w.strip(".") for w in prose(rng, 400).split() if len(w) >= 7][:60]
    texts = []
    for i in range(120):
        own = rng.choices(words, k=40) + [typos(rng, rng.choice(words)) for _ in range(6)]
        texts.append((100 + i, " ".join(own)))
    ladder = " ".join(["anderson"] * 400 + ["andersom"] * 30 + ["andersim"] * 3)
    return odd_rows + texts + [(None, "anderson " * 40 + "andersson x×y÷zéàüab×"), (300, ladder), (300, ladder), (301, "a" * 900 + " " + "a" * 901), (302, "a" * 900)]


@pytest.mark.parametrize("cell_words", [2000, 5])
def test_variants_equal_all_pairs(spark, rows, cell_words):
    got = V.spelling_variants(frame(spark, rows, n=1, word="w", cell=2).repartition(4), cell_words).collect()
    expected = direct(rows)
    assert {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == expected
    assert len(got) == len(expected)
    assert any(r["form"] and r["root"] != r["form"] for r in got)


def test_empty_tables(spark):
    assert V.spelling_variants(frame(spark, [(1, None), (2, "")])).count() == 0
    assert V.spelling_variants(frame(spark, [(1, "x")]).limit(0)).count() == 0


@given(st.lists(st.text("abÿ", min_size=7, max_size=10), min_size=2, max_size=40, unique=True))
@settings(max_examples=60, deadline=None)
def test_trie_finds_every_pair_of_one_length_and_its_neighbours(words):
    size = len(words[0])
    home = [w.encode("latin-1") for w in words if len(w) == size]
    visitors = [w.encode("latin-1") for w in words if abs(len(w) - size) == 1]
    trie = V.CellTrie(home, visitors)
    pairs = {frozenset((trie.words[i].decode("latin-1"), trie.words[j].decode("latin-1"))) for i, j in zip(*(s.tolist() for s in trie.search()))}
    at_home = {w for w in words if len(w) == size}
    assert pairs == {frozenset((a, b)) for a in words for b in at_home if near(a, b) and abs(len(a) - size) <= 1}


def test_search_leaves_most_words_out_of_comparison():
    rng = random.Random(2)
    words = list({"".join(rng.choice("abcdefghijklmnop") for _ in range(10)) for _ in range(3000)})
    trie = V.CellTrie([w.encode() for w in words], [])
    compared = []
    verify = trie._verify
    trie._verify = lambda: (compared.append(trie.size), verify())
    trie.search()
    assert sum(compared) < len(words) * len(words) / 200


def test_cells_meet_once(rows):
    words = sorted(direct_words(rows))
    counts = V.letter_counts([w.encode("latin-1") for w in words], np.arange(256) % 4, 4)
    own, who, where = V.cells(counts)
    visits = set(zip(who.tolist(), where.tolist()))
    assert len(visits) == len(who)
    for i, a in enumerate(words):
        for j, b in enumerate(words[:i]):
            if near(a, b):
                assert (own[i] == own[j]) + ((i, own[j]) in visits) + ((j, own[i]) in visits) == 1


def test_equal_counts_go_to_the_smallest_word(spark):
    text = "banderol " * 30 + "canderol " * 30 + "anderol " * 2
    rows = [(i, text) for i in (2, 4)]
    got = {r["word"]: r for r in V.spelling_variants(frame(spark, rows)).where(F.col("form").isNotNull()).collect()}
    assert {(w, f) for w, f, *_ in direct(rows) if f} == {(w, r["form"]) for w, r in got.items()}
