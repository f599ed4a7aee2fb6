"""Near-duplicate groups against all pairs of shingle sets."""

import random
import re

import pytest
from conftest import frame, prose

from meterline.llm import components, odd_sketch


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """n_shingles and component of each row, in order; a null id counts as the largest."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = float("inf") if doc is None else doc
        least[find(i)] = min(least.get(find(i), key), key)
    return [(doc, len(sets[i]), None if least[find(i)] == float("inf") else least[find(i)]) for i, (doc, _) in enumerate(rows)]


def check(spark, rows, **extra):
    got = odd_sketch.near_duplicates(frame(spark, rows, **extra)).collect()
    want = brute(rows)
    order = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=order) == sorted(want, key=order)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates(spark, odd_rows):
    rng = random.Random(2)
    base = prose(rng, 120)
    rows = odd_rows + [(100 + i, edited(rng, base, i % 5)) for i in range(60)]
    rows += [(200, base), (200, "repeated id"), (201, base.upper()), (None, base), (None, "only null ids"), (None, "only null ids")]
    check(spark, rows, component_id=1, band="x")


def test_chains_and_blocks(spark, monkeypatch):
    """Neighbours are similar and ends are not, in buckets of several blocks."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 4)
    rng = random.Random(3)
    words = prose(rng, 400).split()
    rows = [(1000 - i, " ".join(words[6 * i:6 * i + 100])) for i in range(40)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(3, "a b c"), (3, "a b c")]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, rows)


def test_dropping_keeps_columns_and_one_row(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (3, ""), (4, None), (None, "x y"), (5, "other words here")]
    kept = odd_sketch.drop_near_duplicates(frame(spark, rows, row="r", tag=1, kept=False))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "tag", "kept"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "None"]


def test_one_row_stays_of_each_group_with_null_or_repeated_ids(spark):
    """Near copies without an id, or with one id, are one group; a known id comes before null."""
    rng = random.Random(6)
    null, equal, both, alone = (prose(rng, 120) for _ in range(4))
    near = lambda base: [base, *(edited(rng, base, 1 + i % 3) for i in range(6))]
    rows = [(None, t) for t in near(null)] + [(7, t) for t in near(equal)] + [(None, t) for t in near(both)] + [(9, t) for t in near(both)]
    rows += [(8, t) for t in near(both)] + [(7, alone), (7, alone), (None, ""), (None, None), (7, " "), (7, " ")]
    got = [(r.doc_id, r.text) for r in odd_sketch.drop_near_duplicates(frame(spark, rows)).collect()]
    assert set(got) <= set(rows)
    assert sorted(str(d) for d, t in got if t and t.strip()) == ["7", "7", "8", "None"]
    assert sorted(str(d) for d, t in got if not t or not t.strip()) == ["7", "7", "None", "None"]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    root = {n: n for pair in links for n in pair}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: r for n, r in root.items() if any(n in p and p[0] != p[1] for p in links)}
    assert len({r.node for r in got}) == len(got)
