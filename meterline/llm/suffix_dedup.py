"""Removal of repeated byte strings by suffix arrays.

Every window of WIDTH bytes is filed under an anchor: the least hashed run of
ANCHOR bytes inside it, which depends on the window alone. Equal windows so
meet at equal anchors; an anchor that occurs once holds no repeated window and
is dropped. Around each other anchor the bytes of its windows (a context) are
cut out, equal contexts are counted before they are shuffled, and the rest are
grouped by anchor. Batches of groups become one text each, whose suffix array
is built in two stages: suffixes smaller than their successors are sorted, the
others follow by scans of the buckets. Windows whose neighbours in the array
share WIDTH bytes occur elsewhere.

An anchor that occurs very often, as in a line that many texts share, is
refined first: equal contexts are found by their digests, with counts that
combine before the shuffle, and one of each goes on. Where one anchor still
has too many different contexts, their windows are filed under longer anchors
(LONGER) and at last under themselves. A group whose different contexts
outgrow a batch has its windows ordered by hash instead of content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import collecting, pin, release
from .arrow import record_batch, text_blocks
from .hashing import byte_windows, leftmost_minima

WIDTH = 200
ANCHOR = 64
BATCH_BYTES = 1 << 20       # text of one suffix array
HOT_CONTEXTS = 200_000      # contexts of an anchor beyond which it is refined
LONGER = (0.64, 0.96)       # longer anchors, in widths
BLOCK_BYTES = 1 << 22       # text within which equal contexts are merged before the shuffle
SEGMENT = 1 << 26           # longer texts are cut into overlapping segments when hashed


def anchored(texts: list[bytes], width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Per run of windows with equal anchors: index of the text, anchor hash, first window start, number of windows, of anchors.

    Neighbouring windows with equal anchors make one run also where the anchor
    moves on, as it does in a text that repeats itself.
    """
    out = []
    group, size = [], 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
        lengths = np.array([len(part) for _, _, part in group])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        hashes = byte_windows(data, anchor)
        least = leftmost_minima(hashes, width - anchor + 1)
        owner = np.repeat(np.arange(len(group)), lengths)[:len(least)]
        at = np.flatnonzero(np.arange(len(least)) + width <= (begins + lengths)[owner])
        if len(at):
            own, place = hashes[least[at]], least[at]
            fresh = np.append(True, (own[1:] != own[:-1]) | (np.diff(at) > 1))
            first = np.flatnonzero(fresh)
            moved = np.append(0, np.cumsum(place[1:] != place[:-1]))
            last = np.append(first[1:], len(at)) - 1
            who = owner[at[first]]
            index, offset = np.array([i for i, _, _ in group])[who], np.array([o for _, o, _ in group])[who]
            out.append((index, own[first].view(np.int64), at[first] - begins[who] + offset, last - first + 1, moved[last] - moved[first] + 1))
        group, size = [], 0

    for i, text in enumerate(texts):
        for offset in range(0, len(text) - width + 1, SEGMENT):
            part = text[offset:offset + SEGMENT + width - 1]
            group.append((i, offset, part))
            size += len(part)
            if size >= 1 << 20:
                flush()
    flush()
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


def _piece_ranks(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank (start of its group of equals) of each piece: the codes from one place of ``at`` to the next, both included.

    Pieces end at their second odd code, so none is a prefix of another.
    """
    n = len(at)
    ends = np.append(at[1:], at[-1])
    padded = np.append(codes, np.zeros(8, np.int64))

    def word(which: np.ndarray, step: int) -> np.ndarray:
        value = np.zeros(len(which), np.int64)
        for j in range(step * 6, step * 6 + 6):
            place = at[which] + j
            value = (value << 10) | np.where(place <= ends[which], padded[np.minimum(place, len(codes))], 0)
        return value

    every = np.arange(n)
    rank = np.zeros(n, np.int64)
    active, step = every, 0
    while len(active):
        key = word(active, step)
        order = np.lexsort((key, rank[active]))
        old, new = rank[active][order], key[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (new[1:] != new[:-1])
        group = np.ones(len(order), bool)
        group[1:] = old[1:] != old[:-1]
        place = np.arange(len(order))
        rank[active[order]] = old + place[np.maximum.accumulate(np.where(fresh, place, 0))] - place[np.maximum.accumulate(np.where(group, place, 0))]
        step += 1
        active = active[at[active] + step * 6 <= ends[active]]
    return rank


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols, by two-stage sorting.

    Symbols are 0 to 500, and the last one is 0.

    Suffixes smaller than their successors are sorted directly: by the pieces
    between them, doubling the number of pieces compared. The others are
    induced: bucket by bucket, each takes the order of its successor, which
    the scan has placed before.
    """
    text = np.asarray(text, np.int64)
    n = len(text)
    step = np.sign(np.diff(text))
    # Type of each suffix: the first different successor decides; the last suffix is sorted directly.
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    decider = np.append(np.minimum.accumulate(place[::-1])[::-1], n - 1)
    smaller = np.append(step, 1)[decider] > 0
    at = np.flatnonzero(smaller)
    rank = _piece_ranks(2 * text + smaller + 1, at)

    # First stage: only groups of equals stay active; a group is done when it spans the depth.
    hop = 1
    count = len(at)
    sizes = np.bincount(rank, minlength=count)
    active = np.flatnonzero(sizes[rank] > 1)
    while len(active) and hop < depth:
        ahead = active + hop
        far = np.where(ahead < count, at[np.minimum(ahead, count - 1)], n) - at[active]
        active = active[far < depth]
        if not len(active):
            break
        ahead = active + hop
        key = (rank[active] << 32) | np.where(ahead < count, rank[np.minimum(ahead, count - 1)] + 1, 0)
        order = np.argsort(key)
        ranked = key[order]
        old = ranked >> 32
        spot = np.arange(len(order))
        fresh, group = np.ones(len(order), bool), np.ones(len(order), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        group[1:] = old[1:] != old[:-1]
        # Equals that already span the depth keep the group's start; they are not reordered.
        new = old + np.maximum.accumulate(np.where(fresh, spot, 0)) - np.maximum.accumulate(np.where(group, spot, 0))
        rank[active[order]] = new
        sizes = np.bincount(rank, minlength=count)
        active = active[sizes[rank[active]] > 1]
        hop *= 2

    # Second stage: places of the sorted ones, then a scan over the buckets.
    larger = np.flatnonzero(~smaller)
    symbols = int(text.max()) + 1
    per_symbol = np.bincount(text, minlength=symbols)
    bucket = np.concatenate([[0], np.cumsum(per_symbol)])
    larger_upto = np.cumsum(np.bincount(text[larger], minlength=symbols))
    final = np.empty(n, np.int64)
    final[at] = rank + larger_upto[text[at]]
    by_symbol = larger[np.argsort(text[larger].astype(np.uint16), kind="stable")]
    edges = np.concatenate([[0], larger_upto])
    in_bucket = text[1:] == text[:-1]
    for c in range(symbols):
        own = by_symbol[edges[c]:edges[c + 1]]
        base = int(bucket[c])
        level = own[~in_bucket[own]]
        while len(level):
            successor = final[level + 1]
            order = np.argsort(successor)
            ranked = successor[order]
            spot = np.arange(len(order))
            fresh = np.ones(len(order), bool)
            fresh[1:] = ranked[1:] != ranked[:-1]
            final[level[order]] = base + np.maximum.accumulate(np.where(fresh, spot, 0))
            base += len(level)
            before = level - 1
            before = before[before >= 0]
            level = before[(text[before] == c) & ~smaller[before]]
    return np.argsort(final)


def shared_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, in steps of eight bytes and at most ``width``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for step in range(0, width, 8):
        k = min(8, width - step)
        x, y = np.minimum(a[live] + step, len(data)), np.minimum(b[live] + step, len(data))
        left, right = np.ascontiguousarray(words[x]), np.ascontiguousarray(words[y])
        same = left.view(np.uint64).ravel() == right.view(np.uint64).ravel() if k == 8 else (left[:, :k] == right[:, :k]).all(axis=1)
        live = live[same]
        if not len(live):
            break
        out[live] = step + k
    return out


def repeated_windows(contexts: list[bytes], width: int, by_hash: bool = False) -> list[np.ndarray]:
    """For each of the different contexts, whether each of its windows also starts elsewhere in them.

    Neighbours are compared in the order of the suffix array, or of the windows' hashes.
    """
    joined = b"\0".join(contexts) + b"\0"
    data = np.frombuffer(joined, np.uint8)
    lengths = np.array([len(c) for c in contexts])
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    if by_hash:
        order = np.argsort(byte_windows(data, width))
    else:
        text = data.astype(np.int64) + 1
        text[begins + lengths] = 0
        order = suffix_order(text, width)
    room = np.repeat(begins + lengths, lengths + 1) - np.arange(len(data))
    order = order[room[order] >= width]
    found = np.zeros(len(data), bool)
    if len(order) > 1:
        equal = shared_prefix(data, order[:-1], order[1:], width) >= width
        found[order[:-1][equal]] = True
        found[order[1:][equal]] = True
    return [found[b:b + n - width + 1] for b, n in zip(begins.tolist(), lengths.tolist())]


def _spans(flags: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows that are set."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > width)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + width).tolist()))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc`` and ``tag``, which name a row, its text, and its other columns as ``rest``.

    doc is the doc_id, or a hash of the text where that is null; tag is a hash
    of the text. Rows that share both have one text.
    """
    text, doc = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    others = [F.col(c) for c in docs.columns if c != "text"]
    return docs.select(F.coalesce(doc, F.xxhash64(text)).alias("doc"), F.xxhash64(text).alias("tag"), F.col("text").cast("string").alias("text"), F.struct(*others).alias("rest"))


_HIT = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("h", pa.int64()), ("lo", pa.int64()), ("n", pa.int64()), ("places", pa.int64())])
_HIT_TYPE = "doc long, tag long, h long, lo long, n long, places long"


def _anchors(keyed: DataFrame, width: int, anchor: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            index, hashes, lo, n, places = anchored(texts, width, anchor)
            at = pa.array(index)
            yield record_batch(_HIT, doc=batch.column("doc").take(at), tag=batch.column("tag").take(at), h=hashes, lo=lo, n=n, places=places)

    long_enough = keyed.where(F.octet_length("text") >= width).select("doc", "tag", "text")
    return long_enough.mapInArrow(cut, _HIT_TYPE)


def _by_row(hits: DataFrame, *columns: str) -> DataFrame:
    """The hits of each row as one array."""
    return hits.groupBy("doc", "tag").agg(F.collect_set(F.struct(*columns)).alias("hits"))


def _contexts(batch: pa.RecordBatch, block: list[bytes], width: int, *columns: str) -> Iterator[tuple]:
    """doc, tag, first window, and context of each hit, with the named fields of the hit."""
    hits = batch.column("hits")
    ends = hits.offsets.to_numpy()
    fields = [hits.values.field(c).to_pylist() for c in ("lo", "n", *columns)]
    for i, (doc, tag, text) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), block)):
        for lo, n, *more in zip(*(f[ends[i]:ends[i + 1]] for f in fields)):
            yield doc, tag, lo, text[lo:lo + n + width - 1], *more


def _digests(texts: DataFrame, hits: DataFrame, width: int, anchor: int) -> DataFrame:
    """The contexts of longer anchors inside those of ``hits``, each with a digest (g1, g2).

    Where the anchor is the window itself, the digest is that of one window.
    """
    schema = pa.schema([*_HIT, ("g1", pa.int64()), ("g2", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in text_blocks(batches, "text", BLOCK_BYTES):
            found = list(_contexts(batch, block, width))
            index, hashes, lo, n, places = anchored([f[3] for f in found], width, anchor)
            whole = [(found[i][3], a, a + (width if anchor == width else k + width - 1)) for i, a, k in zip(index.tolist(), lo.tolist(), n.tolist())]
            digest = np.frombuffer(b"".join(xxhash.xxh128_digest(piece[a:b]) for piece, a, b in whole), np.int64).reshape(-1, 2)
            names = {c: np.array([f[k] for f in found], np.int64)[index] for k, c in enumerate(("doc", "tag", "start"))}
            yield record_batch(schema, doc=names["doc"], tag=names["tag"], h=hashes, lo=names["start"] + lo, n=n, places=places, g1=digest[:, 0], g2=digest[:, 1])

    rows = texts.join(hits, ["doc", "tag"]).select("doc", "tag", "text", "hits")
    return rows.mapInArrow(cut, _HIT_TYPE + ", g1 long, g2 long")


def _refined(texts: DataFrame, hits: DataFrame, width: int, anchor: int, hot: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Covered ranges found by digests inside the contexts of hot anchors, and the hits left to compare.

    Of equal contexts one goes on; ``many`` says that it stands for others.
    """
    ranges, plain = [], []
    for length in (anchor, *(int(w * width) for w in LONGER if anchor < int(w * width) < width), width):
        rows = pin(_digests(texts, _by_row(hits, "lo", "n"), width, length))
        one = F.min(F.struct("doc", "tag", "lo", "n")).alias("one")
        kinds = pin(rows.groupBy("h", "g1", "g2").agg(F.count("*").alias("copies"), F.sum("places").alias("places"), one))
        repeated = kinds.where("places > 1" if length == width else "copies > 1").select("h", "g1", "g2")
        ranges.append(rows.join(repeated, ["h", "g1", "g2"]).select("doc", "tag", "lo", (F.col("lo") + F.col("n") + width - 1).alias("hi")))
        if length == width:
            break
        different = kinds.groupBy("h").agg(F.count("*").alias("different"), F.max(F.col("places") / F.col("copies")).alias("most")).where("different > 1 or most > 1")
        left = pin(kinds.join(different, "h").select("one.*", "h", (F.col("copies") > 1).alias("many"), (F.col("different") > hot).alias("hot")))
        plain.append(left.where("not hot").drop("hot"))
        hits = left.where("hot")
        if hits.isEmpty():
            break
    return ranges, plain


def covered(keyed: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, batch_bytes: int = BATCH_BYTES, hot: int = HOT_CONTEXTS) -> DataFrame:
    """doc, tag and ``spans`` of the rows of ``keyed`` that hold repeated windows: byte ranges (lo, hi) covered by those."""
    spark = keyed.sparkSession
    texts = keyed.select("doc", "tag", "text")
    with collecting() as made:
        anchors = pin(_anchors(keyed, width, anchor))
        counts = anchors.groupBy("h").agg(F.sum("places").alias("count"), F.count("*").alias("contexts")).where("count > 1")
        hits = pin(anchors.join(counts, "h").select("doc", "tag", "lo", "n", "h", F.lit(False).alias("many"), (F.col("contexts") > hot).alias("hot")))
        ranges, plain = [], [hits.where("not hot").drop("hot")]
        often = hits.where("hot")
        if not often.isEmpty():
            more_ranges, more_plain = _refined(texts, often, width, anchor, hot)
            ranges, plain = ranges + more_ranges, plain + more_plain
        to_compare = plain[0]
        for more in plain[1:]:
            to_compare = to_compare.unionByName(more)
        found = _compared(texts, _by_row(to_compare, "lo", "n", "h", "many"), width, batch_bytes)
        for more in ranges:
            found = found.unionByName(more)
    with collecting() as kept:
        spans = pin(found.groupBy("doc", "tag").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    release(spark, [p for p in made if p not in kept])
    return spans


def _compared(texts: DataFrame, hits: DataFrame, width: int, batch_bytes: int) -> DataFrame:
    """Byte ranges (doc, tag, lo, hi) of the contexts of ``hits`` that repeated windows cover."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kind 0: a covered range; 1: a context, filed under its anchor.
    schema = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("many", pa.bool_()), ("bytes", pa.binary())])
    row = "kind int, h long, doc long, tag long, lo long, hi long, many boolean, bytes binary"

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in text_blocks(batches, "text", BLOCK_BYTES):
            met: dict[tuple, list] = {}
            for doc, tag, lo, piece, h, many in _contexts(batch, block, width, "h", "many"):
                entry = met.setdefault((h, piece), [[], False])
                entry[0].append((doc, tag, lo))
                entry[1] |= many
            out = {f.name: [] for f in schema}

            def add(*values) -> None:
                for name, value in zip(out, values):
                    out[name].append(value)

            known: dict[tuple, list] = {}
            for (h, piece), (places, many) in met.items():
                if len(places) > 1:  # repeated already here; one stands for all elsewhere
                    for doc, tag, lo in places:
                        known.setdefault((doc, tag), []).append({"lo": lo, "hi": lo + len(piece)})
                doc, tag, lo = places[0]
                add(1, h, doc, tag, lo, 0, many or len(places) > 1, piece)
            for (doc, tag), spans in known.items():
                for lo, hi in _merged(spans):
                    add(0, doc, doc, tag, lo, hi, True, None)
            yield record_batch(schema, **out)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Covered ranges of contexts that come in the order of their anchors."""
        found: list[tuple] = []
        batch_groups: dict[bytes, list] = {}
        group: dict[bytes, list] = {}  # of the present anchor: context to its places, and whether there are more
        size, own_size, longest, last = 0, 0, 0, None

        def cover(piece: bytes, entry: list, flags: np.ndarray) -> None:
            spans = [(0, len(piece))] if entry[1] or len(entry[0]) > 1 else _spans(flags, width)
            found.extend((doc, tag, lo + a, lo + b) for doc, tag, lo in entry[0] for a, b in spans)

        def solve(entries: dict[bytes, list], by_hash: bool) -> None:
            pieces = list(entries)
            for piece, flags in zip(pieces, repeated_windows(pieces, width, by_hash) if pieces else []):
                cover(piece, entries[piece], flags)

        def close() -> None:
            nonlocal group, own_size, longest, batch_groups, size
            if len(group) == 1 and all(many or len(places) > 1 for places, many in group.values()):  # nothing to compare with
                (piece, entry), = group.items()
                cover(piece, entry, np.zeros(1, bool))
            elif own_size > 4 * batch_bytes or longest > 8 * width:  # the scan of a long run would go letter by letter
                solve(group, True)
            else:
                batch_groups |= group
                size += own_size
                if size >= batch_bytes:
                    solve(batch_groups, False)
                    batch_groups, size = {}, 0
            group, own_size, longest = {}, 0, 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*found)) or [[]] * 4
            found.clear()
            return record_batch(ranges, doc=columns[0], tag=columns[1], lo=columns[2], hi=columns[3])

        for batch in batches:
            plain = batch.filter(pa.compute.equal(batch.column("kind"), 0))
            if plain.num_rows:
                yield record_batch(ranges, **{c: plain.column(c) for c in ("doc", "tag", "lo", "hi")})
            own = batch.filter(pa.compute.equal(batch.column("kind"), 1))
            columns = [own.column(c).to_pylist() for c in ("h", "doc", "tag", "lo", "many", "bytes")]
            for h, doc, tag, lo, many, piece in zip(*columns):
                if h != last:
                    close()
                    last = h
                entry = group.get(piece)
                if entry is None:
                    entry = group[piece] = [[], False]
                    own_size += len(piece)
                    longest = max(longest, len(piece))
                entry[0].append((doc, tag, lo))
                entry[1] |= many
            if found:
                yield out()
        close()
        solve(batch_groups, False)
        yield out()

    ranges = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
    rows = texts.join(hits, ["doc", "tag"]).select("doc", "tag", "text", "hits").mapInArrow(contexts, row)
    return rows.repartition(partitions, "h").sortWithinPartitions("h").mapInArrow(arrays, "doc long, tag long, lo long, hi long")


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the maximal runs of them."""
    merged = _merged(spans or [])
    parts, at = [], 0
    for lo, hi in merged:
        parts.append(text[at:lo])
        at = hi
    parts.append(text[at:])
    return b"".join(parts), sum(b - a for a, b in merged), len(merged)


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a WIDTH-byte string that covers it also starts anywhere
    else, in the same or another row; strings are judged on the input. Equal
    rows repeat each other. A null or short text stays whole. A null doc_id is
    returned as null.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            left = [_kept(t, s) for t, s in zip(texts, batch.column("spans").to_pylist())]
            yield record_batch(
                schema, doc_id=batch.column("doc_id"), n_bytes=[len(t) for t in texts], n_removed=[x[1] for x in left],
                n_spans=[x[2] for x in left], kept_sha256=[hashlib.sha256(x[0]).hexdigest() for x in left],
            )

    keyed = _keyed(docs.select("doc_id", "text"))
    rows = keyed.join(covered(keyed, **options), ["doc", "tag"], "left").select(F.col("rest.doc_id").cast("long").alias("doc_id"), "text", "spans")
    return rows.mapInArrow(measure, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes taken out of ``text``, and ``n_chars`` counted anew if there.

    A character of which a byte is removed goes whole. A null text stays null.
    """
    names = docs.columns
    keyed = _keyed(docs)
    joined = keyed.join(covered(keyed, **options), ["doc", "tag"], "left")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            kept = [None if t is None else _kept(t, s)[0].decode("utf-8", "ignore") if s else t.decode("utf-8", "replace") for t, s in zip(texts, batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(kept, pa.string())], schema=pa.schema([batch.schema.field("rest"), ("text", pa.string())]))

    fields = joined.schema["rest"].dataType.simpleString()
    cleaned = joined.select("rest", "text", "spans").mapInArrow(clean, f"rest {fields}, text string")
    columns = {n: F.col("rest")[n] for n in names if n != "text"} | {"text": F.col("text")}
    if "n_chars" in names:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[columns[n].alias(n) for n in names])
