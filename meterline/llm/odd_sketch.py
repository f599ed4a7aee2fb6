"""Near-duplicate groups: MinHash bands find candidates, odd sketches screen them, full shingle sets decide.

Documents with the same shingle set are one node, named by a 64-bit hash of
the set (among ten billion sets, about three pairs share one). Band buckets link their
nodes to one hub first, the node that shares most buckets. Buckets that share
nodes form a cluster, and only where a cluster still holds several components
are the remaining pairs compared, block by block; only links that join
components come out. Nothing is gathered whole and no group is expanded into
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .arrow import record_batch, text_blocks
from .components import components
from .hashing import WordHashes, mix, odd_numbers, word_windows

SHINGLE = 5
PERCENT = 75        # least similarity, in percent
BANDS, ROWS = 32, 3  # a pair at 0.75 shares no band once in 40 million
SKETCH_BITS = 512
SCREEN = 0.45       # sketches estimating less are no candidates; 0.3 below the threshold is over six standard errors
BLOCK = 256         # nodes of a cluster that are compared together
_WORDS = SKETCH_BITS // 64


def shingle_set(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes: five words each, or all words of a shorter text, or none."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(word_windows(words, min(SHINGLE, len(words)), seed=min(SHINGLE, len(words))))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS least values under fixed random maps."""
    n = BANDS * ROWS
    flips, factors = odd_numbers(n, 101, np.uint32), odd_numbers(n, 202, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, ((short[at:at + 2048, None] ^ flips) * factors).min(axis=0), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: each (place, value) pair flips one bit; as signed 64-bit words."""
    places = mix((np.arange(len(samples), dtype=np.uint64) << np.uint64(32)) | samples.astype(np.uint64)) % np.uint64(SKETCH_BITS)
    bits = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def largest_distance(at_least: float = SCREEN) -> int:
    """Most differing sketch bits at which the estimated similarity still reaches ``at_least``."""
    differing = 2 * BANDS * ROWS * (1 - at_least)  # samples that are in one of both lists only
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing))


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, tag (hash of the text), n_shingles, key (hash of the set), bands, sketch."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("tag", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.int64()),
        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        fold = odd_numbers(ROWS, 303)
        salt = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
        for batch, texts in text_blocks(batches, "text"):
            sizes, keys, bands, sketches = [], [], [], []
            for text in texts:
                own = shingle_set(text, hashes)
                sizes.append(len(own))
                keys.append(xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63))
                if len(own):
                    samples = minhashes(own)
                    rows = samples.reshape(BANDS, ROWS).astype(np.uint64)
                    bands.append(mix((rows * fold).sum(axis=1, dtype=np.uint64) * np.uint64(3) + salt).view(np.int64))
                    sketches.append(odd_sketch(samples))
                else:
                    bands.append([])
                    sketches.append([])
            yield record_batch(schema, doc_id=batch.column("doc_id"), tag=batch.column("tag"), n_shingles=sizes, key=keys, bands=bands, sketch=sketches)

    return _identified(docs).mapInArrow(sign, "doc_id long, tag long, n_shingles long, key long, bands array<long>, sketch array<long>")


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag"))


def _shingles(docs: DataFrame) -> DataFrame:
    """doc_id, tag and shingle set of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in text_blocks(batches, "text"):
            yield record_batch(schema, doc_id=batch.column("doc_id"), tag=batch.column("tag"), shingles=[shingle_set(t, hashes).view(np.int64) for t in texts])

    return docs.mapInArrow(cut, "doc_id long, tag long, shingles array<long>")


def _close(a: str, b: str):
    """Whether two sketches differ in few enough bits."""
    bits = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, _WORDS)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))
    return bits <= largest_distance()


def node_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full shingle set of each node in ``wanted(node)``, made anew from the text of one of its rows."""
    rows = nodes.join(wanted, "node").select("node", F.col("row.doc_id").alias("w_doc"), F.col("row.tag").alias("w_tag"))
    texts = _identified(docs).join(rows, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("tag") == F.col("w_tag")), "left_semi")
    made = _shingles(texts)
    sets = made.join(rows, made.doc_id.eqNullSafe(F.col("w_doc")) & (made.tag == F.col("w_tag")))
    return sets.groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def confirm(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = pin(node_sets(docs, nodes, wanted))
    left = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    both = left.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= PERCENT * (F.size("sa") + F.size("sb") - common)).select("a", "b")


class _Block:
    """Nodes of a cluster that are compared with those of another block."""

    def __init__(self, rows: pa.StructArray) -> None:
        self.nodes, self.roots = rows.field("node").to_numpy(), rows.field("root").to_numpy()
        self.sketches = rows.field("sketch").flatten().to_numpy().reshape(len(rows), -1).view(np.uint64)
        sets = rows.field("shingles")
        self.sizes = sets.value_lengths().to_numpy()
        self.flat = sets.flatten().to_numpy()
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.index: tuple[np.ndarray, np.ndarray] | None = None

    def common(self, shingles: np.ndarray) -> np.ndarray:
        """How many of a sorted set's shingles each node of the block has."""
        if self.index is None:
            self.index = np.unique(self.flat, return_inverse=True)
        values, places = self.index
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        there = np.zeros(len(values), np.int32)
        there[at[values[at] == shingles]] = 1
        return np.add.reduceat(there[places], self.starts)


def joining_links(x: _Block, y: _Block) -> list[tuple[int, int]]:
    """Links between two blocks of one cluster that join different components; none that follows from others."""
    above: dict[int, int] = {}

    def find(r: int) -> int:
        while above.get(r, r) != r:
            r = above[r]
        return r

    most, out = largest_distance(), []
    for k, node in enumerate(x.nodes.tolist()):
        far = np.bitwise_count(y.sketches ^ x.sketches[k]).sum(axis=1)
        maybe = np.flatnonzero((far <= most) & (y.roots != x.roots[k]))
        mine = find(int(x.roots[k]))
        maybe = [j for j in maybe.tolist() if find(int(y.roots[j])) != mine]
        if not maybe:
            continue
        common = y.common(x.flat[x.starts[k]:x.starts[k] + x.sizes[k]])[maybe]
        close = 100 * common >= PERCENT * (x.sizes[k] + y.sizes[maybe] - common)
        for j in np.array(maybe)[close].tolist():
            one, other = find(int(x.roots[k])), find(int(y.roots[j]))
            if one != other:
                above[one] = other
                out.append((node, int(y.nodes[j])))
    return out


def _rest(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) between different components of a cluster; ``pairs`` ties each node to the hubs of its buckets."""
    clusters = components(pairs).select("node", F.col("root").alias("cluster"))
    at = pin(clusters.join(roots, "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("root")))
    split = at.groupBy("cluster").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    blocks = split.select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = pin(at.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    sets = node_sets(docs, nodes, members.select("node"))
    known = members.join(sets, "node").join(nodes.select("node", "sketch"), "node")
    packed = pin(known.groupBy("cluster", "blocks", "block").agg(F.collect_list(F.struct("node", "root", "sketch", "shingles")).alias("rows")))
    left = packed.select("cluster", F.col("rows").alias("left_rows"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("left_rows"), batch.column("rows")):
                links = joining_links(_Block(x.values), _Block(y.values))
                yield record_batch(schema, a=[a for a, _ in links], b=[b for _, b in links])

    joined = left.join(packed.select("cluster", "block", "rows"), ["cluster", "block"]).select("left_rows", "rows")
    return joined.mapInArrow(compare, "a long, b long").distinct()


def _grouped(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, tag, n_shingles, and its component's ``first`` row; null without words.

    ``first`` is the least (unknown, order, doc_id, tag), where a null doc_id is unknown.
    """
    signed = pin(signatures(docs))
    top = F.lit((1 << 63) - 1)
    full = signed.where("n_shingles > 0").withColumn("row", F.struct(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", top).alias("order"), "doc_id", "tag"))
    sets = full.groupBy("key").agg(F.any_value("n_shingles").alias("n_shingles"), F.min("row").alias("row"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    nodes = pin(sets.select(F.col("key").alias("node"), "n_shingles", "row", "bands", "sketch"))

    bands = nodes.select("node", F.explode("bands").alias("band"))
    several = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = pin(bands.join(several, "band"))
    # The original of many copies shares more buckets with them than they do among themselves.
    degrees = shared.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = pin(shared.join(degrees, "node").select("band", "node", F.struct(F.col("degree"), F.col("node").alias("hub")).alias("at")))
    hubs = ranked.groupBy("band").agg(F.max("at").alias("at")).select("band", "at.hub")
    sketches = nodes.select("node", "sketch")
    pairs = pin(shared.join(hubs, "band").where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    near = (
        pairs.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
        .join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
    )
    tried = pin(near.where(_close("sa", "sb")).select("a", "b"))
    links = pin(confirm(docs, nodes, tried))
    roots = pin(components(links))

    rest = pin(_rest(docs, nodes, pairs, roots))
    if not rest.isEmpty():
        roots = pin(components(links.unionByName(rest)))

    linked = nodes.select("node", "row").join(roots, "node")
    least = linked.groupBy("root").agg(F.min("row").alias("least"))
    in_group = linked.join(least, "root").select("node", "least")
    of_key = nodes.join(in_group, "node", "left").select(F.col("node").alias("key"), F.coalesce("least", "row").alias("first"))
    # Rows without words share a key and have no node.
    return signed.join(of_key, "key", "left").select("doc_id", "tag", "n_shingles", "first")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, tag, n_shingles, component_id, kept.

    A component is what links of at least PERCENT join. component_id is its
    least doc_id; kept says that this row's doc_id is that. Rows without words
    stay alone. A null doc_id counts as larger than any other, so such a row
    is kept only in a component without known ids, whose component_id is null.
    Rows that repeat a doc_id are documents of their own.
    """
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.nullif("first.order", F.lit((1 << 63) - 1)))
    return _grouped(docs).select("doc_id", "tag", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, with their columns.

    The one is the least by doc_id, null last, then by hash of the text; of
    rows that are equal in both, one stays. Rows without words all stay.
    """
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.tag") == F.col("tag"))
    kept = pin(_grouped(docs).where((F.col("n_shingles") == 0) | first).select("doc_id", "tag", "n_shingles"))
    keys = kept.where("n_shingles > 0").groupBy("doc_id", "tag").agg(F.count("*").alias("copies"))
    wanted = kept.select("doc_id", "tag").distinct()
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("k_doc"), F.xxhash64(F.col("text").cast("string")).alias("k_tag"))
    out = rows.join(wanted, rows.k_doc.eqNullSafe(wanted.doc_id) & (rows.k_tag == wanted.tag), "left_semi")
    if not keys.where("copies > 1").isEmpty():
        repeated = keys.where("copies > 1").select("doc_id", "tag")
        same = out.k_doc.eqNullSafe(repeated.doc_id) & (out.k_tag == repeated.tag)
        first = out.join(repeated, same, "left_semi").dropDuplicates(["k_doc", "k_tag"])
        out = out.join(repeated, same, "left_anti").unionByName(first)
    return out.select(*[F.col("row")[n].alias(n) for n in names])
