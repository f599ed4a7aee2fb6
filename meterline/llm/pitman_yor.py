"""A hierarchical Pitman-Yor model of word pairs, and the log probability of texts under it.

Every word, and the begin of a text, is a context with a restaurant of its own
whose customers are the tokens that follow it. All these restaurants share one
parent, which seats a customer for each of their tables and draws its dishes
evenly from the words met in training and one unknown word.

Pairs (context, token) are dealt by hash to shards of bounded text, so that a
hot context is split. A Gibbs sweep draws the number of tables of each pair
anew, given all other seats: pairs of up to EXACT customers from their exact
conditional distribution (with generalised Stirling numbers), larger ones by
seating their customers one after the other in leaps. During a sweep the
totals of the restaurants and the parent's probabilities are those of the last
exchange. An exchange adds up each word's tables, as a context and as a token,
over the shards at a target chosen by the word's hash, seats the parent's
customers there and sends the totals back, with what the next draw of the
contexts' common strength needs (auxiliary variables, gamma prior). Discounts
come from the dishes with one and two customers. Predictive probabilities are
averaged over the samples kept.

Shards and targets trade packed arrays, so that a word or pair costs a few
bytes on disk. Words are known by 48 bits of their hash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import collecting, pin, release
from .arrow import record_batch, text_blocks
from .hashing import mix

BLOCK_BYTES = 8 << 20    # text that a task packs at once
SHARD_BYTES = 16 << 20   # text for which there is one shard more
SWEEPS = 3
BURN_IN = 1              # sweeps whose samples are not kept
STRENGTH = 1.0           # of the parent, and the contexts' first
EXACT = 64
LEAP = 16                # customers already seated, for each one seated in the next leap
HELD_OUT = (7, 2)        # fixed values of the contract: modulus and remainder of the checksum
_BEGIN, _END = b" <", b" >"  # no word holds a space
_MASK = np.uint64((1 << 48) - 1)
ENTRIES, ASK, PAIRS, SAMPLE, ANSWER, META = range(6)
ROW = "kind int, round int, shard long, target long, block long, blob binary"
_ROW = pa.schema([("kind", pa.int32()), ("round", pa.int32()), ("shard", pa.int64()), ("target", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_CODEC = pa.Codec("zstd", 3)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, or of doubles, compressed byte plane by byte plane."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        if a.dtype.kind == "f":
            a, width, code = np.ascontiguousarray(a, np.float64).view(np.uint64), 8, 0
        else:
            top = int(a.max()) if len(a) else 0
            width = code = max(1, -(-top.bit_length() // 8))
            a = np.ascontiguousarray(a, np.uint64)
        parts += [struct.pack("<QB", len(a), code), np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()]
    raw = b"".join(parts)
    return struct.pack("<Q", len(raw)) + _CODEC.compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``, as signed 64-bit integers or doubles."""
    raw = _CODEC.decompress(blob[8:], struct.unpack_from("<Q", blob)[0], asbytes=True)
    at, out = 4, []
    for _ in range(struct.unpack_from("<I", raw)[0]):
        n, code = struct.unpack_from("<QB", raw, at)
        at += 9
        width = code or 8
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(wide.view(np.int64 if code else np.float64).ravel())
        at += n * width
    return out


class _Numbers(dict):
    """Words of a block, numbered in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token of the texts, words and ends: number of the word before and its own; tokens of each text; hash by number."""
    numbers = _Numbers({_BEGIN: 0, _END: 1})
    words = [t.lower().split() for t in texts]
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    for w in words:
        w.append(_END)
    own = np.fromiter((numbers[x] for w in words for x in w), np.int64, int(lengths.sum()))
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.cumsum(lengths) - lengths] = 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers)) & _MASK
    return before, own, lengths, hashes


def _shard_of(context: np.ndarray, token: np.ndarray, shards: int) -> np.ndarray:
    return (mix(context * np.uint64(0x9E3779B97F4A7C15) + token) % np.uint64(shards)).astype(np.int64)


def entries(docs: DataFrame, shards: int) -> DataFrame:
    """Each block's pairs with their documents, packed for each shard, and one row of each block's documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch, texts in text_blocks(batches, "text", BLOCK_BYTES):
            before, own, lengths, hashes = tokens(texts)
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(np.int64)
            size, span = len(hashes), len(texts)
            key, n = np.unique((before * size + own) * span + np.repeat(np.arange(span), lengths), return_counts=True)
            pair, doc = np.divmod(key, span)
            u, w = np.divmod(pair, size)
            shard = _shard_of(hashes[u], hashes[w], shards)
            order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1)) if shards < len(order) else None
            names = np.arange(shards) if edges is not None else np.unique(shard)
            if edges is None:
                edges = np.append(np.searchsorted(shard[order], names), len(order))
            rows = []
            for name, lo, hi in zip(names.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                if lo == hi:
                    continue
                at = order[lo:hi]
                used, local = np.unique(np.concatenate([u[at], w[at]]), return_inverse=True)
                first, second = local[:hi - lo], local[hi - lo:]
                rows.append((name, pack(hashes[used], np.diff(first, prepend=0), second, doc[at] * 2 + held[doc[at]], n[at])))
            known = ~np.asarray(batch.column("doc_id").is_null())
            ids = np.where(known, batch.column("doc_id").fill_null(0).to_numpy(), 0)
            rows.append((-1 - block % shards, pack(ids.view(np.uint64), known.astype(np.int64), held, lengths)))
            kinds = [ENTRIES] * (len(rows) - 1) + [META]
            yield record_batch(_ROW, kind=kinds, round=[0] * len(rows), shard=[r[0] for r in rows], target=[0] * len(rows), block=[block] * len(rows), blob=[r[1] for r in rows])
            block += 1

    return docs.mapInArrow(cut, ROW)


class Shard:
    """The pairs of one shard: words in the order of their hashes, and pairs as positions of two words."""

    def __init__(self, rows: list[dict]) -> None:
        self.blocks = [r["block"] for r in rows]
        blobs = [unpack(r["blob"]) for r in rows]
        sizes = np.array([len(b[0]) for b in blobs])
        self.words, place = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)
        offset = np.cumsum(sizes) - sizes
        span = len(self.words)
        keys = np.concatenate([place[np.cumsum(b[1]) + o] * span + place[b[2] + o] for b, o in zip(blobs, offset.tolist())])
        code = np.concatenate([b[3] for b in blobs])
        self.n = np.concatenate([b[4] for b in blobs])
        self.edges = np.cumsum([0] + [len(b[3]) for b in blobs])
        pairs, self.pair = np.unique(keys, return_inverse=True)
        self.doc, held = code >> 1, code & 1
        self.context, self.token = np.divmod(pairs, span)
        self.count = np.bincount(self.pair, self.n * (1 - held), len(pairs)).astype(np.int64)

    def per_word(self, which: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` by word."""
        return np.bincount(which, values, len(self.words)).astype(np.int64)


def _by_target(words: np.ndarray, targets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each target that holds some of the sorted words, and their positions."""
    target = words % targets
    order = np.argsort(target, kind="stable")
    names, edges = np.unique(target[order], return_index=True)
    for name, at in zip(names.tolist(), np.split(order, edges[1:])):
        yield name, at


def _table(rows: list[tuple], schema: pa.Schema = _ROW) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _stirling(size: int, discount: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers: ways to seat c customers at t tables, each weighted by its sizes."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(size):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stay = out[c, t] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def seats(rng: np.random.Generator, customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, discount: float) -> np.ndarray:
    """A draw of the number of tables of each dish.

    ``customers`` it has, ``others`` are the tables of its restaurant's other
    dishes, ``parent`` is the probability of the dish above.
    """
    tables = np.minimum(customers, 1)
    log_ways = _stirling(min(EXACT, int(customers.max(initial=0))), discount)
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    small = small[np.argsort(customers[small], kind="stable")]
    sizes, starts = np.unique(customers[small], return_index=True)
    for c, same in zip(sizes.tolist(), np.split(small, starts[1:])):
        t = np.arange(c)
        for lo in range(0, len(same), 1 << 16):
            at = same[lo:lo + (1 << 16)]
            opened = np.log(parent[at, None]) + np.log(strength + discount * (others[at, None] + t))
            weight = np.cumsum(opened, axis=1) + log_ways[c, 1:c + 1]
            chance = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (chance < rng.random(len(at))[:, None] * chance[:, -1:]).sum(axis=1)
    left = np.flatnonzero(customers > EXACT)
    if len(left):
        goal, free, p = customers[left], others[left], parent[left]
        t, seated = np.ones(len(left), np.int64), np.ones(len(left), np.int64)
        while True:
            step = np.minimum(np.maximum(seated // LEAP, 1), goal - seated)
            if not step.any():
                break
            new = p * (strength + discount * (free + t))
            t += rng.binomial(step, new / (new + seated - discount * t))
            seated += step
        tables[left] = t
    return tables


def auxiliary(rng: np.random.Generator, visits: np.ndarray, tables: np.ndarray, strength: float, discount: float) -> tuple[int, float]:
    """Sums of the auxiliary variables that the draw of a common strength needs, over restaurants.

    A table beyond the first counts with probability strength / (strength +
    discount * tables before it); the logs are of beta draws for the visits.
    """
    opened, log_share = 0, 0.0
    busy = np.flatnonzero(visits > 1)
    if len(busy):
        log_share = float(np.log(np.maximum(rng.beta(strength + 1, visits[busy] - 1.0), 1e-300)).sum())
    more = tables[tables > 1] - 1
    ends = np.cumsum(more)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, 1 << 22):
        spot = np.arange(lo, min(lo + (1 << 22), int(ends[-1])))
        own = np.searchsorted(ends, spot, side="right")
        before = spot - (ends - more)[own] + 1
        opened += int((rng.random(len(spot)) * (strength + discount * before) < strength).sum())
    return opened, log_share


def _discount(once: int | None, twice: int | None) -> float:
    """From the dishes with one and with two customers."""
    once, twice = once or 0, twice or 0
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


class _Root:
    """The parent restaurant as the exchanges know it."""

    def __init__(self, known: int, customers: int, tables: int, strength: float, discount: float) -> None:
        self.known, self.customers, self.tables, self.strength, self.discount = known, customers, tables, strength, discount

    def probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        new = (self.strength + self.discount * self.tables) / (self.known + 1)
        return (customers - self.discount * tables + new) / (self.strength + self.customers)


def _sums(df: DataFrame, **columns) -> dict:
    return df.agg(*(c.alias(n) for n, c in columns.items())).first().asDict()


def score(docs: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN, strength: float = STRENGTH, root_strength: float = STRENGTH, seed: int = 12, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text's tokens are its words, with A-Z lowered, and one end. Rows whose
    checksum of the doc_id leaves the remainder of HELD_OUT are scored only;
    all others train as well, also where they repeat. ``base_score`` is the
    add-one unigram, ``score`` the model's log10 probability of the text. A
    null text is empty and has its end alone; a null doc_id trains and stays
    null. Very long texts are taken whole. If nothing trains, all tokens are
    the one unknown word and both scores are 0. An empty table gives no rows.
    Columns other than doc_id and text are not looked at. ``docs`` is read
    twice and must give the same rows in the same partitions each time, as a
    table does.
    """
    if not 0 <= burn_in < sweeps:
        raise ValueError("some sweeps must be kept")
    spark = docs.sparkSession
    modulus, remainder = HELD_OUT
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder
    docs = docs.select(doc.alias("doc_id"), text.alias("text"), held.alias("held"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // shard_bytes
    with collecting() as made:
        packed = entries(docs, shards)

        def build(group: pa.Table) -> pa.Table:
            shard = Shard(group.to_pylist())
            name = group.column("shard")[0].as_py()
            count, one = shard.count, (shard.count > 0).astype(np.int64)
            columns = [shard.per_word(shard.context, one), shard.per_word(shard.token, one), shard.per_word(shard.context, count), shard.per_word(shard.token, count)]
            rows = [(ASK, 0, name, t, 0, pack(shard.words[at], *(c[at] for c in columns))) for t, at in _by_target(shard.words, shards)]
            single = (count == 1).astype(np.int64)
            more = np.flatnonzero(count > 1)
            blob = pack(shard.context[more], shard.token[more], count[more], shard.per_word(shard.context, single), shard.per_word(shard.token, single))
            # The counts of counts travel as target (once) and block (twice).
            rows.append((PAIRS, 0, name, int(single.sum()), int((count == 2).sum()), blob))
            return _table(rows)

        built = pin(packed.where(F.col("kind") == ENTRIES).groupBy("shard").applyInArrow(build, ROW), ["kind"]).select(*_ROW.names)
        first_asks, pairs = built.where(F.col("kind") == ASK), built.where(F.col("kind") == PAIRS)
        counts = _sums(pairs, once=F.sum("target"), twice=F.sum("block"))
        discount = _discount(counts["once"], counts["twice"])

        numbers = ["known", "tokens", "customers", "tables", "once", "twice", "opened", "log_share"]
        answer_schema = pa.schema([*_ROW, *((n, pa.int64()) for n in numbers[:-1]), (numbers[-1], pa.float64())])
        answer_type = ROW + "".join(f", {n} long" for n in numbers[:-1]) + f", {numbers[-1]} double"

        def answers(asks: DataFrame, turn: int, root: _Root | None, strength: float) -> DataFrame:
            """Each word's totals for every shard that asked, and sums over the words of a target.

            ``asks`` of a later turn come with those of the first, which hold the words.
            """
            def add_up(group: pa.Table) -> pa.Table:
                rows = group.to_pylist()
                target = rows[0]["target"]
                words = {r["shard"]: unpack(r["blob"]) for r in rows if r["round"] == 0}
                now = words if turn == 0 else {r["shard"]: [words[r["shard"]][0], *unpack(r["blob"])] for r in rows if r["round"] == turn}
                names = sorted(now)
                every, place = np.unique(np.concatenate([now[s][0] for s in names]), return_inverse=True)
                totals = [np.bincount(place, np.concatenate([now[s][c] for s in names])).astype(np.int64) for c in range(1, len(now[names[0]]))]
                visits = np.bincount(place, np.concatenate([words[s][3] for s in names])).astype(np.int64)
                customers = totals[1]
                rng = np.random.default_rng([seed, turn, target, 1])
                if root is None:
                    tables = np.minimum(customers, 1)
                else:
                    # Whatever tables the dish had, the others' share is nearly all of the last total.
                    others = np.full(len(customers), max(root.tables - 1, 0))
                    tables = seats(rng, customers, others, np.full(len(customers), 1 / (root.known + 1)), root.strength, root.discount)
                totals.insert(2, tables)
                out, at = [], 0
                for s in names:
                    own = place[at:at + len(now[s][0])]
                    at += len(own)
                    out.append((ANSWER, turn, s, target, 0, pack(*(t[own] for t in totals)), *[None] * len(numbers)))
                trained = totals[4] if turn == 0 else np.zeros(0, np.int64)
                sums = [(trained > 0).sum(), trained.sum(), customers.sum(), tables.sum(), (customers == 1).sum(), (customers == 2).sum()]
                opened, log_share = auxiliary(rng, visits, totals[0], strength, discount)
                out.append((META, turn, -1, target, 0, None, *(int(x) for x in sums), opened, log_share))
                return _table(out, answer_schema)

            return pin(asks.groupBy("target").applyInArrow(add_up, answer_type), ["kind"]).select(*answer_schema.names)

        def root_of(answer: DataFrame, before: _Root | None) -> _Root:
            s = _sums(answer.where(F.col("kind") == META), **{n: F.sum(n) for n in numbers})
            if before is None:
                return _Root(s["known"] or 0, s["customers"] or 0, s["tables"] or 0, root_strength, _discount(s["once"], s["twice"]))
            return _Root(before.known, s["customers"] or 0, s["tables"] or 0, root_strength, before.discount)

        def strength_of(answer: DataFrame, turn: int) -> float:
            s = _sums(answer.where(F.col("kind") == META), y=F.sum("opened"), x=F.sum(F.round("log_share", 6)))
            return np.random.default_rng([seed, turn, 2]).gamma(1 + (s["y"] or 0)) / (1 - (s["x"] or 0.0))

        first = answers(first_asks, 0, None, strength)
        train_tokens = _sums(first.where(F.col("kind") == META), n=F.sum("tokens"))["n"] or 0
        root = root_of(first, None)
        strengths = {0: strength_of(first, 0)}

        def sweep(answer: DataFrame, sample: DataFrame | None, turn: int, root: _Root, strength: float) -> DataFrame:
            def draw(group: pa.Table) -> pa.Table:
                rows = group.to_pylist()
                name = rows[0]["shard"]
                by_kind = lambda kind: [unpack(r["blob"]) for r in sorted(rows, key=lambda r: r["target"]) if r["kind"] == kind]
                words = np.sort(np.concatenate([a[0] for a in by_kind(ASK)]))
                (context, token, count, single_context, single_token), = by_kind(PAIRS)
                old = next(iter(by_kind(SAMPLE)), [np.ones(len(count), np.int64)])[0]
                totals = spread(words, by_kind(ANSWER), shards)
                likely = root.probability(totals[1], totals[2])
                tables = seats(np.random.default_rng([seed, turn, name, 0]), count, totals[0][context] - old, likely[token], strength, discount)
                sums = [single + np.bincount(which, tables, len(words)).astype(np.int64) for which, single in ((context, single_context), (token, single_token))]
                out = [(ASK, turn, name, t, 0, pack(*(s[at] for s in sums))) for t, at in _by_target(words, shards)]
                return _table([*out, (SAMPLE, turn, name, 0, 0, pack(tables))])

            parts = first_asks.unionByName(pairs).unionByName(answer)
            if sample is not None:
                parts = parts.unionByName(sample)
            return pin(parts.groupBy("shard").applyInArrow(draw, ROW), ["kind"]).select(*_ROW.names)

        answer, sample, kept = first.where(F.col("kind") == ANSWER).select(*_ROW.names), None, []
        roots = {}
        parts = packed.unionByName(answer)
        for turn in range(1, sweeps + 1):
            drawn = sweep(answer, sample, turn, root, strengths[turn - 1])
            sample = drawn.where(F.col("kind") == SAMPLE)
            totals = answers(first_asks.unionByName(drawn.where(F.col("kind") == ASK)), turn, root, strengths[turn - 1])
            answer = totals.where(F.col("kind") == ANSWER).select(*_ROW.names)
            root = root_of(totals, root)
            strengths[turn] = strength_of(totals, turn)
            if turn > burn_in:
                kept.append(turn)
                roots[turn] = root
                parts = parts.unionByName(sample).unionByName(answer)
    release(spark, made, parts)

    known_words = root.known
    partial_type = "shard long, block long, blob binary"
    partial = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])

    def evaluate(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        name = rows[0]["shard"]
        if name < 0:
            return _table([(name, r["block"], r["blob"]) for r in rows], partial)
        shard = Shard([r for r in rows if r["kind"] == ENTRIES])
        by_turn = lambda kind, turn: [unpack(r["blob"]) for r in sorted(rows, key=lambda r: r["target"]) if r["kind"] == kind and r["round"] == turn]
        start = spread(shard.words, by_turn(ANSWER, 0), shards)
        visits, trained = start[3], start[4]
        chance = np.zeros(len(shard.count))
        for turn in kept:
            totals = spread(shard.words, by_turn(ANSWER, turn), shards)
            (drawn,), = by_turn(SAMPLE, turn)
            tables = np.minimum(shard.count, 1)
            tables[shard.count > 1] = drawn
            above = roots[turn].probability(totals[1], totals[2])[shard.token]
            passed_up = strengths[turn] + discount * totals[0][shard.context]
            chance += (shard.count - discount * tables + passed_up * above) / (strengths[turn] + visits[shard.context])
        logs = np.log10(chance / len(kept))
        base = np.log10((trained + 1) / (train_tokens + known_words + 1))[shard.token]
        known = (trained > 0)[shard.token]
        out = []
        for block, lo, hi in zip(shard.blocks, shard.edges[:-1].tolist(), shard.edges[1:].tolist()):
            doc, n, pair = shard.doc[lo:hi], shard.n[lo:hi], shard.pair[lo:hi]
            docs, place = np.unique(doc, return_inverse=True)
            sums = [np.bincount(place, n * v[pair]) for v in (known, base, logs)]
            out.append((name, block, pack(np.diff(docs, prepend=0), sums[0].astype(np.int64), sums[1], sums[2])))
        return _table(out, partial)

    scored = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def total(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["shard"])  # one order of addition
        ids, is_known, held, lengths = next(unpack(r["blob"]) for r in rows if r["shard"] < 0)
        sums = np.zeros((3, len(ids)))
        for r in rows:
            if r["shard"] >= 0:
                docs, *values = unpack(r["blob"])
                sums[:, np.cumsum(docs)] += values
        columns = [pa.array(ids, pa.int64(), mask=is_known == 0), held == 1, lengths, sums[0].astype(np.int64), sums[1], sums[2]]
        return pa.table([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, scored)], schema=scored)

    rows = parts.groupBy("shard").applyInArrow(evaluate, partial_type).groupBy("block").applyInArrow(total, SCORES)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def spread(words: np.ndarray, answered: list[list[np.ndarray]], targets: int) -> list[np.ndarray]:
    """The totals that the targets sent, in the order of the words."""
    places = [at for _, at in _by_target(words, targets)]
    out = []
    for column in range(len(answered[0])):
        values = np.empty(len(words), np.int64)
        for at, own in zip(places, answered):
            values[at] = own[column]
        out.append(values)
    return out
