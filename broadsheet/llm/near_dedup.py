"""Near-duplicates by an LSH forest over MinHash signatures.

Documents are sets of distinct 5-word shingles. Documents with equal sets fall
together at once and go on as one node. Each node gets ``TREES`` signature
orders (trees): in a tree the nodes are sorted by a sequence of MinHash values,
and nodes with a long common prefix are neighbours. A region is a run of nodes
with a common prefix of ``DEPTH`` values; all pairs of a small region are
candidates. A region with more than ``REGION`` nodes goes deeper, value by
value, until its parts are small; at full depth the nearest in the order are
candidates. Every node of a deep region is also paired with the region's hub,
the node that agrees best with the majority of all one-bit sketches there: in
a group of copies of one text that is the text itself. So the number of
candidates is linear in the number of nodes, however large a group is.

Pairs whose one-bit sketches speak against the threshold by more than seven
standard deviations are left out. All others are confirmed on the full sets:
in candidate groups of at most ``GROUP`` nodes every pair is compared where the
group's sets are together; the nodes of a larger group are dealt into blocks of
about ``GROUP`` nodes, and its candidate pairs are confirmed for each pair of
blocks with the sets that they name, so a set travels once per pair of blocks
and not once per pair of nodes. Links are then closed to components.

In a deep region only some pairs are candidates, so its nodes, the crowd, get an
exact pass for links between different components: a prefix filter on the
shingles that are rarest in the crowd, with length and positional bounds, then
the distance of parity bitmaps, which is never above that of the sets. The
entries of a hot shingle are dealt into blocks, compared block by block. What
passes is confirmed on the full sets. The bounds lose no link; in a crowd of
which most pairs lie just under the threshold, they leave many to confirm.

Chance that a pair at similarity 0.75 exactly shares a region of some tree:
1 - (1 - 0.75^3)^40 > 0.999999999; every further similar copy adds ways. In a
small region the sketches lose about four pairs in a hundred thousand million; in a
deep one nothing more is lost.

Defined cases: NULL and empty texts, or texts without a word, have no shingle
and are linked with nothing; texts of fewer than five words have one shingle,
the whole; equal rows are one node; a NULL doc_id loses to every doc_id of its
component and is its own component's id only if there is no other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import UID, with_uid, words, written
from broadsheet.llm.components import components

WORDS = 5
PERCENT = 75
TREES = 40
DEPTH = 3
MORE_DEPTH = 4
REGION = 12
#: Nodes next to each other in the order that are compared at full depth.
NEAREST = 4
SKETCH_BITS = 128
#: 112 of 128 agree on average at 0.75, with a deviation of 3.7; fewer than this
#: many do with a probability of 4e-11, and of unrelated sets one pair in 4,000 passes.
SKETCH_AGREE = 84
GROUP = 256
SEED = 11
#: Bits of the filter of texts whose sets are made again: 512 KB, at any size.
FILTER_BITS = 1 << 22
_CELL_BITS = 32_768  # of one aggregated bitmap
#: Slots of the counts that put the shingles of a crowd in order, at any size.
COUNT_BITS = 20
PARITY_BITS = 1024
#: Entries of one shingle that are compared in one block.
POSTING = 1024

_VALUES = TREES * (DEPTH + MORE_DEPTH)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(SEED)
_A = _rng.integers(1 << 16, 1 << 32, _VALUES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, _VALUES, dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    own = words(text)
    if not own:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own))
    n = min(WORDS, len(codes))
    rolled = codes[: len(codes) - n + 1].copy()
    for k in range(1, n):
        rolled *= _PRIME
        rolled += codes[k : len(codes) - n + 1 + k]
    return np.unique(mix(rolled + np.uint64(n)))


def signature(shingle: np.ndarray) -> np.ndarray:
    """MinHash values of a set, as 16-bit numbers."""
    x = (shingle >> np.uint64(32)).astype(np.uint32)
    low = np.full(_VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        hashed = np.multiply.outer(_A, x[at : at + 2048])
        hashed += _B[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    low ^= low >> np.uint32(15)
    low *= np.uint32(0x2C1B3C6D)
    return (low >> np.uint32(16)).astype(np.uint16)


_SIGNED = f"{UID} bigint, doc_id bigint, tkey string, n bigint, f1 bigint, f2 bigint, sig binary"


def _sign(batches):
    for batch in batches:
        n, f1, f2, sig = [], [], [], []
        for text in batch.column("text").to_pylist():
            own = shingles(text)
            n.append(len(own))
            f1.append(int(mix(own ^ _PRIME).sum(dtype=np.uint64).view(np.int64)))
            f2.append(int(mix(own + _PRIME).sum(dtype=np.uint64).view(np.int64)))
            sig.append(signature(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(UID), batch.column("doc_id"), batch.column("tkey"),
             pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
             pa.array(sig, pa.binary())],
            [UID, "doc_id", "tkey", "n", "f1", "f2", "sig"],
        )


_TREE = "tree int, head bigint, tail bigint, node bigint, n bigint, s1 bigint, s2 bigint"


def _plant(batches):
    """One row per node and tree: the prefix, the further values, the sketch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.stack([np.frombuffer(x, np.uint16) for x in batch.column("sig").to_pylist()])
        bits = (sig[:, :SKETCH_BITS] & np.uint16(1)).astype(np.uint8)
        sketch = np.packbits(bits, axis=1).view(np.int64)
        values = sig.reshape(len(sig), TREES, DEPTH + MORE_DEPTH).astype(np.uint64)
        head, tail = np.zeros((2, len(sig), TREES), np.uint64)
        for k in range(DEPTH):
            head = (head << np.uint64(16)) | values[:, :, k]
        for k in range(DEPTH, DEPTH + MORE_DEPTH):
            tail = (tail << np.uint64(16)) | values[:, :, k]
        node, size = (np.repeat(batch.column(c).to_numpy(), TREES) for c in ("node", "n"))
        columns = [
            np.tile(np.arange(TREES, dtype=np.int32), len(sig)),
            head.ravel().view(np.int64),
            tail.ravel().view(np.int64),
            node,
            size,
            np.repeat(sketch[:, 0], TREES),
            np.repeat(sketch[:, 1], TREES),
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["tree", "head", "tail", "node", "n", "s1", "s2"]
        )


def _agreeing(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    different = np.bitwise_count(s[i] ^ s[j]).sum(axis=1, dtype=np.int64)
    return SKETCH_BITS - different


def _hub(s: np.ndarray) -> int:
    """The node that agrees best with the majority bits of a region."""
    bits = np.unpackbits(s.view(np.uint8), axis=1)
    majority = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(s)).view(np.uint64)
    return int(np.bitwise_count(s ^ majority[None]).sum(axis=1, dtype=np.int64).argmin())


def region_pairs(tail: np.ndarray, s: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (positions) of a region sorted by ``tail``."""
    left, right = [], []

    def add(i, j):
        left.append(np.asarray(i, np.int64))
        right.append(np.asarray(j, np.int64))

    def descend(at: int, end: int, depth: int):
        size = end - at
        if size <= REGION:
            i, j = np.triu_indices(size, 1)
            add(i + at, j + at)
            return
        if depth < 2:  # the hub of a deep region; its parts have the same one mostly
            hub = at + _hub(s[at:end])
            rest = np.delete(np.arange(at, end), hub - at)
            add(np.full(len(rest), hub), rest)
        for k in range(1, NEAREST if depth == MORE_DEPTH else 2):
            add(np.arange(at, end - k), np.arange(at + k, end))
        if depth < MORE_DEPTH:
            prefix = tail[at:end] >> np.uint64(16 * (MORE_DEPTH - 1 - depth))
            cuts = np.flatnonzero(np.diff(prefix)) + 1
            for a, b in zip([0, *cuts], [*cuts, size], strict=True):
                if b - a > 1:
                    descend(at + a, at + b, depth + 1)

    descend(0, len(tail), 0)
    return np.concatenate(left), np.concatenate(right)


class _Forest:
    """Which pairs join what other pairs had not joined yet."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent, top = self.parent, x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def joins(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _neighbours(batches):
    """Candidate pairs of a run of a sorted forest; holds one region at a time.

    ``spans`` marks the pairs that already connect all nodes of the run's pairs.
    A node of the crowd comes as a pair with itself: one of a deep region, or of
    the first or last region, which may go on in another run.
    """
    forest = _Forest()

    def pairs(rows: np.ndarray, edge: bool = False):
        tree, node, n = rows[0][0], rows[3], rows[4]
        s = np.stack([rows[5], rows[6]], axis=1).view(np.uint64)
        i, j = region_pairs(rows[2].view(np.uint64), s, int(tree))
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        good = (100 * small >= PERCENT * large) & (_agreeing(s, i, j) >= SKETCH_AGREE)
        a, b = np.minimum(node[i], node[j])[good], np.maximum(node[i], node[j])[good]
        if edge or len(node) > REGION:
            a, b = np.concatenate([a, node]), np.concatenate([b, node])
        return np.unique(np.stack([a, b], axis=1), axis=0)

    def batch_of(found):
        both = np.concatenate(found)
        spans = [forest.joins(a, b) for a, b in both.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(spans, pa.bool_())],
            ["a", "b", "spans"],
        )

    names = ["tree", "head", "tail", "node", "n", "s1", "s2"]
    kept, first = None, True
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
        if not rows.shape[1]:
            continue
        new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        # The last region may go on in the next batch.
        ends = new.tolist()
        found = [
            pairs(rows[:, a:b], first and a == 0)
            for a, b in zip([0, *ends], ends, strict=False)
            if b - a > 1 or (first and a == 0)
        ]
        first = first and not ends
        kept = rows[:, ends[-1] :] if ends else rows
        if found:
            yield batch_of(found)
    if kept is not None and kept.shape[1]:
        yield batch_of([pairs(kept, True)])


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _closed(group: pd.DataFrame) -> pd.DataFrame:
    """Exact components of a bounded group: (node, root) of nodes with sets."""
    nodes = group["node"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["set"]]
    order = np.argsort([len(x) for x in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order])
    forest = _Forest()
    every, inverse = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(len(order)):
        # Sets are in order of size: partners end where sizes get too large.
        end = int(np.count_nonzero(PERCENT * sizes <= 100 * sizes[i]))
        if end <= i + 1:
            continue
        has = np.zeros(len(every), np.int32)
        has[inverse[bounds[i] : bounds[i + 1]]] = 1
        inside = np.add.reduceat(has[inverse[bounds[i + 1] : bounds[end]]], bounds[i + 1 : end] - bounds[i + 1])
        union = sizes[i] + sizes[i + 1 : end] - inside
        for j in np.flatnonzero(100 * inside >= PERCENT * union) + i + 1:
            forest.joins(int(j), i)
    named = nodes[order]
    lowest: dict[int, int] = {}
    for i in range(len(order)):
        r = forest.find(i)
        lowest[r] = min(lowest.get(r, named[i]), named[i])
    return pd.DataFrame({"node": named, "root": [lowest[forest.find(i)] for i in range(len(order))]})


def filter_bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which the ``slot`` of each of ``keys`` is set."""
    cells = keys.groupBy(F.floor(F.col("slot") / _CELL_BITS).alias("cell")).agg(
        F.bitmap_construct_agg(F.col("slot") % _CELL_BITS).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in cells.collect():  # at most FILTER_BITS / _CELL_BITS rows
        at = r["cell"] * _CELL_BITS // 8
        bits[at : at + _CELL_BITS // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return np.unpackbits(bits, bitorder="little").astype(bool)


def _sets(wanted):
    """Sets of the texts that pass the filter; the texts themselves stay where they are."""

    def run(batches):
        bits = wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(bits[batch.column("slot").to_numpy()], pa.bool_()))
            found = [shingles(x).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tkey"), pa.array(found, pa.binary())], ["tkey", "set"]
            )

    return run


def _slot(tkey) -> Column:
    return F.pmod(F.xxhash64(tkey), F.lit(FILTER_BITS)).alias("slot")


def _confirmed(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Links among the pairs of two blocks; enough of them to connect what is linked."""
    sets = {n: np.frombuffer(x, np.uint64) for n, x in zip(held["node"], held["set"], strict=True)}
    forest, links = _Forest(), []
    for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True):
        if forest.find(a) != forest.find(b) and _linked(sets[a], sets[b]):
            forest.joins(a, b)
            links.append((a, b))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _least(n, m):
    """Shingles that sets of n and m at the threshold have in common at least."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def parity(shingle: np.ndarray) -> np.ndarray:
    """Parities of a set's numbers in ``PARITY_BITS`` cells.

    The bitmaps of two sets differ in no more bits than the sets in elements.
    """
    cells = np.bincount((shingle % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((cells & 1).astype(np.uint8))


def _rarity_slot(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _slot_counts(batches):
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in batches:
        for x in batch.column("set").to_pylist():
            np.add.at(counts, _rarity_slot(np.frombuffer(x, np.uint64)), 1)
    used = np.flatnonzero(counts)
    for at in range(0, len(used), 65_536):
        part = used[at : at + 65_536]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["slot", "c"])


def prefix(shingle: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and shingles, rarest first, of which a linked set must have one.

    The order is that of the counts of slots, so it is the same for all sets.
    """
    own = counts[_rarity_slot(shingle)]
    n = len(shingle)
    order = np.lexsort((shingle, own))[: n - -(-PERCENT * n // 100) + 1]
    place = np.flatnonzero(own[order] > 1)  # what only one set has, links nothing
    return place, shingle[order[place]]


_ENTRY = "shingle bigint, place bigint, node bigint, root bigint, n bigint, bits binary"


def _entries(counts):
    def run(batches):
        known = counts.value
        for batch in batches:
            for node, root, x in zip(*(batch.column(c).to_pylist() for c in ("node", "root", "set")), strict=True):
                own = np.frombuffer(x, np.uint64)
                place, rare = prefix(own, known)
                k = len(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rare.view(np.int64)), pa.array(place), pa.array(np.full(k, node)),
                     pa.array(np.full(k, root)), pa.array(np.full(k, len(own))),
                     pa.array([parity(own).tobytes()] * k, pa.binary())],
                    ["shingle", "place", "node", "root", "n", "bits"],
                )

    return run


def posting_pairs(place, root, n, bits, own, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions) of a shingle's entries that the bounds leave; ``across``: of two blocks."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        j = j[(root[j] != root[i]) & ((own[j] != own[i]) if across else True)]
        least = _least(n[i], n[j])
        j, least = (x[np.minimum(n[i] - place[i], n[j] - place[j]) >= least] for x in (j, least))
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        j = j[apart <= n[i] + n[j] - 2 * least]
        left.append(np.full(len(j), i))
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


_POSTED = ["shingle", "p", "q", "own", "place", "node", "root", "n"]


def _posted(batches):
    """Pairs of a run of entries sorted by shingle and blocks; holds one block pair at a time."""

    def pairs(rows, bits):
        _, p, q, own, place, node, root, n = rows
        i, j = posting_pairs(place, root, n, bits, own, bool(p[0] != q[0]))
        flip = node[i] > node[j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        return np.stack([node[i], node[j], root[i], root[j]])

    def batch_of(found):
        each = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in each], ["a", "b", "root_a", "root_b"])

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _POSTED])
        bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(len(rows[0]), -1)
        if kept is not None:
            rows, bits = np.concatenate([kept[0], rows], axis=1), np.concatenate([kept[1], bits])
        ends = (np.flatnonzero((np.diff(rows[:3]) != 0).any(axis=0)) + 1).tolist()
        found = [
            pairs(rows[:, a:b], bits[a:b]) for a, b in zip([0, *ends], ends, strict=False) if b - a > 1
        ]
        kept = (rows[:, ends[-1] :], bits[ends[-1] :]) if ends else (rows, bits)
        if found:
            yield batch_of(found)
    if kept is not None and len(kept[1]) > 1:
        yield batch_of([pairs(*kept)])


def _joined(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Components that pairs of two blocks link: pairs of roots."""
    sets = {n: np.frombuffer(x, np.uint64) for n, x in zip(held["node"], held["set"], strict=True)}
    forest, links = _Forest(), []
    for a, b, x, y in pairs[["a", "b", "root_a", "root_b"]].itertuples(index=False):
        if forest.find(x) != forest.find(y) and _linked(sets[a], sets[b]):
            forest.joins(x, y)
            links.append((x, y))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def crowd_links(crowd: DataFrame) -> DataFrame:
    """Pairs of components (a, b) with a link between them, of all (node, root, set) rows.

    Exact: enough pairs to connect what is linked.
    """
    spark = crowd.sparkSession
    counted = crowd.mapInArrow(_slot_counts, "slot bigint, c bigint").groupBy("slot").agg(F.sum("c").alias("c"))
    table = counted.toArrow()  # at most 2^COUNT_BITS rows
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[table["slot"].to_numpy()] = table["c"].to_numpy()
    entries = written(
        crowd.mapInArrow(_entries(spark.sparkContext.broadcast(counts)), _ENTRY), "dedup-entries"
    )
    shared = (
        entries.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("k"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("shingle", F.ceil(F.col("k") / POSTING).alias("blocks"))
    )
    # A block of a hot shingle meets each block, itself included.
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")
    dealt = entries.join(shared, "shingle").select("*", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select(
        "shingle", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        "own", "place", "node", "root", "n", "bits",
    )
    key = ["shingle", "p", "q"]
    asked = (
        dealt.repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(_posted, "a bigint, b bigint, root_a bigint, root_b bigint")
        .distinct()
    )
    n_blocks = F.lit(-(-crowd.count() // GROUP))
    block = lambda c: F.pmod(F.xxhash64(c), n_blocks)
    ends = F.least(block("a"), block("b")).alias("p"), F.greatest(block("a"), block("b")).alias("q")
    asked = written(asked.select(*ends, "a", "b", "root_a", "root_b"), "dedup-asked")
    needed = asked.select("p", "q", F.explode(F.array("a", "b")).alias("node")).distinct()
    delivered = written(needed.join(crowd.select("node", "set"), "node"), "dedup-crowd-sets")
    return (
        asked.groupBy("p", "q")
        .cogroup(delivered.groupBy("p", "q"))
        .applyInPandas(_joined, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and chosen of each row.

    ``kept`` is doc_id = component_id; ``chosen`` marks one row per component,
    also where rows repeat a doc_id. Rows that are numbered (``common.UID``, in
    a written table) keep their numbers.
    """
    numbered = docs if UID in docs.columns else with_uid(docs)
    rows = numbered.select(UID, F.col("doc_id").cast("bigint"), "text", F.md5("text").alias("tkey"))
    signed = written(rows.mapInArrow(_sign, _SIGNED), "dedup-signed")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", UID)
    nodes = written(
        signed.where("n > 0")
        .groupBy("f1", "f2", "n")
        .agg(
            F.min(UID).alias("node"), F.min(best).alias("best"),
            F.first("sig").alias("sig"), F.min("tkey").alias("tkey"),
        ),
        "dedup-nodes",
    )
    forest = nodes.select("node", "n", "sig").mapInArrow(_plant, _TREE)
    # Ranges of the whole order: a hot region spreads over several tasks, each of
    # which treats its part as a region.
    order = ["tree", "head", "tail", "node"]
    pairs = written(
        forest.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_neighbours, "a bigint, b bigint, spans boolean")
        .groupBy("a", "b")
        .agg(F.max("spans").alias("spans")),
        "dedup-pairs",
    )
    crowd = pairs.where("a = b").select(F.col("a").alias("node"), F.lit(True).alias("crowded"))
    pairs = pairs.where("a < b")
    grouped = components(pairs.where("spans"), "dedup-candidates")
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    lone = crowd.join(grouped, "node", "left_anti").select(
        "node", F.col("node").alias("root"), F.lit(1).cast("bigint").alias("size")
    )
    members = grouped.join(sizes, "root").select("node", "root", "size").union(lone)
    grouped = written(
        members.join(crowd, "node", "left").join(nodes.select("node", "tkey"), "node"),
        "dedup-groups",
    )
    # The sets of candidates only, made again from their texts.
    wanted = docs.sparkSession.sparkContext.broadcast(filter_bits(grouped.select(_slot("tkey"))))
    texts = rows.where(F.col("tkey").isNotNull()).select("text", "tkey", _slot("tkey"))
    sets = (
        texts.mapInArrow(_sets(wanted), "tkey string, set binary")
        .groupBy("tkey")
        .agg(F.first("set").alias("set"))
    )
    held = written(
        grouped.join(sets, "tkey").select("node", "root", "size", "crowded", "set"), "dedup-sets"
    )

    small = held.where((F.col("size") > 1) & (F.col("size") <= GROUP)).groupBy("root").applyInPandas(
        _closed, "node bigint, root bigint"
    )
    large = held.where(F.col("size") > GROUP)
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / GROUP)).alias("block")
    blocks = large.select("root", "node", block)
    asked_pairs = (
        pairs.join(blocks.toDF("root", "a", "block_a"), "a")
        .join(blocks.select(F.col("node").alias("b"), F.col("block").alias("block_b")), "b")
        .select(
            "root", F.least("block_a", "block_b").alias("p"), F.greatest("block_a", "block_b").alias("q"),
            "a", "b",
        )
    )
    asked_pairs = written(asked_pairs, "dedup-blocks")
    key = ["root", "p", "q"]
    needed = asked_pairs.select(*key, F.explode(F.array("a", "b")).alias("node")).distinct()
    delivered = written(
        needed.join(large.select("node", "set"), "node").select(*key, "node", "set"), "dedup-delivered"
    )
    links = (
        asked_pairs.groupBy(*key)
        .cogroup(delivered.groupBy(*key))
        .applyInPandas(_confirmed, "a bigint, b bigint")
    )
    closed = small.union(components(written(links, "dedup-links"), "dedup-components"))
    closed = written(closed, "dedup-closed")
    crowd = held.where("crowded").join(closed.toDF("node", "top"), "node", "left")
    crowd = written(crowd.select("node", F.coalesce("top", "node").alias("root"), "set"), "dedup-crowd")
    if not crowd.isEmpty():
        more = components(written(crowd_links(crowd), "dedup-more"), "dedup-joined").toDF("root", "top")
        closed = (
            closed.union(crowd.select("node", "root")).distinct().join(more, "root", "left")
            .select("node", F.coalesce("top", "root").alias("root"))
        )
    rooted = nodes.join(closed, "node", "left").select(
        "f1", "f2", "n", "best", F.coalesce("root", "node").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("best").alias("best"))
    found = rooted.select("f1", "f2", "n", "root").join(lowest, "root")
    found = found.select(
        "f1", "f2", "n", F.col("best.doc_id").alias("lead"), F.col(f"best.{UID}").alias("lead_row")
    )
    alone = F.col("n") == 0
    joined = signed.select(UID, "doc_id", "n", "f1", "f2").join(found, ["f1", "f2", "n"], "left")
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("lead"))
    return joined.select(
        UID,
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        (alone | (F.col(UID) == F.col("lead_row"))).alias("chosen"),
    )
