"""Packing along a space-filling curve.

Each document gets a hashed vector (counts of its byte 5-grams in a fixed
number of bins), projected to three dimensions by a fixed random matrix and
placed on a Hilbert curve. Documents are range-partitioned and sorted by their
key, so similar documents come to lie next to each other, and each partition
is packed from its first to its last document: a sequence takes what fits and
the rest of the document begins the next one. Ties are split by a row number,
so a large group of equal documents spreads over partitions.

Only a partition's last sequence can be short. It is dealt into sequences of
powers of two, which need no padding.

Defined cases: a NULL or empty text has the end id alone; repeated rows are
packed once each; an empty table gives no row; a document longer than a
sequence is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import pieces
from broadsheet.llm.common import UID, with_uid

SEQUENCE = 2048
END_ID = 1
BINS = 512
DIMENSIONS = 3
BITS = 16
SPREAD = 4.0
SEED = 20_240_601
_MIX = np.uint32(2_654_435_761)

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def hashed_vector(text: str) -> np.ndarray:
    """Unit vector of byte 5-gram counts, square roots taken."""
    data = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint32)
    if len(data) < 5:
        data = np.pad(data, (0, 5 - len(data)))
    gram = data[:-4].copy()
    for k in range(1, 5):
        gram *= np.uint32(257)
        gram += data[k : len(data) - 4 + k]
    gram *= _MIX
    counts = np.sqrt(np.bincount(gram >> np.uint32(23), minlength=BINS).astype(np.float32))
    return counts / np.linalg.norm(counts)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of ``points`` (unsigned coordinates) on the Hilbert curve.

    Walks from the highest bit down, undoing the reflection and exchange of
    axes in each subcell, then reads the Gray code of the axes' bits.
    """
    x = points.astype(np.uint64).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(dims):
            inside = ((x[:, i] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
            swap = np.where(inside, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(inside, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, 0, -1):
        on = ((x[:, dims - 1] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        turn ^= np.where(on, np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn[:, None]
    key = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[:, i] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def _keyed(batches):
    plane = np.random.default_rng(SEED).normal(size=(BINS, DIMENSIONS)).astype(np.float32)
    top = (1 << BITS) - 1
    for batch in batches:
        texts = batch.column("text").to_pylist()
        if not texts:
            continue
        spots = np.stack([hashed_vector(x or "") for x in texts]) @ plane
        cells = np.clip((spots + SPREAD) / (2 * SPREAD) * top, 0, top).astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hilbert_keys(cells))], [*batch.schema.names, "curve"]
        )


class _Packer:
    """Fills sequences one after the other; rows come out with each full one."""

    def __init__(self, sequence: int, first_id: int):
        self.sequence, self.next_id = sequence, first_id
        self.open: list[tuple] = []
        self.filled = 0

    def _close(self, parts) -> list[tuple]:
        rows, at = [], 0
        for doc, start, ids, total in parts:
            n = len(ids) // 4
            rows.append((doc, start, n, ids, total, self.next_id, at))
            at += n
        self.next_id += 1
        return rows

    def add(self, doc, ids: bytes) -> list[tuple]:
        rows, total, at = [], len(ids) // 4, 0
        while at < total:
            n = min(total - at, self.sequence - self.filled)
            self.open.append((doc, at, ids[4 * at : 4 * (at + n)], total))
            at += n
            self.filled += n
            if self.filled == self.sequence:
                rows += self._close(self.open)
                self.open, self.filled = [], 0
        return rows

    def finish(self) -> list[tuple]:
        """The last sequence, dealt into powers of two, largest first."""
        rows, parts = [], list(self.open)
        left = self.filled
        while left:
            room = size = 1 << (left.bit_length() - 1)
            own = []
            while room:
                doc, start, ids, total = parts.pop(0)
                n = min(room, len(ids) // 4)
                own.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    parts.insert(0, (doc, start + n, ids[4 * n :], total))
                room -= n
            rows += self._close(own)
            left -= size
        return rows


def _packed(vocabulary: str, sequence: int):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def table(rows):
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches):
        encoder = pieces.byte_encoder(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        packer = _Packer(sequence, TaskContext.get().partitionId() << 33)
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                rows += packer.add(doc, encoder.ids(text or "").astype("<u4").tobytes() + end)
            if rows:
                yield table(rows)
        if rows := packer.finish():
            yield table(rows)

    return run


def pack(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", sequence: int = SEQUENCE
) -> DataFrame:
    """Pieces of documents in sequences of at most ``sequence`` ids.

    Per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. One shuffle, of the texts by key range;
    each text is encoded once, after it.
    """
    rows = with_uid(docs.select(F.col("doc_id").cast("bigint"), "text"))
    keyed = rows.mapInArrow(_keyed, f"doc_id bigint, text string, {UID} bigint, curve bigint")
    sorted_rows = keyed.repartitionByRange("curve", UID).sortWithinPartitions("curve", UID)
    return sorted_rows.select("doc_id", "text").mapInArrow(_packed(vocabulary, sequence), SCHEMA)
