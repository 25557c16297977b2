"""Token counts: overlap resynchronisation for huge documents.

A document longer than ``chunk_chars`` is encoded in chunks that overlap, each
with offsets. Two neighbours are spliced at a common boundary that is proven
stable: a character position in the overlap that follows white space, at which
both encodings start a token, and from which both agree on ids and offsets.
White space always ends a token of such a vocabulary, so tokens before the
boundary don't depend on what follows it, nor those after it on what precedes
it. Where an overlap has no such position it is widened, at last to the end of
the text. Memory is bounded by the chunk, not by the document.

A document of one chunk is encoded as it is; its words come from ``pieces``,
by the same proof.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; every row
counts for itself; special strings inside a text become their special token,
as the library does by default; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import pieces

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: Tokens that must agree after a boundary (all, where the overlap has fewer).
AGREE = 4
WHITE = " \t\n\r\f\v"

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def _starts(encoding) -> np.ndarray:
    return np.array([a for a, _ in encoding.offsets], dtype=np.int64)


def boundary(text: str, left, right, left_at: int, right_at: int) -> int | None:
    """The stable common boundary of two encodings next to the middle, if any.

    ``left`` and ``right`` are (ids, starts) with starts in the document;
    the overlap begins at ``right_at`` and ends at ``left_at``.
    """
    (left_ids, left_starts), (right_ids, right_starts) = left, right
    common = np.intersect1d(
        left_starts[left_starts > right_at], right_starts[right_starts < left_at]
    )
    middle = (left_at + right_at) / 2
    for p in sorted(common.tolist(), key=lambda x: abs(x - middle)):
        if text[p - 1] not in WHITE:
            continue
        i, j = np.searchsorted(left_starts, p), np.searchsorted(right_starts, p)
        # The last word that the left chunk sees may be cut short.
        whole = np.searchsorted(left_starts, _last_word(text, p, left_at))
        n = min(AGREE, whole - i)
        if n > 0 and left_ids[i : i + n] == right_ids[j : j + n] and np.array_equal(
            left_starts[i : i + n], right_starts[j : j + n]
        ):
            return p
    return None


def _last_word(text: str, start: int, end: int) -> int:
    """Where the last word before ``end`` begins."""
    while end > start and text[end - 1] not in WHITE:
        end -= 1
    return end


def count_huge(text: str, encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a text by overlapping chunks."""

    def encoded(start: int, end: int):
        found = encoder.encode(text[start:end], add_special_tokens=False)
        return found.ids, _starts(found) + start

    total, begin, start, size = 0, 0, 0, len(text)
    end = min(size, chunk + overlap)
    left = encoded(start, end)
    while end < size:
        wide, p = overlap, None
        while p is None and end < size:
            right_at = end - wide
            right_end = min(size, right_at + wide + chunk)
            right = encoded(right_at, right_end)
            p = boundary(text, left, right, end, right_at)
            if p is None:
                # Widen to the right: the left chunk is encoded anew, further on.
                wide *= 2
                end = min(size, end + wide)
                left = encoded(start, end)
        if p is None:
            break
        total += int(np.count_nonzero((left[1] >= begin) & (left[1] < p)))
        begin, start, end, left = p, right_at, right_end, right
    return total + int(np.count_nonzero(left[1] >= begin))


def _counter(vocabulary: str, chunk: int, overlap: int):
    def run(batches):
        encoder = pieces.tokenizer(vocabulary)
        memory = pieces.memory(vocabulary, "number", len)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            split = [pieces.word_pieces(x) if len(x) <= chunk else () for x in texts]
            known = memory.of({p for own in split for p in own})
            counts = [
                sum(map(known.__getitem__, own)) if own else count_huge(text, encoder, chunk, overlap)
                for own, text in zip(split, texts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x.encode()) for x in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    limit: int = 2048,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; no shuffle."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    counted = rows.mapInArrow(_counter(vocabulary, chunk_chars, overlap_chars), SCHEMA)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
