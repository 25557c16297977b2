"""Benchmark decontamination: BM25 with block-max bounds over an index of test items.

The benchmark items are indexed, the training passages are the queries. A
passage is a window of words, each overlapping the next by half, so that every
item lies in one passage as a whole. Impacts are BM25 weights divided by the
item's score for itself: a passage that holds all words of an item scores at
least 1, and one threshold serves all items. An item range (block) holds
``BLOCK_ITEMS`` items and each term keeps its largest impact in each block it
occurs in. As in WAND, the sum of the terms' largest impacts bounds every item's
score, and a passage that can't reach the threshold has no pivot and is left;
as in its block-max form, the sums per block then bound the items of a block,
and only blocks that can reach the threshold are opened. Bounds are added up
for all passages of a document at once, term by term, in place of cursors that
move from item to item. Nothing above the threshold is lost.

Retrieved items are verified: the passage must hold ``OVERLAP`` of the word
triples of the item's question and of its answer. The answer is the last
sentence of an item, the question what precedes it; an item of one sentence is
cut after two thirds of its words.

Triples can't tell an item of two to four words from ordinary text that holds
its words: it is found where they stand in a row, exactly. A single word is no
evidence of a leak and matches nothing.

Term statistics are of all longer items. Items go to classes by length, each
twice as long as the one before, with passages of twice the class's length: a
long item does not loosen the match of a short one. The index is built and
broadcast in parts of about ``PART_WORDS`` words of a class, each queried by all
documents, so neither the driver nor a task ever holds a benchmark of unknown
size. Each document is one row, judged in its task: no shuffle.

Defined cases: NULL or empty texts and items match nothing; repeated items are
reported each; an empty benchmark leaves all documents as they are.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import UID, with_uid, written

THRESHOLD = 0.6
OVERLAP = 0.6
PASSAGE_WORDS = 128
BLOCK_ITEMS = 8
#: Passages times blocks bounded at once: 8 bytes each.
CELLS = 1 << 20
PART_WORDS = 400_000
#: Items of fewer words are matched as a run.
LEAST_WORDS = 5
K1, B = 1.2, 0.75

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.!?…]+\s+|\n+")

HIT = (
    "doc_id bigint, item_id bigint, score double, question_overlap double, "
    "answer_overlap double, passage bigint"
)
_ITEM = (
    f"{UID} bigint, item_id bigint, question array<string>, answer array<string>, "
    "length bigint, word string, tf bigint"
)


def text_words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    sentences = [w for w in map(text_words, SENTENCE_END.split(text)) if w]
    if len(sentences) > 1:
        return [x for s in sentences[:-1] for x in s], sentences[-1]
    own = sentences[0] if sentences else []
    cut = -(-2 * len(own) // 3)
    return own[:cut], own[cut:]


def triples(own: list[str]) -> set[tuple]:
    n = min(3, len(own))
    return set(zip(*(own[k:] for k in range(n)), strict=False)) if n else set()


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's word triples (all of it, if shorter) in the passage."""
    wanted = triples(part)
    if not wanted:
        return 1.0
    n = min(3, len(part))
    held = set(zip(*(passage[k:] for k in range(n)), strict=False))
    return len(wanted & held) / len(wanted)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one range after the other."""
    offsets = np.cumsum(sizes) - sizes
    return np.repeat(starts - offsets, sizes) + np.arange(sizes.sum())


class Index:
    """One part of the inverted index."""

    def __init__(
        self, items: list[tuple], postings: dict[str, list[tuple[int, float]]], passage: int,
        runs: list[int] = (),
    ):
        """items: (item_id, question, answer); postings: (item, impact), items rising; runs:
        items that are matched as a run of words."""
        self.runs: dict[str, list[tuple[list[str], int]]] = {}
        for k in runs:
            own = items[k][1] + items[k][2]
            self.runs.setdefault(own[0], []).append((own, k))
        self.items, self.passage, self.step = items, passage, passage // 2
        self.terms = {w: k for k, w in enumerate(postings)}
        self.blocks = -(-len(items) // BLOCK_ITEMS)
        sizes = [len(own) for own in postings.values()]
        term = np.repeat(np.arange(len(sizes)), sizes)
        place = np.array([i for own in postings.values() for i, _ in own], np.int64)
        impact = np.array([x for own in postings.values() for _, x in own], np.float32)
        # Each term's blocks with its largest impact there, one after the other.
        pairs, which = np.unique(term * max(1, self.blocks) + place // BLOCK_ITEMS, return_inverse=True)
        largest = np.zeros(len(pairs), np.float32)
        np.maximum.at(largest, which, impact)
        # Rounded up, so that a bound is one.
        self.largest = largest * np.float32(1 + 1e-5)
        self.at_block = pairs % max(1, self.blocks)
        self.starts = np.searchsorted(pairs // max(1, self.blocks), np.arange(len(sizes) + 1))
        self.most = np.zeros(len(sizes), np.float32)
        np.maximum.at(self.most, pairs // max(1, self.blocks), self.largest)
        # Each block's postings, by term.
        order = np.lexsort((term, place // BLOCK_ITEMS))
        self.posted = term[order], place[order], impact[order]
        self.cuts = np.searchsorted(place[order] // BLOCK_ITEMS, np.arange(self.blocks + 1))

    def block_scores(self, terms: np.ndarray, block: int, threshold: float):
        """(item, score) of a block's items above the threshold; ``terms`` rise."""
        own = slice(self.cuts[block], self.cuts[block + 1])
        term, place, impact = (x[own] for x in self.posted)
        at = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
        held = terms[at] == term
        first = block * BLOCK_ITEMS
        scores = np.bincount(place[held] - first, weights=impact[held], minlength=BLOCK_ITEMS)
        return [(first + int(i), float(scores[i])) for i in np.flatnonzero(scores >= threshold)]

    def retrieve(self, own: list[str], threshold: float):
        """(passage, item, score) of all passages of a document above the threshold."""
        find = self.terms.get
        ids = np.fromiter((find(w, -1) for w in own), np.int64, len(own))
        at = np.flatnonzero(ids >= 0)
        if not len(at):
            return
        ids, last = ids[at], max(0, -(-(len(own) - self.passage) // self.step))
        codes = []
        for place in (at // self.step, at // self.step - 1):  # a word is in two passages
            inside = (place >= 0) & (place <= last)
            codes.append(place[inside] * len(self.terms) + ids[inside])
        codes = np.unique(np.concatenate(codes))
        passage, term = np.divmod(codes, len(self.terms))
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        ends = np.append(starts[1:], len(codes))
        # Passages whose terms can't reach the threshold anywhere go first.
        able = np.flatnonzero(np.add.reduceat(self.most[term], starts) >= threshold)
        width = max(1, CELLS // self.blocks)
        for low in range(0, len(able), width):
            part = able[low : low + width]
            for k, block in self._open_blocks(term, starts[part], ends[part], threshold):
                terms = term[starts[part[k]] : ends[part[k]]]
                for item, score in self.block_scores(terms, block, threshold):
                    yield int(passage[starts[part[k]]]), item, score

    def _open_blocks(self, term: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: float):
        """(passage, block) where the largest impacts of the passage's terms reach the threshold."""
        sizes = ends - starts
        terms = term[_ranges(starts, sizes)]
        counts = self.starts[terms + 1] - self.starts[terms]
        at = _ranges(self.starts[terms], counts)
        row = np.repeat(np.repeat(np.arange(len(starts)), sizes), counts)
        bounds = np.bincount(
            row * self.blocks + self.at_block[at], weights=self.largest[at],
            minlength=len(starts) * self.blocks,
        )
        for cell in np.flatnonzero(bounds >= threshold):
            yield divmod(int(cell), self.blocks)

    def verified(self, text: str | None, threshold: float, least: float):
        """item -> (score, question overlap, answer overlap, passage), the best of each."""
        own, best = text_words(text), {}
        if self.runs and not self.runs.keys().isdisjoint(own):
            for at, word in enumerate(own):
                for run, item in self.runs.get(word, ()):
                    if own[at : at + len(run)] == run:
                        best.setdefault(item, (1.0, 1.0, 1.0, at // self.step))
        for passage, item, score in self.retrieve(own, threshold):
            _, question, answer = self.items[item]
            held = own[passage * self.step : passage * self.step + self.passage]
            q, a = overlap(question, held), overlap(answer, held)
            if min(q, a) >= least and (score, -passage) > (best.get(item, (-1,))[0], 0):
                best[item] = (score, q, a, passage)
        return best


def _item_words(batches):
    names = [UID, "item_id", "question", "answer", "length", "word", "tf"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(),
             pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for uid, item, text in zip(*(batch.column(c).to_pylist() for c in (UID, "item_id", "text")), strict=True):
            question, answer = question_and_answer(text or "")
            if len(question) + len(answer) < 2:
                continue
            counts = Counter(question + answer)
            for k, (word, tf) in enumerate(sorted(counts.items())):
                parts = (question, answer) if k == 0 else (None, None)
                rows.append((uid, item, *parts, len(question) + len(answer), word, tf))
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names
            )


def index_parts(items: DataFrame, part_words: int = PART_WORDS):
    """Index parts of the items, one after the other."""
    rows = with_uid(items.select(F.col("item_id").cast("bigint"), "text")).select(UID, "item_id", "text")
    found = written(rows.mapInArrow(_item_words, _ITEM), "benchmark-words")
    long = F.col("length") >= LEAST_WORDS
    each = found.where("question is not null")
    totals = each.where(long).agg(F.count(F.lit(1)).alias("items"), F.sum("length").alias("words")).first()
    count, mean = totals["items"], (totals["words"] or 0) / max(1, totals["items"])
    half = PASSAGE_WORDS // 2
    # Twice as long each; one row a class.
    kind = F.greatest(F.lit(0), F.ceil(F.log2(F.col("length") / half))).cast("int")
    classes = each.groupBy(kind.alias("class")).agg(F.sum("length").alias("words")).orderBy("class").collect()
    parts = {r["class"]: -(-r["words"] // part_words) for r in classes}
    if not parts:
        return
    spread = found.where(long).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    dealt = F.element_at(F.create_map(*[F.lit(int(x)) for pair in parts.items() for x in pair]), F.col("class"))
    placed = written(
        found.join(spread, "word", "left")
        .withColumn("class", kind)
        .withColumn("part", F.pmod(F.xxhash64(UID), dealt)),
        "benchmark-index",
    )
    for k, n in parts.items():
        for part in range(n):
            # About part_words words, a share of the class's items dealt by a hash.
            own = placed.where((F.col("class") == k) & (F.col("part") == part)).orderBy(UID, "word").collect()
            if own:
                # A passage holds any item of the class as a whole wherever it begins.
                yield build(own, count, mean, 2 * half * 2**k)


def build(rows: list, count: int, mean: float, passage: int) -> Index:
    """An index of item rows: (item, word, tf, df, length), items together."""
    places, items, weights, runs = {}, [], [], set()
    for r in rows:
        if r[UID] not in places:
            places[r[UID]] = len(items)
            items.append([r["item_id"], [], []])
        k = places[r[UID]]
        if r["question"] is not None:
            items[k][1:] = r["question"], r["answer"]
        if r["length"] < LEAST_WORDS:
            runs.add(k)
            continue
        idf = np.log(1 + (count - r["df"] + 0.5) / (r["df"] + 0.5))
        norm = K1 * (1 - B + B * r["length"] / mean)
        weights.append((k, r["word"], idf * r["tf"] * (K1 + 1) / (r["tf"] + norm)))
    own = np.zeros(len(items))
    for k, _, w in weights:
        own[k] += w
    postings: dict[str, list] = {}
    for k, word, w in weights:
        postings.setdefault(word, []).append((k, w / own[k]))
    return Index([tuple(x) for x in items], postings, passage, sorted(runs))


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP
) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, score, overlaps, passage."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    out = spark.createDataFrame([], HIT)
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passage"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    for part in index_parts(items):
        shared = spark.sparkContext.broadcast(part)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                hits = [
                    (doc, index.items[item][0], *found)
                    for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True)
                    for item, found in sorted(index.verified(text, threshold, least).items())
                ]
                if hits:
                    columns = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names
                    )

        out = out.union(rows.mapInArrow(run, HIT))
    return out


def clean(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP
) -> DataFrame:
    """The documents that leak no item, all columns kept."""
    for part in index_parts(items):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                good = [not index.verified(x, threshold, least) for x in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(good, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
