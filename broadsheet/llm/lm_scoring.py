"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Tokens are words and one end per text. The word counts of all training texts
are the base. The model predicts one of ``SYMBOLS`` symbols from the two before
it: the most frequent words, the end, and ``BUCKETS`` classes for all other
words, by their last bytes. A word of a class has add-one share of the class,
with one place for words never seen, so the model is a distribution over all
texts. With context vectors r, word vectors q, diagonal weights c and biases b

    score(w | h1, h2) = (c1*r[h1] + c2*r[h2]) . q[w] + b[w].

Training is numpy, in the tasks: each runs stochastic NCE over its own texts
from the common parameters, with noise words drawn from the word counts; the
results are averaged by tokens for the next pass. All training texts take
part. The parameters (a fixed size) are what reaches the driver.

Normalising is exact and batched: exp of context x word matrices, multiplied,
gives the sum over all words for each pair of context symbols at once; a
token's log-probability is then a lookup in these products.

Counts of up to ``HEAD`` most frequent words travel to the tasks; all rarer words
of a text are joined with the count table, summed per text before the words
leave their task, so no word is rare or hot enough to be lost or to pile up.

Defined cases: a NULL or empty text is the end alone; a row with a NULL doc_id
is a training row; repeated rows count each; without training rows the counts
are zero and the model is uniform over its symbols.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import UID, with_uid, words, written

END = b""
BUCKETS = 255
WORDS = 768
SYMBOLS = WORDS + BUCKETS + 1  # classes, then the end, then words
WIDTH = 24
HEAD = 100_000
PASSES = 2
BATCH = 2048
NOISE = 48
RATE = 0.12
SEED = 17
#: Distinct words that a task sums up before it hands them on.
HELD_WORDS = 200_000


def bucket(word: bytes) -> int:
    """The class of a word outside the symbols."""
    return zlib.crc32(word[-2:] if word.isascii() else b"+" + word[-2:]) % BUCKETS


def _counted(batches):
    def table(counts):
        own = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.binary()), pa.array([bucket(w) if w else -1 for w in own], pa.int32()),
             pa.array(list(counts.values()), pa.int64())],
            ["word", "bucket", "c"],
        )

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(words(text))
            counts[END] += 1
        if len(counts) > HELD_WORDS:
            yield table(counts)
            counts = Counter()
    if counts:
        yield table(counts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, bucket, c) over all texts, the end as an empty word."""
    each = texts.select("text").mapInArrow(_counted, "word binary, bucket int, c bigint")
    return each.groupBy("word", "bucket").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """At most ``most`` words, all at least as frequent as any other, and the end.

    A histogram of counts in steps of about a tenth (a few hundred rows) gives
    the least count that is still in, so no more than the words themselves
    reach the driver.
    """
    step = F.floor(F.log(F.col("c")) / math.log(1.1))
    sizes = counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least")
    )
    least, taken = None, 0
    for r in sizes.orderBy(F.desc("step")).collect():
        taken += r["n"]
        if taken > most:
            break
        least = r["least"]
    # The end stands in no text, so only the head can tell its count.
    wanted = F.col("word") == F.lit(bytearray(END))
    if least is not None:
        wanted |= F.col("c") >= least
    found = counts.where(wanted).select("word", "c").collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))


class Lexicon:
    """What a task knows of words: symbol, counts of the head, class totals."""

    def __init__(self, head: list[tuple[bytes, int]], totals: dict[int, tuple[int, int]], n: int, v: int):
        """head: (word, count), most frequent first; totals: class -> (tokens, words)."""
        self.n, self.v = n, v
        self.place = {w: k for k, (w, _) in enumerate(head)}
        counts = np.array([c for _, c in head], np.float64)
        named = [w for w, _ in head if w != END][:WORDS]
        symbol = {w: BUCKETS + 1 + k for k, w in enumerate(named)} | {END: BUCKETS}
        self.symbol = np.array([symbol.get(w, -1) for w, _ in head], np.int32)
        tokens, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for b, (t, k) in totals.items():
            tokens[b], kinds[b] = t, k
        for w in named:
            b = bucket(w)
            tokens[b] -= counts[self.place[w]]
            kinds[b] -= 1
        self.tokens, self.share = tokens, tokens + kinds + 1
        rest = np.flatnonzero(self.symbol < 0)
        for k in rest:
            self.symbol[k] = bucket(head[k][0])
        self.base = np.log10((counts + 1) / (n + v + 1))
        self.inside = np.zeros(len(head))
        self.inside[rest] = np.log10((counts[rest] + 1) / self.share[self.symbol[rest]])
        # How often each symbol occurs, for the noise and the first biases.
        seen = np.zeros(SYMBOLS)
        seen[:BUCKETS] = tokens
        own = self.symbol >= BUCKETS
        seen[self.symbol[own]] = counts[own]
        self.unigram = ((seen + 1) / (seen + 1).sum()).astype(np.float32)

    def places(self, own: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.get, own, repeat(-1)), np.int64, len(own))

    def encoded(self, own: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols and head places of a text with its end, and its words beyond the head."""
        places = self.places(own)
        symbols = self.symbol[places] if len(self.symbol) else np.zeros(len(own), np.int32)
        rare = np.flatnonzero(places < 0)
        beyond = [own[k] for k in rare]
        if beyond:
            symbols[rare] = [bucket(w) for w in beyond]
        end = self.place.get(END, -1)
        return np.append(symbols, BUCKETS), np.append(places, end), beyond


def contexts(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two before each token; the end stands before a text."""
    before = np.concatenate([[BUCKETS, BUCKETS], symbols])
    return before[1:-1], before[:-2]


class Model:
    """Parameters in one flat vector, so that tasks can average them."""

    SHAPES = {"r": (SYMBOLS, WIDTH), "q": (SYMBOLS, WIDTH), "b": (SYMBOLS,), "c": (2, WIDTH)}

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = math.prod(shape)
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def first(cls, unigram: np.ndarray) -> Model:
        rng = np.random.default_rng(SEED)
        sizes = sum(math.prod(s) for s in cls.SHAPES.values())
        model = cls((0.1 * rng.normal(size=sizes)).astype(np.float32))
        model.b[:] = np.log(unigram)
        model.c[:] = 1
        return model

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context x word products and the log-sums of all context pairs."""
        near = (self.r * self.c[0]) @ self.q.T
        far = (self.r * self.c[1]) @ self.q.T + self.b
        top, back = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        total = np.exp(near - top) @ np.exp(far - back).T
        return near, far, np.log(total) + top + back.T


def _scatter(ids: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` by id, one row a symbol."""
    sums = np.zeros(SYMBOLS * WIDTH)
    # Floats whose type came by a broadcast are added 30 times slower; fresh doubles are not.
    np.add.at(sums, _CELLS.take(ids, axis=0).ravel(), values.ravel().astype(np.float64))
    return sums.reshape(SYMBOLS, WIDTH).astype(np.float32)


_CELLS = np.arange(SYMBOLS * WIDTH).reshape(SYMBOLS, WIDTH)


class Trainer:
    """NCE with Adagrad on batches of (symbol, context, context)."""

    def __init__(self, model: Model, unigram: np.ndarray, rate: float, seed: int):
        self.model, self.rate = model, rate
        self.rng = np.random.default_rng(seed)
        self.steps = np.cumsum(unigram.astype(np.float64))
        self.log_noise = np.log(NOISE * unigram.astype(np.float64)).astype(np.float32)
        self.sums = {k: np.full(s, 0.1, np.float32) for k, s in Model.SHAPES.items()}
        self.seen = 0

    def _move(self, name: str, grad: np.ndarray):
        self.sums[name] += grad * grad
        getattr(self.model, name)[...] += self.rate * grad / np.sqrt(self.sums[name])

    def update(self, w: np.ndarray, h1: np.ndarray, h2: np.ndarray):
        m = self.model
        noise = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), SYMBOLS - 1)
        q, qn = m.q.take(w, axis=0), m.q[noise]
        guess = (m.r * m.c[0]).take(h1, axis=0)
        guess += (m.r * m.c[1]).take(h2, axis=0)
        good = np.einsum("ij,ij->i", guess, q) + m.b[w] - self.log_noise[w]
        bad = guess @ qn.T
        bad += m.b[noise] - self.log_noise[noise]
        scale = np.float32(1 / np.sqrt(len(w)))
        up = scale / (1 + np.exp(np.clip(good, -30, 30)))
        odds = np.exp(np.clip(bad, -30, 30, out=bad), out=bad)
        down = odds / (odds + 1)
        down *= -scale
        d_guess = down @ qn
        d_guess += up[:, None] * q
        d_q = _scatter(w, up[:, None] * guess)
        np.add.at(d_q, noise, down.T @ guess)
        d_b = np.bincount(w, weights=up, minlength=SYMBOLS)
        d_b += np.bincount(noise, weights=np.ones(len(w), np.float32) @ down, minlength=SYMBOLS)
        # Summed by context symbol first: weights and products are of symbols, not of tokens.
        s1, s2 = _scatter(h1, d_guess), _scatter(h2, d_guess)
        d_r = s1 * m.c[0] + s2 * m.c[1]
        d_c = np.stack([np.einsum("ij,ij->j", s, m.r) for s in (s1, s2)])
        for name, grad in (("q", d_q), ("b", d_b.astype(np.float32)), ("r", d_r), ("c", 0.01 * d_c)):
            self._move(name, grad)
        self.seen += len(w)


_ENCODED = (
    f"{UID} bigint, doc_id bigint, held_out boolean, symbols binary, n_tokens bigint, "
    "n_known bigint, base_score double, inside double, "
    "rare array<struct<word: binary, bucket: int, n: bigint>>"
)
_RARE = pa.list_(pa.struct([("word", pa.binary()), ("bucket", pa.int32()), ("n", pa.int64())]))
#: Symbols as they are written: two bytes a token.
_STORED = np.dtype("<i2")


def _encoded(lexicon):
    """Texts to symbols, with the sums that need no model."""

    def run(batches):
        known = lexicon.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                w, places, beyond = known.encoded(words(text))
                own = places[places >= 0]
                rare = [
                    {"word": x, "bucket": bucket(x), "n": n} for x, n in Counter(beyond).items()
                ]
                rows.append(
                    (w.astype(_STORED).tobytes(), len(w), len(own), float(known.base[own].sum()),
                     float(known.inside[own].sum()), rare)
                )
            if rows:
                symbols, size, found, base, inside, rare = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(UID), batch.column("doc_id"), batch.column("held_out"),
                     pa.array(symbols, pa.binary()), pa.array(size, pa.int64()),
                     pa.array(found, pa.int64()), pa.array(base, pa.float64()),
                     pa.array(inside, pa.float64()), pa.array(rare, _RARE)],
                    [UID, "doc_id", "held_out", "symbols", "n_tokens", "n_known", "base_score",
                     "inside", "rare"],
                )

    return run


def _trained(unigram, flat, rate: float):
    def run(batches):
        from pyspark import TaskContext

        model = Model(flat.value.copy())
        trainer = Trainer(model, unigram.value, rate, SEED + TaskContext.get().partitionId())
        held, size = [], 0
        for batch in batches:
            for stored in batch.column("symbols").to_pylist():
                symbols = np.frombuffer(stored, _STORED)
                held.append(np.stack([symbols, *contexts(symbols)]))
                size += len(symbols)
            if size >= 64 * BATCH:
                _feed(trainer, held)
                held, size = [], 0
        if size:
            _feed(trainer, held)
        if trainer.seen:
            n = len(model.flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, dtype=np.int32)),
                 pa.array(model.flat.astype(np.float64) * trainer.seen),
                 pa.array(np.full(n, trainer.seen, np.int64))],
                ["k", "x", "n"],
            )

    return run


def _feed(trainer: Trainer, held: list[np.ndarray]):
    """Shuffled batches of what is held."""
    tokens = np.concatenate(held, axis=1)
    tokens = tokens.take(trainer.rng.permutation(tokens.shape[1]), axis=1).astype(np.int64)
    for at in range(0, tokens.shape[1], BATCH):
        trainer.update(*tokens[:, at : at + BATCH])


def train(encoded: DataFrame, lexicon: Lexicon, passes: int = PASSES) -> Model:
    """Passes over the ``symbols`` of all texts; parameters are averaged after each."""
    context = encoded.sparkSession.sparkContext
    unigram = context.broadcast(lexicon.unigram)
    model = Model.first(lexicon.unigram)
    for k in range(passes):
        flat = context.broadcast(model.flat)
        found = (
            encoded.select("symbols")
            .mapInArrow(_trained(unigram, flat, RATE / (1 + k)), "k int, x double, n bigint")
            .groupBy("k")
            .agg((F.sum("x") / F.sum("n")).alias("x"))
            .toArrow()  # one row per parameter
        )
        if not found.num_rows:
            break
        fresh = np.empty_like(model.flat)
        fresh[found.column("k").to_numpy()] = found.column("x").to_numpy()
        model = Model(fresh)
    return model


def _scored(flat):
    """``symbols`` replaced by the model's log10 probability of the text's symbols."""

    def run(batches):
        near, far, total = Model(flat.value).tables()
        for batch in batches:
            place = batch.schema.get_field_index("symbols")
            likely = []
            for stored in batch.column(place).to_pylist():
                w = np.frombuffer(stored, _STORED).astype(np.int64)
                h1, h2 = contexts(w)
                model = (near[h1, w] + far[h2, w] - total[h1, h2]).sum(dtype=np.float64)
                likely.append(float(model) / math.log(10))
            yield batch.set_column(place, "likely", pa.array(likely, pa.float64()))

    return run


def score(docs: DataFrame, held_out, passes: int = PASSES) -> DataFrame:
    """Score all ``docs``, learning from the rows where ``held_out`` (a column) is false.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    context = docs.sparkSession.sparkContext
    rows = with_uid(
        docs.select(
            F.col("doc_id").cast("bigint"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"
        )
    ).select(UID, "doc_id", "held_out", "text")
    learnt = rows.where(~F.col("held_out"))
    counts = written(word_counts(learnt), "lm-counts")
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    totals = {
        r["bucket"]: (r["n"], r["v"])
        for r in counts.where("bucket >= 0")
        .groupBy("bucket")
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
        .collect()  # one row per class
    }
    lexicon = Lexicon(most_frequent(counts), totals, whole["n"] or 0, whole["v"])
    # Each text is split and looked up once; what follows reads its symbols.
    encoded = written(rows.mapInArrow(_encoded(context.broadcast(lexicon)), _ENCODED), "lm-encoded")
    model = train(encoded.where(~F.col("held_out")), lexicon, passes)
    narrow = encoded.drop("rare")
    schema = ", ".join(f"{c} {t}" for c, t in narrow.dtypes)
    scored = narrow.mapInArrow(
        _scored(context.broadcast(model.flat)), schema.replace("symbols binary", "likely double")
    )
    n, v = lexicon.n, lexicon.v
    shares = F.array(*[F.lit(float(x)) for x in lexicon.share])
    rare = encoded.select(UID, F.explode("rare").alias("r")).select(UID, "r.*")
    c = F.coalesce("c", F.lit(0)) + F.lit(1.0)
    rest = (
        rare.join(counts.select("word", "c"), "word", "left")
        .groupBy(UID)
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.col("n") * F.log10(c / F.lit(float(n + v + 1)))).alias("base"),
            F.sum(F.col("n") * F.log10(c / F.get(shares, F.col("bucket")))).alias("rest_inside"),
        )
    )
    return scored.join(rest, UID, "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("likely") + F.col("inside") + F.coalesce("rest_inside", F.lit(0.0))).alias("score"),
    )
