"""Language identification by string kernels.

The kernel of two texts is the number of distinct byte n-grams (lengths 2 to
4, hashed) that both have, over the geometric mean of their own numbers: a
blended-spectrum presence kernel. Nystroem landmarks are ``landmarks`` training
documents of each language. A text's features are its kernels with the
landmarks, whitened by the landmarks' own kernel matrix; one-versus-rest
kernel ridge regression on them is solved in closed form. Scoring is batched:
presence matrix x landmark presence matrix, then x weights.

Learning takes a bounded sample of ``sample`` labelled documents, shared out
evenly over all languages that are labelled (at most ``per_language`` and at
least two of each), chosen by a hash of the row; only sets of n-gram hashes reach
the driver. No language is left out, however many there are. Every text is
predicted from all of itself.

Evidence: the presence kernel of a text with all landmarks together, over that
of the text with itself, is the share of its n-grams that the landmarks know. A
text of ``LEAST_GRAMS`` or more distinct n-grams is foreign to the model if that
share is below ``FOREIGN_SHARE`` of what all but one in a hundred learnt texts
show, landmarks against the others. The one-versus-rest margins tell languages apart,
but a text of two languages has as low ones as a text of none.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from. Rows with a NULL doc_id
are never learnt from. Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LENGTHS = (2, 3, 4)
HASH_BITS = 18
PER_LANGUAGE = 160
SAMPLE = 32_000
LANDMARKS = 48
#: Fewer distinct n-grams are no evidence against a language.
LEAST_GRAMS = 400
FOREIGN_SHARE = 0.6
RIDGE = 1e-3
SHARPNESS = 6.0
UNDETERMINED = "und"

_WORDLIKE = re.compile(r"[^\W\d_]")
_MIX = np.uint32(2_654_435_761)


def has_letter(text: str) -> bool:
    """A letter of any script; signs such as a raised two are none."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def gram_codes(text: str) -> np.ndarray:
    """Hashes of all byte n-grams of a text, ASCII letters in lower case.

    Digits become one digit, so numbers don't tell languages apart.
    """
    data = text.encode().lower().translate(_SAME_DIGIT)
    data = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    codes = []
    for n in LENGTHS:
        if len(data) < n:
            break
        gram = data[: len(data) - n + 1] + np.uint32(n << 8)
        for k in range(1, n):
            gram = gram * np.uint32(1_009) + data[k : len(data) - n + 1 + k]
        codes.append((gram * _MIX) >> np.uint32(32 - HASH_BITS))
    return np.concatenate(codes) if codes else np.empty(0, np.uint32)


_SAME_DIGIT = bytes.maketrans(b"123456789", b"000000000")


def _gram_sets(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        sets = [np.unique(gram_codes(x)).tobytes() if has_letter(x) else b"" for x in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(sets, pa.binary())], ["lang", "grams"]
        )


class Model:
    """Weights of a fitted classifier; ``lookup`` maps hashes to landmark n-grams."""

    def __init__(self, languages, lookup, landmarks, own, weights, bias, least):
        self.languages, self.lookup, self.landmarks = languages, lookup, landmarks
        self.own, self.weights, self.bias, self.least = own, weights, bias, least

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language, between 0 and 1."""
        return self.judged(texts)[0]

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The scores, and which texts are foreign to all languages."""
        present = np.zeros((len(texts), self.landmarks.shape[0]), np.float32)
        sizes = np.ones(len(texts), np.float32)
        seen = np.zeros(1 << HASH_BITS, np.bool_)
        for i, text in enumerate(texts):
            codes = gram_codes(text)
            seen[:] = False
            seen[codes] = True
            sizes[i] = max(1, np.count_nonzero(seen))
            present[i, self.lookup[codes]] = 1
        present[:, 0] = 0  # column 0 stands for n-grams of no landmark
        kernel = (present @ self.landmarks) / np.sqrt(sizes[:, None] * self.own[None])
        margin = kernel @ self.weights + self.bias
        best = margin.max(axis=1, keepdims=True)
        foreign = (sizes >= LEAST_GRAMS) & (present.sum(axis=1) < self.least * sizes)
        likely = np.exp(SHARPNESS * (margin - best))
        return likely / likely.sum(axis=1, keepdims=True), foreign


def fit(samples: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """Kernel ridge regression on Nystroem features of (language, n-gram set) rows."""
    samples = [(lang, np.frombuffer(x, np.uint32)) for lang, x in samples if x]
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    taken: dict[str, int] = {}
    chosen, used = [], []
    for lang, codes in samples:
        taken[lang] = taken.get(lang, 0) + 1
        used.append(taken[lang] <= landmarks)
        if used[-1]:
            chosen.append(codes)
    grams = np.unique(np.concatenate(chosen))
    lookup = np.zeros(1 << HASH_BITS, np.int32)
    lookup[grams] = np.arange(1, len(grams) + 1)
    marks = np.zeros((len(grams) + 1, len(chosen)), np.float32)
    for j, codes in enumerate(chosen):
        marks[lookup[codes], j] = 1
    marks[0] = 0
    own = np.array([len(x) for x in chosen], np.float32)

    def kernel(sets):
        out = np.zeros((len(sets), len(chosen)))
        for i, codes in enumerate(sets):
            row = lookup[codes]
            out[i] = marks[row].sum(axis=0) / np.sqrt(len(codes) * own)
        return out

    # Whitened features: K(x, L) K(L, L)^(-1/2).
    values, vectors = np.linalg.eigh(kernel(chosen))
    root = vectors / np.sqrt(np.maximum(values, 1e-4 * values.max()))
    features = kernel([x for _, x in samples]) @ root
    target = np.array([[1.0 if lang == k else -1.0 for k in languages] for lang, _ in samples])
    counts = np.array([taken[lang] for lang, _ in samples], float)
    weight = (1 / counts)[:, None]  # every language weighs the same
    mean, middle = (
        (features * weight).sum(0) / weight.sum(),
        (target * weight).sum(0) / weight.sum(),
    )
    x, y = features - mean, target - middle
    solved = np.linalg.solve(
        x.T @ (x * weight) + ridge * np.eye(x.shape[1]), x.T @ (y * weight)
    )
    weights = (root @ solved).astype(np.float32)
    bias = (middle - mean @ solved).astype(np.float32)
    # What a landmark's n-grams share with the others: itself doesn't count.
    held = np.count_nonzero(marks, axis=1)
    shown = [
        np.count_nonzero(held[lookup[x]] > own_mark) / len(x)
        for (_, x), own_mark in zip(samples, used, strict=True)
        if len(x) >= LEAST_GRAMS
    ]
    least = FOREIGN_SHARE * float(np.quantile(shown, 0.01)) if shown else 0.0
    return Model(languages, lookup, marks, own, weights, bias, least)


def train(
    labelled: DataFrame,
    per_language: int = PER_LANGUAGE,
    landmarks: int = LANDMARKS,
    sample: int = SAMPLE,
) -> Model | None:
    """Fit on rows of (doc_id, text, lang). The sample is the documented bound."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("order"))
    kinds = rows.agg(F.count_distinct("lang")).first()[0]  # one number
    each = max(2, min(per_language, sample // max(1, kinds)))
    # The first rows of each group are kept before the shuffle too.
    first = Window.partitionBy("lang").orderBy("order")
    sets = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each)
    found = (
        sets.repartition(spark.sparkContext.defaultParallelism, "order")
        .select("text", "lang")
        .mapInArrow(_gram_sets, "lang string, grams binary")
        .collect()
    )
    # Few landmarks of each of many languages: their number stays bounded too.
    most = max(1, min(landmarks, LANDMARKS * 4 * per_language // max(1, kinds * landmarks)))
    return fit(sorted((r["lang"], bytes(r["grams"])) for r in found), most)


def predict(
    docs: DataFrame,
    model: Model | None,
    language: str = "lang_pred",
    score: str = "score",
    foreign: str | None = None,
) -> DataFrame:
    """``docs`` with lang_pred and score added; any columns, no shuffle.

    The names of the new columns replace old ones; ``foreign`` names a column
    that tells the texts foreign to all languages.
    """
    names = [language, score, *([foreign] if foreign else [])]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            asked = [i for i, x in enumerate(texts) if known and has_letter(x)]
            told, sure = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            strange = [False] * len(texts)
            if asked:
                scores, far = known.judged([texts[i] for i in asked])
                best = scores.argmax(axis=1)
                for i, k, row, f in zip(asked, best, scores, far, strict=True):
                    told[i], sure[i], strange[i] = known.languages[k], float(row[k]), bool(f)
            made = [pa.array(told), pa.array(sure, pa.float64()), pa.array(strange, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made[: len(names)]], [*batch.schema.names, *names]
            )

    docs = docs.drop(*names)
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, ("string", "double", "boolean"), strict=False):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)
