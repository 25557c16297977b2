"""Personal data: fixed patterns and a trained character tagger.

The patterns give the base spans. A bidirectional LSTM with CRF transitions
(``tagger``), trained in numpy on windows labelled with base spans, adds spans
that the patterns miss: the training windows also hold written variants of
labelled values (a number without its plus sign, other separators).

A text is cut into windows of ``WINDOW`` characters, each overlapping the next
by half. A character takes its tag from the window in which it lies most
centrally; tags are then joined over the whole text, so a span may run through
any number of windows. Every kind has a digit or an at sign, so windows with
neither hold no span and are not run; that skips nothing that could be found.
A tagged span that ends inside a run of letters and digits takes the run in. It
is reported if it then has the form of its kind, its posterior is at least
``SURE`` on average and it touches no base span.

Learning takes a bounded sample, ``TRAIN_WINDOWS`` windows with and as many
without a span, chosen by a hash. Everything else covers all texts, row by
row, without a shuffle.

Defined cases: NULL and empty texts have no span; without a single labelled
window there is no tagger and the base spans remain; repeated rows are judged
alike; a NULL text stays NULL when redacted.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from broadsheet.llm.spans import apart
from broadsheet.llm.tagger import PAD, Tagger, char_ids

# The base patterns of the contract.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails at its start fails from its other digits too.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

KINDS = ["email", "ip", "card", "phone"]
TRIGGER = re.compile(r"[0-9@]")
WINDOW = 96
STEP = WINDOW // 2
TRAIN_WINDOWS = 320
PASSES = 10
SURE = 0.9
#: Letters and digits that a tagged span may be short of on either side.
RUN = 24

SPANS = (
    "array<struct<start: bigint, rank: int, kind: string, end: bigint, base: boolean, sure: double>>"
)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost e-mail addresses, from one at sign to the next: linear."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return spans
    for m in IP.finditer(text):
        # Leading zeros don't matter; int() is kept from huge numbers.
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        own = _digits(m[0])
        if 14 <= len(own) <= 19 and luhn(own):
            spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    last = max(0, -(-(len(text) - WINDOW) // STEP))
    hit = set()
    for m in TRIGGER.finditer(text):
        k = m.start() // STEP
        hit.update(x for x in (k, k - 1) if 0 <= x <= last)
        if k > last:
            hit.add(last)
    return [k * STEP for k in sorted(hit)]


def _padded(ids: np.ndarray) -> np.ndarray:
    return np.pad(ids, (0, WINDOW - len(ids)), constant_values=PAD)


# --- training -------------------------------------------------------------------


def _labelled(batches):
    """Windows with their base spans as text, and a hash to choose by."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            for at in windows(text or ""):
                own = [
                    f"{kind} {max(a - at, 0)} {min(b - at, WINDOW)}"
                    for kind, a, b in base
                    if a < at + WINDOW and b > at
                ]
                piece = text[at : at + WINDOW]
                rows.append((piece, ",".join(own), zlib.crc32(piece.encode())))
        if rows:
            columns = zip(*rows, strict=True)
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                ["piece", "own", "order"],
            )


def _variants(piece: str, spans: list[tuple[str, int, int]], rng: random.Random):
    """A window with its numbers written another way, labels moved along."""
    out, moved, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        value = piece[a:b]
        if kind == "phone":
            value = rng.choice([value[1:], re.sub(r"[ ()]+", "-", value[1:]).strip("-"), value])
        elif kind == "card" and len(_digits(value)) == 16:
            own, sep = _digits(value), rng.choice([" ", "-", ""])
            value = sep.join(own[k : k + 4] for k in range(0, 16, 4))
        out += piece[at:a]
        moved.append((kind, len(out), len(out) + len(value)))
        out, at = out + value, b
    return out + piece[at:], moved


def train(docs: DataFrame, limit: int = TRAIN_WINDOWS, passes: int = PASSES) -> Tagger | None:
    """A tagger from at most ``limit`` windows with and ``limit`` without a base span."""
    found = docs.select("text").mapInArrow(_labelled, "piece string, own string, order bigint")
    rows = []
    for condition in ("own != ''", "own = ''"):
        rows += found.where(condition).distinct().orderBy("order", "piece", "own").limit(limit).collect()
    if not any(r["own"] for r in rows):
        return None
    rng = random.Random(1)
    ids, tags = [], []
    for r in rows:
        spans = [(k, int(a), int(b)) for k, a, b in (x.split() for x in r["own"].split(",") if x)]
        made = [(r["piece"], spans)]
        if spans:
            made.append(_variants(r["piece"], spans, rng))
        for piece, own in made:
            tag = np.zeros(WINDOW, np.int64)
            for kind, a, b in own:
                tag[a : min(b, WINDOW)] = KINDS.index(kind) + 1
            ids.append(_padded(char_ids(piece[:WINDOW])))
            tags.append(tag)
    return Tagger(len(KINDS) + 1).fit(np.array(ids), np.array(tags), passes)


# --- tagging --------------------------------------------------------------------


def _shaped(kind: str, value: str) -> bool:
    """The least form of a kind."""
    n = len(_digits(value))
    if kind == "email":
        host = value.partition("@")[2]
        return 0 < value.find("@") < len(value) - 3 and "." in host.strip(".")
    if kind == "ip":
        return len(value.split(".")) == 4 and n >= 4
    if kind == "card":
        return 13 <= n <= 19 and luhn(_digits(value))
    return 10 <= n <= 15 and bool(re.search(r"[ ().+-]", value))


def reconcile(size: int, starts: list[int], tags: np.ndarray, sure: np.ndarray):
    """(kind, start, end, sure) over a whole text from (window, time) tags.

    Each window speaks for its middle half; the first also for what precedes
    it, the last for what follows.
    """
    spans, edge = [], (WINDOW - STEP) // 2
    last = max(0, -(-(size - WINDOW) // STEP)) * STEP
    for at, tag, own in zip(starts, tags, sure, strict=True):
        a = 0 if at == 0 else edge
        b = min(WINDOW, size - at) if at == last else edge + STEP
        cuts = [a, *(np.flatnonzero(np.diff(tag[a:b])) + 1 + a).tolist(), b]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if tag[x]:
                kind, start, weight = int(tag[x]), at + x, float(own[x:y].sum())
                if spans and spans[-1][0] == kind and spans[-1][2] == start:
                    k, s, _, w = spans.pop()
                    spans.append((k, s, at + y, w + weight))
                else:
                    spans.append((kind, start, at + y, weight))
    return [(KINDS[k - 1], a, b, w / (b - a)) for k, a, b, w in spans]


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _whole(text: str, a: int, b: int) -> tuple[int, int]:
    """A span that ends inside a run of letters and digits takes the run in, if it is short."""
    low, high = max(0, a - RUN), min(len(text), b + RUN)
    start, end = a, b
    while start > low and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while end < high and text[end - 1].isalnum() and text[end].isalnum():
        end += 1
    inside = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    outside = end < len(text) and text[end - 1].isalnum() and text[end].isalnum()
    return (a if inside else start), (b if outside else end)


def _made_whole(text: str, spans: list[tuple]) -> list[tuple]:
    """(start, end, kind, sure), trimmed and completed; of two in one run the surer stays."""
    out: list[tuple] = []
    for kind, a, b, sure in spans:
        a, b = _trimmed(text, a, b)
        if a >= b:
            continue
        span = (*_whole(text, a, b), kind, sure)
        if out and span[0] < out[-1][1]:
            if sure <= out[-1][3]:
                continue
            out.pop()
        out.append(span)
    return out


def find_spans(texts: list[str], tagger: Tagger | None) -> list[list[dict]]:
    """Spans of each text, by start, then kind as listed."""
    base = [base_spans(x) for x in texts]
    more: list[list[tuple]] = [[] for _ in texts]
    if tagger:
        placed = [(i, at) for i, x in enumerate(texts) for at in windows(x)]
        for k in range(0, len(placed), 512):  # bounds the arrays
            own = placed[k : k + 512]
            ids = np.stack([_padded(char_ids(texts[i][at : at + WINDOW])) for i, at in own])
            tags, sure = tagger.decode(ids.T)
            for (i, at), t, s in zip(own, tags.T, sure.T, strict=True):
                more[i].append((at, t, s))
    out = []
    for text, own, tagged in zip(texts, base, more, strict=True):
        spans = [(kind, a, b, True, 1.0) for kind, a, b in own]
        if tagged:
            found = _made_whole(text, reconcile(len(text), *zip(*tagged, strict=True)))
            for a, b, kind, sure in apart(found, [(x, y) for _, x, y in own]):
                if sure >= SURE and _shaped(kind, text[a:b]):
                    spans.append((kind, a, b, False, min(1.0, sure)))
        out.append(
            [
                {"start": a, "rank": KINDS.index(k) + 1, "kind": k, "end": b, "base": own, "sure": s}
                for k, a, b, own, s in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
            ]
        )
    return out


_SPAN_TYPE = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64()),
         ("base", pa.bool_()), ("sure", pa.float64())]
    )
)


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id and its spans: array of (start, rank, kind, end, base, sure)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        for batch in batches:
            found = find_spans([x or "" for x in batch.column("text").to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, _SPAN_TYPE)], ["doc_id", "spans"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def redacted(text: str, spans: list[dict]) -> str:
    """Each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with personal data replaced in the text and n_chars counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = find_spans([x or "" for x in texts], shared.value)
            new = [None if x is None else redacted(x, s) for x, s in zip(texts, found, strict=True)]
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "text", pa.array(new, pa.string()))

    out = docs.mapInArrow(run, StructType(list(docs.schema.fields)))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
