"""Secret scans judged by corpus-wide ownership.

Candidates are found in each text. Their hashes are aggregated over the whole
corpus: in how many repositories (documents) and with how many owners
(sources) a value occurs. Copies of one text are one piece of evidence, however
many and wherever they are: a text counts once, as a repository of the least of
its owners. A value that more than ``OWNERS`` owners or ``REPOSITORIES``
repositories have by this count is a copied example, and so is one that more
than ``OWNERS`` owners have in several repositories each, which a text handed on
once doesn't explain; else it looks live. The
base kinds are reported either way and carry the verdict; the further kinds
(private key blocks, signed web tokens, credentials in addresses, long mixed
tokens) are looser, so they are reported only where they look live.

Texts are scanned once and written without the text; counting is by (hash,
owner, repository), then (hash, owner), then hash, each combined before its
shuffle, so a value that a third of all rows share costs one row per task.

Defined cases: a NULL text is empty; a NULL source or doc_id counts as one
owner or repository of its own; repeated rows count once as a repository; an
empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import UID, with_uid, written
from broadsheet.llm.spans import apart

# The base patterns of the contract, with their least lengths.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 16 and more are the runs of the contract that are long enough.
HEX = re.compile(r"[0-9a-f]{16,}")

# Further kinds of this method.
MORE = {
    "pem": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    # Begins where its run does and gives nothing back: linear.
    "jwt": re.compile(
        r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"
    ),
    "url": re.compile(r"[a-z][a-z0-9+.-]{1,30}://[^\s:/@]{1,100}:[^\s:/@]{6,200}@"),
    "mixed": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}(?![A-Za-z0-9+/_=-])"),
}
KINDS = ["assign", "access", "hex", *MORE]
BASE = KINDS[:3]
MIXED_BITS = 3.5
#: With more owners or repositories than this, each text counted once, a value
#: is a copied example.
OWNERS = 1
REPOSITORIES = 20

_CANDIDATE = "struct<kind: string, start: bigint, end: bigint, base: boolean, hash: string>"
_SCANNED = f"{UID} bigint, doc_id bigint, source string, tkey string, found array<{_CANDIDATE}>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, as the contract has them."""
    spans = [
        ("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12
    ]
    spans += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return spans + [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _is_mixed(value: str) -> bool:
    """Digits, upper and lower case, and little repetition."""
    return (
        any(c.isdigit() for c in value)
        and any(c.isupper() for c in value)
        and any(c.islower() for c in value)
        and _entropy(value) >= MIXED_BITS
    )


def more_spans(text: str, taken: list[tuple]) -> list[tuple[str, int, int, str]]:
    """Spans of the further kinds that touch no base span."""
    busy = [(a, b) for _, a, b, _ in taken]
    spans = []
    for kind, pattern in MORE.items():
        found = [(*m.span(), m[0]) for m in pattern.finditer(text)]
        if kind == "mixed":
            found = [x for x in found if _is_mixed(x[2])]
        own = apart(found, busy)
        spans += [(kind, a, b, value) for a, b, value in own]
        busy += [(a, b) for a, b, _ in own]
    return spans


def _scan(batches):
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            rest = more_spans(text or "", base)
            found.append(
                [
                    {
                        "kind": k, "start": a, "end": b, "base": own,
                        "hash": hashlib.sha256(v.encode()).hexdigest(),
                    }
                    for own, spans in ((True, base), (False, rest))
                    for k, a, b, v in spans
                ]
            )
        kind = pa.struct(
            [
                ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                ("base", pa.bool_()), ("hash", pa.string()),
            ]
        )
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (UID, "doc_id", "source", "tkey")), pa.array(found, pa.list_(kind))],
            [UID, "doc_id", "source", "tkey", "found"],
        )


def ownership(candidates: DataFrame) -> DataFrame:
    """n_repositories and n_owners of each hash in (hash, owner, repository) rows."""
    placed = candidates.groupBy("hash", "owner", "repository").count()
    owned = placed.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("count").alias("uses")
    )
    return owned.groupBy("hash").agg(
        F.sum("repositories").alias("n_repositories"),
        F.count(F.lit(1)).alias("n_owners"),
        F.sum("uses").alias("n_uses"),
        F.count_if(F.col("repositories") > 1).alias("n_repeating"),
    )


def evidence(candidates: DataFrame) -> DataFrame:
    """Distinct texts of each hash in (hash, owner, tkey) rows, and their owners."""
    texts = candidates.groupBy("hash", "tkey").agg(
        F.min(F.struct(F.col("owner").isNull().alias("none"), "owner")).alias("owner")
    )
    owned = texts.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("texts"))
    return owned.groupBy("hash").agg(
        F.sum("texts").alias("n_texts"), F.count(F.lit(1)).alias("n_text_owners")
    )


def scan(docs: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """doc_id and its spans: array of (kind, start, end, base, hash, n_repositories,
    n_owners, live), by start, then kind as listed."""
    rows = with_uid(
        docs.select(
            F.col("doc_id").cast("bigint"), "text", F.col("source").cast("string")
        )
    ).select(UID, "doc_id", "source", F.md5("text").alias("tkey"), "text")
    scanned = written(rows.mapInArrow(_scan, _SCANNED), "secrets-scan")
    each = scanned.where(F.size("found") > 0).select(
        UID, "doc_id", F.col("source").alias("owner"), "tkey", F.explode("found").alias("c")
    )
    each = each.select(UID, "owner", F.col("doc_id").alias("repository"), "tkey", "c.*")
    known = ownership(each.select("hash", "owner", "repository"))
    known = known.join(evidence(each.select("hash", "owner", "tkey")), "hash")
    # Nothing but the verdict crosses this join; Spark splits a hot hash.
    judged = each.select(UID, "kind", "start", "end", "base", "hash").join(known, "hash")
    few = (F.col("n_text_owners") <= owners) & (F.col("n_texts") <= repositories)
    judged = judged.withColumn("live", few & (F.col("n_repeating") <= owners))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(
        "start", rank.alias("rank"), "kind", "end", "base", "hash", "n_repositories",
        "n_owners", "live",
    )
    per_row = (
        judged.where("base or live")
        .groupBy(UID)
        .agg(F.sort_array(F.collect_list(span)).alias("spans"))  # spans of one text
    )
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return (
        scanned.select(UID, "doc_id")
        .join(per_row, UID, "left")
        .select("doc_id", F.coalesce("spans", empty).alias("spans"))
    )
