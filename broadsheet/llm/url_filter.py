"""URL filter: rules first, then a ratio of character language models.

A rule names a host and the start of a path; it fits that host and its
subdomains, and the longest fitting rule decides. Urls that a rule decides are
the examples: allowed ones for a model of accepted urls, blocked ones for one
of rejected urls. Both are variable-order Markov models over the bytes of whole
urls with an end: a byte is predicted from the longest context of up to
``ORDER`` bytes that the model kept, by Witten-Bell smoothing: each context
gives its next shorter one the share T / (N + T) of N occurrences with T
different next bytes, down to a uniform choice. Probabilities of a context sum
to one.

n-grams are counted over all examples outside the calibration fold (a hash of
the url, so copies of a url fall on one side), and all of them count. Models of
at most ``most`` n-grams each are held by the tasks (``Markov``). Larger ones stay
tables (``Wide``): the places of urls are joined to the counts of their n-grams
and contexts, the same probabilities come from these, and the tasks hold the
gaps of the ``most`` most frequent places only, which spreads frequent keys; all
other places are joined. A url's ratio is the difference of its two
log-likelihoods over its length. The threshold is the one that parts accepted
and rejected urls of the calibration fold with the least mean error rate, read
from histograms of the ratio.

Defined cases: a NULL url has no host, no path, fits no rule and has ratio 0;
so has an empty one. Without ``://`` host and path are empty, the url is judged
as a text. Ties of the ratio with the threshold are allowed. Without an example
of either kind there is no model, the ratio is 0 and what no rule fits is
allowed. Repeated rows count each; an empty table gives no row.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from broadsheet.llm.common import UID, with_uid, written

ORDER = 5
MOST = 200_000  # n-grams that tasks hold: 16 bytes each, and as many contexts at most
FOLDS = 5  # one of them calibrates
STEP = 0.01  # width of a bin of ratios
BINS = 2_000  # to either side of zero
#: Bytes looked at together; bounds the scratch memory of long urls.
BLOCK = 1 << 20

ALLOW, BLOCKED = "allow", "block"
START, END = 255, 254  # bytes that UTF-8 never has
CHOICES = 255  # all bytes but the start


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Host, path, verdict.
RULES = (
    Rule("net", "/", BLOCKED),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCKED),
    Rule("org", "/fr/", ALLOW),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = url.substr(F.length(rest) + 4, F.lit(2**31 - 1))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = url.substr(F.length(rest) + 4, F.lit(2**31 - 1))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, rule_verdict (both NULL where none fits)."""
    host, path = F.col("host"), F.col("path")
    name = verdict = F.lit(None).cast("string")
    # The longest is asked first; of equal ones the last by name.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    known = pages.select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    return known.select("*", name.alias("rule"), verdict.alias("rule_verdict"))


def url_bytes(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All urls one after the other, each between START and END, and their first places."""
    parts = [b"\xff" + (u or "").encode("utf-8", "surrogatepass") + b"\xfe" for u in urls]
    first = np.cumsum([0, *map(len, parts)])[:-1]
    return np.frombuffer(b"".join(parts), np.uint8), first


def gram_keys(data: np.ndarray, since: np.ndarray, low: int, high: int, n: int):
    """(places, keys) of the n-grams that end at places from low to high.

    ``since`` is how far each place is from its url's START. A key is the length
    above six bytes of text. START is context only, never predicted.
    """
    at = low + np.flatnonzero(since[low:high] >= max(1, n - 1))
    keys = np.full(len(at), n << 48, np.int64)
    for k in range(n):
        keys |= data[at - k].astype(np.int64) << (8 * k)
    return at, keys


def context_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The n-gram without its last byte."""
    return ((keys & ((1 << 48) - 1)) >> 8) | ((n - 1) << 48)


def ending_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The n-gram without its first byte."""
    return (keys & ((1 << 8 * (n - 1)) - 1)) | ((n - 1) << 48)


def _since(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    sizes = np.diff(np.append(first, len(data)))
    return np.arange(len(data)) - np.repeat(first, sizes)


def _counted(batches):
    for batch in batches:
        accepted = np.array(batch.column("accepted").to_pylist(), bool)
        urls = batch.column("url").to_pylist()
        for kind in (False, True):
            data, first = url_bytes([u for u, a in zip(urls, accepted, strict=True) if a == kind])
            since = _since(data, first)
            for n in range(1, ORDER + 2):
                for low in range(0, len(data), BLOCK):
                    _, keys = gram_keys(data, since, low, min(low + BLOCK, len(data)), n)
                    own, c = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), kind)), pa.array(own), pa.array(c.astype(np.int64))],
                        ["accepted", "gram", "c"],
                    )


def _place(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked key in the sorted ``keys``, -1 if it isn't there."""
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


class Markov:
    """Log-probabilities of kept n-grams and log-shares that contexts pass on."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, counts = grams[order], counts[order].astype(np.float64)
        lengths = self.grams >> 48
        p = np.zeros(len(self.grams))
        contexts, passed = [], []
        for n in range(1, ORDER + 2):
            own = np.flatnonzero(lengths == n)
            if not len(own):
                break
            above, group = np.unique(context_of(self.grams[own], n), return_inverse=True)
            total = np.bincount(group, weights=counts[own])
            kinds = np.bincount(group)
            shorter = 1 / CHOICES
            if n > 1:
                shorter = p[_place(self.grams, ending_of(self.grams[own], n))]
            p[own] = (counts[own] + kinds[group] * shorter) / (total + kinds)[group]
            contexts.append(above)
            passed.append(kinds / (total + kinds))
        self.log_p = np.log(p)
        self.contexts = np.concatenate(contexts)
        rank = np.argsort(self.contexts)
        self.contexts = self.contexts[rank]
        self.log_passed = np.log(np.concatenate(passed)[rank])

    def log_likely(self, data: np.ndarray, since: np.ndarray, low: int, high: int) -> np.ndarray:
        """Log-probability of each byte from low to high; 0 for a START."""
        out = np.zeros(high - low)
        todo = since[low:high] >= 1
        for n in range(ORDER + 1, 0, -1):
            at, keys = gram_keys(data, since, low, high, n)
            left = todo[at - low]
            at, keys = at[left] - low, keys[left]
            place = _place(self.grams, keys)
            known = place >= 0
            out[at[known]] += self.log_p[place[known]]
            todo[at[known]] = False
            at, above = at[~known], context_of(keys[~known], n)
            place = _place(self.contexts, above)
            out[at] += np.where(place >= 0, self.log_passed[place], 0.0)
        out[todo] -= np.log(CHOICES)
        return out


class Filter(NamedTuple):
    accepted: Markov
    rejected: Markov
    threshold: float

    def ratios(self, urls: list[str | None]) -> np.ndarray:
        """Difference of the log-likelihoods over the length with the end."""
        data, first = url_bytes(urls)
        since = _since(data, first)
        sums = np.zeros(len(urls))
        row = np.repeat(np.arange(len(urls)), np.diff(np.append(first, len(data))))
        for low in range(0, len(data), BLOCK):
            high = min(low + BLOCK, len(data))
            gap = self.accepted.log_likely(data, since, low, high)
            gap -= self.rejected.log_likely(data, since, low, high)
            sums += np.bincount(row[low:high], weights=gap, minlength=len(urls))
        sizes = np.diff(np.append(first, len(data))) - 1
        return np.where(sizes > 1, sums / sizes, 0.0)


def in_memory(counts: DataFrame, accepted: bool) -> Markov:
    """A model of all n-grams of one kind."""
    found = counts.where(F.col("accepted") == accepted).select("gram", "c").toArrow()
    return Markov(found.column("gram").to_numpy(), found.column("c").to_numpy())


_TEXT = (1 << 48) - 1  # the bytes of a key, without its length


def _places(pages: DataFrame) -> DataFrame:
    """(key, n): the longest n-grams that end at the places of all urls, and how many there are."""

    def run(batches):
        for batch in batches:
            for _, keys in _longest(batch.column("url").to_pylist()):
                own, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n.astype(np.int64))], ["key", "n"])

    found = pages.select("url").mapInArrow(run, "key bigint, n bigint")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def _longest(urls: list[str | None]):
    """(urls' numbers, keys) of all places, in blocks."""
    data, first = url_bytes(urls)
    since = _since(data, first)
    row = np.repeat(np.arange(len(urls)), np.diff(np.append(first, len(data))))
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        for n in range(2, ORDER + 2):
            at, keys = gram_keys(data, since, low, high, n)
            if n <= ORDER:  # near the start only
                keys, at = keys[since[at] == n - 1], at[since[at] == n - 1]
            yield row[at], keys


class Wide(NamedTuple):
    """Both models as tables: counts of the n-grams, totals and kinds of their contexts."""

    grams: DataFrame
    contexts: DataFrame
    threshold: float
    most: int

    @classmethod
    def of(cls, counts: DataFrame, most: int) -> Wide:
        def own(accepted: bool) -> Column:
            return F.sum(F.when(F.col("accepted") == accepted, F.col("c")).otherwise(0))

        grams = counts.groupBy("gram").agg(own(True).alias("c_a"), own(False).alias("c_r"))
        text = F.shiftright(F.col("gram").bitwiseAND(F.lit(_TEXT)), 8)
        length = F.shiftleft(F.shiftright("gram", 48) - 1, 48)
        contexts = grams.groupBy(text.bitwiseOR(length).alias("context")).agg(
            *[F.sum(f"c_{k}").alias(f"total_{k}") for k in "ar"],
            *[F.count_if(F.col(f"c_{k}") > 0).alias(f"kinds_{k}") for k in "ar"],
        )
        return cls(written(grams, "url-grams"), written(contexts, "url-contexts"), 0.0, most)

    def gaps(self, places: DataFrame) -> DataFrame:
        """(key, n, gap): log-probability of a place in the accepted model less that in the other.

        Each length from 1 up mixes what the shorter one gives into its own
        counts; a context that a model does not know changes nothing.
        """
        n = F.col("length")
        gram = F.expr("(key & (shiftleft(1L, 8 * length) - 1L)) | shiftleft(cast(length as bigint), 48)")
        context = F.expr(
            "shiftright(key & (shiftleft(1L, 8 * length) - 1L), 8) | shiftleft(cast(length - 1 as bigint), 48)"
        )
        longest = F.shiftright("key", 48).cast("int")
        ends = places.select("key", F.explode(F.sequence(F.lit(1), longest)).alias("length"))
        facts = (
            ends.select("key", n, gram.alias("gram"), context.alias("context"))
            .join(self.grams, "gram", "left")
            .join(self.contexts, "context", "left")
        )
        names = [f"{what}_{k}" for k in "ar" for what in ("c", "total", "kinds")]
        fact = F.struct(n, *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in names])

        def mixed(k: str) -> Column:
            def step(p: Column, f: Column) -> Column:
                own = (f[f"c_{k}"] + f[f"kinds_{k}"] * p) / (f[f"total_{k}"] + f[f"kinds_{k}"])
                return F.when(f[f"total_{k}"] > 0, own).otherwise(p)

            return F.log(F.aggregate("facts", F.lit(1 / CHOICES), step))

        # Six facts a place at most.
        found = facts.groupBy("key").agg(F.array_sort(F.collect_list(fact)).alias("facts"))
        return found.select("key", (mixed("a") - mixed("r")).alias("gap")).join(places, "key")

    def with_ratio(self, pages: DataFrame) -> DataFrame:
        """``pages`` with the ratio of each url, worked out once for equal ones."""
        urls = written(with_uid(pages.select("url").where("url <> ''").distinct()), "urls")
        gaps = written(self.gaps(_places(urls)), "url-gaps")
        held = gaps.orderBy(F.desc("n"), "key").limit(self.most).orderBy("key").select("key", "gap").toArrow()
        shared = pages.sparkSession.sparkContext.broadcast(
            (held.column("key").to_numpy(), held.column("gap").to_numpy())
        )

        def run(batches):
            keys, known = shared.value
            for batch in batches:
                uids = batch.column(UID).to_numpy()
                sums = np.zeros(len(uids))
                for row, found in _longest(batch.column("url").to_pylist()):
                    place = _place(keys, found)
                    often = place >= 0
                    sums += np.bincount(row[often], weights=known[place[often]], minlength=len(uids))
                    yield _parts(uids[row[~often]], found[~often], np.zeros(int((~often).sum())))
                yield _parts(uids, np.full(len(uids), -1), sums)

        parts = urls.select(UID, "url").mapInArrow(run, f"{UID} bigint, key bigint, part double")
        rare = parts.where("key >= 0").join(gaps, "key").select(UID, F.col("gap").alias("part"))
        sums = parts.where("key < 0").select(UID, "part").unionByName(rare).groupBy(UID).agg(F.sum("part").alias("s"))
        # Sums of doubles depend on their order in the last places.
        ratio = F.round(F.col("s") / (F.octet_length("url") + 1), 12)
        known = urls.join(sums, UID).select("url", ratio.alias("ratio"))
        return pages.join(known, "url", "left").select(*pages.columns, F.coalesce("ratio", F.lit(0.0)).alias("ratio"))


def _parts(uids: np.ndarray, keys: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(uids), pa.array(keys), pa.array(parts)], [UID, "key", "part"])


def best_threshold(bins: list[tuple[bool, int, int]]) -> float:
    """Least mean error rate over (accepted, bin, rows); the middle of equal ones."""
    total = {kind: sum(n for a, _, n in bins if a == kind) for kind in (False, True)}
    if not all(total.values()):
        return 0.0
    steps = np.zeros(2 * BINS + 2)  # change of the error rate as the threshold passes a bin
    for accepted, k, n in bins:
        steps[k + BINS + 1] += n / total[accepted] * (1 if accepted else -1)
    errors = np.round(np.cumsum(steps), 12)  # beginning below all bins
    best = np.flatnonzero(errors == errors.min())
    # Equal thresholds lie side by side, or else the first run of them counts.
    run = best[: 1 + int(np.argmax(np.append(np.diff(best), 2) > 1))]
    return float((run[0] + run[-1]) / 2 - BINS) * STEP


def train(examples: DataFrame, most: int = MOST) -> Filter | Wide | None:
    """Fit on all rows of (url, accepted); None without both kinds of them."""
    rows = examples.where(F.col("url").isNotNull() & F.col("accepted").isNotNull())
    rows = rows.select("url", "accepted", (F.crc32(F.col("url").cast("binary")) % FOLDS).alias("fold"))
    counts = written(
        rows.where(F.col("fold") != 0)
        .select("accepted", "url")
        .mapInArrow(_counted, "accepted boolean, gram bigint, c bigint")
        .groupBy("accepted", "gram")
        .agg(F.sum("c").alias("c")),
        "url-counts",
    )
    sizes = [r["count"] for r in counts.groupBy("accepted").count().collect()]  # two rows
    if len(sizes) < 2:
        return None
    if max(sizes) <= most:
        plain = Filter(in_memory(counts, True), in_memory(counts, False), 0.0)
    else:
        plain = Wide.of(counts, most)
    kept = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("ratio") / STEP)))
    bins = (
        with_ratio(rows.where(F.col("fold") == 0).select("url", "accepted"), plain)
        .groupBy("accepted", kept.cast("int").alias("bin"))
        .count()
        .collect()  # two rows a bin at most
    )
    threshold = best_threshold([(r["accepted"], r["bin"], r["count"]) for r in bins])
    return plain._replace(threshold=threshold)


def with_ratio(pages: DataFrame, model: Filter | Wide | None) -> DataFrame:
    """``pages`` with the ratio of each url; any columns, no shuffle if tasks hold the models."""
    if isinstance(model, Wide):
        return model.with_ratio(pages.drop("ratio"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            urls = batch.column("url").to_pylist()
            found = known.ratios(urls) if known and urls else np.zeros(len(urls))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "ratio"]
            )

    pages = pages.drop("ratio")
    schema = StructType(list(pages.schema.fields)).add("ratio", "double")
    return pages.mapInArrow(run, schema)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = MOST) -> DataFrame:
    """page_id, url, host, path, rule, verdict, ratio, threshold of every page."""
    known = with_rules(pages, rules)
    examples = known.where(F.col("rule").isNotNull())
    model = train(examples.select("url", (F.col("rule_verdict") == ALLOW).alias("accepted")), most)
    threshold = model.threshold if model else 0.0
    likely = F.when(F.col("ratio") >= threshold, ALLOW).otherwise(BLOCKED)
    return with_ratio(known, model).select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", likely).alias("verdict"),
        "ratio",
        F.lit(threshold).alias("threshold"),
    )
