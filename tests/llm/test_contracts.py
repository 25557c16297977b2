"""Every registered query over the smallest given tables against brute force."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from broadsheet.llm.queries import ORACLE, REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows_of(spark, sf_dir):
    """Result rows of a query as dicts; each query runs once."""
    kept = {}

    def run(prefix):
        if prefix not in kept:
            name = next(k for k in REGISTRY if k.startswith(f"{prefix}_"))
            kept[prefix] = [r.asDict() for r in REGISTRY[name](spark, sf_dir).collect()]
        return kept[prefix]

    return run


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def held(doc_id, divisor, rest):
    return zlib.crc32(str(doc_id).encode()) % divisor == rest


def digest(spans, kinds):
    text = ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], kinds.index(s[1]))))
    return text, hashlib.sha256(text.encode()).hexdigest()


def test_lm_scores(rows_of, given):
    counts = Counter()
    tokens = {d: [*words(t), None] for d, (t, *_) in given.items()}
    for d, own in tokens.items():
        if not held(d, 7, 2):
            counts.update(own)
    total, kinds = sum(counts.values()), len(counts)
    sums = [0.0, 0.0]
    rows = rows_of("op1")
    assert {r["doc_id"] for r in rows} == set(given)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert r["held_out"] == held(r["doc_id"], 7, 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), total)
        assert r["n_known"] == sum(x in counts for x in own)
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        if r["held_out"]:
            sums[0] += r["base_score"]
            sums[1] += r["score"]
    assert sums[1] > sums[0]  # better than the base on texts not learnt from


def test_decontamination_finds_whole_items(spark, rows_of, given, sf_dir):
    plain = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    texts = {d: plain(t) for d, (t, *_) in given.items()}
    expected = {(d, i["item_id"]) for i in items for d, t in texts.items() if plain(i["text"]) in t}
    assert expected
    assert {(r["doc_id"], r["item_id"]) for r in rows_of("op2")} == expected


def test_secret_base_spans(rows_of, given):
    names = "password|passwd|secret|token|api_?key"
    names = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", names)
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    kinds = ["assign", "access", "hex", "pem", "jwt", "url", "mixed"]
    for r in rows_of("op3"):
        text = given[r["doc_id"]][0]
        spans = [(m.start(), "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        base, sha = digest(spans, kinds)
        assert r["base_sha256"] == sha
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        for kind in kinds[:3]:
            assert r[f"n_{kind}"] == sum(k == kind for _, k, _ in spans)


def test_quality_base(rows_of, given):
    kept = 0
    for r in rows_of("op4"):
        text = given[r["doc_id"]][0]
        own = WORD.findall(text)
        grams = list(zip(own, own[1:], own[2:], strict=False))
        counts = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
        )
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
        kept += r["kept"]
    assert kept > 100


def test_packing_is_whole(rows_of, given):
    from broadsheet.llm.pieces import tokenizer

    encoder = tokenizer("byte_bpe_50k.json")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows_of("op5"):
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(given)
    for d, (text, *_) in given.items():
        ids = [*encoder.encode(text, add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *ids[r["start"] : at]))
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # nothing to pad


def test_personal_data_base_spans(rows_of, given):
    from broadsheet.llm.pii import luhn

    digits = lambda x: re.sub("[^0-9]", "", x)
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: max(map(int, x.split("."))) <= 255),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 14 <= len(digits(x)) <= 19 and luhn(digits(x))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 10 <= len(digits(x)) <= 15),
    }
    for r in rows_of("op6"):
        text = given[r["doc_id"]][0]
        spans = [
            (m.start(), kind, m.end())
            for kind, (pattern, good) in tests.items()
            for m in re.finditer(pattern, text)
            if good(m[0])
        ]
        base, sha = digest(spans, list(tests))
        assert r["base_sha256"] == sha
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        for kind in tests:
            assert r[f"n_{kind}"] == sum(k == kind for _, k, _ in spans)


def brute_components(sets):
    """doc -> smallest doc reachable over links, all pairs compared."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    docs = sorted(d for d, s in sets.items() if s)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= 75 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    lower, upper = sorted((find(a), find(b)))
                    parent[upper] = lower
    return {d: find(d) for d in sets}


def shingle_set(text):
    own = words(text)
    if len(own) < 5:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(zip(*(own[k:] for k in range(5)), strict=False))


def test_near_duplicates(rows_of, given):
    sets = {d: shingle_set(t) for d, (t, *_) in given.items()}
    expected = brute_components(sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows_of("op7")}
    assert got == {d: (len(s), expected[d], expected[d] == d) for d, s in sets.items()}


def test_near_duplicates_in_sql(rows_of, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    twin = con.sql(ORACLE["op7_near_dedup"])
    names = ["doc_id", "n_shingles", "component_id", "kept"]
    assert list(twin.columns) == names
    assert sorted(tuple(r[n] for n in names) for r in rows_of("op7")) == sorted(twin.fetchall())


def test_token_counts(rows_of, given):
    from broadsheet.llm.pieces import tokenizer

    encoder = tokenizer("word_bpe_49k.json")
    for r in rows_of("op8"):
        text = given[r["doc_id"]][0]
        n = len(encoder.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)


def test_languages(rows_of, given):
    rows = rows_of("op9")
    tested = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == given[r["doc_id"]][1] for r in tested)
    assert right >= 0.97 * len(tested) > 0
    for r in rows:
        assert r["held_out"] == held(r["doc_id"], 5, 0)
        assert 0 <= r["score"] <= 1


def test_shards(rows_of, given):
    slots = defaultdict(list)
    for r in rows_of("op10"):
        data = given[r["doc_id"]][0].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert len({r["doc_id"] for r in rows_of("op10")}) == len(given)
