"""Nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import (
    decontamination,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    pii,
    quality,
    secrets,
    sharding,
    stages,
    token_counts,
)
from broadsheet.llm.common import remainder


def identify(docs):
    return language_id.predict(docs, language_id.train(docs))


def tag(docs):
    return pii.find(docs, pii.train(docs, limit=8, passes=1))


def score(docs):
    return lm_scoring.score(docs, remainder(F.col("doc_id"), 7) == 2, passes=1)


PER_ROW = {
    "score": score,
    "secrets": secrets.scan,
    "quality": quality.judge,
    "personal": tag,
    "near": near_dedup.near_duplicates,
    "tokens": token_counts.token_counts,
    "language": identify,
    "shard": sharding.shard,
}


@pytest.fixture(scope="module")
def items(spark):
    text = "Which of the rivers of the north runs dry in summer? The small one by the old stone mill."
    return spark.createDataFrame([(7, text), (8, None), (9, ""), (None, "one")], "item_id bigint, text string")


def clashing(docs):
    """Columns named like those that the operators make on their way."""
    for name in ("score", "spans", "size", "part", "root", "node", "n", "lang_pred", "bucket", "word"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(odd, name):
    rows = PER_ROW[name](clashing(odd)).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    assert ids == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in odd.select("doc_id").collect())
    assert [PER_ROW[name](odd.limit(0)).count()] == [0]


def test_odd_packing(odd):
    rows = packing.pack(clashing(odd)).collect()
    # Every row has its end id once; an empty text has nothing else.
    assert sum(r["start"] + r["length"] == r["doc_tokens"] for r in rows) == odd.count()
    assert sum(r["doc_tokens"] == 1 for r in rows) == 5
    assert packing.pack(odd.limit(0)).count() == 0


def test_odd_values(odd, make):
    near = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(odd).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (6, 1, 6), (None, 0, None)} <= near
    chosen = near_dedup.near_duplicates(odd).where("chosen").collect()
    assert len(chosen) == 4 + 2 * 3 + 1 + 1 + 1  # equal rows once, rows without words each
    tokens = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(odd).collect()}
    assert tokens[0] == tokens[1] == (0, 0)
    languages = {r["doc_id"]: r["lang_pred"] for r in identify(odd).select("doc_id", "lang_pred").collect()}
    assert [languages[k] for k in (0, 1, 2, 4)] == ["und"] * 4
    shards = sharding.shard(odd).where("text_crc32 = 0").select("size").distinct().collect()
    assert [r["size"] for r in shards] == [1]


def test_odd_decontamination(odd, items, make, spark):
    leak = "Here it says: which of the RIVERS of the north runs dry in summer? The small one by the old stone mill."
    long = " ".join(f"w{k}" for k in range(900))
    docs = make(leak, f"{long} {leak} {long}", "The small one by the old stone mill.", long)
    hits = decontamination.contaminated(docs, items).select("doc_id", "item_id").collect()
    assert sorted(tuple(r) for r in hits) == [(0, 7), (1, 7)]
    assert [r["doc_id"] for r in decontamination.clean(clashing(docs), items).orderBy("doc_id").collect()] == [2, 3]
    assert decontamination.contaminated(odd, items).count() == 0
    assert decontamination.clean(odd, items.limit(0)).count() == odd.count()
    assert decontamination.contaminated(docs.limit(0), items).count() == 0


def test_index_parts_give_the_same(make, spark):
    texts = [f"item {k} asks a{k} b{k} c{k} d{k} of the e{k}? The answer is f{k} g{k}." for k in range(60)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = make(*[f"some words before {t} and after" for t in texts[::7]], "nothing of the kind here")
    whole = list(decontamination.index_parts(items))
    parts = list(decontamination.index_parts(items, part_words=200))
    assert len(whole) == 1 and len(parts) > 2

    def found(indexes, text):
        return {i.items[k][0] for i in indexes for k in i.verified(text, 0.6, 0.6)}

    for r in docs.collect():
        assert found(whole, r["text"]) == found(parts, r["text"])
    assert found(whole, docs.first()["text"]) == {0}


@pytest.mark.parametrize("name", ["language", "near_dedup", "decontaminate", "redact", "pack"])
def test_stages_meet_odd_rows(spark, odd, sf_dir, name):
    stage = getattr(stages, name)
    mine = ["lang_pred", "score", "chosen", "bits", "language", "foreign", "__uid", "__bits", "__part", "likely"]
    docs = odd
    for k, column in enumerate(mine):
        docs = docs.withColumn(column, F.lit(7.5 + k))
    out = stage(spark, docs, sf_dir)
    rows = out.collect()
    if name != "pack":
        assert out.columns == docs.columns
        assert all(r[column] == 7.5 + k for r in rows for k, column in enumerate(mine)) and rows
    if name == "language":
        assert {r["doc_id"] for r in rows} == {3, 5, 6, 7, None}
    if name == "redact":
        assert len(rows) == odd.count()
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_redaction():
    text = "mail a.b@mail.example.com or +1 (487) 555-7209, host 10.0.0.1, card 4111 1111 1111 1111."
    spans = pii.find_spans([text], None)[0]
    assert pii.redacted(text, spans) == "mail [EMAIL] or [PHONE], host [IP], card [CARD]."


def test_secret_ownership(make):
    key = "AKIA" + "B2C4D6E8F0G1H3J5"
    pem = "-----BEGIN PRIVATE KEY-----\nMIIB\n-----END PRIVATE KEY-----"
    shared = "url https://user:hunter22@host/x"
    rows = [(k, f"word {key} {shared}", "en", f"src{k % 3}") for k in range(6)]
    rows += [(6, f"one {pem}", "en", "src0"), (7, f"one {pem}", "en", "src0")]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(make(*rows)).collect()}
    # A copied value keeps its base span, without being live; a loose kind is dropped.
    assert [(s["kind"], s["live"], s["n_owners"], s["n_repositories"]) for s in found[0]] == [
        ("access", False, 3, 6)
    ]
    assert [(s["kind"], s["live"], s["n_owners"], s["n_repositories"]) for s in found[6]] == [
        ("pem", True, 1, 2)
    ]


def test_secrets_by_repositories_and_copies(make):
    sample, own = "AKIA" + "B2C4D6E8F0G1H3J5", "AKIA" + "Z9Y8X7W6V5U4T3S2"
    pem = "-----BEGIN PRIVATE KEY-----\nMIIB\n-----END PRIVATE KEY-----"
    # A sample in many texts of one hot source; a credential in a text copied to another source.
    rows = [(k, f"text {k} has {sample}", "en", "hot") for k in range(60)]
    rows += [(100 + k, f"one {own} {pem}", "en", f"src{k}") for k in range(3)]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(make(*rows)).collect()}
    assert [(s["live"], s["n_owners"], s["n_repositories"]) for s in found[0]] == [(False, 1, 60)]
    assert [(s["kind"], s["live"]) for s in found[100]] == [("access", True), ("pem", True)]


def test_language_stage_without_labels(spark, make, sf_dir):
    docs = make((1, "clean prose", None, "src0"), (2, "123 ...", None, "src0"), (None, "word", None, None))
    assert {r["doc_id"] for r in stages.language(spark, docs, sf_dir).collect()} == {1, None}


def test_language_stage_rejects_by_the_kernels(spark, sf_dir):
    """Long texts of nothing that was learnt go; a mix of languages, short texts and all clean ones stay."""
    import random

    rng = random.Random(5)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    by_lang = {r["lang"]: r["text"] for r in docs.where("n_chars between 2000 and 9000").collect()}
    noise = ["".join(rng.choices(letters, k=4_000)) for letters in ("abcdefghijklmnopqrstuvwxyz ", "0123456789abcdef", "абвгдежзикл ")]
    two = " ".join(by_lang[k] for k in sorted(by_lang)[:2])
    rows = [(900_000 + k, x, None, "s", len(x)) for k, x in enumerate([*noise, two, noise[2][:40], "ok"])]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in stages.language(spark, both, sf_dir).select("doc_id").collect()}
    assert {r["doc_id"] for r in docs.collect()} <= kept
    assert {x for x in kept if x >= 900_000} == {900_003, 900_004, 900_005}


def test_many_languages(make):
    """Every labelled language is learnt, however many there are."""
    texts = {f"l{k:03}": f"{'abcdefghijklmnopqrst'[k % 20]}{'uvwxyzabcd'[k // 20 % 10]}{k} " for k in range(230)}
    rows = [(k * 10 + i, t * 40, lang, "s") for k, (lang, t) in enumerate(texts.items()) for i in range(3)]
    model = language_id.train(make(*rows), landmarks=2)
    assert model.languages == sorted(texts)


def test_short_items_are_found_as_a_run(make, spark):
    rows = [(1, "Capital of France? Paris."), (2, "two words"), (3, "one"), (4, "Wer, wie, was?"), (5, "")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    docs = make("It asked: capital of france -- PARIS, they said.", "Paris, the capital of France", "two  WORDS two words",
                "words two", "one", "wer wie was", "", None)
    hits = sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect())
    assert hits == [(0, 1), (2, 2), (5, 4)]
    assert sorted(r["doc_id"] for r in decontamination.clean(docs, items).collect()) == [1, 3, 4, 6, 7]


def test_a_long_item_does_not_loosen_short_ones(make, spark):
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    short, long = [word() for _ in range(20)], [word() for _ in range(700)]
    items = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(long))], "item_id bigint, text string")
    # The short item's triples strewn over 600 words are no leak of it.
    strewn = [x for k in range(0, 18, 3) for x in [*short[k : k + 3], *[word() for _ in range(97)]]]
    docs = make(" ".join(strewn), " ".join([word() for _ in range(300)] + long), " ".join([word() for _ in range(99)] + short))
    hits = sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items).collect())
    assert hits == [(1, 2), (2, 1)]
    parts = list(decontamination.index_parts(items))
    assert [p.passage for p in parts] == [128, 2048]


def test_retrieval_against_plain_bm25(make, spark, sf_dir):
    """The query's rows against BM25 of every passage and item, summed plainly."""
    import math
    from collections import Counter

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()][:40]
    parts = {i: decontamination.question_and_answer(x) for i, x in items}
    words = {i: q + a for i, (q, a) in parts.items()}
    df = Counter(w for own in words.values() for w in set(own))
    mean = sum(map(len, words.values())) / len(words)
    k1, b = decontamination.K1, decontamination.B

    def weights(own):
        tf = Counter(own)
        idf = {w: math.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) for w in tf}
        return {w: idf[w] * n * (k1 + 1) / (n + k1 * (1 - b + b * len(own) / mean)) for w, n in tf.items()}

    index = {i: weights(own) for i, own in words.items()}
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()
    cut = [" ".join(own[: len(own) * k // 5]) for k, own in enumerate(list(words.values())[:6])]
    texts = {r["doc_id"]: r["text"] for r in some} | {90_000 + k: x for k, x in enumerate(cut)}
    expected = set()
    for d, text in texts.items():
        own = decontamination.text_words(text)
        last = max(0, -(-(len(own) - 128) // 64))
        for at in range(0, 64 * last + 1, 64):
            held = own[at : at + 128]
            kept = set(held)
            for i, w in index.items():
                if sum(x for k, x in w.items() if k in kept) >= 0.6 * sum(w.values()):
                    if min(decontamination.overlap(p, held) for p in parts[i]) >= 0.6:
                        expected.add((d, i))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = make(*[(d, x, "en", "s") for d, x in texts.items()])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, table).collect()} == expected
    assert expected
