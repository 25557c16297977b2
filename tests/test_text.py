import hashlib
import random
import re

from pyspark.sql import functions as F

from broadsheet.functions import text

ALPHABET = "aB9|[]Signup -_\n\r\t\x0b\x1c\x85\xa0  　éÉ%"


def random_texts(n, seed, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(n)]


def expected_slug(value):
    words = [w for w in re.split("[^a-z0-9]+", value.lower()) if w]
    return "-".join(words)[:80].rstrip("-") or "item"


def expected_placeholder(body, chars=None):
    head = body[:chars]
    lone = any(line.strip() == "|" for line in head.splitlines())
    return "|  |" in head or head.lstrip()[:8] == "[Signup]" or lone


def test_whitespace_is_what_python_strips():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x3100) if chr(i).isspace()}


def test_strip_and_collapse(values):
    texts = random_texts(400, 1)
    assert values(text.strip, texts) == [t.strip() for t in texts]
    assert values(text.rstrip, texts) == [t.rstrip() for t in texts]
    assert values(text.collapse_whitespace, texts) == [" ".join(t.split()) for t in texts]


def test_slug(values):
    texts = random_texts(300, 2, 150) + ["", "---", "a" * 79 + " b", "x" * 90]
    assert values(text.slugify, texts) == [expected_slug(t) for t in texts]


def test_placeholder(values):
    texts = random_texts(1500, 3, 25)
    texts += ["a\n | \nb", "|", "x|", " \n[Signup] now", "a" * 798 + "\n|", "a" * 800 + "\n|\n"]
    texts += ["a" * 797 + "|  |", "a" * 796 + "|  |", "a" * 799 + "|  |"]
    texts += ["a" * 5000 + "\n|\n"]
    assert values(text.looks_like_placeholder, texts) == [expected_placeholder(t) for t in texts]
    first = values(lambda c: text.looks_like_placeholder(c, preview_chars=800), texts)
    assert first == [expected_placeholder(t, 800) for t in texts]


def test_lines_split_like_python(values):
    texts = random_texts(300, 4)
    got = values(text.split_lines, texts)
    for lines, t in zip(got, texts, strict=True):
        # A final line end adds an empty piece that Python leaves out.
        expected = t.splitlines()
        assert lines == expected or lines == expected + [""]


def test_snippet(values):
    assert values(text.snippet, ["a\nb", "x" * 201]) == ["a b", "x" * 200 + "…"]


def test_ids(spark):
    df = spark.createDataFrame([("Hello, World", "https://e/1"), ("", "https://e/2")], "t string, u string")
    got = [r[0] for r in df.select(text.item_id(F.col("t"), F.col("u"))).collect()]
    digest = [hashlib.sha1(u.encode()).hexdigest()[:8] for u in ("https://e/1", "https://e/2")]
    assert got == [f"hello-world-{digest[0]}", f"https-e-2-{digest[1]}"]
    row = df.select(text.record_id(F.lit("s"), F.lit("2026-01-01"), F.col("u"))).first()
    assert row[0] == hashlib.sha1(b"s|2026-01-01|https://e/1").hexdigest()


def test_first_filled_skips_empty_strings(spark):
    df = spark.createDataFrame([("", "b"), (None, None), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(text.body_of(F.col("x"), F.col("y"))).collect()]
    assert got == ["b", "", "a"]


def test_term_is_literal(spark):
    df = spark.createDataFrame([("100% Éclair_x",), ("1000 eclair",)], "t string")
    for term, hits in [("0%", 1), ("_", 1), ("éclair", 1), ("CLAIR", 2), ("", 2)]:
        assert df.where(text.contains_term(F.col("t"), term)).count() == hits
