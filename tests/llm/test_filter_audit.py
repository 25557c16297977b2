"""The filter audit against walking every order over single documents."""

from fractions import Fraction
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import filter_audit
from broadsheet.llm.queries import ORACLE, REGISTRY

NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
         "good_lost", "toxic_lost", "shapley"]


def table(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def brute(rows, labels):
    """rows: (doc_id, text, lang); labels: doc_id -> (quality, toxic)."""
    parts = {}
    for d, text, lang in rows:
        text = text or ""
        own = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        same = [x for x, t, _ in rows if (t or "") == text and x is not None]
        fails = {
            "A": len(own) < 200,
            "B": 100 * len(set(own)) < 50 * len(own),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": d is not None and d > min(same),
        }
        failed = frozenset(k for k, v in fails.items() if v)
        quality, toxic = labels.get(d, (0, 0)) if d is not None else (0, 0)
        parts.setdefault(lang or "", []).append((failed, quality == 1, toxic == 1))
    out = []
    for part, docs in parts.items():
        walks, share = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in docs)
                only = sum(x[0] == {f} for x in docs)
                share[f] += len(gone)
                walks.append((part, "".join(order), step, len(left), len(gone), failing - len(gone),
                              only, sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out += [(*w[:-1], share[w[-1]]) for w in walks]
    return sorted(out)


def test_least_squares_give_shapley_values():
    removed = [0, 5, 3, 8, 2, 7, 4, 9]  # three filters, some overlap
    shares = filter_audit.shapley(removed, 3)
    sums = [0, 0, 0]
    for order in permutations(range(3)):
        seen = 0
        for i in order:
            sums[i] += removed[seen | 1 << i] - removed[seen]
            seen |= 1 << i
    assert shares == [Fraction(x, 6) for x in sums]
    assert filter_audit.solved([[Fraction(0), Fraction(2)], [Fraction(3), Fraction(0)]], [4, 6]) == [2, 2]


def test_given_table_in_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    twin = con.sql(ORACLE["op13_filter_audit"])
    assert sorted(twin.columns) == sorted(NAMES)
    rows = table(REGISTRY["op13_filter_audit"](spark, sf_dir))
    assert rows == sorted(twin.project(", ".join(NAMES)).fetchall())
    assert len(rows) % 600 == 0 and rows


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (5, None, 1), (None, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_small_table(make, labels):
    long = " ".join(f"word{k}" for k in range(200))
    rows = [
        (1, long, "en", "s"), (2, long, "de", "s"), (3, long, "en", "s"), (3, long, "en", "s"),
        (4, "the the the", "en", "s"), (5, "LOUD $ words", None, "s"), (6, None, "en", "s"),
        (7, "", "", "s"), (None, "", "en", "s"), (None, long, "en", "s"), (8, long + " #", "de", "s"),
        (9, "漢字 漢字 漢字", "fr", "s"), (1, "other text", "en", "s"),
    ]
    docs = make(*rows)
    clash = docs.withColumn("n", F.lit(1)).withColumn("bits", F.lit("x")).withColumn("quality", F.lit(3))
    plain = [(d, t, lang) for d, t, lang, _ in rows]
    expected = brute(plain, {1: (1, 0), 2: (0, 1), 3: (1, 1), 5: (None, 1)})
    assert table(filter_audit.audit(clash, labels)) == expected


def test_odd_rows(odd, labels):
    plain = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    found = table(filter_audit.audit(odd, labels))
    assert found == brute(plain, {1: (1, 0), 2: (0, 1), 3: (1, 1), 5: (None, 1)})
    assert filter_audit.audit(odd.limit(0), labels).count() == 0
    assert filter_audit.audit(odd, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
