"""Fill-in-the-middle against a plain version, and the skip list by itself."""

import hashlib
import re

import numpy as np
from hypothesis import given as cases
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.llm import fill_middle
from broadsheet.llm.queries import ORACLE, REGISTRY

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    hexed = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def found(docs):
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return [tuple(r[x] for x in names) for r in fill_middle.rearrange(docs).collect()]


@cases(st.text(alphabet="ab \t\n\x0b漢😀\xa0", max_size=60), st.integers(1, 7))
def test_units_in_any_block(text, block):
    whole, fill_middle.BLOCK = fill_middle.BLOCK, block
    try:
        widths = fill_middle.unit_widths(text)
    finally:
        fill_middle.BLOCK = whole
    assert widths.tolist() == [len(u) for u in UNIT.findall(text)]


def test_skip_list_reaches_every_rank():
    widths = np.random.default_rng(5).integers(1, 40, 5_000)
    units = fill_middle.SkipList(widths)
    assert len(units.lanes) > 3
    for lane, (own, points, _) in enumerate(units.lanes):
        assert own.sum() == 5_000 and points.sum() == widths.sum()
        assert len(own) <= 5_000 * 0.4**lane + 1
    ends = np.concatenate([[0], np.cumsum(widths)])
    assert [units.offset(k) for k in range(5_001)] == ends.tolist()
    assert fill_middle.SkipList(widths[:0]).offset(0) == 0


def test_whole_table(spark, sf_dir, given):
    rows = REGISTRY["op11_fill_middle"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(given) and len(rows) == len(given)
    forms = set()
    for r in rows:
        text = given[r["doc_id"]][0]
        n, form, prefix, middle, output = expected(r["doc_id"], text)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        forms.add(form)
    assert forms == {"plain", "spm", "psm"}


def test_twin_in_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    twin = con.sql(ORACLE["op11_fill_middle"])
    rows = REGISTRY["op11_fill_middle"](spark, sf_dir).select(*twin.columns).collect()
    assert sorted(tuple(r) for r in rows) == sorted(twin.fetchall())


def test_odd_rows(odd, make):
    clash = odd.withColumn("n", F.lit("mine")).withColumn("cuts", F.lit(1)).withColumn("h1", F.lit(2))
    rows = sorted(map(repr, found(clash)))
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows == sorted(repr((d, *expected(d, t))) for d, t in texts)
    assert found(odd.limit(0)) == []


def test_markers_and_restoring(make):
    texts = ["a <P> b", "x <S", "<", "S> <M", "end <M>", "  lead and trail \n", "<P", "> <S > <"]
    docs = make(*[(k * 100 + i, t, "en", "s") for i, t in enumerate(texts) for k in range(40)])
    out = fill_middle.rearrange(docs).withColumn(
        "whole", fill_middle.restored(F.col("output"), F.col("form"))
    )
    kept = {(r["doc_id"], r["whole"]) for r in out.collect()}
    assert kept == {(k * 100 + i, t) for i, t in enumerate(texts) for k in range(40)}
    assert {r["form"] for r in out.where("doc_id % 100 in (0, 4)").collect()} == {"plain"}
    assert len({r["form"] for r in out.collect()}) == 3
