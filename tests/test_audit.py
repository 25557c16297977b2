import json
import random
from collections import Counter

import pytest

from broadsheet.operators import audit
from broadsheet.sources import files

LONG = "word " * 100


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def item(root, source, name, body=LONG, meta="same", **fields):
    path = f"sources/{source}/items/{name}/content.md"
    row = {"id": name, "source_id": source, "url": f"https://e/{name}", "content_path": path} | fields
    if body is not None:
        write(root / path, body)
    if meta is not None:
        meta_row = row if meta == "same" else meta
        data = meta_row if isinstance(meta_row, (bytes, str)) else json.dumps(meta_row)
        write(root / f"sources/{source}/items/{name}/meta.json", data)
    return json.dumps(row)


def manifest(root, source, *lines):
    write(root / f"sources/{source}/manifest.jsonl", "\n".join(lines) + "\n")


def snapshot(root, source, day, data):
    write(root / f"sources/{source}/snapshots/{day}.json", data if isinstance(data, (str, bytes)) else json.dumps(data))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    good = {"title": "t", "url": "u"}
    manifest(
        root, "blog",
        item(root, "blog", "fine"),
        "", "{'a': 1}", "[1]", '{"a": 1} x',
        json.dumps({"id": 5, "url": "u"}),
        item(root, "blog", "nourl", url=""),
        item(root, "blog", "lost", body=None),
        item(root, "blog", "nometa", meta=None),
        item(root, "blog", "badmeta", meta="{"),
        item(root, "blog", "listmeta", meta="[]"),
        item(root, "blog", "othermeta", meta={"id": "x", "url": "y", "content_path": "z"}),
        item(root, "blog", "utf8", body=b"\xff\xfe"),
        item(root, "blog", "blank", body=" \n\t\xa0"),
        item(root, "blog", "short", body="x" * 399),
        item(root, "blog", "exact", body="x" * 400),
        item(root, "blog", "pipes", body="|  |\n" + LONG),
        item(root, "blog", "nul", body="a\0" + LONG),
        item(root, "blog", "repl", body="a�" + LONG),
        json.dumps({"id": "nopath", "url": "u"}),
    )
    write(root / "sources/blog/items/nopath/content.md", LONG)
    write(root / "sources/blog/items/nopath/meta.json", json.dumps({"id": "nopath", "url": "u"}))
    snapshot(root, "blog", "2026-01-01", "ignored: the source has a manifest")
    write(root / "sources/broken/manifest.jsonl", b"\xff\n")
    manifest(root, "empty", " ", "")
    snapshot(root, "ranked", "2026-01-01", "{")
    snapshot(root, "ranked", "2026-01-02", {})
    snapshot(root, "ranked", "2026-01-03", {"items": []})
    snapshot(root, "ranked", "2026-01-04", {"items": [5, {"title": "", "url": 3}, good]})
    snapshot(root, "ranked", "2026-01-05", {"items": [good] * 50 + [5]})
    snapshot(root, "ranked", "2026-01-06", [1])
    snapshot(root, "ranked", "2026-01-07", {"items": {"a": 1}})
    (root / "sources/strange").mkdir()
    write(root / "sources/readme.txt", "not a folder")
    return str(root)


BLOG = {
    "manifest_bad_json": [None, None, None], "manifest_missing_id": [None], "manifest_missing_url": ["nourl"],
    "content_missing": ["lost"], "meta_missing": ["nometa"], "meta_bad_json": ["badmeta", "listmeta"],
    "meta_id_mismatch": ["othermeta"], "meta_url_mismatch": ["othermeta"],
    "meta_content_path_mismatch": ["othermeta"], "content_bad_utf8": ["utf8"], "content_empty": ["blank"],
    "content_too_short": ["short"], "content_placeholder": ["pipes"], "content_has_nul": ["nul"],
    "content_has_replacement_char": ["repl"],
}
RANKED = {
    "snapshot_bad_json": 1, "snapshot_items_not_list": 3, "snapshot_items_empty": 1,
    "snapshot_item_not_object": 2, "snapshot_item_missing_url": 1, "snapshot_item_missing_title": 1,
}


def test_every_rule(spark, folder):
    frame = files.audit_folder(spark, folder)
    rows = audit.issues(frame).collect()
    found = {}
    for r in rows:
        if r["source_id"] == "blog":
            found.setdefault(r["issue_type"], []).append(r["item_id"])
    assert {k: sorted(v, key=str) for k, v in found.items()} == BLOG
    assert Counter(r["issue_type"] for r in rows if r["source_id"] == "ranked") == RANKED
    rest = {(r["source_id"], r["kind"], r["issue_type"]) for r in rows if r["source_id"] not in ("blog", "ranked")}
    assert rest == {("broken", "blog", "manifest_bad_utf8"), ("empty", "blog", "manifest_empty"),
                    ("strange", "unknown", "source_unrecognized_layout")}
    assert {(r["source_id"], r["items_checked"]) for r in audit.items_checked(frame).collect()} == {
        ("blog", 16), ("ranked", 7)}


def test_entries_of_a_snapshot_can_be_limited(spark):
    body = json.dumps({"items": [{"title": "t", "url": "u"}] * 50 + [5]})
    rows = spark.createDataFrame([("s", "p", body)], "source_id string, path string, content string")
    found = [r["seq_pos"] for r in audit.issues(audit.snapshot_rows(rows)).collect()]
    assert found == [51]
    assert audit.issues(audit.snapshot_rows(rows, items_per_file=50)).count() == 0


def test_details(spark, folder):
    issues = audit.issues(files.audit_folder(spark, folder, include_snippets=True))
    details = {r["issue_type"]: r for r in issues.where("detail is not null").collect()}
    assert details["content_too_short"]["detail"] == "chars=399 (<400)"
    assert details["content_too_short"]["snippet"] == "x" * 200 + "…"
    assert details["meta_id_mismatch"]["detail"] == "meta.id='x'"
    lines = sorted(r["detail"] for r in issues.where("issue_type = 'manifest_bad_json'").collect())
    assert lines == ["line=2", "line=3", "line=4"]


def test_report(spark, folder):
    frame = files.audit_folder(spark, folder)
    totals = audit.totals(frame, max_issues=5).first()
    n = sum(map(len, BLOG.values())) + sum(RANKED.values()) + 3
    assert (totals["items_checked"], totals["issues_total"], totals["issues_truncated"]) == (23, n, True)
    assert sum(r["issues"] for r in audit.counts_by_type(frame).collect()) == n
    per_source = {r["source_id"]: r for r in audit.counts_by_source(frame).collect()}
    assert per_source["ranked"]["issues"] == RANKED and per_source["ranked"]["kind"] == "aggregation"
    assert (per_source["strange"]["kind"], per_source["strange"]["items_checked"]) == ("unknown", 0)
    cube = {(r["level"], r["source_id"], r["issue_type"]): r["issues"] for r in audit.count_cube(frame).collect()}
    assert cube[(3, None, None)] == n
    kept = audit.examples(frame, 4).collect()
    assert [r["detail"] for r in kept] == ["line=2", "line=3", "line=4", "line=5"]


def test_options(spark, folder, tmp_path):
    frame = files.audit_folder(spark, folder, source_ids=["ranked"], min_content_chars=1)
    assert {r["source_id"] for r in frame.collect()} == {"ranked"} and audit.items_checked(frame).count() == 1
    frame = files.audit_folder(spark, folder, source_ids=["blog"], min_content_chars=10)
    assert frame.where("issue_type = 'content_too_short'").count() == 0
    frame = files.audit_folder(spark, str(tmp_path / "none"))
    row = frame.first()
    assert (row["source_id"], row["issue_type"], audit.items_checked(frame).count()) == (
        "(none)", "sources_root_missing", 0)
    (tmp_path / "bare/sources").mkdir(parents=True)
    assert files.audit_folder(spark, str(tmp_path / "bare")).count() == 0


def test_last_kind_of_a_source(spark):
    rows = [("s", "blog", "x", "f", 5, 3), ("s", "aggregation", "y", "f", 1, 20), ("t", "blog", None, "f", 0, 0)]
    frame = spark.createDataFrame(
        rows, "source_id string, kind string, issue_type string, seq_file string, seq_pos long, seq_rule int"
    ).selectExpr("*", "cast(issue_type is null as bigint) as checked")
    found = {r["source_id"]: (r["kind"], r["items_checked"], r["issues_total"]) for r in audit.counts_by_source(frame).collect()}
    assert found == {"s": ("blog", 0, 2), "t": ("blog", 1, 0)}


def test_manifests_are_read_in_splits(spark, tmp_path):
    """Numbers are those of a sequential reader, whatever the splits; blanks, long lines, no last line end."""
    rng = random.Random(8)
    sizes = {"big": 3_000, "two": 2, "nl": 40}
    for name, n in sizes.items():
        lines = [rng.choice(["", "  ", "{}", "x" * rng.randint(1, 300), "é\r", "漢字 \x0b"]) for _ in range(n)]
        write(tmp_path / f"sources/{name}/manifest.jsonl", "\n".join(lines) + ("\n" if name == "nl" else ""))
    write(tmp_path / "sources/bad/manifest.jsonl", b"{}\n" * 4_000 + b"\xff{}\n" + b"{}\n" * 4_000)
    write(tmp_path / "sources/a b%20c/manifest.jsonl", "one\n\ntwo")
    write(tmp_path / "sources/none/manifest.jsonl", "\n \n")
    expected = {("bad", "manifest_bad_utf8", None, None), ("none", "manifest_empty", None, None)}
    for path in tmp_path.glob("sources/*/manifest.jsonl"):
        source = path.parent.name
        if source not in ("bad", "none"):
            kept = [x for x in path.read_bytes().decode().split("\n") if x.strip()]
            expected |= {(source, None, k + 1, x) for k, x in enumerate(kept)}
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = files.manifest_lines(spark, str(tmp_path))
        found = {(r["source_id"], r["file_issue"], r["line_no"], r["line"]) for r in df.collect()}
        read = spark.read.text(str(tmp_path / "sources/big/manifest.jsonl"))
        assert read.rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == expected


def test_sources_are_listed_by_tasks(spark, folder):
    """No folder below a source is listed on the driver."""
    tracker, group = spark.sparkContext.statusTracker(), "listing"
    spark.sparkContext.setJobGroup(group, group)
    try:
        files.bodies(spark, folder)
        files.snapshot_files(spark, folder)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One listing job a reader, one task a source.
    assert len(tracker.getJobIdsForGroup(group)) == 2


def test_folder_readers(spark, folder, tmp_path):
    write(tmp_path / "sources/a/manifest.jsonl", '{"id":"1","title":"x y","url":"u"}\n\n{"id":"2"}\n')
    got = files.manifest_items(spark, str(tmp_path)).orderBy("item_pos").collect()
    assert [(r["source_id"], r["item_pos"], r["id"], r["title"]) for r in got] == [
        ("a", 0, "1", "x y"), ("a", 1, "2", None)]
    rows = files.snapshot_rows(spark, folder).where("source_id = 'ranked'")
    # The two documents with a list hold 2 and 50 objects.
    assert rows.count() == 52
