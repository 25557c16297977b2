import pytest

from broadsheet.operators import query
from broadsheet.operators.records import archive_records, records_union, snapshot_records, with_has_content
from broadsheet.sources.registry import sources


@pytest.fixture(scope="module")
def records(spark):
    items = spark.createDataFrame(
        [("antirez", 0, "a1", "100% Éclair", "u1", "2026-01-10T00:00:00Z", None, None, "p1"),
         ("antirez", 1, "a2", "second the", "u2", "2026-01-10T00:00:00Z", None, None, None),
         ("01-me", 0, "z1", "The third", "u3", "2026-01-10T00:00:00Z", None, None, "p3"),
         ("antirez", 2, "a3", "late", "u4", "2026-01-12T23:30:00-05:00", None, None, "p4")],
        "source_id string, item_pos bigint, id string, title string, url string, archived_at string,"
        " published_at string, author string, content_path string")
    ranked = spark.createDataFrame(
        [("hn", "2026-01-10", 0, "the top", "u9", None, None, 5, 2, 1, {"a": "b"}),
         ("hn", "2026-01-10", 1, "same url", "u9", None, None, 5, 2, 2, {}),
         ("hn", "2026-01-13", 0, "newer", "u8", None, None, 1, 1, 1, None)],
        "source_id string, snapshot_date string, item_pos bigint, title string, url string, published_at string,"
        " author string, score bigint, comments_count bigint, rank int, extra map<string,string>")
    dimension = sources(spark)
    return records_union(archive_records(items, dimension), snapshot_records(ranked, dimension)).cache()


def titles(df):
    return [r["title"] for r in df.collect()]


def test_order_is_total(records):
    # The offset stamp is 04:30 UTC on the 13th, after that day's midnight.
    assert titles(query.newest_first(records)) == [
        "late", "newer", "the top", "same url", "The third", "100% Éclair", "second the"]


def test_limits(records):
    assert len(titles(query.by_source(records, "antirez"))) == 3
    assert titles(query.by_source(records, "antirez", 1)) == ["late"]
    assert len(titles(query.by_source(records, "antirez", 0))) == 3
    with pytest.raises(ValueError):
        query.by_source(records, "antirez", -1)


def test_keyword(records):
    assert titles(query.by_keyword(records, "THE")) == ["the top", "The third", "second the"]
    assert titles(query.by_keyword(records, "%")) == ["100% Éclair"]
    assert titles(query.by_keyword(records, "_")) == []
    assert titles(query.by_keyword(records, "ÉCLAIR")) == ["100% Éclair"]
    assert titles(query.by_keyword(records, "the", ["antirez"])) == ["second the"]
    assert titles(query.by_keyword(records, "the", "unknown")) == []
    assert titles(query.by_keyword(records, "the", [])) == []
    assert titles(query.by_keyword(records, "the", limit=2)) == ["the top", "The third"]


def test_archive_date(records):
    assert titles(query.by_archive_date(records, on="2026-01-12")) == ["late"]
    assert titles(query.by_archive_date(records, on="2026-01-13", start="2020-01-01", end="2030-01-01")) == ["newer"]
    assert len(titles(query.by_archive_date(records, start="2026-01-10", end="2026-01-12"))) == 6
    assert titles(query.by_archive_date(records, start="2026-01-12", end="2026-01-10")) == []
    for bounds in ({"start": "2026-01-10"}, {"end": "2026-01-10"}, {}):
        with pytest.raises(ValueError):
            query.by_archive_date(records, **bounds)


def test_record_fields(records):
    row = records.where("title = 'the top'").first()
    assert (row["archived_at"], row["snapshot_date"], row["extra"], row["item_id"]) == (
        "2026-01-10", "2026-01-10", {"a": "b"}, None)
    assert records.where("title = 'same url'").first()["extra"] is None
    row = records.where("title = 'late'").first()
    assert (row["kind"], row["source_name"], row["item_id"], row["rank"]) == ("blog", "antirez", "a3", None)


def test_has_content(spark, records):
    contents = spark.createDataFrame([("p1",), ("p1",), ("p9",)], "content_path string")
    flagged = with_has_content(records, contents)
    assert flagged.count() == records.count()
    assert [r["title"] for r in flagged.where("has_content").collect()] == ["100% Éclair"]


def test_dates_are_strict(records):
    for bad in ("2026-01-12T00:00:00Z", "2026-01-12 and more", "12.1.2026"):
        with pytest.raises(ValueError):
            query.by_archive_date(records, on=bad)
    with pytest.raises(ValueError):
        query.by_archive_date(records, start="2026-01-12", end="2026-01-13x")


def test_limit_plans_as_top_k(records):
    plan = query.by_keyword(records, "the", limit=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
