import random

from broadsheet.operators import merge, ranking

INCOMING = "source_id string, item_pos bigint, title string, url string, summary string, content string"


def placeholder(body):
    return "|  |" in body[:800] or body.lstrip().startswith("[Signup]")


def test_new_items_and_batch_duplicates(spark):
    incoming = spark.createDataFrame(
        [("s", 0, "a", "u1", None, ""), ("s", 1, "b", "u2", None, ""), ("s", 2, "c", "u2", None, ""),
         ("t", 3, "d", "u1", None, "")], INCOMING)
    existing = spark.createDataFrame([("s", "u1"), ("s", "u1"), ("s", "")], "source_id string, url string")
    assert sorted(r["title"] for r in merge.new_items(incoming, existing).collect()) == ["b", "c", "d"]
    assert sorted(r["title"] for r in merge.new_items(incoming, existing, dedup=True).collect()) == ["b", "d"]


def test_refresh_equals_applying_the_batch_in_order(spark):
    rng = random.Random(5)
    pool = ["", None, "good one", "|  | bad", "[Signup] bad", "other good", "  "]
    incoming, stored, expected = [], [], {}
    for n in range(120):
        url, body = f"u{n}", rng.choice(["", "|  | old", " ", "fine", "[Signup]"])
        stored.append(("s", 0, f"i{n}", url, f"p{n}", body))
        current = body
        for pos in range(rng.randrange(5)):
            summary, content = rng.choice([None, "", "sum"]), rng.choice(pool)
            incoming.append(("s", pos, "t", url, summary, content))
            new = content or summary or ""
            if (current == "" or (new and placeholder(current))) and new:
                current = new
        if current != body:
            expected[f"i{n}"] = current
    existing = spark.createDataFrame(
        stored, "source_id string, item_pos bigint, id string, url string, content_path string, content string")
    got = merge.content_refresh(
        spark.createDataFrame(incoming, INCOMING), existing, existing.select("content_path", "content"))
    assert {r["item_id"]: r["body"] for r in got.collect()} == expected


def test_refresh_skips_missing_bodies_and_uses_last_row_of_a_url(spark):
    existing = spark.createDataFrame(
        [("s", 0, "old", "u", "p0"), ("s", 1, "new", "u", "p1"), ("s", 2, "gone", "v", "p2"), ("s", 3, "np", "w", None)],
        "source_id string, item_pos bigint, id string, url string, content_path string")
    contents = spark.createDataFrame([("p0", ""), ("p1", "")], "content_path string, content string")
    incoming = spark.createDataFrame(
        [("s", 0, "t", u, None, "x") for u in ("u", "v", "w")], INCOMING)
    got = merge.content_refresh(incoming, existing, contents).collect()
    assert [(r["item_id"], r["content_path"]) for r in got] == [("new", "p1")]


def test_needs_page_fetch(spark):
    existing = spark.createDataFrame(
        [("s", i, f"u{i}", p) for i, p in enumerate(["p0", "p1", "p2", "p3", "", None])],
        "source_id string, item_pos bigint, url string, content_path string")
    contents = spark.createDataFrame(
        [("p0", "fine"), ("p1", ""), ("p2", "a\n|\nb")], "content_path string, content string")
    incoming = spark.createDataFrame([("s", f"u{i}") for i in range(7)], "source_id string, url string")
    got = {r["url"]: r["reason"] for r in merge.needs_page_fetch(incoming, existing, contents).collect()}
    assert got == {"u1": "empty", "u2": "placeholder", "u3": "missing", "u4": "no_path", "u5": "no_path", "u6": "unknown"}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id")
    top = ranking.top_per_group(df, ["k"], [df["id"].desc()], 2, rank="rank")
    assert sorted(tuple(r) for r in top.collect())[:2] == [(0, 996, 2), (0, 999, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_hot_stories_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("s", 0, None), ("s", 1, 5), ("s", 2, 0), ("s", 3, 5)], "source_id string, seed_pos int, comments_count bigint")
    got = ranking.hot_stories(df, ["source_id"], limit=3).orderBy("rank").collect()
    assert [(r["seed_pos"], r["rank"]) for r in got] == [(1, 1), (3, 2), (0, 3)]


def test_recent_top_n(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(0, 5, "2026-01-03"), (1, 9, "2026-01-02"), (2, 5, "2026-01-09"), (3, None, "2026-01-09")],
        "item_pos bigint, score bigint, created string")
    got = ranking.recent_top_n(df, dt.date(2026, 1, 9), n=2).collect()
    assert [r["item_pos"] for r in got] == [0, 2]
