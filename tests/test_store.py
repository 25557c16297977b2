import json

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import query
from broadsheet.plans import ingest as runs
from broadsheet.schemas import ARCHIVE_ITEM, RANKED_ITEM, RAW
from broadsheet.sources import pages
from broadsheet.sources.registry import sources
from broadsheet.sources.store import Attempt, Conflict, Store


def archive(spark, *rows):
    return spark.createDataFrame(
        [(s, "r", pos, t, u, None, None, summary, content) for s, pos, t, u, summary, content in rows], ARCHIVE_ITEM)


def ranked(spark, *rows):
    return spark.createDataFrame(
        [(s, "r", pos, t, u, None, None, score, 1, pos + 1, None, [], {"k": "v"}) for s, pos, t, u, score in rows],
        RANKED_ITEM)


@pytest.fixture
def store(spark, tmp_path):
    return Store.open(spark, str(tmp_path / "store"))


def bodies(store):
    return {r["content_path"].split("/")[3]: r["content"] for r in store.contents().collect()}


def report(df):
    return {r["source_id"]: (r["status"], r["fetched"], r["stored"]) for r in df.where("fetched is not null").collect()}


def test_new_duplicate_and_refresh(spark, store):
    dimension = sources(spark)
    none = ranked(spark)
    first = archive(spark, ("antirez", 0, "A", "u1", "sum", ""), ("antirez", 1, "B", "u2", None, None),
                    ("antirez", 2, "B", "u2", None, "again"), ("unknown", 0, "X", "u", None, "x"))
    done = runs.ingest(store, dimension, first, none, "run1", "2026-01-10T00:00:00Z")
    assert report(done) == {"antirez": ("success", 3, 2)}
    assert done.where("status = 'failure'").count() == 33
    assert done.where("source_id = 'hn'").first()["error"] == "no items returned"
    ids = {r["url"]: r["id"] for r in store.items().collect()}
    assert bodies(store) == {ids["u1"]: "sum", ids["u2"]: ""}

    second = archive(spark, ("antirez", 0, "New title", "u2", None, "|  | layout"), ("antirez", 1, "C", "u3", None, "c"),
                     ("antirez", 2, "A", "u1", None, "other"))
    for _ in range(2):  # a repeated run changes nothing
        done = runs.ingest(store, dimension, second, none, "run2", "2026-01-11T00:00:00Z")
        assert report(done) == {"antirez": ("success", 3, 1)}
        ids = {r["url"]: r["id"] for r in store.items().collect()}
        assert bodies(store) == {ids["u1"]: "sum", ids["u2"]: "|  | layout", ids["u3"]: "c"}
    third = archive(spark, ("antirez", 0, "B", "u2", None, "clean"))
    assert report(runs.ingest(store, dimension, third, none, "run3", "2026-01-12T00:00:00Z")) == {
        "antirez": ("success", 1, 0)}
    assert bodies(store)[ids["u2"]] == "clean"
    assert store.items().where("title = 'New title'").count() == 0
    assert store.runs().select("run_id").distinct().count() == 3


def test_a_repeated_run_leaves_nothing_of_its_first_attempt(spark, store):
    dimension, none = sources(spark), ranked(spark)
    other = archive(spark, ("antirez", 0, "Z", "u0", None, "z"))
    runs.ingest(store, dimension, other, none, "run0", "2026-01-09T00:00:00Z")
    full = archive(spark, ("antirez", 0, "A", "u1", None, "a"), ("antirez", 1, "B", "u2", None, "b"))
    runs.ingest(store, dimension, full, none, "run1", "2026-01-10T00:00:00Z")
    fewer = archive(spark, ("antirez", 0, "A", "u1", None, "a"))
    done = runs.ingest(store, dimension, fewer, none, "run1", "2026-01-10T00:00:00Z")
    assert report(done) == {"antirez": ("success", 1, 1)}
    assert sorted(r["url"] for r in store.items().collect()) == ["u0", "u1"]
    done = runs.ingest(store, dimension, archive(spark), none, "run1", "2026-01-10T00:00:00Z")
    assert report(done) == {} and done.where("status = 'failure'").count() == 34
    assert [r["url"] for r in store.items().collect()] == ["u0"]
    assert list(bodies(store).values()) == ["z"]


def test_parity_keeps_batch_duplicates(spark, store):
    batch = archive(spark, ("antirez", 0, "B", "u2", None, "one"), ("antirez", 1, "B", "u2", None, "two"))
    done = runs.ingest(store, sources(spark), batch, ranked(spark), "run1", "2026-01-10T00:00:00Z", parity=True)
    assert report(done) == {"antirez": ("success", 2, 2)}
    assert list(bodies(store).values()) == ["two"]


def test_snapshot_rerun_and_index_parity(spark, store):
    dimension = sources(spark)
    runs.ingest(store, dimension, archive(spark, ("antirez", 0, "the A", "u1", None, "x")),
                ranked(spark, ("hn", 0, "the S", "s1", 1), ("hn", 1, "S2", "s2", 1), ("lobsters", 0, "L", "l", 1)),
                "run1", "2026-01-10T01:00:00Z")
    assert store.rebuild_index(dimension) == {"records": 4, "indexed": 4}
    runs.ingest(store, dimension, archive(spark, ("antirez", 0, "the B", "u2", None, "x")),
                ranked(spark, ("hn", 0, "the S", "s1", 7)), "run2", "2026-01-10T05:00:00Z")
    day = store.snapshots().where("source_id = 'hn'").collect()
    assert [(r["title"], r["score"]) for r in day] == [("the S", 7)]
    assert store.snapshots().where("source_id = 'lobsters'").count() == 1
    index, scan = store.records(dimension), store.scan_records(dimension)
    asked = [lambda r: query.by_source(r, "hn"), lambda r: query.by_keyword(r, "THE"),
             lambda r: query.by_archive_date(r, on="2026-01-10"), lambda r: query.by_keyword(r, "the", limit=2)]
    for ask in asked:
        names = scan.columns
        assert ask(index).select(names).collect() == ask(scan).select(names).collect()
    assert query.by_keyword(index, "the").count() == 3


def state(store):
    """All that a reader sees, as text."""
    tables = [store.items(), store.contents(), store.snapshots(), store.runs(), store.index()]
    return [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in tables]


def test_failed_runs_leave_the_old_state(spark, store, monkeypatch):
    dimension = sources(spark)
    first = archive(spark, ("antirez", 0, "A", "u1", None, ""), ("antirez", 1, "B", "u2", None, "b"))
    runs.ingest(store, dimension, first, ranked(spark, ("hn", 0, "S", "s", 1)), "run1", "2026-01-10T01:00:00Z")
    store.rebuild_index(dimension)
    before = state(store)
    second = archive(spark, ("antirez", 0, "A", "u1", None, "filled"), ("antirez", 1, "C", "u3", None, "c"))
    again = ranked(spark, ("hn", 0, "S", "s", 2))
    write = Attempt.write

    def lost(*_):
        raise OSError("lost")

    for broken in ("items", "index", "commit"):
        with monkeypatch.context() as patch:
            def failing(self, table, df, broken=broken):
                write(self, table, df)
                if table == broken:
                    lost()

            patch.setattr(Attempt, "write", failing)
            if broken == "commit":
                patch.setattr(Attempt, "commit", lost)
            with pytest.raises(OSError):
                runs.ingest(store, dimension, second, again, "run2", "2026-01-10T05:00:00Z")
        assert state(store) == before
    runs.ingest(store, dimension, second, again, "run2", "2026-01-10T05:00:00Z")
    ids = {r["url"]: r["id"] for r in store.items().collect()}
    assert bodies(store) == {ids["u1"]: "filled", ids["u2"]: "b", ids["u3"]: "c"}
    assert [r["score"] for r in store.snapshots().collect()] == [2]
    names = store.scan_records(dimension).columns
    shown = lambda df: sorted(map(str, df.select(names).collect()))
    assert shown(store.index()) == shown(store.scan_records(dimension))
    assert store.vacuum() == 3 and store.vacuum() == 0
    assert shown(store.index()) == shown(store.scan_records(dimension))


def test_earlier_versions_stay_readable(spark, store):
    dimension, none = sources(spark), ranked(spark)
    steps = [("run1", "", 1), ("run2", "|  | layout", 2), ("run3", "sound", 3), ("run4", "too late", 4)]
    states = []
    for k, (run, body, score) in enumerate(steps):
        items = archive(spark, ("antirez", 0, "A", "u1", None, body))
        runs.ingest(store, dimension, items, ranked(spark, ("hn", 0, "S", "s", score)), run, f"2026-01-10T0{k}:00:00Z")
        states.append(state(store))
    assert [state(store.at(k + 1)) for k in range(4)] == states
    assert state(store.at(0)) == [[]] * 5
    assert [list(bodies(store.at(k + 1)).values()) for k in range(4)] == [[""], ["|  | layout"], ["sound"], ["sound"]]
    versions = {r["version_no"]: (r["content"], r["first_seen"]) for r in store.content_versions().collect()}
    assert versions == {1: ("", 1), 2: ("|  | layout", 2), 3: ("sound", 3)}
    assert [r["content"] for r in store.read_versions().collect()] == ["sound"]
    assert [r["content"] for r in store.read_versions(2).collect()] == ["|  | layout"]
    assert store.read_versions(9).count() == 0
    assert store.updates().count() == 0
    told = store.at(3).updates().collect()
    assert [(r["version_no"], r["status"]) for r in told] == [(3, "changed")]
    # A repeated run takes the place of its earlier attempt.
    runs.ingest(store, dimension, archive(spark), none, "run3", "2026-01-10T02:00:00Z")
    assert list(bodies(store).values()) == ["|  | layout"]
    assert state(store.at(4)) == states[3]


def test_two_runs_at_once(spark, store):
    one, other = store.begin("run1"), store.begin("run2")
    build = store.begin("(index)")
    assert one.commit() == 1
    with pytest.raises(Conflict):
        other.commit()
    assert build.commit("index") == 2
    # A marker that a crash left empty uses its number up and shows nothing.
    open(store.path("commits/000000000003.json"), "w").close()
    assert store.begin("run2").commit() == 4
    assert {r["run_id"] for r in store.valid().collect()} == {"run1", "run2", "(index)"}


def test_a_repeated_run_from_before_the_build(spark, store):
    dimension = sources(spark)
    first = archive(spark, ("antirez", 0, "A", "u1", None, "a"), ("antirez", 1, "B", "u2", None, "b"))
    runs.ingest(store, dimension, first, ranked(spark, ("hn", 0, "S", "s", 1)), "run1", "2026-01-10T01:00:00Z")
    store.rebuild_index(dimension)
    runs.ingest(store, dimension, first.where("url = 'u1'"), ranked(spark), "run1", "2026-01-10T01:00:00Z")
    assert [r["url"] for r in store.records(dimension).collect()] == ["u1"]


def test_order_does_not_follow_the_partitioning(spark, store):
    rows = [("antirez", f"r{k % 2}", 0, f"T{k}", "u1", None, None, None, f"body {k}") for k in range(6)]
    rows += [("antirez", f"r{k % 2}", 0, "same", f"v{k}", None, None, None, "x") for k in range(6)]
    kept = set()
    for k, parts in enumerate((1, 5)):
        batch = spark.createDataFrame(rows, ARCHIVE_ITEM).repartition(parts, "title")
        own = Store.open(spark, f"{store.root}-{k}")
        runs.ingest(own, sources(spark), batch, ranked(spark), "run1", "2026-01-10T00:00:00Z")
        title = own.items().where("url = 'u1'").first()["title"]
        answers = [r["url"] for r in query.by_source(own.records(sources(spark)), "antirez").collect()]
        kept.add((title, *sorted(bodies(own).values()), *answers))
    assert len(kept) == 1 and next(iter(kept))[0] == "T0"


def test_a_page_landed_twice_doubles_nothing(spark):
    items = spark.createDataFrame([("s", 0, "u", "")], "source_id string, item_pos long, url string, content string")
    pages_ = spark.createDataFrame([("r1", "u", "old"), ("r2", "u", "new"), ("r2", "u", "New")],
                                   "run_id string, url string, html string")
    filled = pages.with_page_body(items, pages_, F.col("html")).collect()
    assert [r["content"] for r in filled] == ["new"]


def test_disabled_sources_are_left_out(spark, store):
    dimension = sources(spark, disabled=frozenset({"antirez"}))
    done = runs.ingest(store, dimension, archive(spark, ("antirez", 0, "A", "u", None, "x")), ranked(spark),
                       "run1", "2026-01-10T00:00:00Z")
    assert done.where("source_id = 'antirez'").count() == 0 and store.items().count() == 0


def test_all_shapes_in_one_run(spark, store):
    rss = "<rss><channel><item><title>{0}</title><link>https://e/{0}</link><description>{1}</description></item></channel></rss>"
    listing = '<main><article><a href="/blog/one"><h2>One</h2></a></article></main>'
    flat = '<main><a href="/blog/two">Two</a></main>'
    bodies_ = {
        "antirez": rss.format("plain", "x"), "paul-graham": rss.format("pg", ""), "vercel-blog": "<broken",
        "mailchimp-archive": rss.format("mc", "&lt;td class='mcnTextContent'&gt;kept&lt;/td&gt;"),
        "founders-fund-anatomy": json.dumps([{"title": {"rendered": "FF"}, "link": "https://f", "content": {"rendered": "c"}}]),
        "alphasignal-last-email": "<title>Mail</title><body><p>x</p><p>Hey you</p></body>",
        "product-hunt": rss.format("ph", "d"),
        "github-trending": json.dumps({"items": [{"full_name": "o/r", "html_url": "https://g"}]}),
        "hn": "[1]",
    }
    raw = spark.createDataFrame([(s, "r", b) for s, b in bodies_.items()], RAW)
    nodes = spark.createDataFrame([(1, '{"type":"story","title":"HN","kids":[2]}'), (2, '{"type":"comment","text":"c"}')],
                                  "id bigint, payload string")
    fetched = spark.createDataFrame([
        ("claude-blog", "r", "https://c.example/blog", listing, True),
        ("claude-blog", "r", "https://c.example/blog/one", "<main><p>Body one</p></main>", False),
        ("openai-dev-blog", "r", "https://o.example/blog", flat, True),
        ("openai-dev-blog", "r", "https://o.example/blog/two", "<article><h1>T2</h1><p>Body two</p></article>", False),
        ("paul-graham", "r", "https://e/pg", "<font size='2' face='verdana'>essay</font>", False),
    ], "source_id string, run_id string, url string, html string, listing boolean")
    items = runs.archive_items(raw, "2026-01-10", fetched)
    got = {r["source_id"]: (r["title"], r["content"]) for r in items.collect()}
    assert got == {
        "antirez": ("plain", "x"), "paul-graham": ("pg", "essay\n"), "mailchimp-archive": ("mc", "kept"),
        "founders-fund-anatomy": ("FF", "c"), "alphasignal-last-email": ("Mail", "Hey you"),
        "claude-blog": ("One", "Body one"), "openai-dev-blog": ("T2", "Body two"),
    }
    top = runs.ranked_items(raw, nodes)
    assert {r["source_id"]: (r["title"], r["rank"]) for r in top.collect()} == {
        "product-hunt": ("ph", 1), "github-trending": ("o/r", 1), "hn": ("HN", 1)}
    done = runs.ingest(store, sources(spark), items, top, "run1", "2026-01-10T00:00:00Z")
    assert done.where("status = 'success'").count() == 10
    assert store.snapshots().where("source_id = 'hn'").first()["comments"][0]["text"] == "c"


def large_store(spark, store, monkeypatch, threshold):
    """A store whose plans were kept, by table: two runs, the second of better bodies."""
    plans = {}
    write = Attempt.write

    def kept(self, table, df):
        name = f"{table} (refresh)" if (self.run_id, table) in plans else table
        plans.setdefault((self.run_id, name), df._jdf.queryExecution().executedPlan().toString())
        write(self, table, df)

    monkeypatch.setattr(Attempt, "write", kept)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for run, body in (("run1", ""), ("run2", "better")):
            items = archive(spark, *[("antirez", i, f"T{i}", f"u{i}", None, body) for i in range(300)])
            rows = ranked(spark, *[("hn", i, f"S{i}", f"s{i}", i) for i in range(300)])
            runs.ingest(store, sources(spark), items, rows, run, f"2026-01-1{run[-1]}T00:00:00Z")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return plans


def test_small_keys_do_not_shuffle_large_rows(spark, store, monkeypatch):
    plans = large_store(spark, store, monkeypatch, 20_000)
    for run in ("run1", "run2"):
        assert "SortMergeJoin" not in plans[run, "snapshots"]
    # The bodies offered are found by the url keys of the targets, whose real size is known.
    offered = [line for line in plans["run2", "contents (refresh)"].splitlines() if "LeftSemi" in line]
    assert any("BroadcastHashJoin" in line for line in offered)
    assert set(bodies(store).values()) == {"better"} and store.snapshots().count() == 600
    left = [n for n in ("staged_days", "staged_targets") if spark.read.schema("x int").parquet(store.path(n)).count()]
    assert left == []


def test_bodies_stay_out_of_the_join(spark, store):
    for run, body in (("run1", ""), ("run2", "better")):
        items = archive(spark, ("antirez", 0, "A", "u1", None, body), ("antirez", 1, "B", "u2", None, "sound"))
        runs.ingest(store, sources(spark), items, ranked(spark), run, f"2026-01-1{run[-1]}T00:00:00Z")
    hashed = store.contents(F.sha1("content").alias("hash"))
    assert "content" not in hashed.columns
    plain = store.contents().withColumn("hash", F.sha1("content")).select(*hashed.columns)
    assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, plain.collect()))
    # Below the join the hash is there already, not the body.
    plan = hashed._jdf.queryExecution().optimizedPlan().toString()
    anti = plan.index("Join LeftAnti")
    assert "sha1" not in plan[:anti] and "sha1" in plan[anti:]
