import json
import random
from collections import deque

from pyspark.sql import functions as F

from broadsheet.operators import threads
from broadsheet.session import ensure_checkpoint_dir


def walk(nodes, roots, limit, budget):
    """Plain queue walk over {id: (type, kids)}."""
    found, queue = [], deque(roots)
    while queue and len(found) < limit:
        node = queue.popleft()
        kind, kids = nodes.get(node, (None, []))
        if kind != "comment":
            continue
        found.append(node)
        for kid in kids:
            if budget and len(found) + len(queue) >= limit:
                break
            queue.append(kid)
    return found


def forest(seed, stories=40):
    rng = random.Random(seed)
    nodes, roots, next_id = {}, {}, 1000
    for story in range(stories):
        size = rng.choice([0, 1, 5, 30, 80])
        ids = list(range(next_id, next_id + size))
        next_id += size + 1
        kids = {i: [] for i in ids}
        top = []
        for n, i in enumerate(ids):
            parent = None if n == 0 or rng.random() < 0.3 else rng.choice(ids[:n])
            (top if parent is None else kids[parent]).append(i)
        for i in ids:
            if rng.random() < 0.05:
                continue  # dangling id
            nodes[i] = (rng.choice(["comment"] * 4 + ["poll"]), kids[i])
        roots[story] = top
    return nodes, roots


def frames(spark, nodes, roots):
    n = spark.createDataFrame([(i, t, k) for i, (t, k) in nodes.items()], "node_id bigint, type string, kids array<bigint>")
    s = spark.createDataFrame([(i, k) for i, k in roots.items()], "story_id bigint, kids array<bigint>")
    return s, n


def check(spark, limit, budget, seed):
    nodes, roots = forest(seed)
    stories, table = frames(spark, nodes, roots)
    got = {}
    for r in threads.thread_comments(stories, table, limit, budget).orderBy("story_id", "comment_pos").collect():
        got.setdefault(r["story_id"], []).append(r["node_id"])
        assert r["comment_pos"] == len(got[r["story_id"]])
    expected = {s: walk(nodes, r, limit, budget) for s, r in roots.items()}
    assert got == {s: w for s, w in expected.items() if w}


def test_walk_with_queue_budget(spark):
    check(spark, 20, True, 1)


def test_walk_with_small_budget(spark):
    check(spark, 6, True, 2)


def test_plain_walk(spark):
    check(spark, 20, False, 3)


def test_story_items(spark):
    items = {
        1: {"type": "story", "title": "A", "url": "https://a", "by": "u", "time": 0, "score": 3, "descendants": 1, "kids": [4, 9]},
        2: {"type": "story", "title": "B", "descendants": 5},
        3: {"type": "job", "title": "J"},
        4: {"type": "comment", "by": "c", "time": 60, "text": "<p>hi &amp; bye</p>", "kids": [5]},
        5: {"type": "comment", "deleted": True},
        6: {"type": "story", "title": ""},
    }
    payloads = spark.createDataFrame([(i, json.dumps(p)) for i, p in items.items()] + [(7, "null")], "id bigint, payload string")
    seeds = spark.createDataFrame([("hn", "r", "[1, 7, 2, 3, 6, 8]")], "source_id string, run_id string, body string")
    got = threads.story_items(seeds, payloads).orderBy("rank").collect()
    assert [(r["rank"], r["title"], r["url"], r["comments_count"]) for r in got] == [
        (1, "B", "https://news.ycombinator.com/item?id=2", 5), (2, "A", "https://a", 1)]
    assert got[0]["comments"] == []
    assert [(c["author"], c["published_at"], c["text"]) for c in got[1]["comments"]] == [
        ("c", "1970-01-01T00:01:00+00:00", "hi & bye"), (None, None, "[deleted]")]
    assert got[1]["published_at"] == "1970-01-01T00:00:00+00:00"


def test_levels_never_shuffle_the_lookup(spark):
    """One exchange of the lookup for any depth: each level only deals its own nodes."""
    nodes = spark.range(1000).select(
        F.col("id").alias("node_id"), F.lit("comment").alias("type"), F.array(F.col("id") + 1).alias("kids")
    )
    ensure_checkpoint_dir(spark)
    lookup = threads.comment_lookup(nodes)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        level = spark.range(40).select(F.col("id").alias("node_id"))
        for depth in range(3):
            level = level.join(lookup, "node_id").select(F.explode("kids").alias("node_id"))
            plan = level._jdf.queryExecution().sparkPlan().toString()
            final = level._jdf.queryExecution().executedPlan().toString()
            # Every level adds the exchange of its nodes and none of the lookup.
            assert final.count("Exchange hashpartitioning") == depth + 1, plan
            assert final.count("Sort [") == depth + 1
        assert level.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
