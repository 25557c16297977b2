"""Discussion threads: the first comments of each story in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.dates import epoch_to_iso
from broadsheet.functions.markup import strip_markup
from broadsheet.functions.text import filled
from broadsheet.operators.ranking import top_per_group
from broadsheet.session import ensure_checkpoint_dir
from broadsheet.sources.ranked import string_at, text_at, whole_at

# What a ranked list shows unless the caller asks for more.
COMMENT_LIMIT = 20
STORY_LIMIT = 10
# Address of a discussion and the text of a removed comment.
DISCUSSION_URL = "https://news.ycombinator.com/item?id="
DELETED = "[deleted]"


def parse_nodes(raw_items: DataFrame) -> DataFrame:
    """Landed ``(id, payload)`` rows to typed thread nodes."""
    v = F.col("v")
    # A payload that is no object has no type and drops out of every step.
    return raw_items.select("id", F.try_parse_json("payload").alias("v")).select(
        F.col("id").cast("bigint").alias("node_id"),
        string_at(v, "$.type").alias("type"),
        text_at(v, "$.title").alias("title"),
        text_at(v, "$.url").alias("url"),
        text_at(v, "$.by").alias("author"),
        epoch_to_iso(text_at(v, "$.time")).alias("published_at"),
        whole_at(v, "$.score").alias("score"),
        F.coalesce(whole_at(v, "$.descendants"), F.lit(0)).alias("comments_count"),
        F.coalesce(
            F.try_variant_get(v, "$.kids", "array<bigint>"), F.array().cast("array<bigint>")
        ).alias("kids"),
        text_at(v, "$.text").alias("text"),
    )


def seed_stories(
    raw_seeds: DataFrame, nodes: DataFrame, limit: int | None = None
) -> DataFrame:
    """Landed id lists ``(source_id, run_id, body)`` joined to their stories.

    ``limit`` reads the first ids of each list only.
    """
    ids = F.from_json("body", "array<bigint>")
    if limit is not None:
        ids = F.slice(ids, 1, limit)
    seeds = raw_seeds.select(
        "source_id", "run_id", F.posexplode(ids).alias("seed_pos", "node_id")
    )
    stories = nodes.where((F.col("type") == "story") & (F.col("title") != ""))
    discussion = F.concat(F.lit(DISCUSSION_URL), F.col("node_id").cast("string"))
    return seeds.join(stories.drop("type", "text"), "node_id").select(
        "source_id", "run_id", "seed_pos", "node_id", "title",
        F.coalesce(filled(F.col("url")), discussion).alias("url"),
        "published_at", "author", "score", "comments_count",
        discussion.alias("discussion_url"), "kids",
    )


def _queue_kids(comments: Column, level_size: Column, taken: Column, limit: int) -> Column:
    """How many kids of each comment of one level still enter the queue.

    ``comments`` holds (place in the level, number of kids) in reading order.
    A kid is queued only while the comments read plus the nodes waiting are
    fewer than ``limit``; waiting nodes include those that turn out to be no
    comments.
    """
    empty = F.struct(
        F.array().cast("array<bigint>").alias("quota"), F.lit(0).cast("bigint").alias("queued")
    )

    def step(acc: Column, c: Column) -> Column:
        read = taken + F.size(acc["quota"]) + 1
        waiting = level_size - c["place"] - 1 + acc["queued"]
        room = F.greatest(F.lit(0).cast("bigint"), F.lit(limit) - read - waiting)
        quota = F.least(c["kids"].cast("bigint"), room).cast("bigint")
        return F.struct(
            F.concat(acc["quota"], F.array(quota)).alias("quota"),
            (acc["queued"] + quota).cast("bigint").alias("queued"),
        )

    return F.aggregate(comments, empty, step)["quota"]


def comment_lookup(nodes: DataFrame) -> DataFrame:
    """Comments by id, dealt and sorted once and written.

    A checkpoint keeps the partitioning that it was written with, so each level
    of a walk sends its few nodes to the lookup's partitions and the lookup
    itself is never shuffled or sorted again. Only a plan that is fixed before
    it runs tells its partitioning; ids are unique, so there is no skew to
    adapt to.
    """
    conf = nodes.sparkSession.conf
    slim = nodes.where("type = 'comment'").select("node_id", "kids")
    dealt = slim.repartition(int(conf.get("spark.sql.shuffle.partitions")), "node_id")
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return dealt.sortWithinPartitions("node_id").checkpoint()
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def thread_comments(
    stories: DataFrame, nodes: DataFrame, limit: int = COMMENT_LIMIT, budget: bool = True
) -> DataFrame:
    """Breadth-first comments of each story, at most ``limit``.

    ``stories`` is ``(story_id, kids)``, ``nodes`` is ``(node_id, type, kids,
    ...)`` with one row per node. One join per level of the tree: at most
    ``limit`` nodes per story can still matter, so a level stays small however
    large a thread is. Each level is checkpointed, and the walk ends when no
    story has a node left. With ``budget`` nodes that are no comments use up
    queue room as they do when a queue of that size is kept; without it, they
    are only skipped.
    """
    spark = stories.sparkSession
    ensure_checkpoint_dir(spark)
    lookup = comment_lookup(nodes)

    # Waiting nodes of the level with their place and the size of the level.
    frontier = stories.select(
        "story_id",
        F.lit(0).cast("bigint").alias("taken"),
        F.size("kids").cast("bigint").alias("level_size"),
        F.posexplode("kids").alias("place", "node_id"),
    ).withColumn("place", F.col("place").cast("bigint"))
    collected = None
    depth = 1
    while True:
        comments = frontier.join(lookup, "node_id")
        room = Window.partitionBy("story_id").orderBy("place")
        read = (
            comments.withColumn("nth", F.row_number().over(room))
            .where(F.col("nth") <= limit)
            .where(F.col("nth") + F.col("taken") <= limit)
        ).checkpoint()
        part = read.select(
            "story_id", "node_id", (F.col("taken") + F.col("nth")).cast("int").alias("comment_pos"),
            F.lit(depth).alias("depth"),
        )
        collected = part if collected is None else collected.unionByName(part)
        # At most ``limit`` rows per story reach this grouping.
        level = read.groupBy("story_id", "taken", "level_size").agg(
            F.array_sort(
                F.collect_list(
                    F.struct("place", F.size("kids").alias("kids"), F.slice("kids", 1, limit).alias("ids"))
                )
            ).alias("c")
        )
        read_now = F.col("taken") + F.size("c")
        if budget:
            quota = _queue_kids(F.col("c"), F.col("level_size"), F.col("taken"), limit)
        else:
            quota = F.transform("c", lambda c: F.size(c["ids"]).cast("bigint"))
        queued = F.flatten(
            F.zip_with(
                F.col("c"), F.col("quota"), lambda c, q: F.slice(c["ids"], F.lit(1), q.cast("int"))
            )
        )
        frontier = (
            level.select("story_id", read_now.cast("bigint").alias("total"), "c", quota.alias("quota"))
            .where(F.col("total") < limit)
            .select("story_id", F.col("total").alias("taken"), queued.alias("queued"))
            .where(F.size("queued") > 0)
            .select(
                "story_id",
                "taken",
                F.size("queued").cast("bigint").alias("level_size"),
                F.posexplode("queued").alias("place", "node_id"),
            )
            .withColumn("place", F.col("place").cast("bigint"))
        )
        depth += 1
        if depth > limit or frontier.isEmpty():
            return collected


def comment_rows(comments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Author, date and plain text of collected comments."""
    text = F.coalesce(filled(F.col("text")), F.lit(DELETED))
    bodies = nodes.select("node_id", "author", "published_at", "text")
    return comments.join(bodies, "node_id").select(
        "story_id", "comment_pos", "author", "published_at",
        F.when(text == DELETED, text).otherwise(strip_markup(text)).alias("text"),
    )


def story_items(
    raw_seeds: DataFrame,
    raw_items: DataFrame,
    seed_limit: int | None = None,
    story_limit: int = STORY_LIMIT,
    comment_limit: int = COMMENT_LIMIT,
) -> DataFrame:
    """The most discussed stories with their first comments attached."""
    nodes = parse_nodes(raw_items)
    stories = top_per_group(
        seed_stories(raw_seeds, nodes, seed_limit),
        ["source_id", "run_id"],
        [F.desc("comments_count"), F.asc("seed_pos")],
        story_limit,
        rank="rank",
    )
    keyed = stories.select(F.col("node_id").alias("story_id"), "kids").dropDuplicates(["story_id"])
    comments = comment_rows(thread_comments(keyed, nodes, comment_limit), nodes)
    # At most ``comment_limit`` rows per story.
    lists = comments.groupBy(F.col("story_id").alias("node_id")).agg(
        F.transform(
            F.array_sort(
                F.collect_list(F.struct("comment_pos", "author", "published_at", "text"))
            ),
            lambda c: F.struct(
                c["author"].alias("author"),
                c["published_at"].alias("published_at"),
                c["text"].alias("text"),
            ),
        ).alias("comments")
    )
    return stories.join(lists, "node_id", "left").select(
        "source_id", "run_id", F.col("seed_pos").cast("bigint").alias("item_pos"),
        "title", "url", "published_at", "author", "score", "comments_count", "rank",
        "discussion_url",
        F.coalesce(
            "comments",
            F.array().cast("array<struct<author:string,published_at:string,text:string>>"),
        ).alias("comments"),
        F.create_map().cast("map<string,string>").alias("extra"),
    )
