"""The registered sources, in registry order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.schemas import SOURCE

RANKED, ARCHIVE = "aggregation", "blog"

#: Sources up to which the dimension is sent to every task (about 2 MB).
MOST_SOURCES = 10_000

# Id, name, kind, method and how many entries of a payload are
# read (None reads all). The order decides ties between equal archive stamps.
SOURCES = [
    ("hn", "Hacker News", RANKED, "api", 20),
    ("lobsters", "Lobsters", RANKED, "api", 25),
    ("releasebot", "Releasebot", RANKED, "api", 10),
    ("hf-papers", "Hugging Face Papers", RANKED, "api", 15),
    ("github-trending", "GitHub Trending", RANKED, "api", 20),
    ("product-hunt", "Product Hunt", RANKED, "rss", 20),
    ("skills-sh-trending", "Skills.sh Trending (24h)", RANKED, "html", 30),
    ("skills-sh-hot", "Skills.sh Hot", RANKED, "html", 30),
    ("01-me", "01.me", ARCHIVE, "rss", None),
    ("antirez", "antirez", ARCHIVE, "rss", None),
    ("ben-evans", "Ben Evans", ARCHIVE, "rss", None),
    ("founders-fund-anatomy", "Founders Fund Anatomy of Next", ARCHIVE, "api", None),
    ("fs-blog", "Farnam Street", ARCHIVE, "rss", None),
    ("claude-blog", "Claude Blog", ARCHIVE, "html", 20),
    ("gwern-changelog", "Gwern Changelog", ARCHIVE, "rss", None),
    ("hf-blog", "Hugging Face Blog", ARCHIVE, "rss", None),
    ("huyen-chip", "Huyen Chip", ARCHIVE, "rss", None),
    ("latent-space", "Latent Space", ARCHIVE, "rss", None),
    ("lilian-weng", "Lilian Weng", ARCHIVE, "rss", None),
    ("lucumr", "Lars (lucumr)", ARCHIVE, "rss", None),
    ("openai-dev-blog", "OpenAI Developers Blog", ARCHIVE, "html", 20),
    ("openai-news", "OpenAI News", ARCHIVE, "rss", None),
    ("paul-graham", "Paul Graham", ARCHIVE, "rss", 30),
    ("pragmatic-engineer", "Pragmatic Engineer", ARCHIVE, "rss", None),
    ("simon-willison", "Simon Willison", ARCHIVE, "rss", None),
    ("sorrycc", "sorrycc", ARCHIVE, "rss", None),
    ("stratechery", "Stratechery", ARCHIVE, "rss", None),
    ("trends-vc", "Trends.vc", ARCHIVE, "rss", None),
    ("lennys-newsletter", "Lenny's Newsletter", ARCHIVE, "rss", None),
    ("mailchimp-archive", "Mailchimp Archive", ARCHIVE, "rss", None),
    ("crunchbase-news", "Crunchbase News", ARCHIVE, "rss", None),
    ("techmeme", "Techmeme", ARCHIVE, "rss", None),
    ("vercel-blog", "Vercel Blog", ARCHIVE, "rss", 40),
    ("alphasignal-last-email", "AlphaSignal Last Email", ARCHIVE, "agent", None),
]


def checked_small(table: DataFrame, most: int = MOST_SOURCES) -> DataFrame:
    """A source dimension that joins never shuffle the other side for.

    At most ``most`` rows are read once and marked for broadcast, whatever the
    size statistics of ``table`` say. A larger table stays as it is and its
    joins are Spark's choice.
    """
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))


def source_rows(disabled: frozenset[str] = frozenset()) -> list[tuple]:
    return [
        (pos, sid, name, kind, method, sid not in disabled, limit)
        for pos, (sid, name, kind, method, limit) in enumerate(SOURCES)
    ]


def sources(
    spark: SparkSession,
    include_disabled: bool = True,
    disabled: frozenset[str] = frozenset(),
) -> DataFrame:
    """The source dimension; small by construction."""
    table = F.broadcast(spark.createDataFrame(source_rows(disabled), SOURCE))
    return table if include_disabled else table.where("enabled")


def get_source(source_id: str) -> dict:
    """One source as a dict; an unknown id fails before any job starts."""
    for row in source_rows():
        if row[1] == source_id:
            return dict(zip(SOURCE.names, row, strict=True))
    raise KeyError(f"no source is registered as {source_id!r}")


def item_limit(source_id: str) -> int | None:
    return get_source(source_id)["item_limit"]


def source_listing(table: DataFrame) -> DataFrame:
    """What a listing of sources shows, in registry order."""
    line = F.concat(
        F.format_string("- %s (%s, %s)", "source_id", "kind", "method"),
        F.when(F.col("enabled"), F.lit("")).otherwise(F.lit(" [disabled]")),
    )
    return table.select(
        "source_id", "source_name", "kind", "method", "enabled", line.alias("line")
    ).orderBy(*([F.col("source_pos")] if "source_pos" in table.columns else []))
