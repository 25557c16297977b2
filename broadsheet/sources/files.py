"""Readers for a landed archive folder.

Layout: ``sources/<id>/manifest.jsonl``, ``sources/<id>/snapshots/<day>.json``,
``sources/<id>/items/<item>/content.md`` and ``.../meta.json``. The driver lists
the sources only; what lies below each is listed by tasks. Manifests are read
in splits and their lines numbered across them. Small files are read as bytes.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.text import strip
from broadsheet.operators import audit as rules
from broadsheet.operators.records import explode_snapshots
from broadsheet.schemas import MANIFEST_ROW

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.threshold"


@contextmanager
def _listed_by_tasks(spark: SparkSession):
    """Each folder that a reader is given is listed in a task, however few they are."""
    kept = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, "0")
    try:
        yield
    finally:
        spark.conf.set(_LISTING, kept)


def _folders(spark: SparkSession, root: str, below: str = "") -> list[str]:
    """``sources/<id><below>`` of the sources that have it; one level is listed here."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(f"{root}/sources")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    paths = [s.getPath() for s in fs.listStatus(base) if s.isDirectory()]
    if below:
        paths = [hadoop.Path(p, below) for p in paths]
        paths = [p for p in paths if fs.exists(p)]
    return [p.toString() for p in paths]


def _files(spark: SparkSession, root: str, below: str, name: str) -> DataFrame:
    """Files called ``name`` anywhere under ``sources/<id>/<below>``, as bytes."""
    folders = _folders(spark, root, below)
    schema = "path string, content binary"
    if folders:
        with _listed_by_tasks(spark):
            read = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .option("pathGlobFilter", name)
                .load(folders)
            )
    else:
        read = spark.createDataFrame([], schema)
    return read.select(_relative(F.col("path")).alias("path"), "content").withColumn(
        "source_id", F.split_part("path", F.lit("/"), F.lit(2))
    )


def _relative(path):
    return F.regexp_extract(path, r"/(sources/[^/]+/(?:manifest\.jsonl|snapshots/[^/]+|items/.*))$", 1)


def manifest_lines(spark: SparkSession, root: str) -> DataFrame:
    """Non-blank manifest lines ``(source_id, path, file_issue, line_no, line)``.

    A manifest of any size is read by as many tasks as it has splits. A split
    counts its lines, the counts of the splits before it are added up, and a
    line's number is its place in its split after them: no line is shuffled. A
    file with a line that is no UTF-8, or without a line, gives one row with
    ``file_issue``. Lines end at ``\\n`` only; a byte order mark is skipped.
    """
    manifests = _folders(spark, root, "manifest.jsonl")
    if not manifests:
        return spark.createDataFrame(
            [], "source_id string, path string, file_issue string, line_no bigint, line string"
        )
    with _listed_by_tasks(spark):
        read = spark.read.option("lineSep", "\n").text(manifests)
    path = F.regexp_extract(F.url_decode("_metadata.file_path"), r"/(sources/[^/]+/manifest\.jsonl)$", 1)
    valid = F.is_valid_utf8(F.col("value"))
    rows = (
        read.select(
            path.alias("path"), F.col("_metadata.file_block_start").alias("split"),
            valid.alias("valid"), F.col("value").alias("line"),
        )
        .where(~F.col("valid") | (strip(F.col("line")) != ""))
        # Rising within a split, whose lines one task reads one after the other.
        .withColumn("place", F.monotonically_increasing_id())
    )
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    # One row a split.
    splits = (
        rows.groupBy("path", "split")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.min("valid").alias("valid"))
        .withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("sound", F.min("valid").over(whole))
    )
    numbered = rows.drop("valid").join(
        splits.where("sound").select("path", "split", "first", "earlier"), ["path", "split"]
    )
    lines = numbered.select(
        "path",
        F.lit(None).cast("string").alias("file_issue"),
        (F.col("place") - F.col("first") + F.col("earlier") + 1).alias("line_no"),
        "line",
    )
    # As many rows as there are sources.
    ids = [(p.rsplit("/", 2)[1],) for p in manifests]
    named = spark.createDataFrame(ids, "source_id string").select(
        F.concat(F.lit("sources/"), "source_id", F.lit("/manifest.jsonl")).alias("path")
    )
    files = splits.groupBy("path").agg(F.min("valid").alias("valid"))
    faulty = named.join(files, "path", "left").where("valid is null or not valid").select(
        "path",
        F.when(F.col("valid").isNull(), "manifest_empty").otherwise("manifest_bad_utf8").alias("file_issue"),
        F.lit(None).cast("bigint").alias("line_no"),
        F.lit(None).cast("string").alias("line"),
    )
    both = lines.unionByName(faulty)
    return both.withColumn("source_id", F.split_part("path", F.lit("/"), F.lit(2)))


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    return _files(spark, root, "snapshots", "*.json")


def _item_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _files(spark, root, "items", name).withColumn(
        "item_id", F.split_part("path", F.lit("/"), F.lit(4))
    )


def bodies(spark: SparkSession, root: str) -> DataFrame:
    return _item_files(spark, root, "content.md").withColumnRenamed("path", "content_path")


def metas(spark: SparkSession, root: str) -> DataFrame:
    return _item_files(spark, root, "meta.json")


def layout(spark: SparkSession, root: str) -> DataFrame | None:
    """Source folders, whether they have a manifest, and their snapshot counts.

    None when there is no store. Names of snapshots stay in the tasks.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(f"{root}/sources")
    if not base.getFileSystem(spark._jsc.hadoopConfiguration()).exists(base):
        return None
    held = {p.rsplit("/", 2)[1] for p in _folders(spark, root, "manifest.jsonl")}
    names = [p.rsplit("/", 1)[1] for p in _folders(spark, root)]
    rows = [(n, f"sources/{n}", int(n in held)) for n in names]
    found = snapshot_files(spark, root).groupBy("source_id").agg(
        F.count(F.lit(1)).cast("int").alias("snapshots")
    )
    folders = spark.createDataFrame(rows, "source_id string, path string, manifests int")
    return folders.join(found, "source_id", "left").fillna(0, ["snapshots"])


def manifest_items(spark: SparkSession, root: str) -> DataFrame:
    """Manifest rows in file order; a line that is no JSON object raises."""
    row = F.from_json("line", MANIFEST_ROW, {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    return (
        manifest_lines(spark, root)
        .where("file_issue is null")
        .select("source_id", (F.col("line_no") - 1).alias("item_pos"), row.alias("r"))
        .select("source_id", "item_pos", *[
            f"r.{name}" for name in MANIFEST_ROW.names if name != "source_id"
        ])
    )


def snapshot_rows(spark: SparkSession, root: str) -> DataFrame:
    """One row per snapshot entry of a landed archive."""
    documents = snapshot_files(spark, root).select(
        "source_id", F.decode("content", "UTF-8").alias("body")
    )
    return explode_snapshots(documents)


def audit_folder(
    spark: SparkSession,
    root: str,
    source_ids: list[str] | None = None,
    min_content_chars: int = rules.MIN_CHARS,
    include_snippets: bool = False,
) -> DataFrame:
    """The frame of all audit rules over a landed archive."""
    folders = layout(spark, root)
    if folders is None:
        return rules.missing_root(spark, f"{root}/sources")
    return rules.audit(
        manifest_lines=manifest_lines(spark, root),
        contents=bodies(spark, root).select("content_path", "content"),
        metas=metas(spark, root).select("source_id", "item_id", "content"),
        snapshot_files=snapshot_files(spark, root),
        layout=folders,
        source_ids=source_ids,
        min_content_chars=min_content_chars,
        include_snippets=include_snippets,
    )
