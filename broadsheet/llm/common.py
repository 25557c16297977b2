"""What the operators share: reading, row ids, shared scratch tables, words."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import configure, ensure_checkpoint_dir

#: Internal row number. Rows may share a doc_id or have none, so no operator
#: uses doc_id as the identity of a row.
UID = "__uid"

_scratch: list[str] = []
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators; their code goes to the Python workers."""
    configure(spark)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send this package with the job, so that no executor needs it installed.

    The archive is made on the driver; Spark hands it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parents[1]
    path = f"{tempfile.mkdtemp(prefix='broadsheet-code-')}/{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def with_uid(df: DataFrame) -> DataFrame:
    """Number the rows; to be used within one plan or before a written table."""
    return df.withColumn(UID, F.monotonically_increasing_id())


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs its running tasks only, and row numbers stay.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    return len(_scratch)


def take_scratch(since: int) -> list[str]:
    """Hand over the scratch tables written after ``since``."""
    taken = _scratch[since:]
    del _scratch[since:]
    return taken


def release(spark: SparkSession, tables: list[str]) -> None:
    """Delete scratch tables; their readers must be done."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in tables:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []
