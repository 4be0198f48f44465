"""Helpers shared by the operators: tables, scratch tables, column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastes.session import checkpoint_dir, ensure_checkpoint_dir

# A word is a run of characters other than these ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"

BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "2m"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Let Python workers get rows by batches of bounded bytes.

    Spark's default counts rows only, so a batch of texts is all of a task's and
    stands in the executor and in the worker, as Arrow and as objects, several times.
    A session that names its own bound keeps it. Results that are computed after
    the operator has returned need it too, so it stays set.
    """
    if spark.conf.get(BATCH_BYTES_CONF, None) is None:
        spark.conf.set(BATCH_BYTES_CONF, BATCH_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a temporary one only in local sessions.

    There driver and executors are the same machine. On a cluster every
    executor would write to its own disk, so a missing setting is an error.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="llm-shared-"))


class Scratch:
    """Tables written in the shared folder to cut lineage.

    A reread table costs no recomputation when an executor is lost, and a
    scan below a join leaves both sides as plain exchanges, which adaptive
    execution can split when a key is hot.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` as Parquet and read it again."""
        df.write.mode("error").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table of this scratch folder that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lowered; splits on exactly the ASCII blanks."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def remainder(column, modulus: int):
    """crc32 of an id's decimal text, modulo `modulus` (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def with_type(df: DataFrame, column: str, kind: T.DataType):
    """`column` of `df`, or a null of that type where the table lacks it."""
    return F.col(column) if column in df.columns else F.lit(None).cast(kind).alias(column)


def free_name(name: str, taken) -> str:
    """`name`, with underscores in front until no column of `taken` is called so."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name
