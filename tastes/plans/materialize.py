"""Cut lineage by writing a table into the session's checkpoint folder.

`materialize` writes a copy for one run. `materialize_files` keeps the copy of
parsed input files from run to run: its name holds a digest of the files' paths,
lengths and modification times, so unchanged files are not parsed again, and
the copies of an earlier state are deleted.

A copy may have a `Placement`: its rows lie in buckets, and plans over it start
from that placement instead of an exchange.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastes.session import CHECKPOINT_DIR_CONF, checkpoint_dir


@dataclass(frozen=True)
class Placement:
    """Distinct rows in `buckets` buckets by the hash of the `columns`.

    Buckets by all columns spread any hot key, and duplicate removal over the copy
    needs no exchange. Buckets by one key column spare the exchange of joins and
    aggregations by that key too, but a hot key's rows are one bucket and one task:
    only for keys that are known to be even.
    """

    columns: tuple[str, ...]
    buckets: int

    def __post_init__(self) -> None:
        if not self.columns or self.buckets < 1:
            raise ValueError("a placement needs columns and at least one bucket")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write `df` as parquet under `spark.checkpoint.dir` and read it back.

    The copy lives in the shared folder the cluster names, so a lost
    executor re-reads it instead of recomputing the lineage, and later
    scans prune columns and push filters into parquet. Without a configured
    checkpoint folder the plan is returned unchanged.

    Each call writes under a new unique folder, so a re-run never collides
    with an earlier, possibly half-written copy; the copies stay for the
    cluster's retention policy of that folder, as Spark's own checkpoints do.
    """
    base = checkpoint_dir(spark)
    if not base:
        return df
    path = f"{base.rstrip('/')}/tastes-{uuid.uuid4().hex}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def files_digest(spark: SparkSession, directory: str, glob: str) -> str:
    """A digest of the paths, lengths and modification times of the files in `directory`.

    One aggregation over Spark's own file listing, one row back; file contents
    are not selected, so they are never read.
    """
    file = (F.col("path"), F.col("length"), F.col("modificationTime").cast("string"))
    row = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(directory)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.bit_xor(F.xxhash64(*file)).alias("hashes"),
            F.bit_xor(F.xxhash64(F.reverse("path"), *file[1:])).alias("others"),
        )
        .first()
    )
    return hashlib.sha256(repr(tuple(row)).encode()).hexdigest()[:32]


def materialize_files(
    spark: SparkSession,
    directory: str,
    glob: str,
    name: str,
    parse: Callable[[], DataFrame],
    base: str | None = None,
    placement: Placement | None = None,
) -> DataFrame:
    """`parse()` of the files in `directory`, as a parquet copy that outlives the run.

    The copy lies in `base`, by default the folder of `spark.checkpoint.dir`
    itself, not the subfolder of one application. It is written beside its place and then
    renamed, so a copy with its final name is whole; of two runs at once the
    first one's copy stays. Copies of other states of the same folder are
    deleted: do not change files under a run that still reads them. Without a
    checkpoint folder the plan is returned unchanged.

    With a `placement` the copy has the distinct rows, in its buckets, and the
    session's catalog gets a table over the folder. Copies of another placement
    count as copies of another state.
    """
    base = base or spark.conf.get(CHECKPOINT_DIR_CONF, None) or checkpoint_dir(spark)
    if not base:
        return parse()
    directory = directory.strip().rstrip("/")
    family = f"tastes-{name}-{hashlib.sha256(directory.encode()).hexdigest()[:16]}"
    digest = files_digest(spark, directory, glob)
    if placement:
        digest = hashlib.sha256(f"{digest}{placement}".encode()).hexdigest()[:32]
    place = f"{base.rstrip('/')}/{family}-{digest}"

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(place).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parsed = parse()
    if not fs.exists(path(place)):
        written = f"{base.rstrip('/')}/writing-{uuid.uuid4().hex}"
        if placement:
            _write_placed(spark, parsed, written, placement)
        else:
            parsed.write.mode("errorifexists").parquet(written)
        if fs.exists(path(place)) or not fs.rename(path(written), path(place)):
            fs.delete(path(written), True)
    for other in fs.globStatus(path(f"{base.rstrip('/')}/{family}-*")) or []:
        if other.getPath().getName() != f"{family}-{digest}":
            old = f"{base.rstrip('/')}/{other.getPath().getName()}"
            spark.sql(f"DROP TABLE IF EXISTS `{table_name(old)}`")
            fs.delete(other.getPath(), True)
    if placement:
        return _placed(spark, parsed, place, placement)
    return spark.read.schema(parsed.schema).parquet(place)


def table_name(place: str) -> str:
    """The catalog's name of the table over a copy's folder, one for each path."""
    folder = place.rsplit("/", 1)[1].replace("-", "_")
    return f"{folder}_{hashlib.sha256(place.encode()).hexdigest()[:8]}"


def _write_placed(spark: SparkSession, df: DataFrame, path: str, placement: Placement) -> None:
    """The distinct rows of `df` in buckets: one shuffle, one file a bucket."""
    name = f"writing_{uuid.uuid4().hex}"
    placed = df.repartition(placement.buckets, *placement.columns).distinct()
    placed.write.format("parquet").mode("errorifexists").option("path", path).bucketBy(
        placement.buckets, *placement.columns
    ).saveAsTable(name)
    # The table has a path of its own, so dropping it leaves the files.
    spark.sql(f"DROP TABLE {name}")


def _placed(spark: SparkSession, parsed: DataFrame, place: str, placement: Placement) -> DataFrame:
    """The copy at `place` as a table that knows its buckets."""
    name = f"`{table_name(place)}`"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema)
    columns = ", ".join(f"`{c}`" for c in placement.columns)
    location = place.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
        f"CLUSTERED BY ({columns}) INTO {placement.buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)
