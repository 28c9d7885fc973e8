"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])

_own: set[str] = set()

#: Java regular expression class of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, have]))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session that names none gets a folder in ``/tmp/checkpoints``,
    which goes when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        own = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
        if own not in _own:
            _own.add(own)
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        return f"file://{own}"
    return f"{named.rstrip('/')}/{spark.sparkContext.applicationId}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` is ``value`` inside, and afterwards what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def cut(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    The lineage ends there, so a lost executor costs a re-read and no more;
    the shuffle files of the write go when it is done.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(*tables: DataFrame) -> None:
    """Remove tables of :func:`cut` that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_cut_path", None):
            _remove(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Remove every table of :func:`cut` of this application, once its results are written elsewhere."""
    _remove(spark, shared_dir(spark))


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit(key, salt: int = 0):
    """Column in (0, 1): a hash of ``key``, the same in every run."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(salt), key), 11).cast("double") + 0.5) / float(2**53)


#: Spark builds a Bloom filter from a side only if that side has a predicate; this one holds for every doc_id.
FILTERED = "doc_id >= -9223372036854775807L - 1L"


def bloom_filters(spark: SparkSession):
    """Inside, joins of a large scan with few rows end the other rows in the scan, whatever the scan's size.

    With more rows than Spark puts into a Bloom filter, joins are plain ones.
    """
    return setting(spark, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")


def narrowed(rows: DataFrame, ids: DataFrame, on: list[str], name: str) -> DataFrame:
    """Rows of a large table whose ``on`` columns are among those of ``ids``, as a table, by a Bloom-filtered semi-join."""
    with bloom_filters(rows.sparkSession):
        least = F.lit(-(2**63)).cast("long")
        return cut(rows.join(ids.where(F.col(on[0]) >= least), on, "left_semi"), name)


#: A key is very common if it has more than one part in HOT of a task's mean rows, so HOT keys a task at most are.
HOT = 4


def spread_join(rows: DataFrame, one: DataFrame, on: list[str], times: str, total: int, how: str = "left", idle: Column | None = None) -> DataFrame:
    """``rows`` joined with ``one``, of which no task gets all rows of a very common key.

    ``one`` has a row per key ``on``; its column ``times``, never null, says how
    many of the ``total`` rows have the key.  Very common keys are at most
    HOT for each shuffle partition whatever the input, so their rows of ``one``
    are broadcast, and the rows that meet them are dealt evenly, as are ``idle``
    ones, which have no partner.  ``rows`` and ``one`` are read from tables, so
    that a task that runs again deals the same.
    """
    spark = rows.sparkSession
    hot = one.where(F.col(times) * (HOT * width(spark)) > total)
    if idle is None and hot.isEmpty():
        return rows.join(one, on, how)
    values = [c for c in one.columns if c not in on]
    met = rows.join(F.broadcast(hot.select(*on, F.struct(*values).alias("__hot"))), on, "left")
    even = F.col("__hot").isNotNull() | (F.lit(False) if idle is None else idle)
    # a key's own salt is no constant, which the optimiser would take out of the join's keys
    met = met.withColumn("__salt", F.when(even, F.monotonically_increasing_id()).otherwise(F.xxhash64(*on)))
    cold = one.select(*on, F.xxhash64(*on).alias("__salt"), F.struct(*values).alias("__cold"))
    met = met.join(cold, [*on, "__salt"], "left").withColumn("__one", F.coalesce("__hot", "__cold"))
    met = met if how == "left" else met.where("__one is not null")
    return met.select(*rows.columns, *(F.col("__one")[c].alias(c) for c in values))
