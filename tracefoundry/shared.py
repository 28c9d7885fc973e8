"""Tables between the rounds of an iterative plan, and a join that very common keys do not pile up in."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: set[str] = set()

#: A key is very common if it has more than one part in HOT of a shuffle partition's mean rows.
HOT = 4


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


def folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session that names none gets a folder in ``/tmp/checkpoints``,
    which goes when Python ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        own = f"/tmp/checkpoints/{spark.sparkContext.applicationId}-core"
        if own not in _own:
            _own.add(own)
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        return f"file://{own}/{name}-{uuid.uuid4().hex}"
    return f"{named.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: the lineage ends, a lost executor costs a re-read."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def remove(*tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_written_path", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread_join(rows: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``one``, a row per ``key``; rows of very common keys are dealt evenly.

    Very common keys are at most HOT for each shuffle partition whatever the
    input, so their rows of ``one`` are broadcast; the others are joined by
    key.  A null key has no partner.  Both sides are read twice, so they should be tables.
    """
    total = rows.count()
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    hot = counts.where(F.col("__n") * (HOT * width(rows.sparkSession)) > total).select(key, F.lit(True).alias("__hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    common = one.join(F.broadcast(hot.drop("__hot")), key, "left_semi")
    often = marked.where("__hot").drop("__hot").join(F.broadcast(common), key, how)
    rest = marked.where("__hot is null").drop("__hot").join(one, key, how)
    return often.unionByName(rest)
