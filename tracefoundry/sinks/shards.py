"""JSON lines in sorted shards with a manifest, in one pass.

Each task writes its shard to a staging folder and reports rows, skipped rows,
bytes and a digest; the commit on the driver moves the shards into place and
writes the manifest, an abort removes the staging folder.  So a folder holds a
whole run or what it held before, and a manifest that agrees with the shards.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shared import ship

MANIFEST = "_manifest.json"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; local paths may come without a scheme."""
    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return pafs.FileSystem.from_uri(path)


@dataclass
class Shard(WriterCommitMessage):
    partition: int
    staged: str
    rows: int
    skipped: int
    bytes: int
    sha256: str


class JsonlShards(DataSource):
    """Format ``jsonl_shards``: rows (value string); null values are counted as skipped.  Option: ``path``, a URI."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_shards"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(self.options["path"], overwrite)


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"
        # made here and not by tasks: one that goes on after an abort finds no folder to write to
        files, folder = _opened(self.staging)
        files.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{task.partitionId()}-{task.taskAttemptId()}"
        files, folder = _opened(self.staging)
        staged, rows, skipped, size, digest = f"{folder}/{name}", 0, 0, 0, hashlib.sha256()
        try:
            with files.open_output_stream(staged) as out:
                for batch in iterator:
                    column = batch.column("value")
                    values = column.drop_null().to_pylist()
                    rows, skipped = rows + len(values), skipped + column.null_count
                    block = "".join(f"{v}\n" for v in values).encode()
                    size += len(block)
                    digest.update(block)
                    out.write(block)
        except BaseException:
            if files.get_file_info(staged).type != pafs.FileType.NotFound:
                files.delete_file(staged)
            raise
        return Shard(task.partitionId(), f"{self.staging}/{name}", rows, skipped, size, digest.hexdigest())

    def commit(self, messages: list) -> None:
        files, folder = _opened(self.path)
        files.create_dir(folder, recursive=True)
        old = read_manifest(self.path)
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{self.path} holds shards already")
        # a shard without rows is none; names ascend with the partitions, and so with the order
        kept = sorted((m for m in messages if m and m.rows), key=lambda m: m.partition)
        run = uuid.uuid4().hex[:8]
        shards = [{"name": f"part-{i:05d}-{run}.jsonl", "rows": m.rows, "bytes": m.bytes, "sha256": m.sha256} for i, m in enumerate(kept)]
        for shard, message in zip(shards, kept):
            files.move(_opened(message.staged)[1], f"{folder}/{shard['name']}")
        told = {"rows": sum(m.rows for m in kept), "skipped": sum(m.skipped for m in messages if m), "shards": shards}
        # readers go by the manifest: once it is there, the new shards count and the old ones do not
        with files.open_output_stream(f"{folder}/{MANIFEST}.{run}") as out:
            out.write(json.dumps(told, indent=1).encode())
        files.move(f"{folder}/{MANIFEST}.{run}", f"{folder}/{MANIFEST}")
        for shard in (old or {"shards": []})["shards"]:
            files.delete_file(f"{folder}/{shard['name']}")
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        files, folder = _opened(self.staging)
        if files.get_file_info(folder).type != pafs.FileType.NotFound:
            files.delete_dir(folder)


def read_manifest(path: str) -> dict | None:
    files, folder = _opened(path)
    if files.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.NotFound:
        return None
    with files.open_input_stream(f"{folder}/{MANIFEST}") as source:
        return json.loads(source.read())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the session's file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    text = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return text.replace("file:/", "file:///", 1) if text.startswith("file:/") and not text.startswith("file://") else text


def write_shards(lines: DataFrame, path: str, order: list[str], shards: int | None = None) -> dict:
    """Write ``value`` of ``lines`` in order of the columns ``order``; returns the manifest.

    Shards are ranges of the order, so reading them by name gives all rows
    sorted.  Null values are skipped and counted.  Shards already there are replaced.
    """
    spark = lines.sparkSession
    ship(spark)
    spark.dataSource.register(JsonlShards)
    rows = lines.repartitionByRange(*([shards] if shards else []), *order).sortWithinPartitions(*order) if order else lines
    where = qualified(spark, path)
    rows.select("value").write.format("jsonl_shards").mode("overwrite").save(where)
    return read_manifest(where) or {"rows": 0, "skipped": 0, "shards": []}


def joined(spark: SparkSession, path: str, target: str) -> None:
    """The shards of ``path`` as one file ``target``, copied block by block on the driver, for sets that a person reads."""
    told = read_manifest(qualified(spark, path)) or {"shards": []}
    files, folder = _opened(qualified(spark, path))
    _, out_path = _opened(qualified(spark, target))
    files.create_dir(out_path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(out_path) as out:
        for shard in told["shards"]:
            with files.open_input_stream(f"{folder}/{shard['name']}") as source:
                while block := source.read(8 << 20):
                    out.write(block)
    files.delete_dir(folder)
