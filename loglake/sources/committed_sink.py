"""A sink whose files count once the whole write has: a Python data source writer with commit and abort.

Tasks write Parquet files, one per topic partition that they hold (or one, of rows without these columns), under names that
no other attempt uses, and report them. Only when every task has ended well does ``commit`` name them in a manifest, one small
file that appears whole: ``<root>/_committed/<id>.json``. Files of failed tasks, of lost attempts and of writes that were
given up are named nowhere and so do not count; ``abort`` removes those it hears of, ``sweep`` the rest. A batch of a stream
that is run again after a restart replaces the manifest of its first attempt.

Files are opened with Arrow's file systems (local, HDFS, S3, GCS); ``read_committed`` is an ordinary Spark read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from loglake.session import delete_path, file_system, path_exists, register_source

NAME = "loglake_sink"
OPEN_FILES = 64  # of a task; the one that waited longest is closed first
MANIFEST = "file string, rows bigint, topic string, partition int, min_offset bigint, max_offset bigint"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class _Files:
    """The files that one task writes."""

    def __init__(self, root: str):
        self.fs, self.root = _opened(root)
        self.folder = f"files/{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/{self.folder}")
        self.open: dict[tuple, tuple[pq.ParquetWriter, dict]] = {}
        self.done: list[dict] = []

    def write(self, key: tuple, batch: pa.RecordBatch) -> None:
        writer, about = self.open.pop(key, (None, None))
        if writer is None:
            if len(self.open) >= OPEN_FILES:
                self._close(next(iter(self.open)))
            name = f"{self.folder}/{len(self.done) + len(self.open)}-{uuid.uuid4().hex[:8]}.parquet"
            about = {"file": name, "rows": 0, "topic": key[0] if key else None, "partition": key[1] if key else None, "min_offset": None, "max_offset": None}
            writer = pq.ParquetWriter(f"{self.root}/{name}", batch.schema, filesystem=self.fs)
        self.open[key] = (writer, about)  # at the end of the line
        writer.write_batch(batch)
        about["rows"] += batch.num_rows
        if "offset" in batch.schema.names:
            low, high = (pc.min_max(batch.column("offset")).as_py()[k] for k in ("min", "max"))
            about["min_offset"] = low if about["min_offset"] is None else min(low, about["min_offset"])
            about["max_offset"] = high if about["max_offset"] is None else max(high, about["max_offset"])

    def _close(self, key: tuple) -> None:
        writer, about = self.open.pop(key)
        writer.close()
        self.done.append(about)

    def close(self) -> list[dict]:
        for key in list(self.open):
            self._close(key)
        return self.done


def _write(root: str, batches: Iterator[pa.RecordBatch]) -> Written:
    files = _Files(root)
    for b in batches:
        if not b.num_rows:
            continue
        if not {"topic", "partition"} <= set(b.schema.names):
            files.write((), b)
            continue
        table = pa.Table.from_batches([b])
        for key in table.select(["topic", "partition"]).group_by(["topic", "partition"]).aggregate([]).to_pylist():
            same = [pc.equal(b.column(c), pa.scalar(v, b.schema.field(c).type)) if v is not None else pc.is_null(b.column(c)) for c, v in key.items()]
            files.write((key["topic"], key["partition"]), b.filter(pc.and_(*[pc.fill_null(s, False) for s in same])))
    return Written(files.close())


def _commit(root: str, name: str, messages: list[Written | None]) -> None:
    """Name the files of all tasks, in one file that appears whole."""
    fs, at = _opened(root)
    fs.create_dir(f"{at}/_committed")
    draft = f"{at}/_committed/.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(draft) as f:
        f.write("\n".join(json.dumps(x) for m in messages if m is not None for x in m.files).encode())
    fs.move(draft, f"{at}/_committed/{name}.json")


def _abort(root: str, messages: list[Written | None]) -> None:
    fs, at = _opened(root)
    for m in messages:
        for x in m.files if m is not None else ():
            if fs.get_file_info(f"{at}/{x['file']}").type == pafs.FileType.File:
                fs.delete_file(f"{at}/{x['file']}")


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.name = root, uuid.uuid4().hex

    def write(self, iterator):
        return _write(self.root, iterator)

    def commit(self, messages):
        _commit(self.root, self.name, messages)

    def abort(self, messages):
        _abort(self.root, messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str, name: str):
        self.root, self.name = root, name

    def write(self, iterator):
        return _write(self.root, iterator)

    def commit(self, messages, batchId):
        _commit(self.root, f"{self.name}-{batchId}", messages)

    def abort(self, messages, batchId):
        _abort(self.root, messages)


class CommittedSink(DataSource):
    """``df.write.format("loglake_sink").mode("append").save(root)``; of a stream with option ``name``, which tells the
    manifests of several queries apart."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("this sink only appends")
        return BatchWriter(self.options["path"].rstrip("/"))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"].rstrip("/"), self.options.get("name", "stream"))


def write_committed(df: DataFrame, root: str) -> None:
    """Append a batch: all of it counts, or nothing."""
    register_source(df.sparkSession, CommittedSink)
    df.write.format(NAME).mode("append").save(root)


def start_committed(df: DataFrame, root: str, checkpoint: str, name: str = "stream", **trigger):
    """Start a stream into the sink; each of its batches counts once."""
    register_source(df.sparkSession, CommittedSink)
    return df.writeStream.format(NAME).option("name", name).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "0 seconds"})).start(root)


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """What the manifests name: file, rows, topic, partition, offset range."""
    at = f"{root.rstrip('/')}/_committed"
    return spark.read.schema(MANIFEST).json(at) if path_exists(spark, at) else spark.createDataFrame([], MANIFEST)


def read_committed(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows that count."""
    files = [f"{root.rstrip('/')}/{r['file']}" for r in committed_files(spark, root).select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def sweep(spark: SparkSession, root: str, age_sec: float) -> int:
    """Remove files that no manifest names and that are older than ``age_sec`` (longer than any write takes); how many."""
    named = {r["file"] for r in committed_files(spark, root).select(F.col("file")).collect()}
    fs, at = file_system(spark, f"{root.rstrip('/')}/files")
    gone = 0
    for folder in fs.listStatus(at) if fs.exists(at) else ():
        for st in fs.listStatus(folder.getPath()):
            name = f"files/{folder.getPath().getName()}/{st.getPath().getName()}"
            if name not in named and time.time() - st.getModificationTime() / 1000 > age_sec:
                delete_path(spark, str(st.getPath()))
                gone += 1
    return gone
