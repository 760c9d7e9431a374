"""Session helpers: a configured local session for tests and benches, and the
shared scratch folder every materialisation of the engine goes to.

On a cluster the scratch folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared file system). Only when that setting is
missing, as in tests on one machine, do we pick a local temporary folder and
register it as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCK = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "loglake") -> SparkSession:
    """A local session with the settings the engine is designed and tested with."""
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cores == "*" else max(2, int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, with its scheme. Where the session names none, a local temp folder
    is set under a local master (tests on one machine); on a cluster that is an error, as executors could not read it."""
    with _LOCK:
        root = spark.sparkContext.getCheckpointDir()
        if root:
            return root
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if conf:
            spark.sparkContext.setCheckpointDir(conf)
            return conf
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        local = tempfile.mkdtemp(prefix="loglake-ckpt-")
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, *parts: str, fresh: bool = True) -> str:
    """A path below the shared checkpoint folder; ``fresh`` adds a unique leaf."""
    leaf = list(parts)
    if fresh:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(checkpoint_root(spark), "loglake", *leaf)


def register_source(spark: SparkSession, source: type) -> None:
    """Register a Python data source with ``spark``, again and again if need be. Spark looks for a name already taken in the
    active session, which may be another one that knows this very source: ``spark`` is the active one meanwhile."""
    sessions = spark.sparkContext._jvm.org.apache.spark.sql.SparkSession
    active = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(source)
    finally:
        if active.isDefined():
            sessions.setActiveSession(active.get())
        else:
            sessions.clearActiveSession()


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path of any scheme the cluster uses."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = file_system(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder or file that this engine wrote, if it is there."""
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole: written under another name, then renamed."""
    fs, hpath = file_system(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(hpath):
        fs.delete(hpath, False)
    if not fs.rename(draft, hpath):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, also one that Spark's readers take for hidden."""
    fs, hpath = file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
