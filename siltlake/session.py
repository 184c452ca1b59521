"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local[N] session configured like the cluster profile we target."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siltlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SILTLAKE_DRIVER_MEMORY", "12g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set (a folder every executor can reach) and is used
    as is; where it is unset a local master gets a fresh temporary folder, and
    any other master an error: its executors would each write their own disk.
    The SparkContext's checkpoint folder is pointed at the same place so
    ``DataFrame.checkpoint()`` writes there."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="siltlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def put_new_file(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small metadata file (a pointer, a manifest entry); False, and
    nothing done, if it is there already.

    The text is written whole under a hidden name of its own and then takes its
    final name, which fails if that is taken. So the file is never seen in part
    and never replaced, and a writer that dies leaves at most a hidden file
    that nobody reads. The store must have such a rename (HDFS) or hard links
    (a shared POSIX folder)."""
    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(final):
        return False
    tmp = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        return _take_name(jvm, fs, tmp, final)
    finally:
        fs.delete(tmp, False)


def _take_name(jvm, fs, tmp, final) -> bool:
    """Give ``tmp``'s file the name ``final`` unless that exists."""
    if fs.getUri().getScheme() == "file":  # a local rename would replace the other file; a link does not
        names = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (final, tmp)]
        try:
            jvm.java.nio.file.Files.createLink(*names)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getName() == "java.nio.file.FileAlreadyExistsException":
                return False
            raise
    if fs.rename(tmp, final):
        return True
    if fs.exists(final):
        return False
    raise IOError(f"could not publish {final}")
