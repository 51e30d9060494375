"""What the operators share: table access, shared storage, checkpoints, file systems for Python tasks."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship as _ship

__all__ = ["checkpoint", "checkpoint_root", "discard", "open_fs", "owned", "purge", "retire", "release", "scratch_path", "ship", "sized", "table", "written"]


#: Rows that go to Python at a time, where the session has Spark's default: whole texts are long.
BATCH_ROWS = "2000"


def ship(spark: SparkSession) -> None:
    """Gets the package's code to the workers, and keeps their batches small."""
    _ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; without one, a temporary folder under a local master and an error elsewhere."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if root is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="lumenset-"))
    return root or sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a copy in the shared folder; Spark drops the files once nothing refers to them."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


#: Session, folder and owner of each scratch table that is still there.
_written: list[tuple[SparkSession, str, str]] = []
_owner = "call"


def _hadoop_delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _delete(entries: list[tuple[SparkSession, str, str]]) -> None:
    for entry in entries:
        _written.remove(entry)
        try:
            if entry[0].sparkContext._jsc:
                _hadoop_delete(*entry[:2])
        except Exception:  # noqa: BLE001, S112  the session may have ended before
            continue


@atexit.register
def purge() -> None:
    """Deletes the scratch tables of this process; results that still read them become unreadable."""
    _delete(list(_written))


@contextmanager
def owned(owner: str) -> Iterator[None]:
    """Scratch tables made inside belong to `owner`."""
    global _owner
    before, _owner = _owner, owner
    try:
        yield
    finally:
        _owner = before


def retire(owner: str, docs: DataFrame) -> None:
    """Deletes the owner's scratch tables that docs doesn't read: what docs was made of, once docs is a table of its own. Memory is given back too."""
    mine = [w for w in _written if w[2] == owner]
    if mine:
        read = {f"/{f.split('/lumenset-')[-1].split('/')[0]}" for f in docs.inputFiles() if "/lumenset-" in f}
        _delete([w for w in mine if f"/{w[1].split('/lumenset-')[-1]}" not in read])
    release(docs.sparkSession)


def discard(df: DataFrame) -> None:
    """Deletes the scratch table that `written` gave, once nothing is left that reads it."""
    _delete([w for w in _written if w[1] == df._scratch])


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{checkpoint_root(spark).rstrip('/')}/lumenset-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path, _owner))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: compact, prunable, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._scratch = path
    return out


def _trim(spark: SparkSession) -> None:
    """malloc_trim in the driver's JVM, whose many threads leave freed memory in arenas of their own; other JVMs than HotSpot from 17.0.9 on lack it."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    with suppress(Py4JError):
        # through the interface, because the class of the server isn't accessible
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = new_array(jvm.Object, 4)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of frames that are no longer referenced, and gives freed memory of the driver, Python's and the JVM's, back."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trim(spark)
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI or plain path, for tasks that write or read byte ranges."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def sized(df: DataFrame, limit: int):
    """df to be broadcast if it is proven to have at most limit rows, else left to a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
