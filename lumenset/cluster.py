"""What driver and executors share: this package's code, and a folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package's code to the session, once, so that workers find it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_lumenset_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="lumenset-code-")) / "lumenset.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._lumenset_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; without one only a local master gets a folder of its own."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if root is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="lumenset-"))
    return root or sc.getCheckpointDir()


_scratch: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is deleted when the process ends."""
    path = f"{shared_root(spark).rstrip('/')}/lumenset-{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _scratch:
        try:
            if spark.sparkContext._jsc:
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001, S112  the session may have ended before
            continue
