"""Small files in any store that Hadoop knows: JSON, text, bytes; copies and links."""

from __future__ import annotations

import datetime
import enum
import hashlib
import json
import math
import uuid
from collections.abc import Iterable, Mapping
from pathlib import PurePath
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):  # noqa: ANN202
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """The file's bytes, or None if there is no such file."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes beside the target and renames, so that readers never see half a file."""
    fs, target = _at(spark, path)
    _, beside = _at(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"can't rename to {path}")


def append_line(spark: SparkSession, path: str, line: str) -> None:
    """Adds a line; stores without append get the file anew."""
    write_bytes(spark, path, (read_bytes(spark, path) or b"") + line.encode() + b"\n")


def plain(x: Any) -> Any:
    """x as JSON can hold it: enumerations by value, paths and times as text, sets sorted, numbers that aren't finite as null."""
    if isinstance(x, enum.Enum):
        return plain(x.value)
    if isinstance(x, bool) or x is None or isinstance(x, (str, int)):
        return x
    if isinstance(x, float):
        return x if math.isfinite(x) else None
    if isinstance(x, Mapping):
        return {str(plain(k)): plain(v) for k, v in x.items()}
    if isinstance(x, (set, frozenset)):
        return sorted((plain(v) for v in x), key=str)
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if hasattr(x, "tolist"):
        return plain(x.tolist())
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat()
    if isinstance(x, PurePath):
        return x.as_posix()
    if isinstance(x, Iterable):
        return [plain(v) for v in x]
    return str(x)


def canonical(x: Any) -> str:
    """JSON with sorted keys and no blanks: equal values, equal text."""
    return json.dumps(plain(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(x: Any) -> str:
    """SHA-256 of the canonical JSON."""
    return hashlib.sha256(canonical(x).encode()).hexdigest()


def write_json(spark: SparkSession, path: str, x: Any) -> None:
    write_bytes(spark, path, json.dumps(plain(x), indent=2, ensure_ascii=False).encode() + b"\n")


def read_json(spark: SparkSession, path: str) -> Any:
    """What the file holds; None if it is missing or no JSON."""
    data = read_bytes(spark, path)
    try:
        return None if data is None else json.loads(data)
    except ValueError:
        return None


def read_mapping(spark: SparkSession, path: str) -> dict:
    """A mapping from a JSON file, or from YAML where a YAML reader is installed."""
    data = read_bytes(spark, path)
    if data is None:
        raise FileNotFoundError(path)
    if path.lower().endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: no YAML reader is installed; use JSON") from e
        found = yaml.safe_load(data)
    else:
        found = json.loads(data)
    if not isinstance(found or {}, dict):
        raise ValueError(f"{path}: not a mapping")
    return found or {}


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file within or between stores."""
    (a, b), (c, d) = _at(spark, source), _at(spark, target)
    c.mkdirs(d.getParent())
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(a, b, c, d, False, True, spark.sparkContext._jsc.hadoopConfiguration()):
        raise OSError(f"can't copy {source}")


def link(spark: SparkSession, source: str, target: str) -> bool:
    """A hard link where both are local files, else a copy; tells whether it is a link."""
    import os

    local = [p.removeprefix("file://").removeprefix("file:") for p in (source, target)]
    if all(p.startswith("/") for p in local):
        os.makedirs(os.path.dirname(local[1]), exist_ok=True)
        try:
            os.link(local[0], local[1])
            return True
        except OSError:
            pass
    copy(spark, source, target)
    return False
