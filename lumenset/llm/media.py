"""Media columns: content-addressed payloads in tar shards.

A payload is stored once, as a one-row 8-bit grayscale PNG, in a tar shard of the shared folder, under the
SHA-256 of its samples. Rows carry that digest with shard, offset and length. Header-only range reads fill the
metadata columns; a full range read gives the samples back.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, open_fs, scratch_path, ship

UNIT = 64
_PNG = b"\x89PNG\r\n\x1a\n"
HEADER = 33  # signature and IHDR


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(payload: bytes) -> bytes:
    """The payload as one row of 8-bit gray samples."""
    return _PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", len(payload), 1, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(b"\0" + payload, 6)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int]:
    """(width, height, bit depth) from the first HEADER bytes."""
    if data[:8] != _PNG or data[12:16] != b"IHDR":
        raise ValueError("not a PNG")
    return struct.unpack(">IIB", data[16:25])


def decode(data: bytes) -> bytes:
    width, height, depth = header(data)
    at, parts = 8, []
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged chunk")
        if kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    raw = zlib.decompress(b"".join(parts))
    if (height, depth, raw[:1], len(raw)) != (1, 8, b"\0", width + 1):
        raise ValueError("not one unfiltered row of 8-bit samples")
    return raw[1:]


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\0" * (-len(data) % UNIT or (0 if data else UNIT))


def payload_digest(text_column: str):
    """The digest that payload_of's bytes have, as a column expression."""
    data = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    n = F.octet_length(data)
    pad = F.when(n == 0, UNIT).otherwise(F.pmod(-n, F.lit(UNIT)))
    return F.sha2(F.concat(data, F.unhex(F.repeat(F.lit("00"), pad.cast("int")))), 256)


INDEX_SCHEMA = "digest string, shard string, offset long, length long"


def store_texts(texts: DataFrame, root: str, shard_bytes: int = 256 << 20, remembered: int = 200_000) -> DataFrame:
    """Stores the payloads of texts (text) under root; returns one digest, shard, offset, length for each distinct one.

    Payloads are written where they are read and never shuffled. A task stores what it hasn't seen among its last
    `remembered` digests; of the copies that several tasks have stored, the index names one, so a text that makes up a
    third of all rows costs a copy a task and not a row. Each attempt of a task writes files of its own name, and only
    rows of attempts that succeeded refer to them, so retries do no harm.
    """

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        fs.create_dir(base, recursive=True)
        seen: set[bytes] = set()
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for value in batch.column(0):
                payload = payload_of(value.as_py())
                digest = hashlib.sha256(payload)
                if digest.digest() in seen:
                    continue
                if len(seen) >= remembered:
                    seen.clear()
                seen.add(digest.digest())
                data = encode(payload)
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.tar", 0
                    out = fs.open_output_stream(f"{base}/{name}")
                info = tarfile.TarInfo(f"{digest.hexdigest()}.png")
                info.size = len(data)
                head = info.tobuf(tarfile.USTAR_FORMAT)
                out.write(head)
                out.write(data)
                out.write(b"\0" * (-len(data) % 512))
                rows.append((digest.hexdigest(), name, at + len(head), len(data)))
                at += len(head) + len(data) + -len(data) % 512
                if at >= shard_bytes:
                    out.write(b"\0" * 1024)
                    out.close()
                    out = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["digest", "shard", "offset", "length"])
        if out is not None:
            out.write(b"\0" * 1024)
            out.close()

    ship(texts.sparkSession)
    copies = checkpoint(texts.select("text").mapInArrow(stored, INDEX_SCHEMA))
    place = F.struct("shard", "offset", "length")
    return copies.groupBy("digest").agg(F.min(place).alias("p")).select("digest", "p.shard", "p.offset", "p.length")


def _ranges(index: DataFrame, root: str, read: int | None, make, schema: str) -> DataFrame:
    """make(digest, bytes) for the first `read` bytes (all if None) of each stored medium, read in shard order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        name, file = None, None
        for batch in batches:
            rows = []
            for digest, shard, offset, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if shard != name:
                    if file is not None:
                        file.close()
                    name, file = shard, fs.open_input_file(f"{base}/{shard}")
                rows.append((digest, *make(file.read_at(length if read is None else min(read, length), offset))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=[x.split()[0] for x in schema.split(", ")])
        if file is not None:
            file.close()

    ship(index.sparkSession)
    spread = index.repartition("shard", F.floor(F.col("offset") / (64 << 20))).sortWithinPartitions("shard", "offset")
    return spread.mapInArrow(run, schema)


def metadata_columns(index: DataFrame, root: str) -> DataFrame:
    """digest, width, height, bit_depth: from HEADER bytes a medium."""
    return _ranges(index, root, HEADER, header, "digest string, width long, height long, bit_depth long")


def _features(data: bytes) -> tuple:
    import numpy as np

    payload = decode(data)
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    p = counts[counts > 0] / len(payload)
    mean = float((counts * np.arange(256)).sum()) / len(payload)
    return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), f"mean={mean:.4f};entropy={max(0.0, -float((p * np.log2(p)).sum())):.4f}")


def media_columns(index: DataFrame, root: str) -> DataFrame:
    """What full range reads give: sizes, digests, checksum and a feature string of each stored medium."""
    return _ranges(index, root, None, _features, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_media(spark, sf_dir: str) -> DataFrame:
    """Contract query: every text of documents stored, read back and described. Null texts are empty; repeated rows each get a row."""
    from .common import table

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    root = scratch_path(spark, "media")
    index = store_texts(docs, root)
    stored = index.join(media_columns(index, root), "digest").join(metadata_columns(index, root), "digest")
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), payload_digest("text").alias("digest"))
    return rows.join(stored, "digest").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "shard", "offset", "length", "width", "height", "bit_depth")
