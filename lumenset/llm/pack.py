"""Packing token pieces into windows, online and in bounded space.

Each partition keeps a fixed number of open windows. A piece goes where it leaves the least room; if it fits
nowhere and all windows are in use, the fullest is emitted. What stays open at the end of the partitions is
merged in groups of neighbouring partitions. Documents longer than a window are cut into full windows first.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, ship

PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TYPES = [pa.int64()] * 7 + [pa.int64()]
_NAMES = [x.split()[0] for x in PIECES_SCHEMA.split(", ")] + ["task"]


#: Runs of letters and digits, with an apostrophe that begins a run of signs, and runs of other signs.
_PARTS = re.compile(r"[^\W_]+|'[^\W_]+|(?:[^\w\s]|_)+").findall
_PARTS_PLAIN = re.compile(r"\w+|'\w+|[^\w\s]+").findall  # the same where there is no underscore, and faster
#: Beyond Latin-1 letters fold case and combine in other ways; four controls are blanks to Python only.
_OUTSIDE = re.compile("[\x1c-\x1f\u0100-\U0010ffff]").search
_CONTROLS = re.compile("[\x1c-\x1f]").search
_BLANKS = re.compile("[ \t\r\n]+").split
_BLANK = re.compile(r"\s").search
_WORD = re.compile(r"[^\W_]").search
_LONG = 1 << 22

#: The normaliser and the splits that `Ids` takes apart; any other tokenizer gets whole texts.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level tokenizers write for each byte: itself where it is printable in Latin-1, else the next from U+0100 on."""
    table, spare = {}, 256
    for b in range(256):
        if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b):
            table[b], spare = spare, spare + 1
    return table


_LETTERS = _byte_letters()


class Memory(dict):
    """What `make` gives for keys, for those that came twice of late: a key stays from its second time on, until there are more than `most`.

    Keys on trial are held in two sets of up to `trial`, of which the older one is dropped when the newer one is full;
    most keys come once, and would only push the others out.
    """

    def __init__(self, make, most: int, trial: int):  # noqa: ANN001
        super().__init__()
        self.make, self.most, self.trial, self.new, self.old = make, most, trial, {}, {}

    def __missing__(self, key: str) -> bytes:
        found = self.new.get(key) or self.old.get(key)
        if found is not None:
            self[key] = found
            return found
        found = self.make(key)
        if len(key) <= 200:  # longer ones are not worth their room
            self.new[key] = found
            if len(self.new) >= self.trial:
                self.old, self.new = self.new, {}
        return found

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


class Ids:
    """The little-endian unsigned 32-bit ids of texts, by way of a bounded memory of their parts.

    The tokenizer drops white space, folds case, and neither its normaliser nor its splits reach across white space;
    so a text's ids are its words' ids in a row. Within Latin-1, words fall into parts at places where the tokenizer
    always splits, and far fewer parts differ than words. Words beyond Latin-1, and those with a special token's
    string, are encoded whole. A tokenizer of another make (`local` is False) encodes whole texts.
    """

    def __init__(self, path: str, most: int = 150_000, trial: int = 75_000):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        made = json.loads(self.tokenizer.to_str())
        before = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.special = [t["content"] for t in made["added_tokens"]]
        self.local = (
            (made["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and [p["type"] for p in before] == ["Split", "ByteLevel"]
            and before[0]["pattern"] == {"Regex": _SPLIT}
            and not any(before[1].get(k) for k in ("add_prefix_space", "use_regex"))
            and made["model"]["type"] == "BPE"
            and made["model"].get("dropout") is None
            and not any(_BLANK(s) for s in self.special)
            and all(self._tokens(p) == self.whole(p) for p in ("straße", "àâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿªµº", "...", "«»¿¡§©®°±¶·×÷"))
        )
        self.parts, self.words = Memory(self._part, most, trial), Memory(self.whole, most, trial)

    def whole(self, text: str) -> bytes:
        """The ids as the tokenizer gives them."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _tokens(self, part: str) -> bytes:
        """The ids of a part in which neither the normaliser nor the splits find anything to do."""
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _part(self, part: str) -> bytes:
        return self._tokens(part) if part.isalpha() or not _WORD(part) else self.whole(part)

    def of(self, text: str) -> bytes:
        if not self.local:
            return self.whole(text)
        self.parts.trim()
        self.words.trim()
        if _OUTSIDE(text) or any(s in text for s in self.special):
            words = _BLANKS(text) if _CONTROLS(text) else text.split()
            return b"".join([self.words[w] if _OUTSIDE(w) or any(s in w for s in self.special) else self._latin(w) for w in words])
        if len(text) <= _LONG:
            return self._latin(text)
        out, at = [], 0
        while at < len(text):  # long texts are cut at blanks, so that only a stretch of parts is held at a time
            blank = _BLANK(text, at + _LONG)
            end = blank.end() if blank else len(text)
            out.append(self._latin(text[at:end]))
            self.parts.trim()
            at = end
        return b"".join(out)

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, (_PARTS if "_" in text else _PARTS_PLAIN)(text.lower())))


_shared: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The memory of this Python worker, which its tasks share."""
    if path not in _shared:
        _shared.clear()
        _shared[path] = Ids(path)
    return _shared[path]


class Windows:
    """Open windows of one partition; emits (sequence number, pieces) when one is full or must make room."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[tuple[int, int]] = []  # (room, number), ascending
        self.held: dict[int, list] = {}
        self.next = 0

    def add(self, length: int, piece: tuple) -> list[tuple[int, list]]:
        """Places piece, of length at most size, at the offset it is then given as its last field."""
        out = []
        at = bisect.bisect_left(self.free, (length, -1))
        if at == len(self.free):
            if len(self.free) >= self.most:
                out.append(self._emit(0))
            room, number = self.size, self.next
            self.next += 1
            self.held[number] = []
        else:
            room, number = self.free.pop(at)
        self.held[number].append((*piece, self.size - room))
        if room == length:
            out.append((number, self.held.pop(number)))
        else:
            bisect.insort(self.free, (room - length, number))
        return out

    def _emit(self, at: int) -> tuple[int, list]:
        _, number = self.free.pop(at)
        return number, self.held.pop(number)

    def rest(self) -> list[tuple[int, list]]:
        return [self._emit(0) for _ in range(len(self.free))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, open_windows: int = 64, merged_partitions: int = 16) -> DataFrame:
    """Pieces of all documents (doc_id, text) in sequences of at most `size` ids.

    A document's ids are its text's (a null text is empty) and end_id; hence each document has a piece. Rows that
    repeat are packed each on its own, null doc_ids too. sequence_id tells sequences apart and is not consecutive.
    Any tokenizer file will do; ids are those of the tokenizer itself, whatever its normaliser and splits. An empty table
    gives no pieces. Memory per task: `open_windows` windows, and at the merge those of `merged_partitions` tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        known, windows = ids_of(tokenizer_path), Windows(size, open_windows)
        end = int(end_id).to_bytes(4, "little")
        rows: list[tuple] = []

        def emit(closed: list[tuple[int, list]], leftover: int = -1) -> None:
            for number, pieces in closed:
                rows.extend((*p[:5], task << 32 | number, p[5], leftover) for p in pieces)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = known.of(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, size):
                    part = ids[4 * start : 4 * (start + size)]
                    emit(windows.add(len(part) // 4, (doc_id, start, len(part) // 4, zlib.crc32(part), n)))
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows.clear()
        emit(windows.rest(), task)
        if rows:
            yield _batch(rows)

    def merge(table: pa.Table) -> pa.Table:
        held: dict[int, list] = {}
        for r in zip(*(table.column(i).to_pylist() for i in range(7)), strict=True):
            held.setdefault(r[5], []).append(r)
        used = {k: sum(r[2] for r in v) for k, v in held.items()}
        windows, rows = Windows(size, len(held) + 1), []
        group = (min(table.column(7).to_pylist()) // merged_partitions) if table.num_rows else 0
        closed = []
        for k in sorted(held, key=lambda k: (-used[k], k)):
            closed += windows.add(used[k], (k,))
        for number, parts in closed + windows.rest():
            for k, at in parts:
                rows.extend((*r[:5], 1 << 62 | group << 32 | number, at + r[6], -1) for r in held[k])
        return pa.Table.from_batches([_batch(rows)])

    ship(docs.sparkSession)
    placed = checkpoint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, PIECES_SCHEMA + ", task long"))
    last = placed.filter("task >= 0").groupBy(F.expr(f"task div {merged_partitions}").alias("g")).applyInArrow(lambda t: merge(t.select(_NAMES)), PIECES_SCHEMA + ", task long")
    return placed.filter("task < 0").unionByName(last).drop("task")


def op4_pack(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sequences of 2048 ids."""
    import public_tokenizers

    from .common import table

    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), str(public_tokenizers.path("word_bpe_49k.json")))
