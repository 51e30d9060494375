"""Chat formatting with black-box templates.

The template is only ever asked to render message lists. Rendering successive prefixes of a conversation and
comparing consecutive outputs shows where each turn lies; rendering the last turn once more around a marker
that occurs nowhere in the output shows where its text lies inside that turn. If an output doesn't continue the previous one, the template
rewrites history and the turn is flagged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

Message = tuple[str, str]


def marker(absent_from: str) -> str:
    """The shortest of a row of private-use strings that the output doesn't hold; a text that holds one gets the next."""
    n = 1
    while (mark := "\ue000" + "\ue001" * n + "\ue002") in absent_from:
        n += 1
    return mark


TURNS_SCHEMA = "conv_id long, turn_index long, role string, piece string, start long, end long, content_start long, content_end long, in_loss boolean, rewrites_history boolean, tail string"


class TurnTemplate:
    """`<turn ROLE>` newline TEXT `</turn>` newline; a backslash precedes every `<` and backslash of a text, so control strings in texts stay inert and can be read back."""

    turn_local = True  # a turn's piece depends on that turn only

    def escape(self, text: str) -> str:
        return text.replace("\\", "\\\\").replace("<", "\\<")

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace(">", "\\>").replace("\n", "\\n")

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)

    def render(self, messages: list[Message]) -> str:
        return "".join(f"<turn {self.escape_role(role)}>\n{self.escape(text)}</turn>\n" for role, text in messages)

    def parse(self, piece: str) -> Message:
        m = re.fullmatch(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)</turn>\n", piece, flags=re.DOTALL)
        if m is None:
            raise ValueError("not a turn of this template")
        return self.unescape(m[1]), self.unescape(m[2])


def turn_local(template) -> bool:
    """Whether the class (or object) that defines the template's render declares it turn-local; one that overrides render has to say so itself."""
    for owner in (template, *type(template).__mro__):
        if "render" in getattr(owner, "__dict__", {}):
            return bool(owner.__dict__.get("turn_local", False))
    return False


def _common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def locate_turn(render, before: list[Message], last: Message, previous: str) -> dict:
    """Where `last` lies in render(before + [last]), given previous = render(before); offsets from the turn's start."""
    out = render([*before, last])
    at = _common_prefix(previous, out)
    tail = previous[at:]
    rewrites = not out.endswith(tail) or len(out) - len(tail) < at
    stop = len(out) if rewrites else len(out) - len(tail)
    sign = marker(out)
    marked = render([*before, (last[0], sign)])
    mark = marked.rfind(sign)
    found = mark >= at and marked.count(sign) == 1
    after = len(marked) - mark - len(sign)
    found = found and len(out) - after >= mark
    return {"out": out, "piece": out[at:stop], "begin": mark - at if found else None, "finish": len(out) - after - at if found else None, "rewrites": rewrites or not found, "tail": "" if rewrites else tail}


def format_turns(conversations: DataFrame, template=None, loss_roles: tuple[str, ...] = ("assistant",), window: int = 64) -> DataFrame:
    """One row per turn, in order inside each partition: its piece of the formatted text, its span, the span of its text, and whether that is under the loss mask. Pieces in order, then the last tail, are the whole output.

    Rows are turns by (turn, role, text); a null role or text is empty, null conversation ids form one conversation,
    repeated turns stay as turns of their own; an empty table gives no rows and other columns are not read. A
    conversation is a sequence, so one task renders it however long it is. Prefixes are rendered whole, so work grows with the square of a
    conversation's turns; for a template that declares itself turn-local each turn is compared within the last `window`
    turns, and memory and work per turn stay bounded for a conversation of any length.
    """
    ship(conversations.sparkSession)
    template = template or TurnTemplate()
    bounded = turn_local(template)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started = None, False
        before: list[Message] = []
        index = offset = 0
        previous = ""
        for batch in batches:
            out: list[tuple] = []
            conv, _, roles, texts = (batch.column(i).to_pylist() for i in range(4))
            for c, role, text in zip(conv, roles, texts, strict=True):
                if not started or c != current:
                    current, started, before, index, offset, previous = c, True, [], 0, 0, template.render([])
                if bounded and len(before) >= window:
                    before = before[1:]
                    previous = template.render(before)
                t = locate_turn(template.render, before, (role, text), previous)
                begin, finish = t["begin"], t["finish"]
                out.append((c, index, role, t["piece"], offset, offset + len(t["piece"]), None if begin is None else offset + begin, None if finish is None else offset + finish, role in loss_roles, t["rewrites"], t["tail"]))
                offset += len(t["piece"])
                index += 1
                before, previous = [*before, (role, text)], t["out"]
            if out:
                cols = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in TURNS_SCHEMA.split(", ")])

    return rows.mapInArrow(run, TURNS_SCHEMA)


def assemble(turns: DataFrame) -> DataFrame:
    """conv_id and formatted: the whole output of each conversation in one string."""
    part = F.sort_array(F.collect_list(F.struct("turn_index", "piece", "tail")))
    return turns.groupBy("conv_id").agg(part.alias("p")).select("conv_id", F.concat(F.array_join("p.piece", ""), F.element_at("p.tail", -1)).alias("formatted"))


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites_history boolean"


def read_back(turns: DataFrame, template=None) -> DataFrame:
    """Digests of each conversation, read from format_turns' output as it streams by: roles and texts from the pieces, loss text from the spans."""
    ship(turns.sparkSession)
    template = template or TurnTemplate()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def done() -> tuple:
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5] + state[7], state[6])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in DIGEST_SCHEMA.split(", ")])

        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if state is None or r["turn_index"] == 0:
                    if state is not None:
                        rows.append(done())
                    state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False, 0]
                role, text = template.parse(r["piece"])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if r["in_loss"] and r["content_start"] is not None:
                    loss = template.unescape(r["piece"][r["content_start"] - r["start"] : r["content_end"] - r["start"]])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "surrogatepass"))
                state[5] += len(r["piece"])
                state[6] = state[6] or r["rewrites_history"]
                state[7] = len(r["tail"])
            if rows:
                yield batch_of(rows)
        if state is not None:
            yield batch_of([done()])

    return turns.mapInArrow(run, DIGEST_SCHEMA)


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """Contract query: all conversations and conversation -7, formatted and read back."""
    from .common import table

    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(format_turns(rows.unionByName(extra)))


#: The same in DuckDB: the registered template's pieces, put together by the order of the turns.
SQL = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)),
 p AS (SELECT *, '<turn ' || replace(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>'), chr(10), '\n') || '>' || chr(10) || replace(replace(text, '\', '\\'), '<', '\<') || '</turn>' || chr(10) AS piece FROM t)
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length(piece))::BIGINT AS formatted_chars, false AS rewrites_history FROM p GROUP BY conv_id"""
