"""Chat formatting by a finite-state machine over roles, from a declarative template.

The machine accepts an optional system turn, then user and assistant turns in
alternation, a tool's after an assistant's.  It says where a conversation first
breaks the order; the conversation is formatted all the same.  Each turn becomes
a list of segments with loss flags; the texts of a conversation's segments joined
are the formatted conversation.  Control strings inside texts are escaped with a
backslash and read back exactly.

Conversations are dealt out by id and sorted by turn outside memory, and both the
writer and the reader take one turn after another, with nothing but the machine's
state (the reader: the turn that isn't closed yet, and two running digests) kept
between them.  So a conversation of any number of turns needs no more memory than
its longest turn.

Defined results: null text is empty; a null or unknown role is written by its
name (empty for null) through the template's default marks, without loss; turns
are ordered by turn (nulls first), role and text; repeated rows are turns of
their own; rows without an id are one conversation; an empty table gives no rows;
other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import table

#: role: (text before a turn, does the loss count its text?); ``end`` closes a turn, ``other`` is for roles without a line.
TEMPLATE = {
    "turns": {"system": ("### System: ", False), "user": ("### User: ", False), "assistant": ("### Assistant: ", True), "tool": ("### Tool: ", False)},
    "other": "### Role {role}: ",
    "end": " </turn>\n",
    "escape": "\\",
    "escaped": "#<",
}
#: state: {role: next state}
MACHINE = {
    "start": {"system": "primed", "user": "asked"},
    "primed": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked", "tool": "returned"},
    "returned": {"assistant": "answered"},
}
FINAL = ("answered", "asked")


def states(roles: Iterable[str]) -> Iterator[str | None]:
    """The machine's state after each turn; None from the first turn out of order on."""
    state: str | None = "start"
    for role in roles:
        state = MACHINE[state].get(role) if state else None
        yield state


def first_fault(roles: list[str]) -> int | None:
    """The index of the first turn out of order; the number of turns if only the end is wrong; None if all is well."""
    after = list(states(roles))
    if None in after:
        return after.index(None)
    return None if after and after[-1] in FINAL else len(after)


def escape(text: str, template=TEMPLATE) -> str:
    e = template["escape"]
    text = text.replace(e, e + e)
    for c in template["escaped"]:
        text = text.replace(c, e + c)
    return text


def unescape(text: str, template=TEMPLATE) -> str:
    return re.sub(re.escape(template["escape"]) + "(.)", r"\1", text, flags=re.S)


def segments(role: str, text: str, template=TEMPLATE) -> list[tuple[str, bool]]:
    """(text, loss flag) in order: a turn's mark, its escaped text, and its end."""
    mark, loss = template["turns"].get(role, (None, False))
    if mark is None:
        mark = template["other"].format(role=escape(role, template).replace(":", template["escape"] + ":"))
    return [(mark, False), (escape(text, template), loss), (template["end"], False)]


class TurnReader:
    """Finds turns in formatted text that comes bit by bit, by their unescaped marks."""

    def __init__(self, template=TEMPLATE):
        self.template = template
        e, self.end = re.escape(template["escape"]), template["end"]
        usual = f"[^{e}{re.escape(template['escaped'])}]*"
        plain = rf"{usual}(?:{e}.{usual})*"  # may give back what the end begins with
        other = re.escape(template["other"]).replace(re.escape("{role}"), rf"(?P<role>(?:[^{e}:]++|{e}.)*+)")
        self.marks = {mark: role for role, (mark, _) in template["turns"].items()}
        self.turn = re.compile(rf"(?P<mark>{'|'.join(map(re.escape, self.marks))}|{other})(?P<text>{plain}){re.escape(self.end)}", re.S)
        self.left: list[str] = []

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """The turns that ``text`` completes, after what was left before."""
        self.left.append(text)
        if not text.endswith(self.end):
            return  # a turn ends where a segment does
        whole, at = "".join(self.left), 0
        while m := self.turn.match(whole, at):
            role = self.marks.get(m["mark"])
            yield unescape(m["role"], self.template) if role is None else role, unescape(m["text"], self.template)
            at = m.end()
        self.left = [whole[at:]]

    def close(self) -> None:
        if any(self.left):
            raise ValueError("the formatted text ends within a turn")


def read_back(formatted: Iterable[tuple[str, bool]], template=TEMPLATE) -> tuple[list[tuple[str, str]], list[str]]:
    """The turns in the joined segments; and the texts under the loss mask."""
    reader, turns, loss = TurnReader(template), [], []
    for text, flag in formatted:
        turns += reader.feed(text)
        if flag:
            loss.append(unescape(text, template))
    reader.close()
    return turns, loss


class Digests:
    """What a formatted conversation says, gathered segment by segment."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.reader = conv_id, TurnReader()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.state, self.fault = "start", None

    def add(self, parts: list[dict], state: str | None) -> None:
        for part in parts:
            self.formatted_chars += len(part["text"])
            if part["loss"]:
                text = unescape(part["text"])
                self.loss_chars += len(text)
                self.loss.update(text.encode())
            for role, text in self.reader.feed(part["text"]):
                self.n_turns += 1
                self.turns.update(f"{role}\n{text}\n".encode())
        if state is None and self.fault is None:
            self.fault = self.n_turns - 1
        self.state = state

    def row(self) -> tuple:
        self.reader.close()
        fault = self.n_turns if self.fault is None and self.state not in FINAL else self.fault
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, fault


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, place, segments, state): a row for each turn, in order, each conversation whole within a partition.

    ``place`` counts a conversation's turns from 0; ``state`` is the machine's after the turn, null once the order is broken.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))), ("state", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, state = object(), 0, None
        for batch in batches:
            out = []
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if own != conv:
                    conv, place, state = own, 0, "start"
                state = MACHINE[state].get(role) if state else None
                out.append({"conv_id": own, "place": place, "segments": [{"text": s, "loss": f} for s, f in segments(role, text)], "state": state})
                place += 1
            yield pa.RecordBatch.from_pylist(out, schema)

    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), plain("role"), plain("text"))
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, place long, segments array<struct<text:string,loss:boolean>>, state string")


def read_conversations(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """Digests of what the formatted conversations say, read back from their segments.

    ``in_order``: the rows are as ``format_conversations`` gives them; otherwise (read from files, say) they are dealt out anew.
    """
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "fault": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Digests | None = None
        for batch in batches:
            done = []
            for conv, parts, state in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segments", "state"))):
                if now is None or conv != now.conv_id:
                    done += [now.row()] if now else []
                    now = Digests(conv)
                now.add(parts, state)
            yield rows_of(done)
        yield rows_of([now.row()] if now else [])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], kind) for i, kind in enumerate(kinds.values())], list(kinds))

    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, fault long")


#: A conversation whose texts hold the template's control strings.
PROBE = r"\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and -7, formatted and read back."""
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_conversations(format_conversations(rows.unionByName(probe)), in_order=True)


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
  lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t),
f AS (SELECT *, NOT CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
    WHEN 'assistant' THEN role IN ('user', 'tool') WHEN 'tool' THEN role = 'assistant' ELSE false END OR (i > 0 AND role = 'system') AS wrong FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + length(text) - length(translate(text, '\#<', '')) + 9 +
    CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'tool' THEN 10
      ELSE 11 + length(role) + length(role) - length(translate(role, '\#<:', '')) END)::BIGINT AS formatted_chars,
  coalesce(min(i) FILTER (wrong), CASE WHEN max_by(role, i) IN ('user', 'assistant') THEN NULL ELSE count(*) END)::BIGINT AS fault
FROM f GROUP BY conv_id"""
