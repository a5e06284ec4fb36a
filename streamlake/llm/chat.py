"""Chat formatting with budgeted, turn-aligned windows.

Template of a window: ``<s>``, then per turn ``[INST]role\\ntext[/INST]``,
then ``</s>``. Roles and texts are escaped, so these control strings occur
only as marks and a window can be read back exactly.

A window holds the conversation's leading system turn, the last turns before
it as repeated history (within ``history`` tokens) and new turns up to
``budget`` tokens in all; differences of the prefix sums of turn tokens
decide where it ends. Every turn is new in exactly one window. New assistant
texts are the loss; repeated turns are masked, so each target counts once.
A turn that exceeds the budget alone gets a window with the system turn only.

A conversation of more than ``BLOCK`` turns is cut into blocks of so many
turns, which are worked on apart: a running count over balanced ranges of the
turns numbers them, and a block starts with the system turn and the last
``CARRIED`` turns of the block before, from which its first window takes its
history. Windows end at block borders. The turns of a block are streamed in
order through a task, which holds one window at a time. Only the digest of
``read_back`` runs over a whole conversation, window by window.

Defined results: turns are ordered by (turn, role, text), nulls first (in
conversations of several blocks texts of one turn and role by their digest);
``window`` ascends within a conversation, with gaps at block borders; a null
role or text is empty; a null conv_id is a conversation; repeated rows are
turns of their own; an empty table gives no windows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from streamlake.operators.ranges import order_range
from streamlake.operators.running import running_count

from . import marks
from .common import write_table

BLOCK = 1024  # turns of a conversation that are formatted together
CARRIED = 64  # turns before a block that can be its history
START, END, TURN, TURN_END = "<s>", "</s>", "[INST]", "[/INST]"
_CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.?)", re.S)

WINDOWS = ("conv_id {id}, window long, repeated int, n_turns int, tokens long, formatted string, "
           "loss array<struct<start:long,end:long>>")


def escape(text: str, line: bool = False) -> str:
    """Double backslashes and break control strings with one; ``line`` also
    writes newlines as ``\\n``."""
    out = _CONTROL.sub(lambda m: m.group() + "\\~", text.replace("\\", "\\\\"))
    return out.replace("\n", "\\n") if line else out


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"~": "", "n": "\n"}.get(m.group(1), m.group(1)), text)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end delimit the
    escaped text inside ``formatted``."""
    at = len(START)
    while formatted.startswith(TURN, at):
        line = formatted.index("\n", at)
        end = formatted.index(TURN_END, line + 1)
        yield unescape(formatted[at + len(TURN):line]), unescape(formatted[line + 1:end]), line + 1, end
        at = end + len(TURN_END)
    if formatted[at:] != END:
        raise ValueError("not a formatted window")


def _render(turns: list[tuple[str, str, int]], repeated: int) -> tuple[str, list[dict]]:
    parts, at, loss = [START], len(START), []
    for k, (role, text, _) in enumerate(turns):
        head, body = f"{TURN}{escape(role, line=True)}\n", escape(text)
        if k >= repeated and role == "assistant":
            loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, TURN_END]
        at += len(head) + len(body) + len(TURN_END)
    return "".join([*parts, END]), loss


class _Windows:
    """Cuts one conversation's turns into windows, as they come."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.recent: deque[tuple] = deque()  # last turns with their prefix sum, within the history budget
        self.total = 0  # prefix sum of all turns so far
        self.begun = 0  # prefix sum where the window's new turns begin
        self.turns: list[tuple] = []
        self.context = self.repeated = 0
        self.seen = self.number = 0

    def resume(self, role: str, text: str, tokens: int, first: bool) -> None:
        """A turn of an earlier block: the system turn (``first``), or history."""
        turn = (role, text, tokens)
        if first:
            self.system = turn
            return
        self.seen = max(self.seen, 1) + 1
        self.total += tokens
        self._remember(turn)
        self.begun = self.total

    def _remember(self, turn: tuple) -> None:
        self.recent.append((self.seen, self.total, turn))
        while self.recent and self.total - self.recent[0][1] + self.recent[0][2][2] > self.history:
            self.recent.popleft()

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        turn = (role, text, tokens)
        if not self.turns and (self.seen or self.system):  # the first turn of a later block
            self.seen = max(self.seen, 1)
            self.open(tokens)
        if len(self.turns) > self.repeated and self.context + self.total - self.begun + tokens > self.budget:
            yield self.close()
            self.open(tokens)
        if not self.seen and role == "system":
            self.system = turn
        self.turns.append(turn)
        self.seen += 1
        self.total += tokens
        self._remember(turn)

    def open(self, tokens: int) -> None:
        context = [self.system] if self.system else []
        room = self.budget - tokens - sum(t[2] for t in context)
        back = [t for k, total, t in self.recent
                if self.total - total + t[2] <= room and not (self.system and k == 1)]
        self.turns = context + back
        self.repeated, self.context = len(self.turns), sum(t[2] for t in self.turns)
        self.begun = self.total

    def close(self) -> dict:
        formatted, loss = _render(self.turns, self.repeated)
        row = {"window": self.number, "repeated": self.repeated, "n_turns": len(self.turns),
               "tokens": sum(t[2] for t in self.turns), "formatted": formatted, "loss": loss}
        self.number += 1
        return row


_COUNTERS: dict = {}


def _counter(ranks: bytes, pattern: str):
    key = hashlib.md5(ranks).digest()
    if key not in _COUNTERS:
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _COUNTERS[key] = tiktoken.Encoding("turns", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _COUNTERS[key]


def format_windows(turns: DataFrame, ranks_path: str, pattern: str, budget: int = 512, history: int = 128,
                   columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """One row per window (schema ``WINDOWS``); ``window`` gives their order
    within a conversation. ``ranks_path`` names the rank file that
    counts turn tokens; the driver reads it (a fixed few MB) and broadcasts it."""
    conv, turn, role, text = columns
    with open(ranks_path, "rb") as f:
        ranks = turns.sparkSession.sparkContext.broadcast(f.read())

    @pandas_udf("long")
    def tokens(texts):
        count = _counter(ranks.value, pattern)
        return texts.map(lambda x: len(count.encode_ordinary(x)))

    schema = WINDOWS.format(id=dict(turns.dtypes)[conv])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, window, out = None, None, []
        shape = None

        def row(w: dict) -> dict:
            return {"conv_id": current[0], **w, "window": current[1] * BLOCK + w["window"]}

        for batch in batches:
            if shape is None:
                shape = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("window", pa.int64()),
                                   ("repeated", pa.int32()), ("n_turns", pa.int32()), ("tokens", pa.int64()),
                                   ("formatted", pa.string()),
                                   ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
            names = ("conv_id", "block", "carried", "n", "role", "text", "tokens")
            for c, block, carried, n, r, t, size in zip(*(batch.column(k).to_pylist() for k in names)):
                if window is None or (c, block) != current:
                    if window is not None:
                        out.append(row(window.close()))
                    current, window = (c, block), _Windows(budget, history)
                if carried:
                    window.resume(r, t, size, n == 1)
                else:
                    out += [row(w) for w in window.add(r, t, size)]
            if len(out) >= 500:
                yield pa.RecordBatch.from_pylist(out, shape)
                out = []
        if window is not None:
            out.append(row(window.close()))
            yield pa.RecordBatch.from_pylist(out, shape)

    rows = marks.placed(marks.scan(turns, "chat-turns")).select(
        "file", "at", F.col(f"row.{conv}").alias("conv_id"), F.col(f"row.{turn}").alias("turn"),
        F.coalesce(F.col(f"row.{role}").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"row.{text}"), F.lit("")).alias("text"))
    number = marks.save(_numbers(rows), "chat-numbers")
    rows = (rows.withColumn("place", number.of(F.col("file"), F.col("at")))
            .select("conv_id", "turn", "role", "text", F.col("place.n").alias("n"), F.col("place.blocks").alias("blocks")))
    own = F.coalesce(F.floor((F.col("n") - 1) / BLOCK), F.lit(0)).cast("int")
    # the system turn goes to every block of its conversation, a block's last turns to the next one
    blocks = (F.when((F.col("n") == 1) & (F.col("role") == "system"), F.sequence(F.lit(0), F.col("blocks") - 1))
              .when(((F.col("n") - 1) % BLOCK >= BLOCK - CARRIED) & (own + 1 < F.col("blocks")), F.array(own, own + 1))
              .otherwise(F.array(own)))
    dealt = (rows.withColumn("tokens", tokens("text")).withColumn("own", own)
             .withColumn("block", F.explode(blocks)).withColumn("carried", F.col("block") != F.col("own")))
    order = ["conv_id", "block", "n", "turn", "role", "text"]
    return (dealt.repartition("conv_id", "block").sortWithinPartitions(*order)
            .select("conv_id", "block", "carried", "n", "role", "text", "tokens").mapInArrow(cut, schema))


def _numbers(rows: DataFrame) -> DataFrame:
    """``file, at, n`` (from 1) and ``blocks`` (of its conversation) for the
    turns of conversations of more than BLOCK turns; no text takes part."""
    narrow = rows.select("file", "at", "conv_id", "turn", "role", F.md5("text").alias("digest"))
    long = (rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).filter(F.col("turns") > BLOCK)
            .select(F.col("conv_id").alias("_conv"), F.ceil(F.col("turns") / BLOCK).cast("int").alias("blocks")))
    own = write_table(narrow.join(long, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv"), "chat-long")
    order = ["turn", "role", "digest", "file", "at"]
    counted = running_count(own, ["conv_id"], order, "n", "turn", bucket=order_range(own, ["conv_id", *order], 100_000))
    return counted.select("file", "at", "n", "blocks")


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted windows in their order alone: ``n_turns``,
    ``turns_sha256`` (role, newline, text, newline of each turn),
    ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    kind = dict(windows.dtypes)["conv_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out, shape = None, None, [], None

        def row():
            return {"conv_id": current, "n_turns": state[0], "turns_sha256": state[1].hexdigest(),
                    "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        for batch in batches:
            if shape is None:
                shape = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()),
                                   ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for c, repeated, formatted, loss in zip(*(batch.column(k).to_pylist() for k in
                                                      ("conv_id", "repeated", "formatted", "loss"))):
                if state is None or c != current:
                    if state is not None:
                        out.append(row())
                    current, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(formatted)
                for role, text, _, _ in list(parse(formatted))[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    target = unescape(formatted[span["start"]:span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, shape)
                out = []
        if state is not None:
            out.append(row())
            yield pa.RecordBatch.from_pylist(out, shape)

    ordered = (windows.select("conv_id", "window", "repeated", "formatted", "loss").repartition("conv_id")
               .sortWithinPartitions("conv_id", "window").drop("window"))
    return ordered.mapInArrow(
        digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                "formatted_chars long")
