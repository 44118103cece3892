"""Chat conversations as training texts in windows of a token budget.

Turns are dealt by conversation and run of turn numbers, sorted, and formatted as a stream.
Prefix sums of the turns' tokens choose each window's span of whole turns. Every window keeps
the conversation's system turn and repeats a limited number of tokens of the turns before it;
the loss mask covers the assistant's texts in the window's new turns only, so each is a target
once.

Control strings inside texts and roles are escaped: backslashes are doubled, and a single one
parts the first character of a control string from the rest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import batches_by_size
from siltstone.llm.pieces import encode_texts

#: Tokens of a window and, of these, of repeated turns.
BUDGET, HISTORY = 1024, 256
#: Turn numbers of a run, and how many of its last ones may be repeated in the next run.
RUN, TAIL = 512, 32


@dataclass(frozen=True)
class Template:
    """``begin`` and then, for each turn, ``opens`` role ``says`` text ``closes``.

    ``reserved`` are further strings that must not stand in a text as they are.
    """

    begin: str = "<s>"
    opens: str = "<|turn|>"
    says: str = "<|says|>"
    closes: str = "</s>"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>")

    def __post_init__(self) -> None:
        marks = [self.begin, self.opens, self.says, self.closes]
        for m in (*marks, *self.reserved):
            if len(m) < 2 or "\\" in m or any(m.startswith(m[-k:]) for k in range(1, len(m))):
                raise ValueError(f"{m!r} cannot be a control string: too short, with a backslash, or overlapping itself")
        if len(set(marks)) < 4 or any(a != b and a[-k:] == b[:k] for a in marks for b in (*marks, *self.reserved)
                                      for k in range(1, min(len(a), len(b)) + 1)):
            raise ValueError("control strings must differ, and none may begin with the end of a marker")

    @cached_property
    def _inside(self) -> re.Pattern:
        marks = (self.begin, self.opens, self.says, self.closes, *self.reserved)
        return re.compile(f"(?=(?:{'|'.join(map(re.escape, marks))}))(.)", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._inside.sub(r"\1\\", text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def turn(self, role: str, text: str) -> tuple[str, int, int]:
        """A formatted turn and where its text begins and ends."""
        head = f"{self.opens}{self.escape(role)}{self.says}"
        body = self.escape(text)
        return f"{head}{body}{self.closes}", len(head), len(head) + len(body)

    def parse(self, window: str) -> list[tuple[str, str]]:
        """Role and text of a window's turns; ValueError if it is not of this template."""
        if not window.startswith(self.begin):
            raise ValueError(f"a window does not begin with {self.begin!r}")
        turns, at = [], len(self.begin)
        while at < len(window):
            says = window.find(self.says, at)
            ends = window.find(self.closes, says)
            if not window.startswith(self.opens, at) or says < 0 or ends < 0:
                raise ValueError(f"no turn at character {at} of a window")
            turns.append((self.unescape(window[at + len(self.opens):says]),
                          self.unescape(window[says + len(self.says):ends])))
            at = ends + len(self.closes)
        return turns


@dataclass
class _Turn:
    line: str
    text: tuple[int, int]
    target: bool
    tokens: int
    key: tuple


def spans(prefix: np.ndarray, start: int, first: int, room: int, history: int) -> tuple[int, int]:
    """The window whose first new turn is ``start``: where its repeated turns begin and where
    it ends. ``prefix`` are the running sums of the turns' tokens, one more than turns; turns
    before ``first`` are not repeated. A turn that alone exceeds ``room`` has its own window.
    """
    low = np.searchsorted(prefix, prefix[start] - history)  # repeated turns within their share
    low = max(low, first, np.searchsorted(prefix, prefix[start + 1] - room))  # and the new one fits
    low = min(int(low), start)
    end = int(np.searchsorted(prefix, prefix[low] + room, side="right")) - 1
    return low, max(end, start + 1)


class _Group:
    """The turns of one run of a conversation, cut into windows as they come."""

    def __init__(self, conv_id, run: int, begin: int, template: Template, budget: int, history: int):
        self.conv_id, self.run = conv_id, run
        self.begin, self.template, self.budget, self.history = begin, template, budget, history
        self.head: _Turn | None = None
        self.head_new = False  # the head is the first new turn, not a repeated one
        self.begun = False  # an earlier run or turn is known
        self.turns: list[_Turn] = []
        self.start = 0  # the first turn that is not in a window yet
        self.held = self.window = 0

    def add(self, kind: int, turn: _Turn) -> None:
        if kind == 1:
            if not (self.head and self.head.key == turn.key):
                self.turns.append(turn)
                self.start += 1
                self.held += turn.tokens
        else:
            if not (self.begun or self.turns) and turn.key[1] == "system":
                self.head, self.head_new = turn, True
            self.begun = True
            self.turns.append(turn)
            self.held += turn.tokens

    def cut(self, last: bool) -> Iterator[tuple]:
        """Windows of the turns held: all of them, or those that further turns cannot change."""
        prefix = np.cumsum([0, *(t.tokens for t in self.turns)])
        n = len(self.turns)
        while self.start < n:
            fresh = self.head is None or (self.head_new and self.start == 0)
            room = self.budget - self.begin - (0 if fresh else self.head.tokens)
            low, end = spans(prefix, self.start, int(self.head_new and self.start > 0), room, self.history)
            if end == n and not last:
                break
            yield self._row(low, end, [] if fresh else [self.head])
            self.start = end
        low = int(np.searchsorted(prefix, prefix[self.start] - self.history))
        keep = min(low, self.start)
        if keep and self.head_new:
            self.head_new = False  # from now on the head stands apart from the turns held
        self.turns, self.start = self.turns[keep:], self.start - keep
        self.held = sum(t.tokens for t in self.turns)

    def _row(self, low: int, end: int, head: list[_Turn]) -> tuple:
        parts, loss, at = [self.template.begin], [], len(self.template.begin)
        chosen = [*head, *self.turns[low:end]]
        repeated = len(head) + self.start - low
        for i, t in enumerate(chosen):
            if i >= repeated and t.target:
                loss.append({"start": at + t.text[0], "end": at + t.text[1]})
            parts.append(t.line)
            at += len(t.line)
        tokens = self.begin + sum(t.tokens for t in chosen)
        self.window += 1
        return self.conv_id, self.run, self.window - 1, "".join(parts), tokens, len(chosen), repeated, loss


_WINDOW = ("conv_id long, run long, window long, text string, n_tokens long, n_turns long, "
           "n_repeated long, loss array<struct<start: int, end: int>>")
_WINDOW_TYPE = pa.schema([
    ("conv_id", pa.int64()), ("run", pa.int64()), ("window", pa.int64()), ("text", pa.string()),
    ("n_tokens", pa.int64()), ("n_turns", pa.int64()), ("n_repeated", pa.int64()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _table(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _stream(batches: Iterable[pa.RecordBatch], model: str, template: Template, budget: int, history: int,
            target: str) -> Iterator[pa.RecordBatch]:
    group, seen, out, size = None, None, [], 0
    roles: dict[str, int] = {}

    def done(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal out, size
        for row in group.cut(last):
            out.append(row)
            size += len(row[3])
            if size > 1 << 22:
                yield from _table(out, _WINDOW_TYPE)
                out, size = [], 0

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "run", "kind", "at", "role", "text")]
        texts = [template.escape(t or "").encode() for t in columns[-1]]
        sizes: list[int] = []
        for a, b in batches_by_size(texts):
            sizes += map(len, encode_texts(model, texts[a:b]))
        for row, n in zip(zip(*columns, strict=True), sizes, strict=True):
            conv_id, run, kind, at, role, text = row
            if (conv_id, run) != seen:
                if group is not None:
                    yield from done(True)
                seen, group = (conv_id, run), _Group(conv_id, run, 1, template, budget, history)
            if kind == 0:
                group.begun = True
            if role is None:  # nothing to repeat in this run
                continue
            if role not in roles:
                roles[role] = len(encode_texts(model, [template.escape(role).encode()])[0])
            line, begin, end = template.turn(role, text)
            turn = _Turn(line, (begin, end), role == target, n + roles[role] + 3, (at, role, text))
            if kind == 0:
                group.head = turn
            else:
                group.add(kind, turn)
            if group.held > 64 * budget:
                yield from done(False)
    if group is not None:
        yield from done(True)
    yield from _table(out, _WINDOW_TYPE)


def windows(conversations: DataFrame, model: str, template: Template | None = None, budget: int = BUDGET,
            history: int = HISTORY, target: str = "assistant", run: int = RUN) -> DataFrame:
    """conv_id, run, window, text, n_tokens, n_turns, n_repeated, loss: formatted conversations.

    Turns go by ``turn`` (NULL first), then role and text. A window holds at most ``budget``
    tokens: a begin token, three markers a turn, and the ids of role and text by the
    SentencePiece ``model``; a turn that alone exceeds what the system turn leaves has a window
    of its own, over the budget and whole. The first turn, if its role is ``system``, is in
    every window; up to ``history`` tokens of the turns before are repeated. ``n_repeated``
    turns at a window's beginning are such repeats; ``loss`` gives the code point ranges of the
    ``target`` role's texts in its new turns. Windows of a conversation go by (run, window).

    A run of ``run`` turn numbers is the unit that is dealt to tasks, so a conversation of any
    length is formatted by many; each run begins a window. NULL texts and roles are empty; a
    NULL conv_id is a conversation; repeated rows are turns of their own; other columns are
    ignored; an empty table gives no rows.
    """
    template = template or Template()
    least = F.lit(-2**63).cast("long")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), least).alias("at"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).withColumn("run", F.expr(f"at div {run} - IF(at % {run} < 0, 1, 0)"))

    # Conversations of several runs: a row of kind 0 tells each later run that the conversation
    # has begun, and its system turn if there is one.
    same = lambda a, b, *cols: [a[c].eqNullSafe(b[c]) for c in cols]
    long = turns.groupBy("conv_id").agg(F.min("run").alias("low"), F.max("run").alias("high"),
                                        F.min("at").alias("at")).where("low < high")
    opening = turns.join(long, same(turns, long, "conv_id", "at"), "left_semi").groupBy("conv_id", "at", "run").agg(
        F.min(F.struct("role", "text")).alias("first"))
    system = F.when(F.col("first.role") == "system", F.col("first"))
    opening = opening.select("conv_id", "at", F.col("run").alias("low"), system.alias("head"))
    later = turns.select("conv_id", "run").distinct()
    later = later.join(opening, [*same(later, opening, "conv_id"), later.run > opening.low]).select(
        later.conv_id, "at", F.col("head.role").alias("role"), F.col("head.text").alias("text"), "run",
        F.lit(0).alias("kind"))

    own = F.array(F.struct(F.col("run").alias("run"), F.lit(2).alias("kind")))
    both = F.concat(own, F.array(F.struct((F.col("run") + 1).alias("run"), F.lit(1).alias("kind"))))
    near_end = F.pmod("at", F.lit(run)) >= run - min(TAIL, run)
    dealt = turns.select("conv_id", "at", "role", "text", F.inline(F.when(near_end, both).otherwise(own)))
    return (
        dealt.unionByName(later)
        .repartition("conv_id", "run")
        .sortWithinPartitions("conv_id", "run", "kind", "at", "role", "text")
        .mapInArrow(lambda b: _stream(b, model, template, budget, history, target), _WINDOW)
    )


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterable[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    seen, state, out = False, None, []
    for batch in batches:
        for conv_id, text, repeated, loss in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "text", "n_repeated", "loss")), strict=True):
            if state is None or conv_id != seen:
                if state:
                    out.append((seen, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                seen, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in template.parse(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for part in loss:
                said = template.unescape(text[part["start"]:part["end"]])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if len(out) > 4096:
            yield from _table(out, schema)
            out = []
    if state:
        out.append((seen, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
    yield from _table(out, schema)


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from windows.

    Each conversation is parsed from its windows alone, in order and as a stream: repeated turns
    are passed over, texts and masked ranges unescaped. ``formatted_chars`` counts the code
    points of all its windows. Text that is not of the template stops the read.
    """
    template = template or Template()
    return (
        formatted.select("conv_id", "run", "window", "text", "n_repeated", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "run", "window")
        .mapInArrow(lambda batches: _digests(batches, template), _DIGEST)
    )
