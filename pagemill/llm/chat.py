"""Chat formatting: a hidden Markov model recovers who speaks, Viterbi decodes it, turns are rendered.

A transcript is a conversation's turns in order, each beginning with the speaker marker its source gives
(``User:``, ``### Assistant:``, ``AI:`` ... or none) and read line by line.  Hidden states are (role, begins)
and (role, goes on).  A line emits the kind of its marker and a few features of its own (question, long,
blank).  Role changes and features are counted over all turns that carry a known role; how far a marker is
to be trusted is a parameter.  A turn's first line always begins a turn; a marker within a text begins one
there if the whole conversation reads better that way.

Conversations are dealt by ranges of (conversation, turn), so one of any length spreads over many tasks; parts
hold ``PART_BYTES`` of text at most, about.  A first pass counts role changes and features; what lies across the
borders of parts and tasks is counted from the rows there, so the model doesn't depend on how rows are dealt.
A second pass sums up each part's share of the conversations that cross its borders as a max-plus matrix;
chaining those (one small matrix a part) gives each part the best score up to its first line and from its
last one on; the third decodes every part by itself.  That is exact Viterbi, not an approximation.

Defined results: null roles give no marker, unknown ones a marker of no known speaker; null or empty texts
are one empty line; null conversation ids are one conversation; repeated rows are turns of their own; equal turn
numbers stand in the order of a hash of their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

ROLES = ("system", "user", "assistant")
#: What sources call the speakers.
SPEAKERS = {
    "system": ("system", "developer", "context", "instructions"),
    "user": ("user", "human", "prompter", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "gpt", "model", "answer", "a", "agent", "chatbot"),
}
NAMED = {name: role for role, names in SPEAKERS.items() for name in names}
#: At a turn's first line: its own marker, none, another role's; a marker is all but certain.  Within a text: a line that begins a turn,
#: and a marker on a line that doesn't (SURE: one of a chat template's own, which prose doesn't hold).
OWN, BARE, OTHER = 0.97, 0.02999, 0.00001
BREAK, STRAY, SURE = 0.02, 0.002, 0.000001
LONG = 200
NONE, ODD = "none", "odd"
N = len(ROLES)
_NAMES = "|".join(sorted(NAMED, key=len, reverse=True))
_WHOLE = "|".join(sorted((n for n in NAMED if len(n) > 1), key=len, reverse=True))
#: <|im_start|>name, <|name|> and [name] stand by themselves; # name needs a colon or the line's end, a bare name a colon.
_INLINE = re.compile(
    rf"^\s*(?:<\|im_start\|>\s*({_WHOLE})\b\s*:?\s*|<\|\s*({_WHOLE})\s*\|>\s*:?\s*|\[\s*({_WHOLE})\s*\]\s*:?\s*|#{{1,6}}\s*({_WHOLE})\s*(?::\s*|$)|(?:#{{1,6}}\s*|\[)?({_NAMES})\s*\]?\s*:\s*)",
    re.I,
)
START, END = "<|im_start|>", "<|im_end|>"
PART_BYTES = 16_000_000


def marker_of(line: str) -> tuple[str, int]:
    """The role that a line's marker names, and where the text after it starts."""
    found = _INLINE.match(line)
    return (NAMED[found[found.lastindex].lower()], found.end()) if found else (NONE, 0)


def lines_of(role: str | None, text: str | None) -> list[tuple[str, int, str]]:
    """(marker, characters of the marker, line) of each line of a turn."""
    out = [(*marker_of(line), line) for line in (text or "").split("\n")]
    if role is not None and role.strip():
        given = NAMED.get(role.strip().lower(), ODD)
        out[0] = (given, out[0][1] if out[0][0] == given else 0, out[0][2])
    return out


def feature(line: str) -> int:
    bare = line.strip()
    return (bare[-1:] == "?") + 2 * (len(bare) > LONG) + 4 * (not bare)


class Model:
    """States 0..N-1 begin a turn of a role, N..2N-1 go on with one."""

    def __init__(self, turns: dict[tuple[str, str], int], features: dict[tuple[str, int], int]):
        rate = lambda found, total, kinds: math.log((found + 1) / (total + kinds))
        self.first = np.full(2 * N, -np.inf)
        self.step = np.full((2 * N, 2 * N), -np.inf)
        after = {a: sum(turns.get((a, b), 0) for b in ROLES) for a in ("", *ROLES)}
        for k, b in enumerate(ROLES):
            self.first[k] = rate(turns.get(("", b), 0), after[""], N)
            for j, a in enumerate(ROLES):
                for state in (j, N + j):
                    self.step[state, k] = rate(turns.get((a, b), 0), after[a], N)
            for state in (k, N + k):
                self.step[state, N + k] = 0.0
        total = {a: sum(features.get((a, f), 0) for f in range(8)) for a in ROLES}
        # a tenth of each is uniform, so that no line's features outweigh a marker, however lopsided the counts
        self.feature = np.log([[0.9 * math.exp(rate(features.get((a, f), 0), total[a], 8)) + 0.1 / 8 for a in ROLES * 2] for f in range(8)])
        self.begin, self.on, self.sure = {}, {}, {}
        for m in (NONE, ODD, *ROLES):
            self.begin[m] = np.array([math.log(BARE if m in (NONE, ODD) else OWN if m == r else OTHER / (N - 1)) for r in ROLES] + [-np.inf] * N)
            inside = lambda stray, m=m: math.log(1 - BREAK) + math.log(1 - stray if m == NONE else stray)
            # within a text only a marker begins a turn
            starts = [-np.inf] * N if m == NONE else [math.log(BREAK) + x for x in self.begin[m][:N]]
            self.on[m], self.sure[m] = (np.array(starts + [inside(stray)] * N) for stray in (STRAY, SURE))

    def emit(self, marker: str, line: str, starts: bool) -> np.ndarray:
        told = self.begin if starts else self.sure if line.lstrip().startswith("<|") else self.on
        return told[marker] + self.feature[feature(line)]

    def into(self, before: np.ndarray, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores one line on, and where each came from."""
        ways = before[:, None] + self.step
        best = ways.argmax(axis=0)
        return ways[best, np.arange(2 * N)] + emitted, best


def emissions(model: Model, rows: list[tuple]) -> Iterator[np.ndarray]:
    for _, _, role, text in rows:
        for k, (marker, _, line) in enumerate(lines_of(role, text)):
            yield model.emit(marker, line, k == 0)


def matrix(model: Model, rows: list[tuple]) -> np.ndarray:
    """Best score from each state before the rows to each state at their last line."""
    total = np.full((2 * N, 2 * N), -np.inf)
    np.fill_diagonal(total, 0.0)
    for e in emissions(model, rows):
        total = (total[:, :, None] + model.step[None]).max(axis=1) + e
    return total


def decode(model: Model, rows: list[tuple], before: np.ndarray | None, after: np.ndarray | None) -> list[list[int]]:
    """The states of each row's lines.  before: scores of the states ahead of the rows (None: a conversation starts);
    after: scores of what follows, by the state at the last line (None: nothing follows)."""
    back, score = [], None
    for e in emissions(model, rows):
        if score is None and before is None:
            score, came = model.first + e, np.zeros(2 * N, np.int64)
        else:
            score, came = model.into(before if score is None else score, e)
        back.append(came)
    state = int((score if after is None else score + after).argmax())
    states = []
    for came in reversed(back):
        states.append(state)
        state = int(came[state])
    states.reverse()
    out, at = [], 0
    for _, _, role, text in rows:
        n = (text or "").count("\n") + 1
        out.append(states[at : at + n])
        at += n
    return out


def rendered(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def pieces(rows: list[tuple], states: list[list[int]]) -> Iterator[tuple]:
    """(conv_id, turn, piece, role, text, rendered) of each recovered turn."""
    for (conv, turn, role, text), own in zip(rows, states, strict=True):
        parts: list[tuple[str, list[str]]] = []
        for (marker, n, line), state in zip(lines_of(role, text), own, strict=True):
            if state < N:
                parts.append((ROLES[state], [line[n:] if marker == ROLES[state] else line]))
            else:
                parts[-1][1].append(line)
        opened = [START in line for (_, _, line), state in zip(lines_of(role, text), own, strict=True) if state < N]
        for k, (who, lines) in enumerate(parts):
            body = "\n".join(lines)
            if opened[k]:  # rendered before: what the markers add goes
                body = re.sub(rf"{re.escape(END)}\s*\Z", "", body.removeprefix("\n"))
            yield conv, turn, k, who, body, rendered(who, body)


def _conversations(table: pa.Table) -> list[list[tuple]]:
    """Rows of one part, in order, by conversation."""
    order = table.sort_by("pos")
    out: list[list[tuple]] = []
    for row in zip(*(order.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
        if not out or out[-1][0][0] != row[0]:
            out.append([])
        out[-1].append(row)
    return out


def ordered(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """part, pos, conv_id, turn, role, text: parts follow one another in the order of conversation and turn."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int64)), pa.array(np.arange(pos, pos + n)), *batch.columns], ["part", "pos", *batch.schema.names])
            pos += n

    spark = conversations.sparkSession
    rows = conversations.select(*[F.col(f"`{c}`").cast(kind).alias(name) for c, kind, name in ((conv_col, "long", "conv_id"), (turn_col, "long", "turn"), (role_col, "string", "role"), (text_col, "string", "text"))])
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    n = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // 1_000_000)), -(-size // PART_BYTES), 1)
    # the last key parts rows that are the same in every column
    keys = ["conv_id", "turn", "h", "r", "m"]
    dealt = rows.withColumns({"h": F.xxhash64("text"), "r": F.xxhash64("role"), "m": F.monotonically_increasing_id()}).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return materialize(dealt.select("conv_id", "turn", "role", "text").mapInArrow(number, "part long, pos long, conv_id long, turn long, role string, text string"), "turns")


UNKNOWN = "?"


def known(role: str | None) -> str:
    return NAMED.get((role or "").strip().lower(), UNKNOWN)


def learn(turns: DataFrame) -> Model:
    """Role changes and line features over all turns of known role."""
    kinds = pa.schema([("kind", pa.string()), ("a", pa.string()), ("b", pa.string()), ("f", pa.int32()), ("n", pa.int64()), ("part", pa.int64()), ("pos", pa.int64()), ("conv_id", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        ends: list[tuple] = []  # (first | last, role, part, pos, conversation) of each run of rows that follow one another
        last = None
        for batch in batches:
            for part, pos, conv, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                who = known(role)
                if last is None or last[2] != part or last[3] + 1 != pos:
                    ends += [] if last is None else [("last", *last[1:])]
                    ends.append(("first", who, part, pos, conv))
                else:
                    found["turn", last[1] if last[4] == conv else "", who, 0] += 1
                last = ("last", who, part, pos, conv)
                if who != UNKNOWN:
                    for line in (text or "").split("\n"):
                        found["line", who, "", feature(line)] += 1
        ends += [] if last is None else [last]
        rows = [(*k, n, None, None, None) for k, n in found.items()] + [(kind, who, None, None, None, part, pos, conv) for kind, who, part, pos, conv in ends]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    counted = materialize(turns.mapInArrow(count, "kind string, a string, b string, f int, n long, part long, pos long, conv_id long"), "turn-counts")
    # at most some sixty rows
    turn, line = Counter(), Counter()
    for r in counted.where("kind IN ('turn', 'line')").groupBy("kind", "a", "b", "f").agg(F.sum("n").alias("n")).collect():
        if r.kind == "line":
            line[r.a, r.f] += r.n
        elif UNKNOWN not in (r.a, r.b):
            turn[r.a, r.b] += r.n
    # two rows a part and task: a run's first row follows the last one of the run before
    last = None
    for r in sorted(counted.where("kind IN ('first', 'last')").select("kind", "a", "part", "pos", "conv_id").collect(), key=lambda r: (r.part, r.pos, r.kind)):
        if r.kind == "first":
            before = last.a if last is not None and last.conv_id == r.conv_id else ""
            if UNKNOWN not in (before, r.a):
                turn[before, r.a] += 1
        else:
            last = r
    return Model(turn, line)


def borders(turns: DataFrame, model: Model) -> dict[int, tuple]:
    """part -> (scores ahead of its first conversation or None, scores of what follows its last one or None)."""

    def sum_up(table: pa.Table) -> pa.Table:
        own = _conversations(table)
        ends = [own[0], own[-1]]
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()], pa.int64()),
            "first": pa.array([ends[0][0][0]], pa.int64()), "last": pa.array([ends[1][0][0]], pa.int64()), "one": pa.array([len(own) == 1]),
            "head": pa.array([matrix(model, ends[0]).ravel().tolist()], pa.list_(pa.float64())), "tail": pa.array([matrix(model, ends[1]).ravel().tolist()], pa.list_(pa.float64())),
            "start": pa.array([start_scores(model, ends[1]).tolist()], pa.list_(pa.float64())),
        })

    # two small matrices a part
    parts = turns.groupBy("part").applyInArrow(sum_up, "part long, first long, last long, one boolean, head array<double>, tail array<double>, start array<double>").orderBy("part").collect()
    square = lambda x: np.array(x).reshape(2 * N, 2 * N)
    before: dict[int, np.ndarray | None] = {}
    carried, last = None, None
    for k, p in enumerate(parts):
        before[p.part] = carried if k and p.first == last else None
        if p.one and before[p.part] is not None:
            carried = (before[p.part][:, None] + square(p.tail)).max(axis=0)
        else:
            carried = np.array(p.start)
        last = p.last
    after: dict[int, np.ndarray | None] = {}
    carried, following = None, None
    for k, p in enumerate(reversed(parts)):
        after[p.part] = carried if k and p.last == following else None
        rest = after[p.part] if p.one and after[p.part] is not None else np.zeros(2 * N)
        carried = (square(p.head) + rest).max(axis=1)
        following = p.first
    return {p.part: (before[p.part], after[p.part]) for p in parts}


def start_scores(model: Model, rows: list[tuple]) -> np.ndarray:
    """Best scores at the last line of rows with which a conversation starts."""
    score = None
    for e in emissions(model, rows):
        score = model.first + e if score is None else model.into(score, e)[0]
    return score


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a recovered turn: conv_id, turn, piece, role, text, rendered."""
    spark = conversations.sparkSession
    turns = ordered(conversations, conv_col, turn_col, role_col, text_col)
    model = learn(turns)
    shared = spark.sparkContext.broadcast((model, borders(turns, model)))

    def recover(table: pa.Table) -> pa.Table:
        fitted, edges = shared.value
        before, after = edges[table.column("part")[0].as_py()]
        own, out = _conversations(table), []
        for k, rows in enumerate(own):
            states = decode(fitted, rows, before if k == 0 else None, after if k == len(own) - 1 else None)
            out += pieces(rows, states)
        kinds = [("conv_id", pa.int64()), ("turn", pa.int64()), ("piece", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("rendered", pa.string())]
        return pa.table([pa.array(c, kind) for c, (_, kind) in zip(zip(*out, strict=True), kinds, strict=True)], schema=pa.schema(kinds))

    return turns.groupBy("part").applyInArrow(recover, "conv_id long, turn long, piece int, role string, text string, rendered string")
