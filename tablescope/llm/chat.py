"""Chat formatting: transcripts are parsed by a hidden Markov model.

A transcript is a conversation's rows in order of their position, each holding
one or more lines, with speaker markers ("User:", "Q:") on some turns, spelled
in several ways, and on others none. The hidden states are the roles, each
beginning a turn or inside one. A line is observed as its marker word, length,
last character and first letter; counts over all labelled rows give the
probabilities. Viterbi finds the best states, and turns are rendered in one
canonical form.

No conversation need fit a task. Rows are range-partitioned by conversation,
position and the digest of the text, equal ones too, and numbered within their conversation from
per-task counts; a segment is :data:`SEGMENT` of them, whatever their
positions. A segment is summed up as a matrix: the best score
from each state before it to each state at its end. Matrices of one
conversation are multiplied (maximum, plus) in groups of :data:`FAN`, level by
level; then, from the top, each level learns the state before and after each
of its parts. With those a segment is decoded alone, and the result is that of
Viterbi over the whole conversation.

Defined results: a null text is one empty line; a null position comes first;
rows with equal positions are ordered by the text's SHA-256. Rows without a conversation id
are one conversation. Extra columns are ignored; an empty table gives an empty
result. A role that is not in :data:`ROLES` is not counted in training.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescope.session import materialize, materialize_observed

ROLES = ("system", "user", "assistant")
#: Rows in one segment, and parts combined at one level.
SEGMENT, FAN = 64, 64

# Words that are read as speaker markers.
SPEAKERS = frozenset(
    "user human customer me you q question prompt assistant ai bot agent model a answer reply "
    "system instruction instructions context setup".split())

_MARKER = re.compile(r"\s*([A-Za-z]{1,14})\s?[:>]\s*")
_STATES = 2 * len(ROLES)  # even: a turn begins; odd: inside
_K = _STATES + 1  # and the state before the first line
_SIGNS = "SsUuAa"


def observe(line: str) -> tuple[str, ...]:
    """The features of a line, each from a small set of values."""
    m = _MARKER.match(line)
    word = m.group(1).lower() if m else ""
    body = line[m.end():] if word in SPEAKERS else line
    return ("marker " + (word if word in SPEAKERS else "none"),
            f"length {len(body).bit_length()}",
            "last " + (body[-1] if body[-1:] in tuple(".?!:,") else "other" if body else "empty"),
            "first " + ("upper" if body[:1].isupper() else "other"))


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


class Hmm:
    """Log probabilities: of moves between states, and of features in states."""

    def __init__(self, counts: dict[tuple[int, str], int]):
        moves, self.seen = np.ones((_K, _K)), {}
        totals: dict[str, np.ndarray] = {}
        for (state, what), n in counts.items():
            if what.startswith("to "):
                moves[state, int(what[3:])] += n
            else:
                self.seen.setdefault(what, np.zeros(_STATES))[state] += n
                totals.setdefault(what.split(" ")[0], np.zeros(_STATES))[state] += n
        moves[:, _STATES] = 0
        # A turn never starts inside, and inside a turn the role stays.
        for s in range(_K):
            for t in range(1, _STATES, 2):
                if s // 2 != t // 2:
                    moves[s, t] = 0
        with np.errstate(divide="ignore"):
            self.move = np.log(moves / moves.sum(axis=1, keepdims=True))
        kinds = Counter(w.split(" ")[0] for w in self.seen)
        self.rare = {k: np.log(1 / (t + kinds[k] + 1)) for k, t in totals.items()}
        self.seen = {w: np.log((n + 1) / (totals[w.split(" ")[0]] + kinds[w.split(" ")[0]] + 1))
                     for w, n in self.seen.items()}

    def emit(self, lines: list[str]) -> np.ndarray:
        out = np.full((len(lines), _K), -np.inf)
        for i, line in enumerate(lines):
            out[i, :_STATES] = sum(self.seen.get(w, self.rare.get(w.split(" ")[0], 0)) for w in observe(line))
        return out


def combined(parts: Iterator[np.ndarray]) -> np.ndarray:
    """The (maximum, plus) product of matrices."""
    total = None
    for m in parts:
        total = m if total is None else (total[:, :, None] + m[None, :, :]).max(axis=1)
    return total


def trace(parts: list[np.ndarray], before: int, after: int | None) -> list[tuple[int, int]]:
    """States (before, after) each matrix on the best way from ``before`` to
    ``after`` (None: wherever it is best)."""
    score = np.full(_K, -np.inf)
    score[before] = 0
    back = []
    for m in parts:
        step = score[:, None] + m
        back.append(step.argmax(axis=0))
        score = step.max(axis=0)
    at = int(score.argmax()) if after is None else after
    out = []
    for b in reversed(back):
        out.append((int(b[at]), at))
        at = int(b[at])
    return out[::-1]


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys, across the batches of a sorted task."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for key, run in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(run)


def _out(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 512:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows, and the state that its first row begins with
    and its last one ends in: the move into the first row is counted later."""
    counts: Counter = Counter()
    task, first, last, state = TaskContext.get().partitionId(), None, None, None
    for row in (r for batch in batches for r in batch.to_pylist()):
        role = ROLES.index(row["role"]) if row["role"] in ROLES else None
        if first is None:
            first = (row["conv"], None if role is None else 2 * role)
        elif row["conv"] != last:
            state = _STATES
        last = row["conv"]
        if role is None:
            state = None
            continue
        for i, line in enumerate(_lines(row["text"])):
            to = 2 * role + (i > 0)
            counts.update([(to, w) for w in observe(line)])
            if state is not None:
                counts[state, f"to {to}"] += 1
            state = to
    if first is not None:
        yield from _out(_COUNTS, ((None, None, s, w, n) for (s, w), n in counts.items()))
        yield from _out(_COUNTS, iter([(task, *first, "first", 1), (task, last, state, "last", 1)]))


_COUNTS = pa.schema([("task", pa.int64()), ("conv", pa.int64()), ("state", pa.int32()), ("what", pa.string()),
                     ("n", pa.int64())])


def _across(ends: dict[tuple[int, str], tuple[int | None, int | None]]) -> Iterator[tuple[int, int]]:
    """The moves into the first rows of tasks, of (conversation, state) by
    task and "first" or "last"."""
    before: tuple = (object(), None)
    for task in sorted({t for t, _ in ends}):
        conv, to = ends[task, "first"]
        state = before[1] if conv == before[0] else _STATES
        if state is not None and to is not None:
            yield state, to
        before = ends[task, "last"]


def _matrices(shared):
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("matrix", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def rows() -> Iterator[tuple]:
            for (conv, segment), group in _groups(batches, ("conv", "segment")):
                lines = [x for r in group for x in _lines(r["text"])]
                yield conv, segment, combined(model.move + e for e in model.emit(lines)).ravel()
        yield from _out(schema, rows())
    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("matrix", pa.list_(pa.float64()))])
    yield from _out(schema, ((conv, up, combined(np.reshape(r["matrix"], (_K, _K)) for r in group).ravel())
                             for (conv, up), group in _groups(batches, ("conv", "up"))))


_ENDS = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("before", pa.int32()), ("after", pa.int32()),
                   ("last", pa.bool_())])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for _, group in _groups(batches, ("conv", "up")):
            first = group[0]
            states = trace([np.reshape(r["matrix"], (_K, _K)) for r in group], first["b"], first["a"])
            for i, (r, (b, a)) in enumerate(zip(group, states, strict=True)):
                yield r["conv"], r["part"], b, a, first["l"] and i == len(group) - 1
    yield from _out(_ENDS, rows())


_RENDERED = pa.schema([("conv", pa.int64()), ("segment", pa.int64()), ("n_lines", pa.int64()),
                       ("n_turns", pa.int64()), ("states", pa.string()), ("rendered", pa.string())])


def _render(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value

        def rows() -> Iterator[tuple]:
            for (conv, segment), group in _groups(batches, ("conv", "segment")):
                lines = [x for r in group for x in _lines(r["text"])]
                first = group[0]
                states = [a for _, a in trace([model.move + e for e in model.emit(lines)],
                                              first["before"], first["after"])]
                yield (conv, segment, len(lines), sum(s % 2 == 0 for s in states), "".join(_SIGNS[s] for s in states),
                       canonical(lines, states, first["before"] == _STATES, first["last"]))
        yield from _out(_RENDERED, rows())
    return run


def canonical(lines: list[str], states: list[int], first: bool, last: bool) -> str:
    """Turns as ``<|role|>``, their lines, ``<|end|>``. A part of a transcript
    closes the turn before it only when a new one begins; the last one closes."""
    out = []
    for line, state in zip(lines, states, strict=True):
        if state % 2 == 0:
            m = _MARKER.match(line)
            if m and m.group(1).lower() in SPEAKERS:
                line = line[m.end():]
            if not (first and not out):
                out.append("<|end|>")
            out.append(f"<|{ROLES[state // 2]}|>")
        out.append(line)
    return "\n".join([*out, "<|end|>"] if last else out) + "\n"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, last, n = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        at = []
        for conv in batch.column("conv").to_pylist():
            n = n + 1 if conv == last else 0
            last = conv
            at.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("text"),
                                          pa.array([task] * len(at), pa.int64()), pa.array(at, pa.int64())],
                                         names=["conv", "text", "task", "at"])


def _in_order(rows: DataFrame, *by: str) -> DataFrame:
    """Tasks of neighbouring rows, in order; also rows that are equal in ``by``
    (no result depends on theirs) are spread over tasks."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    return rows.repartitionByRange(*by, "tie").sortWithinPartitions(*by, "tie").drop("tie")


def _with_digest(rows: DataFrame) -> DataFrame:
    """What orders the rows at one position: 64 characters of a text, as the
    rows that a range partition samples go to the driver."""
    return rows.withColumn("dig", F.sha2("text", 256))


def _numbered(rows: DataFrame) -> DataFrame:
    """``conv``, ``text`` and ``number``, the row's place in its conversation."""
    placed = materialize(_in_order(_with_digest(rows), "conv", "pos", "dig")
                         .mapInArrow(_number, "conv long, text string, task long, at long"))
    counts = placed.groupBy("conv", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # Only the conversation that a task begins with can have rows before it: one per task.
    before = materialize(counts.select("conv", "task", F.sum("n").over(earlier).alias("before"))
                         .where("before > 0"))
    return (placed.alias("r").join(F.broadcast(before).alias("b"), F.col("r.conv").eqNullSafe(F.col("b.conv"))
                                   & (F.col("r.task") == F.col("b.task")), "left")
            .select("r.conv", "r.text", (F.col("at") + F.coalesce("before", F.lit(0))).alias("number")))


def _dealt(numbered: DataFrame) -> DataFrame:
    rows = numbered.withColumn("segment", F.floor(F.col("number") / SEGMENT).cast("long"))
    return rows.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "number")


def _rows(frame: DataFrame, id_col: str, order_col: str, text_col: str, *more) -> DataFrame:
    return frame.select(F.col(id_col).cast("long").alias("conv"), F.col(order_col).cast("long").alias("pos"),
                        F.col(text_col).cast("string").alias("text"), *more)


def fit(labelled: DataFrame, id_col: str = "conv_id", order_col: str = "turn", text_col: str = "text",
        role_col: str = "role") -> Hmm:
    """The model of all labelled rows, one turn each; of turns that share
    position and text the role decides. Tasks send counts of (state, feature
    value), whose number does not depend on the rows, and their ends."""
    rows = _rows(labelled, id_col, order_col, text_col, F.col(role_col).cast("string").alias("role"))
    counts = (_in_order(_with_digest(rows), "conv", "pos", "dig", "role")
              .mapInArrow(_count, "task long, conv long, state int, what string, n long"))
    found = counts.groupBy("task", "conv", "state", "what").agg(F.sum("n").alias("n")).collect()
    total = Counter({(r["state"], r["what"]): r["n"] for r in found if r["task"] is None})
    total.update((s, f"to {t}") for s, t in _across({(r["task"], r["what"]): (r["conv"], r["state"])
                                                     for r in found if r["task"] is not None}))
    return Hmm(total)


def parse(transcripts: DataFrame, model: Hmm, id_col: str = "conv_id", order_col: str = "turn",
          text_col: str = "text") -> DataFrame:
    """One row per conversation and segment: ``id_col``, ``segment``,
    ``n_lines``, ``n_turns`` (begun there), ``states`` (one letter per line:
    S, U, A where a turn begins, small inside) and ``rendered``; the segments'
    texts one after the other are the conversation's."""
    shared = transcripts.sparkSession.sparkContext.broadcast(model)
    rows = _dealt(_numbered(_rows(transcripts, id_col, order_col, text_col)))
    level, seen = materialize_observed(rows.mapInArrow(_matrices(shared), "conv long, part long, matrix array<double>"),
                                       last=F.max("part"))
    levels, last = [level], seen["last"] or 0
    up = F.floor(F.col("part") / FAN).cast("long")
    while last >= FAN:
        rows_up = levels[-1].withColumn("up", up)
        levels.append(materialize(rows_up.repartition("conv", "up").sortWithinPartitions("conv", "up", "part")
                                  .mapInArrow(_products, "conv long, part long, matrix array<double>")))
        last //= FAN
    # From the top: a whole conversation runs from the start state to the best end.
    ends = (levels[-1].withColumn("up", up).select("conv", "up").distinct()
            .withColumns({"b": F.lit(_STATES), "a": F.lit(None).cast("int"), "l": F.lit(True)}))
    for level in reversed(levels):
        parts = level.withColumn("up", up).alias("p").join(
            ends.alias("e"), F.col("p.conv").eqNullSafe(F.col("e.conv")) & (F.col("p.up") == F.col("e.up")))
        parts = parts.select("p.conv", "p.part", "p.matrix", "p.up", "b", "a", "l")
        found = materialize(parts.repartition("conv", "up").sortWithinPartitions("conv", "up", "part")
                            .mapInArrow(_ends, "conv long, part long, before int, after int, last boolean"))
        ends = found.select("conv", F.col("part").alias("up"), F.col("before").alias("b"),
                            F.col("after").alias("a"), F.col("last").alias("l"))
    known = found.alias("k")
    placed = rows.alias("r").join(known, F.col("r.conv").eqNullSafe(F.col("k.conv"))
                                  & (F.col("r.segment") == F.col("k.part")))
    placed = placed.select("r.conv", "r.segment", "r.number", "r.text", "before", "after", "last")
    return (placed.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "number")
            .mapInArrow(_render(shared), "conv long, segment long, n_lines long, n_turns long, states string, "
                                         "rendered string")
            .withColumnRenamed("conv", id_col))


# How raw transcripts name the speakers (system, user, assistant).
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("SYSTEM> ", "Human: ", "AI: "),
    ("Instructions: ", "Q: ", "A: "),
    ("Context: ", "Customer: ", "Agent: "),
    ("", "Me: ", "Bot: "),
    ("system: ", "user: ", ""),
)


def raw_transcripts(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                    text_col: str = "text", bare: int = 8) -> DataFrame:
    """Turns as they stand in found transcripts: each conversation in one of
    :data:`STYLES`, one turn in ``bare`` without a marker."""
    style = F.pmod(F.xxhash64(F.col(id_col)), F.lit(len(STYLES)))
    marker = F.lit("")
    for i, names in enumerate(STYLES):
        for role, name in zip(ROLES, names, strict=True):
            marker = F.when((style == i) & (F.col(role_col) == role), F.lit(name)).otherwise(marker)
    kept = F.pmod(F.xxhash64(F.col(id_col), F.col(order_col)), F.lit(bare)) > 0
    text = F.concat(F.when(kept, marker).otherwise(F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return turns.select(id_col, order_col, role_col, text.alias(text_col))
