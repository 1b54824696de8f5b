"""Roles in chat transcripts by a hidden Markov model over lines, then turns in one canonical form.

Each line of a transcript shows a speaker marker or none, its length, whether it asks, whether it opens the transcript and
whether it opens a row of the table. Hidden states say who speaks and whether the line opens a turn. Viterbi runs in
blocks of at most some 64 rows: a long conversation's blocks are reduced to small max-plus matrices, runs of which are
joined level by level to find each block's first and last state, and then decoded apart, so no conversation has to fit a
task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .scratch import done, saved

ROLES = ("system", "user", "assistant")
# Names that speakers go by.
NAMES = {
    "system": ("system", "sys", "instruction", "instructions", "context", "developer"),
    "user": ("user", "human", "customer", "client", "question", "q", "prompter", "me", "you"),
    "assistant": ("assistant", "ai", "bot", "gpt", "model", "agent", "answer", "a", "chatbot", "support"),
}
_ROLE = {n: i for i, r in enumerate(ROLES) for n in NAMES[r]}
#: names that are also letters or common words: inside a row they are markers only where used again, as such, in it
COMMON = frozenset("a q me you model agent answer question context instruction instructions support client customer developer".split())
_MARK = re.compile(r"^\s*(?:[#>*\[<|(]+\s*)?([A-Za-z]{1,14})\s*(?:[\]>|*)]+\s*:?|:)[*\s]*")
#: states: who speaks, and whether the line opens a turn
STATES = [(r, opens) for r in range(3) for opens in (True, False)]
BLOCK = 64


def marker(line: str) -> tuple[int, int]:
    """Role that a line's marker names (3: none), and the marker's length."""
    m = _MARK.match(line)
    role = _ROLE.get(m[1].lower(), 3) if m else 3
    return role, m.end() if role < 3 else 0


def marked(rows: list[str], alone: bool) -> list[tuple[str, int, int, int]]:
    """(line, role of its marker, the marker's length, opens a row) for each line of some rows.

    alone: the one row is the whole transcript, so rows say nothing of turns (2).
    """
    out = []
    for row in rows:
        lines = row.split("\n")
        names = [m[1].lower() for x in lines if (m := _MARK.match(x)) and m[1].lower() in COMMON]
        for k, line in enumerate(lines):
            role, n = marker(line)
            m = _MARK.match(line) if role < 3 else None
            if m and k and m[1].lower() in COMMON and not (alone and names.count(m[1].lower()) > 1):
                role, n = 3, 0
            out.append((line, role, n, 2 if alone else int(k == 0)))
    return out


def observe(line: str, role: int, opens: int, first: bool) -> tuple[int, int, int, int, int]:
    """Marker, length in four steps, asks, opens the transcript, opens a row."""
    n = len(line)
    return role, (n > 0) + (n > 60) + (n > 300), int(line.rstrip().endswith("?")), int(first), opens


@dataclass
class Model:
    """Log probabilities: start (6), move (6, 6), and for each feature a table (6, values)."""

    start: np.ndarray
    move: np.ndarray
    show: list[np.ndarray] = field(default_factory=list)

    def emission(self, seen: np.ndarray) -> np.ndarray:
        return sum(t[:, seen[:, i]].T for i, t in enumerate(self.show))


def prior() -> list[np.ndarray]:
    """Pseudo-counts: what is expected of transcripts before any was seen."""
    start = np.array([4.0 if o else 0.01 for _, o in STATES]) * np.array([1, 1, 2, 2, 0.5, 0.5])
    move = np.full((6, 6), 0.02)
    turn = np.array([[0.5, 8, 2], [0.2, 0.5, 8], [0.2, 8, 0.5]])
    for i, (r, _) in enumerate(STATES):
        for j, (q, opens) in enumerate(STATES):
            move[i, j] = turn[r, q] if opens else (8.0 if q == r else 0.001)
    marks = np.full((6, 4), 0.05)
    for i, (r, opens) in enumerate(STATES):
        marks[i, r] = 20.0 if opens else 0.01
        marks[i, 3] = 3.0 if opens else 20.0
    length, asks, first = np.full((6, 4), 3.0), np.full((6, 2), 2.0), np.full((6, 2), 2.0)
    asks[2, 1], asks[4, 1] = 3.0, 0.7
    first[0, 1] = 3.0
    row = np.array([[6.0, 30.0, 0.0] if o else [30.0, 0.005, 0.0] for _, o in STATES])
    row[:, 2] = row[:, :2].sum(1)  # says nothing
    return [start, move, marks, length, asks, first, row]


def estimated(counts: list[np.ndarray] | None = None) -> Model:
    total = [p if counts is None else p + c for p, c in zip(prior(), counts or prior(), strict=True)]
    logs = [np.log(t / t.sum(-1, keepdims=True)) for t in total]
    return Model(logs[0], logs[1], logs[2:])


def count(turns: list[tuple[int, str]], first: bool = True) -> list[np.ndarray]:
    """Counts as in prior() of a run of turns with known roles, each a row; first: they open the transcript."""
    out = [np.zeros_like(p) for p in prior()]
    before = -1
    for role, text in turns:
        for k, (line, mark, _, opens) in enumerate(marked([text], False)):
            s = STATES.index((role, k == 0))
            if before >= 0:
                out[1][before, s] += 1
            elif first:
                out[0][s] += 1
            for i, v in enumerate(observe(line, mark, opens, first and before < 0)):
                out[2 + i][s, v] += 1
            before = s
    out[-1][:, 2] = out[-1][:, :2].sum(1)
    return out


def reduced(emission: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best score from each state before these lines to each state of their last line."""
    best = move + emission[0]
    for e in emission[1:]:
        best = (best[:, :, None] + move[None]).max(1) + e
    return best


def viterbi(emission: np.ndarray, move: np.ndarray, start: np.ndarray, last: int = -1) -> np.ndarray:
    """The best states of these lines; start is the score of each first state before its line, last fixes the end."""
    n = len(emission)
    back = np.zeros((n, len(start)), np.int8)
    score = start + emission[0]
    for i in range(1, n):
        step = score[:, None] + move
        back[i] = step.argmax(0)
        score = step.max(0) + emission[i]
    path = np.empty(n, np.int64)
    path[-1] = last if last >= 0 else int(score.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def _block() -> Column:
    """Place of a row: 64 turn numbers to a group; in a group with a turn of very many rows each turn stands alone, cut by hash."""
    fine = F.col("most") > BLOCK
    parts = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") / BLOCK, F.lit(1.0))))).cast("long")
    return F.struct("group", F.when(fine, F.col("turn")).otherwise(0).alias("turn"), F.when(fine, F.shiftrightunsigned("lot", 1) % parts).otherwise(0).alias("part"))


def _placed(rows: DataFrame) -> DataFrame:
    """rows (conv_id, solo, turn, lot, ..) with block, of at most some BLOCK rows; blocks in order hold rows in order of (turn, part, lot)."""
    rows = saved(rows.withColumn("group", F.coalesce(F.expr(f"turn div {BLOCK}"), F.lit(0))), "chat-rows")
    turns = rows.groupBy("conv_id", "solo", "group", "turn").agg(F.count("*").alias("n"))
    heavy = turns.where(F.col("n") > BLOCK)
    groups = heavy.groupBy("conv_id", "solo", "group").agg(F.max("n").alias("most"))
    sizes = saved(turns.join(groups, ["conv_id", "solo", "group"]).select("conv_id", "solo", "group", "turn", "n", "most"), "chat-heavy")
    if not sizes.head(1):
        return rows.withColumn("block", F.struct("group", F.lit(0).cast("long").alias("turn"), F.lit(0).cast("long").alias("part")))
    return rows.join(sizes, ["conv_id", "solo", "group", "turn"], "left").na.fill(1, ["n", "most"]).withColumn("block", _block()).drop("n", "most")


def train(messages: DataFrame, sample: int = 2000) -> Model:
    """Counts over at most about `sample` runs of up to 64 turn numbers with known roles, chosen by a hash.

    A run in which a turn number has more than a few rows is left out of the counts only; a transition from one run to the
    next, or over a missing turn number, is not counted.
    """
    known = messages.where(F.lower("role").isin(list(_ROLE)) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    raw = F.concat(F.lower("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    rows = known.select("conv_id", F.expr(f"turn div {BLOCK}").alias("run"), F.struct("turn", F.lower("role").alias("role"), raw.alias("raw")).alias("t"))
    runs = rows.groupBy("conv_id", "run").agg(F.count("*").alias("n")).where(F.col("n") <= 4 * BLOCK)
    total = runs.count()
    chosen = runs.where(F.pmod(F.xxhash64("conv_id", "run", F.lit(5)), F.lit(1_000_003)) < min(1.0, sample / max(total, 1)) * 1_000_003)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros_like(p) for p in prior()]
        for b in batches:
            for turns in b.column(0).to_pylist():
                cuts = [i for i, t in enumerate(turns) if not i or t["turn"] != turns[i - 1]["turn"] + 1]  # a row is missing there
                for i, z in zip(cuts, [*cuts[1:], len(turns)], strict=True):
                    got = count([(_ROLE[t["role"]], t["raw"]) for t in turns[i:z]], turns[i]["turn"] == 0)
                    total = [a + c for a, c in zip(total, got, strict=True)]
        flat = np.concatenate([t.ravel() for t in total])
        yield pa.record_batch({"i": pa.array(range(len(flat)), pa.int32()), "n": pa.array(flat, pa.float64())})

    packed = rows.join(chosen.select("conv_id", "run"), ["conv_id", "run"]).distinct().groupBy("conv_id", "run").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    sums = {r["i"]: r["n"] for r in packed.select("turns").mapInArrow(counted, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    if not sums:
        return estimated()
    flat, out, at = np.array([sums[i] for i in range(len(sums))]), [], 0
    for p in prior():
        out.append(flat[at : at + p.size].reshape(p.shape))
        at += p.size
    return estimated(out)


def transcripts(messages: DataFrame) -> DataFrame:
    """Raw transcripts in blocks: conv_id, solo, block, told (of each row), turns (raw strings in order).

    A message is its role as a marker, then its text. Without a role, or with one that is none of NAMES (tool, narrator),
    it has no marker: whose it is follows from its neighbours, and the unknown label is no part of its text.
    """
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    text = F.coalesce("text", F.lit(""))
    name = F.lower(F.regexp_extract(F.concat(F.coalesce("role", F.lit("")), F.lit(": ")), _MARK.pattern, 1))
    told = name.isin(list(_ROLE))
    raw = F.when(told, F.concat("role", F.lit(": "), text)).otherwise(text)
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), raw.alias("raw"), told.alias("told"), F.when(alone, F.xxhash64("conv_id", "turn", raw)).otherwise(0).alias("solo"))
    rows = _placed(rows.distinct().withColumn("lot", F.xxhash64("raw")))
    packed = rows.groupBy("conv_id", "solo", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "raw", "told"))).alias("t"))
    return packed.select("conv_id", "solo", "block", F.col("t.told").alias("told"), F.col("t.raw").alias("turns"))


def _score(model: Model, turns: list[str], first: bool, alone: bool) -> tuple[list[tuple], np.ndarray]:
    lines = marked(turns, alone)
    return lines, model.emission(np.array([observe(x, r, o, first and i == 0) for i, (x, r, _, o) in enumerate(lines)]))


#: blocks, or runs of them, that are joined in one row
RUN = 256
_KEY = ["conv_id", "solo"]


def _same(a: str, b: str, *more: str) -> Column:
    out = F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.solo") == F.col(f"{b}.solo"))
    for c in more:
        out = out & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}"))
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, solo, at, steps) to the max-plus product of each run's matrices."""
    for b in batches:
        out = []
        for steps in b.column(3).to_pylist():
            m = np.array(steps[0]["matrix"]).reshape(6, 6)
            for x in steps[1:]:
                m = (m[:, :, None] + np.array(x["matrix"]).reshape(1, 6, 6)).max(1)
            out.append(m.ravel().tolist())
        yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.float64()))], ["conv_id", "solo", "at", "matrix"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, solo, steps, enter, leave) of runs with known ends to the ends of each step."""
    for b in batches:
        conv, solo, at, enter, leave = [], [], [], [], []
        for c, s, steps, i, o in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            path = viterbi_chain([np.array(x["matrix"]).reshape(6, 6) for x in steps], i, o)
            for k, x in enumerate(steps):
                conv.append(c), solo.append(s), at.append(x["at"]), enter.append(path[k - 1] if k else i), leave.append(path[k])
        yield pa.record_batch([pa.array(conv, pa.int64()), pa.array(solo, pa.int64()), pa.array(at, pa.int64()), pa.array(enter, pa.int32()), pa.array(leave, pa.int32())], ["conv_id", "solo", "at", "enter", "leave"])


def _chained(mats: DataFrame) -> DataFrame:
    """conv_id, solo, at, enter, leave for rows (conv_id, solo, at, matrix): states before and at the end of each block.

    Runs of RUN matrices become one, level by level, until each conversation is one run; then ends are handed down.
    """
    levels = [saved(mats, "chat-matrices")]
    pack = lambda m: m.groupBy(*_KEY, F.expr(f"at div {RUN}").alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "matrix"))).alias("steps"))
    while levels[-1].where(F.col("at") >= RUN).head(1):
        levels.append(saved(pack(levels[-1]).mapInArrow(_runs, "conv_id long, solo long, at long, matrix array<double>"), "chat-matrices"))
    ends = None
    for level in reversed(levels):
        runs = pack(level)
        if ends is None:
            known = runs.select(*_KEY, "steps", F.lit(-1).alias("enter"), F.lit(-1).alias("leave"))
        else:
            known = runs.alias("x").join(ends.alias("y"), _same("x", "y", "at")).select("x.conv_id", "x.solo", "x.steps", "y.enter", "y.leave")
        ends = saved(known.mapInArrow(_ends, "conv_id long, solo long, at long, enter int, leave int"), "chat-ends")
    done(*levels)
    return ends


def parse(messages: DataFrame, model: Model | None = None) -> DataFrame:
    """Recovered turns: conv_id, turn (from 0), role, told, text, rendered.

    messages: conv_id, turn, role (a marker in any of the known names; others count as null), text. A row is taken to open a
    turn, unless a conversation is one row, which is then cut at markers and lines. told: the turn's first row had a
    known marker. Rows that repeat in full count once; rows without conv_id or turn are transcripts of their own; a null text is
    an empty line. Rows of one turn number are taken in the order of their text, or of its hash where there are very many
    of them. An empty table gives an empty result. Long rows are read whole; one turn's text is one value. rendered is
    <|role|>, a line break, the text without its marker and white space at the ends, <|end|>.
    """
    model = model or train(messages)
    blocks = saved(transcripts(messages), "chat-blocks")
    order = W.partitionBy(*_KEY).orderBy("block")
    index = blocks.select(*_KEY, "block", (F.row_number().over(order) - 1).cast("long").alias("at"))
    several = index.groupBy(*_KEY).agg(F.count("*").alias("n_blocks"))
    index = saved(index.alias("x").join(several.alias("y"), _same("x", "y")).select("x.*", "y.n_blocks"), "chat-index")
    placed = saved(blocks.alias("x").join(index.alias("y"), _same("x", "y", "block")).select("x.conv_id", "x.solo", "y.at", "x.turns", "x.told", "y.n_blocks"), "chat-placed")
    done(blocks, index)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for turns, at in zip(b.column(3).to_pylist(), b.column(2).to_pylist(), strict=True):
                e = _score(model, turns, at == 0, False)[1]
                out.append((reduced(e, model.move) if at else _opening(e, model)).ravel().tolist())
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.float64()))], ["conv_id", "solo", "at", "matrix"])

    mats = placed.where("n_blocks > 1").select(*_KEY, "at", "turns").mapInArrow(matrices, "conv_id long, solo long, at long, matrix array<double>")
    ends = _chained(mats)
    ready = placed.alias("x").join(ends.alias("y"), _same("x", "y", "at"), "left")
    ready = ready.select("x.conv_id", "x.solo", "x.at", "x.turns", "x.told", "x.n_blocks", F.coalesce("y.enter", F.lit(-1)).alias("enter"), F.coalesce("y.leave", F.lit(-1)).alias("leave"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, solo, block, part, role, told, text = [], [], [], [], [], [], []
            for c, s, k, turns, says, n_blocks, enter, leave in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                lines, e = _score(model, turns, k == 0, n_blocks == 1 and len(turns) == 1)
                path = viterbi(e, model.move, model.start if enter < 0 else model.move[enter], leave)
                row, n, starts = -1, 0, {0}
                for t in turns[:-1]:
                    starts.add(max(starts) + t.count("\n") + 1)
                for i, ((line, _, cut, _), p) in enumerate(zip(lines, path, strict=True)):
                    row += i in starts
                    r, opens = STATES[p]
                    if opens or i == 0:
                        n += opens or k == 0  # part 0 goes on with the block before
                        conv.append(c), solo.append(s), block.append(k), part.append(n), role.append(ROLES[r]), told.append(says[row] and i in starts), text.append([])
                    text[-1].append(line[cut:] if opens else line)
            yield pa.record_batch([pa.array(conv, pa.int64()), pa.array(solo, pa.int64()), pa.array(block, pa.int64()), pa.array(part, pa.int64()), pa.array(role, pa.string()), pa.array(told, pa.bool_()), pa.array(["\n".join(t) for t in text], pa.string())], ["conv_id", "solo", "at", "part", "role", "told", "text"])

    parts = saved(ready.mapInArrow(decoded, "conv_id long, solo long, at long, part long, role string, told boolean, text string"), "chat-parts")
    done(placed, ends)
    count_ = parts.groupBy(*_KEY, "at").agg(F.max("part").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*_KEY).orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = count_.select(*_KEY, "at", before.alias("shift"))
    numbered = parts.alias("x").join(offsets.alias("y"), _same("x", "y", "at")).select("x.*", (F.col("x.part") + F.col("y.shift") - 1).alias("turn"))
    whole = numbered.groupBy(*_KEY, "turn").agg(F.min_by("role", "at").alias("role"), F.min_by("told", "at").alias("told"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("t"))
    text = F.regexp_replace(F.array_join("t.text", "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return whole.select("conv_id", "turn", "role", "told", text.alias("text")).withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>")))


def _opening(emission: np.ndarray, model: Model) -> np.ndarray:
    """reduced() for a transcript's first block: every row is the score from the start."""
    score = model.start + emission[0]
    for e in emission[1:]:
        score = (score[:, None] + model.move).max(0) + e
    return np.repeat(score[None], len(score), 0)


def viterbi_chain(mats: list[np.ndarray], enter: int = -1, leave: int = -1) -> list[int]:
    """The last state of each block on the best path, from state enter to state leave where these are given.

    Without enter, the first matrix has equal rows, which are the scores from the start.
    """
    score, back = mats[0][max(enter, 0)], []
    for m in mats[1:]:
        step = score[:, None] + m
        back.append(step.argmax(0))
        score = step.max(0)
    path = [leave if leave >= 0 else int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]
