"""Operator 6: chat formatting by a hidden Markov model over transcript turns.

A transcript is a sequence of turns, each a block of lines that may begin with
a speaker marker.  Hidden states are the speakers' roles; a turn is observed
through its marker and line features.  Counts over turns whose role is known
give the model; Viterbi recovers the roles of a whole conversation, and each
turn is rendered in one canonical form.

A conversation is handled in pieces of consecutive turns: a first pass turns
each piece into a max-plus matrix (best score from the state before it to its
last state), the matrices of a conversation are chained, and a second pass
decodes each piece between its now known ends, so a conversation of any length
never meets in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.operators.ordered import row_numbers

ROLES = ("system", "user", "assistant")
START = len(ROLES)  # the state before a conversation
#: Turns of a piece.
PIECE = 512
# Speaker markers and what they say.
MARKERS = {
    "system": "system instruction instructions context",
    "user": "user human customer client question q prompt you me",
    "assistant": "assistant ai bot agent answer a model support gpt response",
}
_ROLE_OF = {w: r for r, words in MARKERS.items() for w in words.split()}
_MARKER = re.compile(r"\s*(?:[-*>#]+\s*)?(?:<\|(?:im_start\|>)?|\[|\*\*)?\s*([A-Za-z]{1,12})\s*(?:\|>|\]|\*\*)?\s*(?:[:>]|\n)(?:\*\*)?\s*")
#: Sizes of the features: marker, length, lines, end, first turn, question, instruction.
SIZES = (4, 10, 5, 4, 2, 2, 2)
_INSTRUCTS = re.compile(r"\b(?:you are|your task|always|never|must|du bist|tu es|eres)\b", re.I)
TEMPLATE = "<|im_start|>{role}\n{text}<|im_end|>\n"


def marker_of(text: str) -> tuple[int, str]:
    """Index of the role that a leading speaker marker names (3: none) and the
    text without it."""
    m = _MARKER.match(text)
    role = _ROLE_OF.get(m.group(1).lower()) if m else None
    return (ROLES.index(role), text[m.end() :]) if role else (START, text)


def features(text: str, first: bool) -> tuple[int, ...]:
    """The observation of a turn."""
    role, body = marker_of(text)
    body = body.strip()
    end = body[-1:]
    return (
        role,
        min(len(body).bit_length(), 9 + 6) - 6 if len(body) > 63 else 0,
        min(body.count("\n"), 4),
        0 if not body else 1 if end == "?" else 2 if end in ".!" else 3,
        int(first),
        int("?" in body),
        int(_INSTRUCTS.search(body) is not None),
    )


@dataclass
class Model:
    """Log probabilities: ``moves[from, to]`` (the last row: from the start) and
    one table of ``[role, value]`` for each feature."""

    moves: np.ndarray
    emits: list[np.ndarray]

    def observe(self, texts: list[str], first: list[bool]) -> np.ndarray:
        out = np.zeros((len(texts), len(ROLES)))
        for i, (t, f) in enumerate(zip(texts, first)):
            for table, v in zip(self.emits, features(t, f)):
                out[i] += table[:, v]
        return out

    def matrix(self, seen: np.ndarray, begins: bool) -> np.ndarray:
        """Best score from each state before the piece to each state at its
        end; only the start leads into a conversation's first piece."""
        score = self.moves + seen[0]
        score[: len(ROLES) if begins else 0] = -np.inf
        if not begins:
            score[START] = -np.inf
        for row in seen[1:]:
            score = (score[:, :, None] + self.moves[None, : len(ROLES)]).max(axis=1) + row
        return score

    def decode(self, seen: np.ndarray, before: int, last: int) -> np.ndarray:
        """The best roles of a piece that comes after state ``before`` and ends in ``last``."""
        n = len(seen)
        score = self.moves[before] + seen[0]
        back = np.zeros((n, len(ROLES)), dtype=np.int64)
        for i in range(1, n):
            step = score[:, None] + self.moves[: len(ROLES)]
            back[i] = step.argmax(axis=0)
            score = step.max(axis=0) + seen[i]
        path = np.empty(n, dtype=np.int64)
        path[-1] = last
        for i in range(n - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        return path


def model_from(counts: dict[tuple[int, int, int], int], smooth: float = 0.5) -> Model:
    """From counts keyed (table, row, column): table -1 holds the moves."""
    moves = np.full((len(ROLES) + 1, len(ROLES)), smooth)
    # without any known role, speakers are expected to take turns
    moves[START] += (0.2, 0.6, 0.2)
    moves[1, 2] += 0.5
    moves[2, 1] += 0.5
    emits = [np.full((len(ROLES), n), smooth) for n in SIZES]
    emits[0][np.arange(len(ROLES)), np.arange(len(ROLES))] += 2
    for (table, row, column), n in counts.items():
        (moves if table < 0 else emits[table])[row, column] += n
    return Model(np.log(moves / moves.sum(axis=1, keepdims=True)), [np.log(e / e.sum(axis=1, keepdims=True)) for e in emits])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one piece of one conversation at a time."""
    for table in common.whole_groups(batches, "group"):
        table = table.combine_chunks()
        key = table.column("key").to_pylist()
        piece = table.column("piece").to_pylist()
        cut = [0, *(i for i in range(1, len(key)) if (key[i], piece[i]) != (key[i - 1], piece[i - 1])), len(key)]
        for a, b in zip(cut[:-1], cut[1:]):
            yield table.slice(a, b - a)


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str | None = "role", text_col: str = "text") -> DataFrame:
    """The turns with the keys of their conversation and piece; rows that
    repeat count once, a row without conversation is one of its own.  Pieces
    are cut by the rows' numbers in the order of turn (null first), text and
    role, so turns without number, or of one number, make no larger piece."""
    role = F.lower(F.trim(F.col(role_col))) if role_col else F.lit(None).cast("string")
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    alone = F.concat(F.lit("row:"), F.xxhash64("turn", "role", "text").cast("string"))
    rows = rows.withColumn("key", F.when(F.col("conv_id").isNull(), alone).otherwise(F.concat(F.lit("id:"), F.col("conv_id").cast("string"))))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "text", "role")]
    rows = row_numbers(rows, ["key"], order, "number")
    rows = rows.withColumn("piece", F.floor((F.col("number") - 1) / PIECE).cast("long")).drop("number")
    return rows.withColumn("group", F.xxhash64("key", "piece"))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("group").sortWithinPartitions("group", "key", "piece", "turn", "text", "role")


def fit(rows: DataFrame, usable: Column | None = None) -> Model:
    """Counts of moves and observations over all :func:`turns` with a known
    role.  A move from one piece to the next (one turn in 512) is not counted;
    a conversation's first move is that of its smallest piece."""
    if usable is not None:
        rows = rows.where(usable)
    first = rows.groupBy("key").agg(F.min("piece").alias("first_piece"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int, int], int] = {}
        for part in _pieces(batches):
            begins = part.column("piece")[0].as_py() == part.column("first_piece")[0].as_py()
            before = START if begins else None
            for i, (role, text) in enumerate(zip(part.column("role").to_pylist(), part.column("text").to_pylist())):
                state = ROLES.index(role) if role in ROLES else None
                if state is not None:
                    for table, value in enumerate(features(text, begins and i == 0)):
                        seen[table, state, value] = seen.get((table, state, value), 0) + 1
                    if before is not None:
                        seen[-1, before, state] = seen.get((-1, before, state), 0) + 1
                before = state
        yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in seen], pa.int64()) for c in range(3)] + [pa.array(list(seen.values()), pa.int64())], names=["t", "r", "c", "n"])

    found = common.per_task(_sorted(rows.join(first, "key")), count, "t long, r long, c long, n long")
    return model_from({(r.t, r.r, r.c): r.n for r in found.groupBy("t", "r", "c").agg(F.sum("n").alias("n")).collect()})


def parse(rows: DataFrame, model: Model) -> DataFrame:
    """``conv_id, turn, given, role, text, rendered`` for every row of
    :func:`turns`: the given role, the recovered one, the turn without its
    marker and its canonical form.  Every role is recovered from the text
    alone.  An empty text is a turn like any other; turns without number come
    first; turns of one number are ordered by their text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    first = rows.groupBy("key").agg(F.min("piece").alias("first_piece"))
    rows = rows.join(first, "key")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, matrix = [], [], []
        for part in _pieces(batches):
            key.append(part.column("key")[0].as_py())
            piece.append(part.column("piece")[0].as_py())
            begins = piece[-1] == part.column("first_piece")[0].as_py()
            seen = shared.value.observe(part.column("text").to_pylist(), [begins, *[False] * (part.num_rows - 1)])
            matrix.append(shared.value.matrix(seen, begins).ravel().tolist())
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(piece, pa.int64()), pa.array(matrix, pa.list_(pa.float64()))], names=["key", "piece", "matrix"])

    ends = common.per_task(_sorted(rows), matrices, "key string, piece long, matrix array<double>")
    chained = ends.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("piece", "matrix"))).alias("all"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int, int]] = []
            for key, pieces in zip(batch.column("key").to_pylist(), batch.column("all").to_pylist()):
                score, back = np.full(len(ROLES) + 1, -np.inf), []
                score[START] = 0
                for p in pieces:
                    step = score[:, None] + np.array(p["matrix"]).reshape(len(ROLES) + 1, len(ROLES))
                    back.append(step.argmax(axis=0))
                    score = np.append(step.max(axis=0), -np.inf)
                last = int(score.argmax())
                for p, b in zip(reversed(pieces), reversed(back)):
                    out.append((key, p["piece"], int(b[last]), last))
                    last = int(b[last])
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), *[pa.array([o[c] for o in out], pa.int64()) for c in (1, 2, 3)]], names=["key", "piece", "before", "last"]
            )

    known = common.per_task(chained, chain, "key string, piece long, before long, last long")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            texts = part.column("text").to_pylist()
            begins = part.column("piece")[0].as_py() == part.column("first_piece")[0].as_py()
            seen = shared.value.observe(texts, [begins, *[False] * (part.num_rows - 1)])
            path = shared.value.decode(seen, part.column("before")[0].as_py(), part.column("last")[0].as_py())
            roles = [ROLES[s] for s in path.tolist()]
            bodies = [marker_of(t)[1].strip() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(c).combine_chunks() for c in ("conv_id", "turn", "role")]
                + [pa.array(roles), pa.array(bodies), pa.array([TEMPLATE.format(role=r, text=b) for r, b in zip(roles, bodies)])],
                names=["conv_id", "turn", "given", "role", "text", "rendered"],
            )

    schema = f"conv_id {kind}, turn long, given string, role string, text string, rendered string"
    return common.per_task(_sorted(rows.join(known, ["key", "piece"])), decode, schema)
