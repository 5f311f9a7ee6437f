"""Operator 8: substring de-duplication over sliding sentence spans.

Every run of ``run`` consecutive sentences of every document is hashed to 128
bits; runs that occur more than once anywhere keep their first occurrence (by
document id, then position), and sentences inside any other occurrence are
covered.  Covered stretches of at least ``min_words`` words are cut out.
A repeated passage without ``run`` whole sentences, or with too few words in
them, is not seen that way: ``cut_passages`` cuts every window of more than 50
words that occurs before, wherever sentences begin.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import Words
from incidentflow.session import materialise

#: A text is the concatenation of its sentences: each ends with all the marks that follow it.
SENTENCE = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"
_SENTENCE = re.compile(SENTENCE)
_WORD = re.compile(r"[^ \t\n\r]+")
BLANK = " \t\n\r"
#: As in Words with split_on_space.
_BYTES_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
#: Words of the grams from which windows pick their fingerprint.
GRAM = 16
#: A place is the document id and, below it, the sentence's number.
PLACE = "cast(doc AS decimal(20,0)) * cast(2147483648 AS decimal(10,0)) + cast(pos AS decimal(10,0))"


def _name(df: DataFrame) -> str:
    """A name that none of the frame's columns has or begins with."""
    return "_" * (1 + max(len(c) for c in df.columns))


def _own(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, digest, text`` of the rows that take part."""
    own = df.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("digest"), F.col(f"`{text_col}`").alias(common.TEXT))
    return own.where("doc IS NOT NULL AND text IS NOT NULL")


def _marked(df: DataFrame, marks: DataFrame, id_col: str, text_col: str, columns: list[str]) -> DataFrame:
    """``columns`` of every row, then its positions, named by their numbers
    (a task takes no column with a dot in its name)."""
    name = _name(df)
    keyed = df.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{id_col}`").cast("long").alias(f"{name}doc"), F.xxhash64(F.col(f"`{text_col}`")).alias(f"{name}digest"))
    marks = marks.toDF(f"{name}d", f"{name}g", f"{name}positions")
    same = (F.col(f"{name}doc") == F.col(f"{name}d")) & (F.col(f"{name}digest") == F.col(f"{name}g"))
    found = keyed.join(marks, same, "left").select(*[F.col(f"`{c}`") for c in columns], f"{name}positions")
    return found.toDF(*[f"c{i}" for i in range(len(columns) + 1)])


def _rewritten(marked: DataFrame, cut, columns: list[str], more: str = "") -> DataFrame:
    """The rows that ``cut`` makes of :func:`_marked` ones, under their names."""
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(marked.schema.fields[:-1])]
    added = [m.split()[0] for m in more.split(", ") if m]
    return common.per_task(marked, cut, ", ".join([*kinds, *([more] if more else [])])).toDF(*columns, *added)


def _spans(run: int):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 22):
            digests, number, count = [], [], np.zeros(part.num_rows, dtype=np.int64)
            for i, text in enumerate(part.column(2).to_pylist()):
                keys = [s.strip(BLANK) for s in _SENTENCE.findall(text)]
                n = count[i] = max(len(keys) - run + 1, 0)
                digests += [blake2b("\n".join(keys[k : k + run]).encode("utf-8", "replace"), digest_size=16).digest() for k in range(n)]
                number.append(np.arange(n, dtype=np.int32))
            pair = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            row = np.repeat(np.arange(part.num_rows), count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(np.concatenate(number))],
                names=["h1", "h2", "doc", "digest", "pos"],
            )

    return spans


def _cut(text: str, positions: list[int], run: int, min_words: int) -> tuple[str, int, int]:
    """The text without its covered stretches; its sentences and how many went."""
    sentences = _SENTENCE.findall(text)
    covered = np.zeros(len(sentences) + 1, dtype=bool)
    for p in positions:
        covered[p : p + run] = True
    kept, gone, k = [], 0, 0
    while k < len(sentences):
        stop = k
        while covered[stop] and stop < len(sentences):
            stop += 1
        if stop == k:
            kept.append(sentences[k])
            k += 1
        elif sum(len(_WORD.findall(s)) for s in sentences[k:stop]) >= min_words:
            gone += stop - k
            k = stop
        else:
            kept += sentences[k:stop]
            k = stop
    return "".join(kept), len(sentences), gone


def dedup_spans(df: DataFrame, run: int = 2, min_words: int = 25, id_col: str = common.ID, text_col: str = common.TEXT) -> DataFrame:
    """``df`` with repeated passages cut from its text, and the columns
    ``n_sentences`` and ``n_removed`` (they replace columns of that name).

    The id must be an integer.  Rows with a null id or text take no part and
    stay as they are (0 sentences for a null text).  Other columns may have any
    names.  Rows of one id count as
    one document: where a run occurs again in a repeated row, at the same
    place, nothing is cut.  An empty text has no sentence.  Shuffled are 128
    bits, id and position of each run (partial counts first, so that a run with
    a million copies is no hot key), and the documents once, by id.
    """
    own = _own(df, id_col, text_col)
    spans = common.per_task(own, _spans(run), "h1 long, h2 long, doc long, digest long, pos int").withColumn("place", F.expr(PLACE))
    repeated = spans.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").drop("n")
    # written once, so that both sides of the join are plain shuffles, of which Spark splits a hot run's part
    repeated = materialise(repeated, "repeated-runs")
    later = spans.join(repeated, ["h1", "h2"]).where("place <> first")
    marks = later.groupBy("doc", "digest").agg(F.collect_set("pos").alias("positions"))
    rest = [c for c in df.columns if c not in ("n_sentences", "n_removed")]
    marked = _marked(df, marks, id_col, text_col, rest)
    at = rest.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, f"c{at}", 1 << 22):
            done = [
                (None, 0, 0) if t is None else _cut(t, p or [], run, min_words)
                for t, p in zip(part.column(at).to_pylist(), part.column(len(rest)).to_pylist())
            ]
            columns = [part.column(i) for i in range(len(rest))]
            columns[at] = pa.array([d[0] for d in done], part.column(at).type)
            columns += [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_sentences", "n_removed"])

    names = [f"c{i}" for i in range(len(rest))]
    return _rewritten(marked, cut, rest, "n_sentences long, n_removed long")


# ------------------------------------------------------------------ passages
def _runs(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """A hash of each ``k`` neighbours of ``h``, put together from runs of 1, 2, 4, ..."""
    block, size, out, have = h, 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(base, size, 2**64))
            if k & size:
                if out is None:
                    out, have = block, size
                else:
                    n = max(len(h) - have - size + 1, 0)
                    out, have = out[:n] * power + block[have : have + n], have + size
            if 2 * size > k:
                return common.mix(out)
            n = max(len(h) - 2 * size + 1, 0)
            block, size = block[:n] * power + block[size : size + n], 2 * size


def _picks(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of grams; the windows of ``k`` words inside one text, by their
    first word, and the gram that each picks: its least (of equal ones the
    last), so that equal windows pick the same."""
    gram = low = _runs(words.hash, GRAM, 0x9E3779B97F4A7C15)
    at, reach, span = np.arange(len(gram)), 1, k - GRAM + 1
    while reach < span:
        s = min(reach, span - reach)
        after = low[s:] <= low[:-s]
        at, low = np.where(after, at[s:], at[:-s]), np.where(after, low[s:], low[:-s])
        reach += s
    start = np.arange(len(at))
    inside = start + k <= words.first[words.doc[start] + 1]
    return gram, start[inside], at[inside]


def _fingerprints(k: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 20):
            words = Words(part.column(2), split_on_space=True, fold=False)
            gram, _, pick = _picks(words, k)
            pick = np.unique(pick)
            row = words.doc[pick]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[pick].view(np.int64)), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array((pick - words.first[row]).astype(np.int32))],
                names=["h", "doc", "digest", "pos"],
            )

    return fingerprints


def _windows(k: int):
    """The windows whose pick is among the row's ``seeds``, each with its own
    position and that of the first equal window of its text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 20):
            words = Words(part.column(2), split_on_space=True, fold=False)
            _, start, pick = _picks(words, k)
            seeds = part.column(3)
            seed = np.zeros(len(words.hash) + 1, dtype=bool)
            seed[seeds.flatten().to_numpy() + np.repeat(words.first[:-1], np.diff(seeds.offsets.to_numpy()))] = True
            start = start[seed[pick]]
            row = words.doc[start]
            h1 = _runs(words.hash, k, 0xD1342543DE82EF95)[start]
            h2 = _runs(common.mix(words.hash), k, 0xAF251AF3B0F025B5)[start]
            pos = (start - words.first[row]).astype(np.int32)
            order = np.lexsort((pos, h2, h1, row))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(row[order]) != 0) | (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
            first = np.empty_like(pos)
            first[order] = pos[order][new][np.cumsum(new) - 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(pos), pa.array(first)],
                names=["h1", "h2", "doc", "digest", "pos", "own"],
            )

    return windows


def _without(text: str, positions: list[int], k: int) -> str:
    """The text without the words of these windows and the blanks after them."""
    raw = text.encode("utf-8")
    spans = [m.span() for m in _BYTES_WORD.finditer(raw)]
    edge = np.zeros(len(spans) + 1, dtype=np.int64)
    np.add.at(edge, positions, 1)
    np.add.at(edge, np.asarray(positions) + k, -1)
    covered = np.cumsum(edge) > 0
    out, at = [], 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    for a, b in zip(turns[::2], turns[1::2]):
        out.append(raw[at : spans[a][0]])
        at = spans[b][0] if b < len(spans) else len(raw)
    return b"".join([*out, raw[at:]]).decode("utf-8")


def cut_passages(df: DataFrame, words: int = 51, id_col: str = common.ID, text_col: str = common.TEXT) -> DataFrame:
    """``df`` without the passages of ``words`` words or more that occur before
    (by document id, then position): every window of so many words (between
    ASCII white space, case kept) with an earlier equal one that it does not
    overlap is covered, and covered words are cut.  Text without white space is
    one word.

    Each window picks one of its 16-word grams; equal windows pick equal
    grams, so only windows whose pick occurs more than once are hashed whole (to
    128 bits) and compared.  Shuffled are a hash and a place for every pick
    (some one in 18 words), the same for windows around repeated picks, and the
    documents by id, once for these windows and once for the cut.  Rows with a
    null id or text stay as they are; rows of one id take nothing from each other.
    Columns may have any names; an empty table gives none.
    """
    own = _own(df, id_col, text_col)
    picks = common.per_task(own, _fingerprints(words), "h long, doc long, digest long, pos int")
    again = materialise(picks.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-picks")
    seeds = picks.join(again, "h").groupBy("doc", "digest").agg(F.collect_set("pos").alias("seeds"))
    near = own.join(seeds, ["doc", "digest"]).select("doc", "digest", common.TEXT, "seeds")
    windows = materialise(common.per_task(near, _windows(words), "h1 long, h2 long, doc long, digest long, pos int, own int"), "passage-windows")
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc").alias("first")).where("n > 1").drop("n")
    repeated = materialise(repeated, "repeated-passages")
    later = windows.join(repeated, ["h1", "h2"]).where((F.col("doc") > F.col("first")) | (F.col("pos") - F.col("own") >= words))
    marks = later.groupBy("doc", "digest").agg(F.collect_set("pos").alias("positions"))
    marked = _marked(df, marks, id_col, text_col, df.columns)
    at = df.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, f"c{at}", 1 << 22):
            columns = [part.column(i) for i in range(len(part.columns) - 1)]
            places = part.column(len(columns)).to_pylist()
            if any(places):
                columns[at] = pa.array([_without(t, p, words) if p else t for t, p in zip(columns[at].to_pylist(), places)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [f"c{i}" for i in range(len(df.columns))]
    return _rewritten(marked, cut, df.columns)
