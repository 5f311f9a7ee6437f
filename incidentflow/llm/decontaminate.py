"""Operator 4: benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows (runs of consecutive words; a short
item is one window).  A window's shingles are ordered by how rare they are in
the corpus; as a window counts only when the whole of it occurs, its rarest
shingle alone is a sufficient prefix.  Documents are joined on that shingle,
the length and position bounds discard places where the window would not fit
the document, and the rest is verified word by word and then byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import Words

SHINGLE = 3
_BITS = 20


class Block:
    """The windows of some items and the shingles that find them."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        words = Words(pa.array(texts, pa.string()))
        found: dict[bytes, int] = {}
        owners: list[set[str]] = []
        at, length = [], []
        for item, a, b in zip(ids, words.first[:-1].tolist(), words.first[1:].tolist()):
            size = min(window, b - a)
            for s in range(a, b - size + 1) if size else ():
                key = words.text(s, s + size)
                if (k := found.setdefault(key, len(owners))) == len(owners):
                    owners.append(set())
                    at.append(s)
                    length.append(size)
                owners[k].add(item)
        self.window = window
        self.bytes = list(found)
        self.length = np.array(length, dtype=np.int64)
        self.words = np.zeros((len(at), window), dtype=np.uint64)
        for k, (s, n) in enumerate(zip(at, length)):
            self.words[k, :n] = words.hash[s : s + n]
        names = sorted({x for o in owners for x in o})
        number = {x: i for i, x in enumerate(names)}
        self.items = names
        self.owner_first = np.cumsum([0, *map(len, owners)])
        self.owner = np.array([number[x] for o in owners for x in sorted(o)], dtype=np.int64)
        # each window's shingles: of SHINGLE words, or of all where it is shorter
        self.sizes = sorted({min(SHINGLE, n) for n in length})
        self.shingles = {}
        for g in self.sizes:
            grams, _ = words.grams(g)
            of = [(k, o, grams[s + o]) for k, (s, n) in enumerate(zip(at, length)) if min(SHINGLE, n) == g for o in range(n - g + 1)]
            self.shingles[g] = (np.array([x[0] for x in of]), np.array([x[1] for x in of]), np.array([x[2] for x in of], dtype=np.uint64))
        self.keys = {g: np.unique(x[2]) for g, x in self.shingles.items()}

    def choose(self, frequency: dict[int, np.ndarray]) -> None:
        """Keeps of each window its rarest shingle (ties: the first)."""
        for g, (window, offset, key) in self.shingles.items():
            rarity = frequency[g][np.searchsorted(self.keys[g], key)]
            order = np.lexsort((offset, rarity, window))
            first = order[np.concatenate([[True], np.diff(window[order]) > 0])] if len(order) else order
            by_key = first[np.argsort(key[first], kind="stable")]
            self.shingles[g] = (window[by_key], offset[by_key], key[by_key])
        self.keys = {g: np.unique(x[2]) for g, x in self.shingles.items()}

    def places(self, words: Words, g: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a text has one of the block's shingles of ``g`` words, and which."""
        keys = self.keys[g]
        if not len(keys) or not len(words.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams, whole = words.grams(g)
        mask = np.zeros(1 << _BITS, dtype=bool)
        mask[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        at = np.flatnonzero(mask[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] & whole)
        k = np.minimum(np.searchsorted(keys, grams[at]), len(keys) - 1)
        same = keys[k] == grams[at]
        return at[same], k[same]

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every verified occurrence."""
        starts, windows = [], []
        for g in self.sizes:
            at, k = self.places(words, g)
            window, offset, key = self.shingles[g]
            low = np.searchsorted(key, self.keys[g])
            many = np.searchsorted(key, self.keys[g], side="right") - low
            n = many[k]
            total = np.cumsum(n)
            row = np.repeat(low[k] - (total - n), n) + np.arange(total[-1] if len(total) else 0)
            at, window, offset = np.repeat(at, n), window[row], offset[row]
            start = at - offset
            doc = words.doc[at]
            fits = (start >= words.first[doc]) & (start + self.length[window] <= words.first[doc + 1])
            start, window = start[fits], window[fits]
            for i in range(self.window):
                in_window = i < self.length[window]
                same = ~in_window | (words.hash[np.minimum(start + i, len(words.hash) - 1)] == self.words[window, i])
                start, window = start[same], window[same]
            exact = np.array([words.text(s, s + n) == self.bytes[w] for s, n, w in zip(start.tolist(), self.length[window].tolist(), window.tolist())], dtype=bool)
            starts.append(start[exact])
            windows.append(window[exact])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(windows)


def blocks_of(benchmark: DataFrame, window: int, block_words: int, item_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark's items in blocks of about ``block_words`` words, read one
    after the other; a null id is the empty string."""
    ids, held, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    for row in rows.toLocalIterator():
        ids.append(row.i)
        held.append(row.t)
        size += 1 + len(row.t) // 6
        if size >= block_words:
            yield Block(ids, held, window)
            ids, held, size = [], [], 0
    if ids:
        yield Block(ids, held, window)


def with_rarest(df: DataFrame, block: Block, text_col: str) -> None:
    """Counts the block's shingles over all documents and keeps the rarest of
    each window.  At most one number for each of the block's shingles comes
    from a task and to the driver."""
    shared = df.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        seen = {g: np.zeros(len(own.keys[g]), dtype=np.int64) for g in own.sizes}
        for part in common.slices(batches, common.TEXT, 1 << 22):
            words = Words(part.column(0))
            for g in own.sizes:
                seen[g] += np.bincount(own.places(words, g)[1], minlength=len(seen[g]))
        for g, n in seen.items():
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), g, np.int32)), pa.array(k.astype(np.int32)), pa.array(n[k])], names=["g", "k", "n"])

    rows = df.select(F.coalesce(F.col(text_col), F.lit("")).alias(common.TEXT))
    total = common.per_task(rows, count, "g int, k int, n long").groupBy("g", "k").agg(F.sum("n").alias("n")).collect()
    frequency = {g: np.zeros(len(block.keys[g]), dtype=np.int64) for g in block.sizes}
    for r in total:
        frequency[r.g][r.k] = r.n
    block.choose(frequency)
    shared.unpersist()


def _runs(start: np.ndarray, stop: np.ndarray) -> list[dict[str, int]]:
    """The union of intervals, as disjoint ones."""
    out: list[dict[str, int]] = []
    for a, b in sorted(zip(start.tolist(), stop.tolist())):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(b, out[-1]["stop"])
        else:
            out.append({"start": a, "stop": b})
    return out


def _results(words: Words, block: Block) -> tuple[list[list[dict[str, int]]], list[list[str]]]:
    start, window = block.occurrences(words)
    hits: list[list[dict[str, int]]] = [[] for _ in range(words.n_docs)]
    items: list[list[str]] = [[] for _ in range(words.n_docs)]
    doc = words.doc[start]
    order = np.argsort(doc, kind="stable")
    cut = np.flatnonzero(np.diff(doc[order])) + 1
    for rows in np.split(order, cut) if len(order) else []:
        d = int(doc[rows[0]])
        a = start[rows] - words.first[d]
        hits[d] = _runs(a, a + block.length[window[rows]])
        items[d] = sorted({block.items[o] for w in np.unique(window[rows]) for o in block.owner[block.owner_first[w] : block.owner_first[w + 1]]})
    return hits, items


_HITS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
N_HIT = "aggregate(hits, 0L, (n, x) -> n + x.stop - x.start)"


def contamination(
    df: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = common.ID, text_col: str = common.TEXT,
    item_col: str = "item_id", item_text: str = "text", block_words: int = 2_000_000,
) -> DataFrame:
    """For every row of ``df``: ``doc_id``, ``n_words``, ``hits`` (disjoint
    word intervals inside occurrences of a window) and ``items`` (sorted ids
    of the items with an occurring window).

    Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing
    A-Z.  Benchmarks of more than ``block_words`` words are taken in blocks, a
    pass over the documents for each, so what is broadcast stays bounded.  A
    null or empty text has no words and no hit; a null or empty item has no
    window, an item without id is named by the empty string; repeated items
    count once, repeated rows of ``df`` give a row each; with an empty
    benchmark nothing is hit; other columns are ignored.
    """
    rows = common.texts(df, id_col, text_col)
    kind = rows.schema[common.ID].dataType.simpleString()
    schema = f"{common.ID} {kind}, digest long, n_words long, hits array<struct<start:int,stop:int>>, items array<string>"
    rows = rows.withColumn("digest", F.xxhash64(common.TEXT))
    outs = []
    for block in blocks_of(benchmark, window, block_words, item_col, item_text):
        with_rarest(df, block, text_col)
        outs.append(common.per_task(rows, _mapper(rows, block), schema))
    if not outs:
        outs.append(common.per_task(rows, _mapper(rows, Block([], [], window)), schema))
    out = outs[0]
    for more in outs[1:]:
        out = out.unionAll(more)
    if len(outs) > 1:
        out = _merged(out, len(outs))
    return out.drop("digest")


def _mapper(rows: DataFrame, block: Block):
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 22):
            words = Words(part.column(1))
            hits, items = _results(words, shared.value)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(words.count.astype(np.int64)), pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string()))],
                names=[common.ID, "digest", "n_words", "hits", "items"],
            )

    return run


def _merged(out: DataFrame, blocks: int) -> DataFrame:
    """One row again for each document of a pass: its intervals united."""
    own = out.groupBy(common.ID, "digest", "n_words").agg(
        (F.count("*") / blocks).cast("int").alias("times"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    united = F.expr(
        """aggregate(all, cast(array() AS array<struct<start:int,stop:int>>), (done, x) ->
             CASE WHEN size(done) > 0 AND x.start <= element_at(done, -1).stop
                  THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
                       'start', element_at(done, -1).start, 'stop', greatest(element_at(done, -1).stop, x.stop))))
                  ELSE concat(done, array(x)) END)"""
    )
    again = F.explode(F.sequence(F.lit(1), F.col("times")))
    return own.select(common.ID, "digest", "n_words", united.alias("hits"), "items", again.alias("_time")).drop("_time")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = common.TEXT, block_words: int = 2_000_000) -> DataFrame:
    """The rows of ``df``, all columns, whose text has no hit; block by block."""
    out = df
    for block in blocks_of(benchmark, window, block_words, "item_id", "text"):
        with_rarest(df, block, text_col)
        shared = df.sparkSession.sparkContext.broadcast(block)
        at = out.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in common.slices(batches, text_col, 1 << 22):
                words = Words(part.column(at))
                start, _ = shared.value.occurrences(words)
                clean = np.ones(part.num_rows, dtype=bool)
                clean[words.doc[start]] = False
                yield part.filter(pa.array(clean))

        out = common.per_task(out, run, df.schema)
    return out
