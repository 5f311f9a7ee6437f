"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.session import ship_package

ID, TEXT = "doc_id", "text"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(df: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Only the id and the text, so that no other column of ``df`` can clash
    with an operator's own; a null text becomes the empty one."""
    return df.select(F.col(id_col).alias(ID), F.coalesce(F.col(text_col), F.lit("")).alias(TEXT))


def per_task(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], text_col: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows so that the texts of a slice have about
    ``most_bytes`` (a single longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(text_col)).to_pylist()], dtype=np.int64)
        group = (np.cumsum(sizes) - sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a)


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


class HashTable:
    """Which entry of a table of distinct hashes each hash is (-1: none); a
    bit for each value of the high bits answers most of them."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.order = np.argsort(keys)
        self.keys, self.shift = keys[self.order], np.uint64(64 - bits)
        self.mask = np.zeros(1 << bits, dtype=bool)
        self.mask[(keys >> self.shift).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a known hash stands, and its entry."""
        at = np.flatnonzero(self.mask[(hashes >> self.shift).astype(np.int64)])
        if not len(self.keys):
            return at, at
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[k] == hashes[at]
        return at[same], self.order[k[same]]


# ---------------------------------------------------------------- word arrays
#: 64-bit values of the word hash: a polynomial over random byte values, modulo 2**64.
_SEED = np.random.default_rng(20_231)
_ODD = int(_SEED.integers(1, 2**63, dtype=np.uint64)) | 1
_ODD_INV = pow(_ODD, -1, 2**64)
_BYTE = _SEED.integers(1, 2**63, size=256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POW: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers up to ``n``, kept up to 2**21 of them (a longer text makes its own)."""
    if n > 1 << 21:
        return powers(base, n)
    if base not in _POW:
        _POW[base] = powers(base, 1 << 21)
    return _POW[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), so that low bits depend on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Words:
    """The words of many texts as arrays: lower-cased A-Z, then maximal runs
    of word bytes (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``; with
    ``split_on_space`` of bytes that are not ASCII white space; without
    ``fold`` case is kept).

    ``data`` holds the texts' bytes with a break after each; ``start``/``end``
    are byte offsets of words, ``hash`` their 64-bit hashes, ``doc`` the text
    each belongs to and ``first[d]:first[d + 1]`` the words of text ``d``.
    """

    def __init__(self, column: pa.Array, split_on_space: bool = False, fold: bool = True):
        column = column.cast(pa.large_binary()).fill_null(b"")
        self.n_docs = len(column)
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]] if len(column) else np.zeros(0, np.uint8)
        ends = ends - ends[0] if len(ends) else np.zeros(1, np.int64)
        data = np.full(len(raw) + self.n_docs + 1, 32, dtype=np.uint8)
        keep = np.ones(len(data), dtype=bool)
        keep[ends[1:] + np.arange(1, self.n_docs + 1)] = False
        keep[0] = False
        data[keep] = _FOLD[raw] if fold else raw
        self.data = data
        inside = (_NOT_SPACE if split_on_space else _IS_WORD)[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        with np.errstate(over="ignore"):
            self.total = np.empty(len(data) + 1, dtype=np.uint64)
            self.total[0] = 0
            np.cumsum(_BYTE[data] * _power(_ODD, len(data)), out=self.total[1:])
            self.shift = _power(_ODD_INV, len(data))[self.start]
            self.hash = mix((self.total[self.end] - self.total[self.start]) * self.shift)
        # text d lies between its break before and its break after
        breaks = np.concatenate([[0], ends[1:] + np.arange(1, self.n_docs + 1)])
        self.first = np.searchsorted(self.start, breaks)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``k`` words starting at each word, and
        whether the run stays inside its text."""
        n = len(self.hash)
        with np.errstate(over="ignore"):
            out = np.zeros(n, dtype=np.uint64)
            for i in range(k):
                out[: max(n - i, 0)] = out[: max(n - i, 0)] * np.uint64(_ODD) + self.hash[i:]
        whole = np.arange(n) + k <= self.first[self.doc + 1] if n else np.zeros(0, bool)
        return mix(out), whole

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The words of more than ``n`` bytes, and the hashes of their first ``n``."""
        long = np.flatnonzero(self.end - self.start > n)
        at = self.start[long]
        with np.errstate(over="ignore"):
            return long, mix((self.total[at + n] - self.total[at]) * self.shift[long])

    def text(self, a: int, b: int) -> bytes:
        """Words ``a`` to ``b`` joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist()))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups, of batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if at or (held and held[-1].column(key)[-1].as_py() != keys[-1]):
            if at:
                held.append(batch.slice(0, at))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)
