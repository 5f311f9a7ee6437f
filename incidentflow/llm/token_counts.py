"""Operator 9: token counts by rank-synchronous array merging.

The pre-tokens of a batch of texts that are not yet known are held as one
ragged numpy array of symbols.  In each round every pre-token finds its
lowest-rank adjacent pair and merges all its (non-overlapping) occurrences,
all pre-tokens at once; what survives is counted.  Counts of pre-tokens are
kept in a bounded table per Python worker.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common

_NONE = np.int64(2**62)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the rest follow from
    code point 256 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class PairTable:
    """Pair of symbols -> rank and merged symbol; open addressing over arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, bits: int = 19):
        while len(left) * 8 > 1 << bits:
            bits += 1
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << bits, -1, dtype=np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.ranks[slot[todo]] < 0
            _, first = np.unique(slot[todo][free], return_index=True)
            put = todo[free][first]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            busy = self.ranks[slot[todo]] >= 0
            slot[todo[busy]] = (slot[todo[busy]] + 1) & self.mask
        self.merged = merged.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where the two do not merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        out = np.full(len(keys), _NONE)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            go = ~hit & (self.ranks[at] >= 0)
            todo = todo[go]
            slot[todo] = (slot[todo] + 1) & self.mask
        return out


class Vocabulary:
    """What counting needs of a ``word_bpe`` style tokenizer file (NFC, lower
    case, a split pattern, byte-level symbols, an end-of-word suffix)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs])
        right = np.array([vocab[b] for _, b in pairs])
        self.pairs = PairTable(left, right, np.array([vocab[a + b] for a, b in pairs]))
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a tokenizer file with another normaliser")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.known: dict[str, int] = {}

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings it holds."""
        if self.special is not None and "<" in text and (parts := self.special.split(text)) and len(parts) > 1:
            return [w for p in parts for w in self.pretokens_of(p)], len(parts) - 1
        return self.pretokens_of(text), 0

    def pretokens_of(self, text: str) -> list[str]:
        if not text.isascii():
            # each letter is lowered on its own: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def count_new(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word, all words merged in step."""
        data = [w.encode() for w in words]
        lengths = np.array([len(b) for b in data], dtype=np.int64)
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lengths)
        sym[ends - 1] = self.last[flat[ends - 1]]
        seq = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), dtype=np.int64)
        rank = self._ranks(sym, seq)
        while True:
            # every sequence's lowest rank; sequences with none are finished
            starts = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(seq)))
            done = lowest == _NONE
            if done.any():
                counts[seq[starts[done]]] = size[done]
                if done.all():
                    return counts
                live = np.repeat(~done, size)
                sym, seq, rank = sym[live], seq[live], rank[live]
                lowest, size = lowest[~done], size[~done]
            at = rank == np.repeat(lowest, size)
            # in a run of overlapping matches (a a a) every second one merges
            pos = np.flatnonzero(at)
            head = np.concatenate([[True], np.diff(pos) > 1])
            if not head.all():
                run_start = np.maximum.accumulate(np.where(head, np.arange(len(pos)), 0))
                pos = pos[((np.arange(len(pos)) - run_start) & 1) == 0]
            sym[pos] = self.pairs.merged[rank[pos]]
            keep = np.ones(len(sym), dtype=bool)
            keep[pos + 1] = False
            new_at = pos - np.arange(len(pos))  # each merge before moved it one to the left
            sym, seq, rank = sym[keep], seq[keep], rank[keep]
            # only the pairs that touch a merged symbol have changed
            for touched in (new_at, new_at[new_at > 0] - 1):
                rank[touched] = self._ranks_at(sym, seq, touched)

    def _ranks(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        return self._ranks_at(sym, seq, np.arange(len(sym)))

    def _ranks_at(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position."""
        out = np.full(len(at), _NONE)
        inside = at + 1 < len(sym)
        inside[inside] = seq[at[inside]] == seq[at[inside] + 1]
        if inside.any():
            out[inside] = self.pairs.rank(sym[at[inside]], sym[at[inside] + 1])
        return out

    def counts(self, texts: list[str], most_known: int) -> list[int]:
        split = [self.pretokens(t) for t in texts]
        new = set()
        for words, _ in split:
            new.update(words)
        new.difference_update(self.known)
        if len(self.known) + len(new) > most_known:
            self.known = {}
            new = {w for words, _ in split for w in words}
        fresh, group, held = sorted(new, key=len), [], 0
        for i, w in enumerate(fresh):
            group.append(w)
            held += len(w)
            if held > 1 << 20 or i + 1 == len(fresh):
                self.known.update(zip(group, self.count_new(group).tolist()))
                group, held = [], 0
        get = self.known.__getitem__
        return [sum(map(get, words)) + extra for words, extra in split]


_LOADED: dict[str, Vocabulary] = {}


def count_tokens(
    df: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = common.ID, text_col: str = common.TEXT, most_known: int = 400_000
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``df``.

    ``vocabulary`` is the tokenizer file's path on the driver (its content,
    a few MB, is broadcast); ``limit`` is what ``over_limit`` compares with;
    ``most_known`` bounds the table of known pre-tokens a worker keeps.  A
    null or empty text has 0 bytes and 0 tokens; repeated rows and null ids
    give a row each; an empty table gives none; other columns are ignored.
    """
    with open(vocabulary, encoding="utf-8") as f:
        raw = f.read()
    spark = df.sparkSession
    shared, name = spark.sparkContext.broadcast(raw), f"{vocabulary}:{hash(raw)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LOADED:
            _LOADED[name] = Vocabulary(json.loads(shared.value))
        vocab = _LOADED[name]
        for part in common.slices(batches, common.TEXT, 1 << 21):
            n = vocab.counts(part.column(1).to_pylist(), most_known)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64())], names=[common.ID, "n_bytes", "n_tokens"])

    rows = common.texts(df, id_col, text_col)
    rows = rows.withColumn("n_bytes", F.octet_length(common.TEXT).cast("long"))
    kind = rows.schema[common.ID].dataType.simpleString()
    out = common.per_task(rows, run, f"{common.ID} {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
