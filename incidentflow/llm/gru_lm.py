"""Operator 3: language-model scoring by a gated recurrent network.

Word counts of the whole training corpus give the vocabulary: the most
frequent words stand for themselves, in classes of equal size by frequency;
every other word belongs to the class of its last two bytes.  The network
predicts the class (first softmax) and, for frequent words, the word in its
class (second softmax); inside the other classes words have their counts'
shares.  It starts as the unigram model, is trained by truncated
backpropagation in numpy on every training document, partition by partition,
with the partitions' weights averaged after each round, and scores documents
whole, its state carried from window to window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import HashTable, Words
from incidentflow.session import materialise

#: The hash that stands for the end of a text (no word has it but by chance of 2**-64).
END = np.uint64(0x0E4D0F7E8C0DE5A1)
GROUP = 64
CACHED = 1024
#: Targets after which a text goes on from a fresh state in training (scoring carries it on).
PIECE = 2048
#: Bytes of text made into words at once, and words that fill the lanes together.
SLICE, POOL = 1_900_000, 2_500_000


# ---------------------------------------------------------------- vocabulary
@dataclass
class Vocabulary:
    """``head``: words frequent enough to be broadcast, by falling count;
    the first ``n_words`` of them (a multiple of GROUP or fewer) are the
    network's own.  ``suffix_class`` gives each two-byte ending its class among
    the others, whose mass is ``tail_mass``."""

    head: HashTable
    counts: np.ndarray
    n_words: int
    suffix_class: np.ndarray
    tail_mass: np.ndarray
    total: int
    distinct: int

    @property
    def n_groups(self) -> int:
        return -(-self.n_words // GROUP)

    @property
    def n_classes(self) -> int:
        return self.n_groups + len(self.tail_mass)


def suffixes(words: Words) -> np.ndarray:
    """The last two bytes of each word, as one number."""
    last = words.data[words.end - 1].astype(np.int32)
    before = np.where(words.end - words.start > 1, words.data[words.end - 2], 0).astype(np.int32)
    return last * 256 + before


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    for part in common.slices(batches, common.TEXT, SLICE):
        words = Words(part.column(0), split_on_space=True)
        h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
        held.append(np.array([part.num_rows]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(h, END).view(np.int64)), pa.array(np.append(suffixes(words)[first], -1).astype(np.int32)), pa.array(np.append(n, part.num_rows).astype(np.int64))],
            names=["h", "suffix", "c"],
        )


def count_words(texts: DataFrame) -> DataFrame:
    """``h, suffix, c``: the count of every word and of the end, written once."""
    found = common.per_task(texts.select(common.TEXT), _count, "h long, suffix int, c long")
    return materialise(found.groupBy("h").agg(F.max("suffix").alias("suffix"), F.sum("c").alias("c")), "word-counts")


def vocabulary(counts: DataFrame, n_words: int, n_tails: int, most_head: int) -> Vocabulary:
    """At most ``most_head`` words, and a number for each of at most 65,537
    endings, come to the driver."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    steps = counts.groupBy(F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int").alias("step")).count().collect()
    least, held = 1.0, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["count"]
        if held > most_head:
            least = 2 ** ((row["step"] + 1) / 8)
            break
    near = counts.where((F.col("c") >= F.lit(least)) | (F.col("suffix") == -1)).where(F.floor(F.log2(F.col("c").cast("double")) * 8) >= math.floor(math.log2(least) * 8 + 1e-9))
    head = near.toPandas()
    end = counts.where("suffix = -1").toPandas()
    if end.empty:  # nothing to learn from: the end alone, never seen
        end = pd.DataFrame({"h": [END.view(np.int64)], "suffix": [-1], "c": [0]})
    head = head[head["suffix"] != -1].sort_values(["c", "h"], ascending=[False, True])
    hashes = np.append(end["h"].to_numpy(), head["h"].to_numpy()).view(np.uint64)
    c = np.append(end["c"].to_numpy(), head["c"].to_numpy()).astype(np.int64)
    own = np.append(end["suffix"].to_numpy(), head["suffix"].to_numpy()).astype(np.int64)
    n_words = min(n_words, len(c))
    # the end is the first of the network's words, the others by falling count
    mass = np.zeros(65_536)
    for row in counts.groupBy("suffix").agg(F.sum("c").alias("c"), F.count("*").alias("n")).where("suffix >= 0").collect():
        mass[row["suffix"]] = row["c"] + 0.5 * row["n"]
    np.subtract.at(mass, own[1:n_words], c[1:n_words] + 0.5)
    mass = np.maximum(mass, 0)
    large = np.argsort(-mass, kind="stable")[: n_tails - 1]
    of = np.full(65_536, n_tails - 1, dtype=np.int64)
    of[large] = np.arange(len(large))
    # each of these classes also holds an unknown word, of count 0
    tail = np.bincount(of, weights=mass, minlength=n_tails) + 0.5
    return Vocabulary(HashTable(hashes, bits=22), c, n_words, of, tail, int(total), int(distinct))


# ------------------------------------------------------------------- network
class Network:
    """Parameters: ``inputs`` (a row of gate inputs for each word and class,
    plus one), ``recur``, ``class_w``/``class_b`` and ``word_w``/``word_b``."""

    NAMES = ("inputs", "recur", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, vocab: Vocabulary, hidden: int, seed: int = 11):
        pick = np.random.default_rng(seed)
        groups, classes = vocab.n_groups, vocab.n_classes
        self.hidden, self.n_words, self.n_groups = hidden, vocab.n_words, groups
        self.inputs = pick.normal(0, 0.3, (vocab.n_words + len(vocab.tail_mass), 3 * hidden)).astype(np.float32)
        self.inputs[:, :hidden] += 1.0  # gates begin by keeping their state
        self.recur = pick.normal(0, 0.5 / math.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        share = np.zeros(groups * GROUP)
        share[: vocab.n_words] = vocab.counts[: vocab.n_words] + 0.5
        share = share.reshape(groups, GROUP)
        mass = np.append(share.sum(axis=1), vocab.tail_mass)
        self.class_w = np.zeros((hidden, classes), dtype=np.float32)
        self.class_b = np.log(mass / mass.sum()).astype(np.float32)
        self.word_w = np.zeros((groups, hidden, GROUP), dtype=np.float32)
        with np.errstate(divide="ignore"):
            self.word_b = np.maximum(np.log(share / share.sum(axis=1, keepdims=True)), -60).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32).copy())
            at += old.size

    def forward(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool):
        """States after each step of ``x`` (steps by lanes), state ``h`` before;
        ``fresh`` marks the first step of a text.  ``keep``: what backward needs."""
        steps, lanes = x.shape
        n = self.hidden
        states = np.empty((steps + 1, lanes, n), dtype=np.float32)
        states[0] = h
        held = [np.empty((steps, lanes, k * n), dtype=np.float32) for k in (2, 1, 1)] if keep else None
        given = self.inputs[x]
        keeps = (~fresh).astype(np.float32)[:, :, None]
        for t in range(steps):
            h = states[t] * keeps[t]
            if keep:
                states[t] = h
            u = h @ self.recur
            gates = given[t, :, : 2 * n] + u[:, : 2 * n]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = np.tanh(given[t, :, 2 * n :] + gates[:, n:] * u[:, 2 * n :])
            states[t + 1] = new + gates[:, :n] * (h - new)
            if keep:
                held[0][t], held[1][t], held[2][t] = gates, u[:, 2 * n :], new
        return states, held

    def outputs(self, h: np.ndarray, cls: np.ndarray, word: np.ndarray, grad: dict[str, np.ndarray] | None):
        """Log-probability of each target's class and, where ``word`` is not
        negative, of the word in it; with ``grad`` also the loss's gradient by
        the states, its share of the parameters' being added to ``grad``."""
        ones = np.ones((len(h), 1), dtype=np.float32)
        wide = np.concatenate([h, ones], axis=1)
        part = None if grad is None else (grad["class_w"], grad["class_b"])
        # in pieces whose logits stay in a core's cache
        pieces = [_softmax(wide[a : a + CACHED], self.class_w, self.class_b, cls[a : a + CACHED], part) for a in range(0, len(h), CACHED)]
        logp, dh = np.concatenate([p for p, _ in pieces]), None if grad is None else np.concatenate([d for _, d in pieces])
        known = np.flatnonzero(word >= 0)
        known = known[np.argsort(cls[known], kind="stable")]
        cut = np.flatnonzero(np.concatenate([[True], np.diff(cls[known]) > 0])) if len(known) else []
        for a, b in zip(cut, [*cut[1:], len(known)]):
            at = known[a:b]
            g = cls[at[0]]
            part = None if grad is None else (grad["word_w"][g], grad["word_b"][g])
            more, dmore = _softmax(wide[at], self.word_w[g], self.word_b[g], word[at], part)
            logp[at] += more
            if grad is not None:
                dh[at] += dmore
        return logp, dh

    def backward(self, x, fresh, states, held, dh_out, grad) -> None:
        """Truncated backpropagation through the steps of one window."""
        steps, lanes = x.shape
        n = self.hidden
        dgiven = np.empty((steps, lanes, 3 * n), dtype=np.float32)
        du = np.empty((steps, lanes, 3 * n), dtype=np.float32)
        dh = np.zeros((lanes, n), dtype=np.float32)
        keeps = (~fresh).astype(np.float32)[:, :, None]
        # the parts that do not depend on the steps behind
        slopes = held[0] * (1 - held[0])
        z, r = held[0][:, :, :n], held[0][:, :, n:]
        for_new = (1 - z) * (1 - held[2] * held[2])
        for_z = (states[:-1] - held[2]) * slopes[:, :, :n]
        for_r = held[1] * slopes[:, :, n:]
        back = np.ascontiguousarray(self.recur.T)
        for t in range(steps - 1, -1, -1):
            dh += dh_out[t]
            dnew = dgiven[t, :, 2 * n :]
            np.multiply(dh, for_new[t], out=dnew)
            np.multiply(dh, for_z[t], out=du[t, :, :n])
            np.multiply(dnew, for_r[t], out=du[t, :, n : 2 * n])
            np.multiply(dnew, r[t], out=du[t, :, 2 * n :])
            dh *= z[t]
            dh += du[t] @ back
            dh *= keeps[t]
        dgiven[:, :, : 2 * n] = du[:, :, : 2 * n]
        grad["recur"] += states[:-1].reshape(-1, n).T @ du.reshape(-1, 3 * n)
        flat, rows = dgiven.reshape(-1, 3 * n), x.ravel()
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) > 0]))
        grad["inputs"][rows[order][first]] += np.add.reduceat(flat[order], first, axis=0)


def _softmax(wide: np.ndarray, w: np.ndarray, b: np.ndarray, target: np.ndarray, grad: tuple[np.ndarray, np.ndarray] | None):
    """Log-probabilities of the targets and, with ``grad`` (of ``w`` and ``b``,
    added to), the gradient by the states; ``wide``: states and a one.

    States lie within one of zero, so the columns' absolute sums bound every
    logit; as long as the bounds are near each other one shift does for all
    rows, otherwise each row is shifted by its largest logit."""
    reach = np.abs(w).sum(axis=0)
    shift = float((b + reach).max())
    logits = wide @ np.concatenate([w, (b - shift)[None, :]])
    if shift - float((b - reach).max()) > 20:
        logits -= logits.max(axis=1, keepdims=True)
    np.maximum(logits, -60, out=logits)  # no denormal numbers
    rows = np.arange(len(wide))
    picked = logits[rows, target]
    np.exp(logits, out=logits)
    mass = logits @ np.ones(len(b), dtype=np.float32)
    logp = picked - np.log(mass)
    if grad is None:
        return logp, None
    # the division by the mass is left to the narrow side of each product
    logits[rows, target] -= mass
    share = 1 / mass
    own = (wide * share[:, None]).T @ logits
    grad[0][...] += own[:-1]
    grad[1][...] += own[-1]
    return logp, (logits @ w.T) * share[:, None]


class Adam:
    """Takes a step once the gradients of ``batch`` targets have come together,
    so that the last windows of a long text, alone in its lane, weigh no more
    than their share."""

    def __init__(self, net: Network, rate: float, batch: int):
        self.net, self.rate, self.t = net, rate, 0
        self.batch, self.targets = batch, 0
        self.grad = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
        self.first = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
        self.second = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}

    def add(self, targets: int) -> None:
        """``targets`` more have been added to ``grad``."""
        self.targets += targets
        if self.targets >= self.batch:
            self._step(self.rate)

    def rest(self) -> None:
        """A last step with what is left, shorter by its share of a batch."""
        if self.targets:
            self._step(self.rate * self.targets / self.batch)

    def _step(self, rate: float) -> None:
        self.t += 1
        fix = math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        for n, g in self.grad.items():
            g /= self.targets
            m, v = self.first[n], self.second[n]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            getattr(self.net, n)[...] -= rate * fix * m / (np.sqrt(v) + 1e-6)
            g[...] = 0
        self.targets = 0


# --------------------------------------------------------------------- lanes
@dataclass
class Lanes:
    """Texts laid end to end in lanes: ``order`` has the targets lane by lane,
    each lane from ``start`` and ``load`` long, by falling load.  A window is
    cut out when it is used, so a long text does not widen all lanes."""

    before: np.ndarray  # input of each target
    cls: np.ndarray
    word: np.ndarray
    begins: np.ndarray
    order: np.ndarray
    start: np.ndarray
    load: np.ndarray

    def windows(self, steps: int):
        """``where`` (steps by lanes still active; -1: beyond a lane's end),
        inputs and first-step marks of each window."""
        for a in range(0, int(self.load[0]), steps):
            n = int(np.searchsorted(-self.load, -a))  # lanes longer than a
            t = np.arange(a, min(a + steps, int(self.load[0])))[:, None]
            inside = t < self.load[:n]
            where = np.where(inside, self.order[np.minimum(self.start[:n] + t, len(self.order) - 1)], -1)
            at = np.where(inside, where, 0)
            yield where, self.before[at], self.begins[at] | ~inside


class Finder:
    """:class:`HashTable` for many look-ups: the first key of each run of high
    bits is known, so a hash meets the few keys of its run without a search."""

    def __init__(self, table: HashTable):
        self.keys, self.order, self.shift = np.append(table.keys, ~np.uint64(0)), np.append(table.order, -1), table.shift
        runs = np.bincount((table.keys >> table.shift).astype(np.int64), minlength=len(table.mask))
        self.first = np.append(0, np.cumsum(runs)).astype(np.int32)
        self.longest = int(runs.max()) if len(runs) else 0

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where it is not in the table."""
        run = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[run], self.first[run + 1]
        out = np.full(len(hashes), -1, dtype=np.int64)
        for _ in range(self.longest):
            same = self.keys[at] == hashes
            same &= at < end
            out = np.where(same, self.order[at], out)
            at = np.minimum(at + 1, end)
        return out


def encode(words: Words, vocab: Vocabulary, finder: Finder):
    """For the targets of all texts (their words, then the end): the network's
    input id, class, word in class (-1: none), count (-1: not in the head)."""
    n = len(words.hash) + words.n_docs
    ends = words.first[1:] + np.arange(words.n_docs)
    is_word = np.ones(n, dtype=bool)
    is_word[ends] = False
    entry = finder.entries(words.hash)
    rank = np.zeros(n, dtype=np.int64)  # the end is entry 0
    rank[is_word] = entry
    tail = np.zeros(n, dtype=np.int64)
    tail[is_word] = vocab.suffix_class[suffixes(words)]
    own = (rank >= 0) & (rank < vocab.n_words)
    ids = np.where(own, rank, vocab.n_words + tail)
    cls = np.where(own, rank // GROUP, vocab.n_groups + tail)
    word = np.where(own, rank % GROUP, -1)
    count = np.where(rank >= 0, vocab.counts[rank], -1)
    return ids.astype(np.int32), cls.astype(np.int32), word.astype(np.int32), count, is_word


@dataclass
class Pool:
    """Encoded texts of several slices, so that the lanes are full: a lane is
    as long as the longest text, so few words would leave most lanes idle."""

    ids: list = field(default_factory=list)
    cls: list = field(default_factory=list)
    word: list = field(default_factory=list)
    size: list = field(default_factory=list)  # targets of each text
    targets: int = 0

    def add(self, ids: np.ndarray, cls: np.ndarray, word: np.ndarray, first: np.ndarray) -> None:
        for held, new in ((self.ids, ids), (self.cls, cls), (self.word, word), (self.size, np.diff(first))):
            held.append(new)
        self.targets += len(ids)

    def lanes(self, lanes: int, longest: int | None = None) -> Lanes:
        first = np.concatenate([[0], np.cumsum(np.concatenate(self.size))])
        return lay_out(np.concatenate(self.ids), np.concatenate(self.cls), np.concatenate(self.word), first, lanes, longest)


def lay_out(ids: np.ndarray, cls: np.ndarray, word: np.ndarray, first: np.ndarray, lanes: int, longest: int | None = None) -> Lanes:
    """The longest texts first, each into the shortest lane so far; with
    ``longest`` texts are cut into pieces of so many targets, each from a
    fresh state (for training)."""
    if longest:
        first = np.unique(np.concatenate([first, *[np.arange(a, b, longest) for a, b in zip(first[:-1], first[1:]) if b - a > longest]]))
    size = np.diff(first)
    lanes = max(1, min(lanes, len(size)))
    heap = [(0, k) for k in range(lanes)]
    own: list[list[int]] = [[] for _ in range(lanes)]
    for d in np.argsort(-size, kind="stable").tolist():
        load, k = heapq.heappop(heap)
        own[k].append(d)
        heapq.heappush(heap, (load + int(size[d]), k))
    loads = {k: load for load, k in heap}
    ranked = sorted(range(lanes), key=lambda k: -loads[k])
    pieces = np.array([d for k in ranked for d in own[k]])
    end = np.cumsum(size[pieces])
    order = np.repeat(first[pieces] - (end - size[pieces]), size[pieces]) + np.arange(end[-1])
    load = np.array([loads[k] for k in ranked])
    before = np.concatenate([ids[:1] * 0, ids[:-1]])
    begins = np.zeros(len(ids), dtype=bool)
    begins[first[:-1]] = True
    # a text begins after an end (id 0), which is also what comes before it here
    return Lanes(before, cls, word, begins, order, np.cumsum(load) - load, load)


def train_on(net: Network, adam: Adam, lanes: Lanes, window: int) -> None:
    h = np.zeros((len(lanes.load), net.hidden), dtype=np.float32)
    for where, x, fresh in lanes.windows(window):
        states, held = net.forward(x, fresh, h[: x.shape[1]], True)
        h = states[-1]
        real = np.flatnonzero(where.ravel() >= 0)
        at = where.ravel()[real]
        _, dh = net.outputs(states[1:].reshape(-1, net.hidden)[real], lanes.cls[at], lanes.word[at], adam.grad)
        dh_out = np.zeros((x.size, net.hidden), dtype=np.float32)
        dh_out[real] = dh
        net.backward(x, fresh, states, held, dh_out.reshape(*x.shape, -1), adam.grad)
        adam.add(len(real))


def score_on(net: Network, lanes: Lanes, n_targets: int, window: int) -> np.ndarray:
    """Log-probability of every target."""
    out = np.zeros(n_targets)
    h = np.zeros((len(lanes.load), net.hidden), dtype=np.float32)
    for where, x, fresh in lanes.windows(window):
        states, _ = net.forward(x, fresh, h[: x.shape[1]], False)
        h = states[-1]
        real = np.flatnonzero(where.ravel() >= 0)
        at = where.ravel()[real]
        out[at], _ = net.outputs(states[1:].reshape(-1, net.hidden)[real], lanes.cls[at], lanes.word[at], None)
    return out


# ---------------------------------------------------------------- operations
def _targets_first(words: Words) -> np.ndarray:
    return words.first + np.arange(words.n_docs + 1)


def _rare(words: Words, rare: np.ndarray) -> pa.ListArray:
    """Hash and number of each text's words outside the head."""
    rare = rare[np.lexsort((words.hash[rare], words.doc[rare]))]
    d, h = words.doc[rare], words.hash[rare]
    once = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])) if len(rare) else rare
    offset = pa.array(np.searchsorted(d[once], np.arange(words.n_docs + 1)).astype(np.int32))
    times = np.diff(np.append(once, len(rare)))
    return pa.ListArray.from_arrays(offset, pa.StructArray.from_arrays([pa.array(h[once].view(np.int64)), pa.array(times.astype(np.int32))], names=["h", "n"]))


def _train_round(texts: DataFrame, vocab: Vocabulary, net: Network, lanes: int, window: int, rate: float, chunk: int = 4096) -> np.ndarray | None:
    """Every partition trains from the same weights; the mean of theirs, each
    weighted by its tokens.  Weights travel in chunks that are added up in the
    cluster; one set of weights comes to the driver."""
    shared = texts.sparkSession.sparkContext.broadcast((vocab, net))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, start = shared.value
        own = Network.__new__(Network)
        own.__dict__.update(start.__dict__)
        own.load(start.flat())
        adam, tokens = Adam(own, rate, lanes * window // 2), 0
        finder, pool = Finder(words_of.head), Pool()
        for part in common.slices(batches, common.TEXT, SLICE):
            words = Words(part.column(0), split_on_space=True)
            ids, cls, word, _, _ = encode(words, words_of, finder)
            pool.add(ids, cls, word, _targets_first(words))
            if pool.targets >= POOL:
                tokens += pool.targets
                train_on(own, adam, pool.lanes(lanes, PIECE), window)
                pool = Pool()
        if pool.targets:
            tokens += pool.targets
            train_on(own, adam, pool.lanes(lanes, PIECE), window)
        adam.rest()
        if tokens:
            flat = own.flat().astype(np.float64) * tokens
            flat = np.append(flat, np.zeros(-len(flat) % chunk)).reshape(-1, chunk)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(np.full(len(flat), tokens)), pa.array(list(flat.astype(np.float32)), pa.list_(pa.float32()))], names=["k", "tokens", "w"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        tokens: dict[int, int] = {}
        for batch in batches:
            for k, n, w in zip(batch.column("k").to_pylist(), batch.column("tokens").to_pylist(), batch.column("w")):
                total[k] = total.get(k, 0.0) + w.values.to_numpy().astype(np.float64)
                tokens[k] = tokens.get(k, 0) + n
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([tokens[k] for k in total]), pa.array([w / tokens[k] for k, w in total.items()], pa.list_(pa.float64()))], names=["k", "tokens", "w"])

    made = common.per_task(texts, train, "k long, tokens long, w array<float>")
    rows = sorted(common.per_task(made.repartition("k"), add, "k long, tokens long, w array<double>").collect())
    shared.unpersist()
    return np.concatenate([np.array(r.w) for r in rows]) if rows else None


def fit(
    texts: DataFrame, counts: DataFrame, hidden: int = 16, n_words: int = 2048, n_tails: int = 48, most_head: int = 262_144, rounds: int = 3, lanes: int = 512, window: int = 16, rate: float = 0.01
) -> tuple[Vocabulary, Network]:
    """Vocabulary and network from all of ``texts`` (column ``text``); each
    text is read once, in the round that a hash of it names."""
    vocab = vocabulary(counts, n_words, n_tails, most_head)
    net = Network(vocab, hidden)
    for r in range(rounds if vocab.total else 0):
        part = texts.select(common.TEXT).where(F.pmod(F.xxhash64(common.TEXT), F.lit(rounds)) == r)
        flat = _train_round(part, vocab, net, lanes, window, rate)
        if flat is not None:
            net.load(flat)
    return vocab, net


def score(
    df: DataFrame, train: Column, id_col: str = common.ID, text_col: str = common.TEXT, lanes: int = 512, window: int = 32, **options
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row: log10 probabilities of whole texts by the smoothed unigram
    model (base) and by the network, learned from the rows where ``train`` (a
    condition on ``doc_id``) holds.

    Tokens are the words between ASCII white space, A-Z lower-cased, then one
    end.  A null or empty text is the end alone.  Null ids count as the
    condition says (null: not trained on); repeated rows are trained on and
    scored as often as they occur; without any training row both scores are 0.  Counts of words too rare to be
    broadcast are joined to the documents that hold them.
    """
    rows = common.texts(df, id_col, text_col)
    learned = rows.where(F.coalesce(train, F.lit(False)))
    counts = count_words(learned)
    vocab, net = fit(learned, counts, **options)
    shared = rows.sparkSession.sparkContext.broadcast((vocab, net))
    kind = rows.schema[common.ID].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, own = shared.value
        finder, pool, slices = Finder(words_of.head), Pool(), []
        log_mass = np.log(words_of.tail_mass)
        uid = TaskContext.get().partitionId() << 33

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal uid
            every = score_on(own, pool.lanes(lanes), pool.targets, window)
            upto = 0
            for part, first, cls, word, count, rare in slices:
                n = len(first) - 1
                logp, upto = every[upto : upto + len(cls)], upto + len(cls)
                doc = np.repeat(np.arange(n), np.diff(first))
                held = count >= 0
                log_count = np.log(np.where(held, count, 0) + 0.5)
                tail = word < 0
                logp[tail] -= log_mass[cls[tail] - words_of.n_groups]
                logp[tail & held] += log_count[tail & held]
                total = lambda w: np.bincount(doc, weights=w, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(n)), part, pa.array(np.diff(first)), pa.array(total((held & (count > 0)).astype(float)).astype(np.int64)),
                     pa.array(total(np.where(held, log_count, 0.0))), pa.array(total(logp)), rare],
                    names=["uid", common.ID, "n_tokens", "known", "base", "net", "rare"],
                )
                uid += n

        for part in common.slices(batches, common.TEXT, SLICE):
            words = Words(part.column(1), split_on_space=True)
            ids, cls, word, count, is_word = encode(words, words_of, finder)
            first = _targets_first(words)
            pool.add(ids, cls, word, first)
            slices.append((part.column(0), first, cls, word, count, _rare(words, np.flatnonzero(count[is_word] < 0))))
            if pool.targets >= POOL:
                yield from done()
                pool, slices = Pool(), []
        if slices:
            yield from done()

    schema = f"uid long, {common.ID} {kind}, n_tokens long, known long, base double, net double, rare array<struct<h:long,n:int>>"
    scored = materialise(common.per_task(rows, run, schema), "lm-scored")
    rare = scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.h", "r.n")
    own = rare.join(counts.select("h", "c"), "h", "left")
    sums = own.groupBy("uid").agg(
        F.sum(F.col("n") * F.log(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known")
    )
    scale = math.log10(vocab.total + 0.5 * (vocab.distinct + 1))
    more = F.coalesce("more", F.lit(0.0))
    base = (F.col("base") + more) / math.log(10) - F.col("n_tokens") * scale
    return scored.join(sums, "uid", "left").select(
        common.ID,
        (~F.coalesce(train, F.lit(False))).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        ((F.col("net") + more) / math.log(10) if vocab.total else base).alias("score"),
    )
