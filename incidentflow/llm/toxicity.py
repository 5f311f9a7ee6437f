"""Operator 10: toxicity by a weighted finite-state pattern grammar.

Five small transducers read the word classes of a clause: insult, threat,
target, negation and reported speech.  Their composition gives every clause
with an insult or a threat a kind (insult at a target, negated insult,
reported threat, ...); clauses without one have none.  A document's score is
the logistic of the weighted counts of its clauses' kinds, and of what the
insults in them weigh, with weights fitted on labelled rows.  The insult
lexicon is a short fixed list plus words and word stems that labelled rows
show to go with the label far beyond chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import HashTable, Words
from incidentflow.session import materialise

# Word classes; a word that is in no list is OTHER.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# The word lists of the grammar (English, German, French, Spanish).
LISTS = {
    INSULT: "idiot moron stupid scum trash loser pathetic worthless disgusting clown imbecile dumbass jerk vermin filth "
    "dummkopf trottel abschaum versager widerlich arschloch connard imbécile ordure minable crétin salaud "
    "estúpido basura escoria imbécil asqueroso patético pendejo",
    THREAT: "kill murder hurt destroy strangle stab shoot töten umbringen vernichten erschießen tuer détruire frapper matar destruir golpear",
    TARGET: "you your yours yourself u they them their he him she her these those people du dich dir ihr euch sie tu te toi vous votre "
    "tú ti usted ustedes vosotros ellos",
    NEGATION: "not never no nobody isn aren don doesn nicht kein keine niemals pas jamais aucun nunca jamás ningún",
    REPORT: "said says say told wrote writes quoted called claims claimed sagte sagt schrieb behauptet dit disait écrit affirme dijo dice escribió afirma",
}
#: Bytes that end a clause.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".!?;:\n\"()"]] = True
#: Byte lengths of the word stems that are learned.
STEMS = (4, 5, 6, 7, 8)


# ----------------------------------------------------------- the transducers
@dataclass(frozen=True)
class Transducer:
    """``move[state][word class]`` is the next state; state 0 is the first;
    ``says[state]`` is what it says of a clause that ends there."""

    move: tuple[tuple[int, ...], ...]
    says: tuple[str, ...]


def _seen(kind: int, name: str) -> Transducer:
    """Says ``name`` once a word of the class has been read."""
    return Transducer((tuple(int(c == kind) for c in range(6)), (1,) * 6), ("", name))


def _negation(reach: int = 3) -> Transducer:
    """Says 'negated' if the clause's first insult or threat stands at most
    ``reach`` words behind a negation."""
    bad, negated = reach + 1, reach + 2
    rows = []
    for left in range(reach + 1):  # words that the last negation still reaches
        row = [max(left - 1, 0)] * 6
        row[NEGATION] = reach
        row[INSULT] = row[THREAT] = negated if left else bad
        rows.append(tuple(row))
    rows.append((bad,) * 6)
    rows.append((negated,) * 6)
    return Transducer(tuple(rows), ("",) * (reach + 2) + ("negated",))


def compose(parts: list[Transducer]) -> tuple[np.ndarray, list[tuple[str, ...]]]:
    """The product of the transducers over the states that can be reached."""
    order, number = [(0,) * len(parts)], {(0,) * len(parts): 0}
    table = []
    for state in order:
        row = []
        for c in range(6):
            to = tuple(p.move[s][c] for p, s in zip(parts, state))
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    return np.array(table), [tuple(p.says[s] for p, s in zip(parts, state)) for state in order]


GRAMMAR, SAYS = compose([_seen(INSULT, "insult"), _seen(THREAT, "threat"), _seen(TARGET, "target"), _negation(), _seen(REPORT, "reported")])


def _kind(says: tuple[str, ...]) -> int:
    """The kind of a clause that ends in a state; -1: neither insult nor threat."""
    insult, threat, target, negated, reported = map(bool, says)
    if not insult and not threat:
        return -1
    soft = "negated" if negated else "reported" if reported else "direct"
    return KINDS.index(("threat" if threat and (target or not insult) else "insult", "target" if target else "none", soft))


#: How a clause means what it says.
SOFT = ("direct", "negated", "reported")
KINDS = list(product(("insult", "threat"), ("target", "none"), SOFT))
KIND_OF = np.array([_kind(s) for s in SAYS])
N_FEATURES = len(KINDS) + 2 * len(SOFT)
#: Weights before any fit: kinds, then the largest and the summed word weight of
#: direct, negated and reported clauses, constant.
DEFAULT = np.array([{"direct": 2.0, "negated": 0.5, "reported": 0.7}[k[2]] * (0.3 if k[0] == "threat" and k[1] == "none" else 1.0) for k in KINDS] + [0.5, 0.1, 0.1, 0.0, 0.15, 0.0, -2.5])


class Lexicon:
    """Hashes of words and stems with their class and weight."""

    def __init__(self, learned: list[tuple[int, int, float]] = ()):
        """``learned``: (stem length or 0 for a whole word, hash, weight)."""
        fixed = {c: Words(pa.array([w for w in words.split()])) for c, words in LISTS.items()}
        hashes = np.concatenate([w.hash for w in fixed.values()])
        kinds = np.concatenate([np.full(len(w.hash), c) for c, w in fixed.items()])
        own = {h: w for n, h, w in learned if n == 0}
        more = np.array([h for h in own if h not in set(hashes.tolist())], dtype=np.uint64)
        hashes, first = np.unique(np.concatenate([hashes, more]), return_index=True)
        self.kind = np.concatenate([kinds, np.full(len(more), INSULT)])[first]
        self.weight = np.array([own.get(int(h), 2.0 if k in (INSULT, THREAT) else 0.0) for h, k in zip(hashes.tolist(), self.kind.tolist())])
        self.words = HashTable(hashes)
        self.stems = {}
        for n in STEMS:
            at = sorted((h, w) for m, h, w in learned if m == n)
            if at:
                self.stems[n] = (HashTable(np.array([h for h, _ in at], dtype=np.uint64)), np.array([w for _, w in at]))

    def read(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of every word."""
        kind = np.zeros(len(words.hash), dtype=np.int8)
        weight = np.zeros(len(words.hash))
        for n, (table, value) in self.stems.items():
            long, hashes = words.prefixes(n)
            at, k = table.find(hashes)
            kind[long[at]] = INSULT
            weight[long[at]] = np.maximum(weight[long[at]], value[k])
        at, k = self.words.find(words.hash)
        kind[at] = self.kind[k]
        weight[at] = np.maximum(weight[at], self.weight[k])
        return kind, weight

    def features(self, words: Words) -> np.ndarray:
        """For each text: log counts of matched clauses by kind, and for direct,
        negated and reported clauses each the largest and the summed (log)
        weight of the insults and threats in them."""
        out = np.zeros((words.n_docs, N_FEATURES))
        kind, weight = self.read(words)
        hot = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        if not len(hot):
            return out
        breaks = np.concatenate([[0], np.cumsum(_BREAK[words.data])])
        new = np.ones(len(kind), dtype=bool)
        new[1:] = (breaks[words.start[1:]] > breaks[words.end[:-1]]) | (words.doc[1:] != words.doc[:-1])
        clause = np.cumsum(new) - 1
        first = np.append(np.flatnonzero(new), len(kind))
        verdict = np.zeros(len(first), dtype=np.int64)
        for c in np.unique(clause[hot]).tolist():
            state = 0
            for k in kind[first[c] : first[c + 1]].tolist():
                state = GRAMMAR[state, k]
            verdict[c] = KIND_OF[state]
            out[words.doc[first[c]], verdict[c]] += 1
        # a word weighs in as its clause means it (the last part of the kind)
        column = len(KINDS) + 2 * (verdict[clause[hot]] % len(SOFT))
        np.maximum.at(out, (words.doc[hot], column), weight[hot])
        np.add.at(out, (words.doc[hot], column + 1), weight[hot])
        out[:, : len(KINDS)] = np.log1p(out[:, : len(KINDS)])
        out[:, len(KINDS) + 1 :: 2] = np.log1p(out[:, len(KINDS) + 1 :: 2])
        return out


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        x = self.lexicon.features(words)
        clauses = np.rint(np.expm1(x[:, : len(KINDS)]).sum(axis=1)).astype(np.int64)
        return 1 / (1 + np.exp(-(x @ self.weights[:-1] + self.weights[-1]))), clauses


# ------------------------------------------------------------------- the fit
def _terms(batches: Iterator[pa.RecordBatch], keep: dict[int, HashTable] | None) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word or stem, counted per task;
    ``keep``: of these terms only."""
    for part in common.slices(batches, common.TEXT, 1 << 22):
        words = Words(part.column(0))
        toxic = part.column(1).to_numpy(zero_copy_only=False)
        for n in (0, *STEMS):
            at, hashes = (np.arange(len(words.hash)), words.hash) if n == 0 else words.prefixes(n)
            if keep is not None:
                if n not in keep:
                    continue
                found, _ = keep[n].find(hashes)
                at, hashes = at[found], hashes[found]
            # a term counts once in a document
            doc = words.doc[at]
            order = np.lexsort((doc, hashes))
            hashes, doc = hashes[order], doc[order]
            once = np.ones(len(doc), dtype=bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            hashes, doc = hashes[once], doc[once]
            term, inverse = np.unique(hashes, return_inverse=True)
            total = np.bincount(inverse, minlength=len(term))
            bad = np.bincount(inverse, weights=toxic[doc], minlength=len(term)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), n, np.int32)), pa.array(term.astype(np.int64)), pa.array(bad), pa.array(total)], names=["n", "term", "bad", "total"])


def _count(rows: DataFrame, keep: dict[int, HashTable] | None) -> DataFrame:
    found = common.per_task(rows, lambda batches: _terms(batches, keep), "n int, term long, bad long, total long")
    return found.groupBy("n", "term").agg(F.sum("bad").alias("bad"), F.sum("total").alias("total"))


def surprise(bad: np.ndarray, total: np.ndarray, prior: float) -> np.ndarray:
    """How unlikely so many labelled documents are by chance, as -log of the
    Chernoff bound on the binomial tail (0 at or below the prior)."""
    p = bad / np.maximum(total, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log(p / prior), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - prior)), 0)
    return np.where(p > prior, total * kl, 0.0)


def learn_terms(rows: DataFrame, n_bad: int, n_rows: int, precision: float) -> list[tuple[int, int, float]]:
    """Words and stems that go with the label beyond chance: the chance bound
    is divided by the number of candidates, and at least ``precision`` of
    their documents have the label."""
    prior = n_bad / n_rows
    least = max(3, int(np.ceil(3 / -np.log(prior))))
    # no other term can pass: even if all of its documents had the label, it has too few
    candidates = _count(rows.where("toxic = 1"), None).where(F.col("bad") >= least).select("n", "term").collect()
    if not candidates:
        return []
    by_size = {n: np.array([r.term for r in candidates if r.n == n], dtype=np.int64).view(np.uint64) for n in (0, *STEMS)}
    keep = {n: HashTable(h) for n, h in by_size.items() if len(h)}
    found = _count(rows, keep).where(F.col("bad") >= F.lit(precision) * F.col("total")).collect()
    if not found:
        return []
    bad, total = np.array([r.bad for r in found]), np.array([r.total for r in found])
    sure = surprise(bad, total, prior) > np.log(len(candidates) / 0.05)
    weight = np.log((bad + 0.5) / (total - bad + 0.5)) - np.log(prior / (1 - prior))
    order = [i for i in np.lexsort((-weight, -bad)).tolist() if sure[i]]
    return [(found[i].n, int(np.int64(found[i].term).view(np.uint64)), float(weight[i])) for i in order]


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton steps for a logistic regression, pulled towards ``start``."""
    x = np.column_stack([x, np.ones(len(x))])
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, most_rows: int = 40_000, precision: float = 0.9,
    id_col: str = common.ID, text_col: str = common.TEXT, label_col: str = "toxic",
) -> Model:
    """Lexicon and weights from labelled rows.

    ``usable`` is a condition on ``doc_id`` for the labels that may be used
    (default: all).  At most about ``most_rows`` labelled documents, chosen by
    a hash of the id, are used, which bounds the lexicon.  Null ids,
    texts and labels are left out; of several labels of a document the largest
    holds; repeated texts count once.  Without rows of both labels the fixed
    lists and default weights hold.
    """
    own = labels.select(F.col(id_col).alias(common.ID), F.col(label_col).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if usable is not None:
        own = own.where(usable)
    own = own.groupBy(common.ID).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = most_rows / max(own.count(), 1)
    texts = docs.select(F.col(id_col).alias(common.ID), F.col(text_col).alias(common.TEXT)).where("doc_id IS NOT NULL AND text IS NOT NULL")
    if share < 1:
        chosen = F.pmod(F.xxhash64(common.ID), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        own, texts = own.where(chosen), texts.where(chosen)
    # about ``most_rows`` ids and labels at most: small enough for every task
    rows = texts.join(F.broadcast(own), common.ID).groupBy(common.TEXT).agg(F.max("toxic").alias("toxic"))
    rows = materialise(rows.select(common.TEXT, "toxic"), "toxicity-rows")
    n_rows, n_bad = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_bad < n_rows:
        return Model(Lexicon(), DEFAULT)
    lexicon = Lexicon(learn_terms(rows, n_bad, n_rows, precision))
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 22):
            x = shared.value.features(Words(part.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), part.column(1)], names=["x", "y"])

    # a few numbers for each of at most ``most_rows`` rows
    seen = common.per_task(rows, run, "x array<double>, y int").collect()
    return Model(lexicon, _logistic(np.array([r.x for r in seen]), np.array([r.y for r in seen], dtype=float), DEFAULT))


def score(df: DataFrame, model: Model, id_col: str = common.ID, text_col: str = common.TEXT) -> DataFrame:
    """``doc_id, score, n_clauses`` for every row: the chance of the label and
    the number of matched clauses.  A null or empty text has no clause and the
    score of such a text; long texts are read whole; repeated rows and null
    ids give a row each, an empty table none; other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 22):
            value, clauses = shared.value.score(Words(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array(clauses)], names=[common.ID, "score", "n_clauses"])

    rows = common.texts(df, id_col, text_col)
    return common.per_task(rows, run, f"{common.ID} {rows.schema[common.ID].dataType.simpleString()}, score double, n_clauses long")


def drop_toxic(df: DataFrame, model: Model, threshold: float = 0.5, text_col: str = common.TEXT) -> DataFrame:
    """The rows of ``df``, all columns, that score below ``threshold``.  A null
    text is the empty one; repeated rows and null ids stay or go each by their
    text; an empty table stays empty."""
    shared, at = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, text_col, 1 << 22):
            value, _ = shared.value.score(Words(part.column(at)))
            yield part.filter(pa.array(value < threshold))

    return common.per_task(df, run, df.schema)
