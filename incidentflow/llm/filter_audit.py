"""Operator 11: how a set of filters interacts, by counting paths in the
lattice of filter subsets.

A state is the set of filters applied so far, an edge applies one more.  Going
forward from the empty state counts the orders that reach every state, going
backward from the full one counts those that leave it; their product is the
number of orders that run through an edge.  A row of the data only matters by
the set of filters it fails, so the corpus is counted once per part and failure
set.  From these counts every edge gets what it keeps, removes and finds
removed already; removals weighted by the orders through the edge add up to a
filter's Shapley total, and the steps of an order are the edges of its path.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.session import materialise

#: Orders are listed up to this many filters (8! paths of 8 steps).
MOST_LISTED = 8
_SPACE = r"[\x20\x09-\x0D]+"


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every set of ``n`` filters (a bit each): the orders that reach it
    from the empty set, and those that lead from it to the full one."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full - 1, -1, -1):
        leave[state] = sum(leave[state | 1 << f] for f in range(n) if not state >> f & 1)
    return reach, leave


def text_failures(text: Column) -> dict[str, Column]:
    """Which of the four conditions on a text alone it fails."""
    words = F.array_remove(F.split(text, _SPACE), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _mask(failures: list[Column]) -> Column:
    """The failures as bits; a condition that is unknown is not failed."""
    out = F.lit(0)
    for bit, failed in enumerate(failures):
        out = out.bitwiseOR(F.when(failed, 1 << bit).otherwise(0))
    return out


def label_flags(labels: DataFrame, flags: dict[str, Column], id_col: str = common.ID) -> DataFrame:
    """``doc_id`` and a 0/1 column for each flag: 1 if any row of the id has it.
    Rows without an id label nothing."""
    known = labels.where(F.col(id_col).isNotNull())
    return known.groupBy(F.col(id_col).alias(common.ID)).agg(*[F.max(F.when(c, 1).otherwise(0)).alias(name) for name, c in flags.items()])


def failure_states(
    docs: DataFrame,
    labelled: DataFrame,
    part: Column,
    conditions=text_failures,
    copies: str | None = "E",
    id_col: str = common.ID,
    text_col: str = common.TEXT,
) -> tuple[list[str], DataFrame]:
    """The filters' names and ``part, mask, n`` with a sum for each flag of
    ``labelled`` (see :func:`label_flags`): how many rows of a part fail just
    the filters whose bits are set.

    ``conditions`` maps a text column to the conditions' columns; ``copies``
    names a last filter, failed by a row whose text a smaller id has anywhere in
    the table (None: no such filter).  A null text is the empty one, a null part
    the empty string.  A null id has no label, is smaller than none and has none
    smaller.  Repeated rows count each.  Other columns of ``docs`` are ignored.

    The texts are read once and only their digests move.  Equal rows are
    counted before the shuffles, the labels join by id (rows without an id are
    spread by digest), and the smallest id of each text is an aggregate joined
    back, so no group of copies meets in one task.
    """
    flags = [c for c in labelled.columns if c != common.ID]
    text = F.coalesce(F.col("_text"), F.lit(""))
    tests = conditions(text)
    names = [*tests, *([copies] if copies else [])]
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("_text"))
    rows = rows.select("_id", "part", _mask(list(tests.values())).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    rows = rows.groupBy("_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    known = labelled.select(F.col(common.ID).alias("_of"), F.lit(0).cast("long").alias("_spread_of"), *[F.col(c).alias(f"_f_{c}") for c in flags])
    # a null id matches nothing: its rows are dealt out by digest
    rows = rows.withColumn("_spread", F.when(F.col("_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    rows = rows.join(known, (F.col("_id") == F.col("_of")) & (F.col("_spread") == F.col("_spread_of")), "left")
    rows = rows.select("part", "mask", "digest", "_id", "n", *[F.coalesce(F.col(f"_f_{c}"), F.lit(0)).alias(f"_f_{c}") for c in flags])
    if copies is None:
        split = rows
    else:
        keys = ["digest", "part", "mask", *[f"_f_{c}" for c in flags]]
        known_id = F.when(F.col("_id").isNotNull(), F.struct("_id", "n"))
        groups = rows.groupBy(*keys, "_id").agg(F.sum("n").alias("n")).groupBy(*keys).agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("n"))), F.lit(0)).alias("n_free"),
            F.min(known_id).alias("least"),
        )
        groups = materialise(groups, "audit-texts")
        first = groups.groupBy("digest").agg(F.min("least._id").alias("first"))
        groups = groups.join(first, "digest")
        # rows that hold the text's smallest id, or none, are no later copies
        passed = F.col("n_free") + F.when(F.col("least._id") == F.col("first"), F.col("least.n")).otherwise(0)
        both = F.array(
            F.struct(F.col("mask").alias("m"), passed.alias("c")),
            F.struct(F.col("mask").bitwiseOR(F.lit(1 << len(tests))).alias("m"), (F.col("n") - passed).alias("c")),
        )
        split = groups.select("part", F.explode(both).alias("s"), *[f"_f_{c}" for c in flags])
        split = split.select("part", F.col("s.m").alias("mask"), F.col("s.c").alias("n"), *[f"_f_{c}" for c in flags])
    # parts stay with 0 rows in a state; the lattice needs each part once at least
    return names, split.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"_f_{c}") * F.col("n")).alias(c) for c in flags])


def edges(states: DataFrame, filters: list[str]) -> DataFrame:
    """One row per part and lattice edge: ``part, before`` (filters applied, as
    bits), ``bit, filter, orders`` (that run through the edge), ``kept,
    removed, redundant, unique_fails``, ``<flag>_lost`` for every flag of
    ``states``, and ``shapley``: the filter's removals over all orders."""
    n = len(filters)
    reach, leave = path_counts(n)
    through = [reach[s] * leave[s | 1 << f] for s in range(1 << n) for f in range(n)]
    flags = [c for c in states.columns if c not in ("part", "mask", "n")]
    at = states.withColumn("_e", F.explode(F.sequence(F.lit(0), F.lit((n << n) - 1))))
    at = at.withColumns({"before": F.floor(F.col("_e") / n).cast("int"), "_f": F.col("_e") % n})
    at = at.withColumn("bit", F.expr("shiftleft(1, _f)")).where(F.col("before").bitwiseAND(F.col("bit")) == 0)
    arrives, fails = F.col("mask").bitwiseAND(F.col("before")) == 0, F.col("mask").bitwiseAND(F.col("bit")) != 0

    def total(of: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(of)).otherwise(F.lit(0)))

    out = at.groupBy("part", "before", "bit", "_f", "_e").agg(
        total("n", arrives & ~fails).alias("kept"),
        total("n", arrives & fails).alias("removed"),
        total("n", ~arrives & fails).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        *[total(c, arrives & fails).alias(f"{c}_lost") for c in flags],
    )
    out = out.withColumns(
        {
            "orders": F.element_at(F.array(*[F.lit(x).cast("long") for x in through]), F.col("_e") + 1),
            "filter": F.element_at(F.array(*[F.lit(x) for x in filters]), F.col("_f") + 1),
        }
    )
    # at most 2**(n-1) edges of a part apply a filter
    own = Window.partitionBy("part", "bit")
    return out.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(own)).drop("_e", "_f")


def audit(states: DataFrame, filters: list[str], orders: list[str] | None = None) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails,
    <flag>_lost..., shapley`` of every part, order and step.

    ``filters`` have names of one letter; ``orders`` are strings of them, all
    orders by default (up to 8 filters; more raise unless orders are given).  A
    part has its rows even where all are zero; no states, no rows.
    """
    if orders is None:
        if len(filters) > MOST_LISTED:
            raise ValueError(f"{len(filters)} filters have too many orders to list; name the orders to read")
        orders = ["".join(p) for p in permutations(filters)]
    bit = {f: 1 << i for i, f in enumerate(filters)}
    steps = [(o, k + 1, sum(bit[f] for f in o[:k]), bit[f]) for o in orders for k, f in enumerate(o)]
    path = states.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, bit int")
    flags = [c for c in states.columns if c not in ("part", "mask", "n")]
    # the path table's size depends on the number of filters alone
    return edges(states, filters).join(F.broadcast(path), ["before", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[f"{c}_lost" for c in flags], "shapley"
    )
