"""Operator 2: n-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles; equal sets are one class from the
start.  Each set is embedded as a signature whose tokens are (coordinate,
minhash) pairs.  A run starts at a root that holds all sets; a node chooses
coordinates by a hash of its path and hands every set on to the child named
by the set's token there, so only sets that share the sampled tokens meet.
Buckets are split until they are small, then compared by brute force, and the
run is repeated until the target recall.  What a bucket finds similar is
joined into candidate groups; within these every pair is verified on the
exact shingle sets, in blocks, and links are counted and joined into classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import Words, mix
from incidentflow.llm.components import components
from incidentflow.session import materialise, releasing

SIGNATURE = 64
_RANDOM = np.random.default_rng(77_003)
_XOR = _RANDOM.integers(1, 2**63, size=SIGNATURE, dtype=np.uint64)
_TIMES = _RANDOM.integers(1, 2**63, size=SIGNATURE, dtype=np.uint64) | np.uint64(1)
#: Buckets of up to so many sets are compared as they are; larger ones are
#: split, and past the last level dealt out in pairs of blocks.
SMALL, DEPTH = 1024, 4
#: Runs after which what has met is joined: later runs only compare buckets
#: that still hold sets of different groups.
FIRST_RUNS = 3
#: Candidate groups of up to so many sets are verified as one comparison.
WHOLE = 256


def survival(similarity: float, depth: int) -> float:
    """The chance that a pair at ``similarity`` still shares a bucket after so
    many levels: a node chooses 1 / similarity tokens on average (see
    :func:`_children`), each of which the pair shares with that probability."""
    least = int(1 / similarity)
    more = 1 / similarity - least
    q = 1.0
    for _ in range(depth):
        miss = 1 - similarity * q
        q = 1 - (1 - more) * miss**least - more * miss ** (least + 1)
    return q


def runs_for(recall: float, similarity: float) -> int:
    """Runs after which a pair at the threshold has met with probability
    ``recall``; never fewer than if one token were shared on average (Poisson)
    in three levels, which leaves room for what a finite signature varies."""
    p = 1.0
    for _ in range(3):
        p = 1 - exp(-p)
    p = min(p, survival(similarity, DEPTH))
    return ceil(log(1 - recall) / log(1 - p))


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, one after the other and sorted,
    and where each text's begin.  A text of fewer than ``k`` words, but not
    none, has one shingle of all its words."""
    grams, whole = words.grams(k)
    value, doc = grams[whole], words.doc[whole]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        first = words.first[short]
        own = np.zeros(len(short), dtype=np.uint64)
        for n in range(1, k):
            at = words.count[short] == n
            own[at] = words.grams(n)[0][first[at]] + np.uint64(n)
        value, doc = np.concatenate([value, own]), np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    once = np.ones(len(value), dtype=bool)
    once[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[once], doc[once]
    return value, np.searchsorted(doc, np.arange(words.n_docs + 1))


_SALT = (np.uint64(0), np.uint64(0x5DEECE66D1234567))


def fingerprint(value: np.ndarray, first: np.ndarray, which: int) -> np.ndarray:
    """64 bits that do not depend on order; two of them stand for a set."""
    out = np.zeros(len(first) - 1, dtype=np.int64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        with np.errstate(over="ignore"):
            out[full] = np.add.reduceat(mix(value ^ _SALT[which]), first[full]).view(np.int64)
    return out


def describe(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every set: its size, two 64-bit fingerprints and the signature."""
    size = np.diff(first)
    sig = np.zeros((len(size), SIGNATURE), dtype=np.int32)
    full = np.flatnonzero(size)
    if len(full):
        at = first[full]
        with np.errstate(over="ignore"):
            for i in range(SIGNATURE):
                least = np.minimum.reduceat((value ^ _XOR[i]) * _TIMES[i], at)
                sig[full, i] = (mix(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return size, fingerprint(value, first, 0), fingerprint(value, first, 1), sig


def _describer(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 22):
            size, fp1, fp2, sig = describe(*shingle_sets(Words(part.column(1)), k))
            flat = pa.array(sig.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * SIGNATURE), flat)
            arrays = [part.column(0), part.column(2), pa.array(size.astype(np.int64)), pa.array(fp1), pa.array(fp2), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=[common.ID, "digest", "n", "fp1", "fp2", "sig"])

    return run


def _child(path: Column, coordinate: Column) -> Column:
    """The path of the child that a set goes to: its token at the coordinate."""
    return F.xxhash64(path, coordinate, F.element_at("sig", coordinate.cast("int") + 1))


def _children(path: Column, similarity: float) -> Column:
    """The children of a node that a set goes to: 1 / similarity coordinates on
    average, chosen by hashes of the path (the last one as often as the
    fraction says)."""
    least = int(1 / similarity)
    more = round((1 / similarity - least) * 10_000)
    chosen = [F.pmod(F.xxhash64(path, F.lit(i + 1)), F.lit(SIGNATURE)) for i in range(least)]
    always = F.array_distinct(F.array(*chosen))
    if more:
        last = F.pmod(F.xxhash64(path, F.lit(-1)), F.lit(SIGNATURE))
        both = F.array_distinct(F.array(*chosen, last))
        always = F.when(F.pmod(F.xxhash64(path, F.lit(0)), F.lit(10_000)) < more, both).otherwise(always)
    return F.transform(always, lambda c: _child(path, c))


def _with_keys(rows: DataFrame, whole: int, blocks: Column) -> DataFrame:
    """Rows of ``path`` and ``size`` with ``keys``, the comparisons they take
    part in and their block there: one for a group of up to ``whole`` rows, or
    for a larger one each pair of its ``blocks`` that holds the row's own."""
    rows = rows.withColumn("_n", F.when(F.col("size") <= whole, 1).otherwise(F.ceil(blocks)).cast("int"))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("id", F.lit(9)), F.col("_n")).cast("int"))
    keys = F.expr("transform(sequence(0, _n - 1), j -> struct(xxhash64(path, least(j, _b), greatest(j, _b)) AS key, _b AS block))")
    return rows.withColumn("keys", keys).drop("_n", "_b", "size", "path")


def _local_classes(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id each row is connected to, by a matrix of what is near."""
    label = ids.copy()
    big = np.int64(2**63 - 1)
    while True:
        new = np.minimum(label, np.where(near, label[None, :], big).min(axis=1))
        if (new == label).all():
            return label
        label = new


def _bucket_edges(least_equal: int):
    """Of the groups that meet in a bucket, those with sets whose signatures
    agree enough, as edges to the smallest group they are connected to there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.whole_groups(batches, "key"):
            key = table.column("key").to_numpy()
            groups = table.column("group").to_numpy()
            sig = np.asarray(table.column("sig").combine_chunks().flatten(), dtype=np.int32).reshape(-1, SIGNATURE)
            cuts = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key)).tolist()
            found = [np.zeros((0, 2), np.int64)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                own, group = sig[i:j], groups[i:j]
                if j - i == 2:
                    if group[0] != group[1] and (own[0] == own[1]).sum() >= least_equal:
                        found.append(group[None, :].copy())
                elif j - i > 2:
                    equal = np.zeros((j - i, j - i), dtype=np.int16)
                    for c in range(SIGNATURE):
                        equal += own[:, c][:, None] == own[:, c]
                    label = _local_classes((equal >= least_equal) | (group[:, None] == group), group)
                    found.append(np.unique(np.stack([group, label], axis=1)[label != group], axis=0))
            edges = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["a", "b"])

    return run


def _met(sets: DataFrame, runs: range, least_equal: int, similarity: float) -> DataFrame:
    """Edges between groups whose sets (``id, group, sig``) meet in a bucket of
    some of the runs and whose signatures agree."""
    roots = F.array(*[F.lit(r).cast("long") for r in runs])
    # the root of each run holds all sets
    no_parent = F.lit(2**62).alias("parent")
    rows = sets.select("id", "group", "sig", F.explode(roots).alias("path")).select("id", "group", no_parent, F.explode(_children(F.col("path"), similarity)).alias("path"))
    found = None
    for level in range(1, DEPTH + 1):
        # a bucket of a single group has nothing to compare
        sizes = rows.groupBy("path").agg(F.count("*").alias("size"), F.min("group").alias("_a"), F.max("group").alias("_b")).where("_a < _b").drop("_a", "_b")
        met = materialise(rows.join(sizes, "path"), "paths")
        # a bucket that keeps half of its parent is one of similar sets: to split it on would only repeat it
        final = F.lit(level == DEPTH) | (F.col("size") <= SMALL) | (2 * F.col("size") >= F.col("parent"))
        dealt = _with_keys(met.where(final), SMALL, F.col("size") / (SMALL // 2)).select("id", "group", F.explode("keys.key").alias("key")).join(sets.select("id", "sig"), "id")
        dealt = dealt.select("key", "group", "sig").repartition("key").sortWithinPartitions("key")
        edges = common.per_task(dealt, _bucket_edges(least_equal), "a long, b long")
        found = edges if found is None else found.unionAll(edges)
        rest = met.where(~final)
        if level == DEPTH or rest.isEmpty():
            break
        rows = rest.join(sets.select("id", "sig"), "id").select("id", "group", F.col("size").alias("parent"), F.explode(_children(F.col("path"), similarity)).alias("path"))
    return found


def candidate_groups(sets: DataFrame, recall: float, similarity: float) -> DataFrame:
    """``node, component``: sets that chains of agreeing signatures (up to four
    standard deviations below the threshold) connect, of those that met."""
    least_equal = int(SIGNATURE * similarity - 4 * (SIGNATURE * similarity * (1 - similarity)) ** 0.5)
    runs = runs_for(recall, similarity)
    first = components(_met(sets.withColumn("group", F.col("id")), range(min(FIRST_RUNS, runs)), least_equal, similarity))
    joined = sets.join(first, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("group"), "sig")
    later = _met(materialise(joined, "joined-sets"), range(FIRST_RUNS, runs), least_equal, similarity)
    return components(later.unionAll(first.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _exact(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Verifies all pairs of a comparison on their shingle sets: for each set
    how many others it links to, and the smallest id it is connected to.  In a
    pair of different blocks only pairs across count, so none counts twice."""
    for table in common.whole_groups(batches, "key"):
        key = table.column("key").to_numpy()
        cuts = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key)).tolist()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, j in zip(cuts[:-1], cuts[1:]):
            part = table.slice(i, j - i).combine_chunks()
            ids, pick = np.unique(part.column("id").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            block = part.column("block").to_numpy()[pick]
            lists = part.column("shingles").chunk(0)
            offset = lists.offsets.to_numpy()
            size = (offset[1:] - offset[:-1])[pick]
            values = lists.values.to_numpy()
            token = np.concatenate([values[offset[p] : offset[p + 1]] for p in pick])
            owner = np.repeat(np.arange(len(ids)), size)
            # tokens of a single set add to no intersection
            _, token, times = np.unique(token, return_inverse=True, return_counts=True)
            shared = times[token] > 1
            token, owner = token[shared], owner[shared]
            _, token = np.unique(token, return_inverse=True)
            common_count = np.zeros((len(ids), len(ids)), dtype=np.float32)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            for t in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
                a, b = np.searchsorted(token, [t, t + 4096])
                x = np.zeros((len(ids), 4096), dtype=np.float32)
                x[owner[a:b], token[a:b] - t] = 1
                common_count += x @ x.T
            both = size[:, None] + size[None, :] - common_count
            linked = common_count >= similarity * both - 1e-6 * both
            np.fill_diagonal(linked, False)
            if (block != block[0]).any():
                linked &= block[:, None] != block[None, :]
            n = linked.sum(axis=1)
            label = _local_classes(linked, ids)
            out.append((ids[n > 0], n[n > 0], label[n > 0]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)) for k in range(3)], names=["id", "links", "root"])


def _shingles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, common.TEXT, 1 << 21):
            value, first = shingle_sets(Words(part.column(1)), k)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(value.view(np.int64)))
            # of rows that share the id, only those with the set that is meant
            same = fingerprint(value, first, 0) == part.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(3), lists], names=["id", "keys", "shingles"]).filter(pa.array(same))

    return run


def links(docs: DataFrame, sets: DataFrame, groups: DataFrame, similarity: float, k: int) -> DataFrame:
    """``id, links, root`` of every comparison in which a set has a link."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("size")).where("size > 1")
    rows = groups.join(sizes, "component").select(F.col("node").alias("id"), F.col("component").alias("path"), "size")
    rows = _with_keys(rows, WHOLE, F.col("size") / F.greatest(F.lit(64), F.least(F.lit(256), F.col("size") / 32)))
    rows = rows.join(sets.select("id", "first", "fp1"), "id")
    texts = docs.join(rows, docs[common.ID] == rows["first"]).select("id", common.TEXT, "fp1", "keys")
    kept = common.per_task(texts, _shingles(k), "id long, keys array<struct<key:long,block:int>>, shingles array<long>")
    kept = kept.select("id", F.explode("keys").alias("at"), "shingles").select("at.key", "at.block", "id", "shingles")
    return common.per_task(
        kept.repartition("key").sortWithinPartitions("key"), lambda batches: _exact(batches, similarity), "id long, links long, root long"
    )


def _classified(df: DataFrame, similarity: float, k: int, recall: float, id_col: str, text_col: str) -> DataFrame:
    """For every row its ``doc_id``, the ``digest`` of its text, the size ``n``
    and fingerprints of its shingle set, the set's ``first`` document,
    ``links`` and ``copies``, the class's first document ``class_first`` and
    whether the set ``stands`` for its class (has that document; of several the
    one with the smallest number).

    Sets are numbered when they are written, so that an id with several texts
    lends its number to none of them."""
    docs = common.texts(df, id_col, text_col)
    docs = docs.select(F.col(common.ID).cast("long").alias(common.ID), common.TEXT, F.xxhash64(common.TEXT).alias("digest"))
    # sets, buckets and edges go once every row has its class
    with releasing(df.sparkSession) as scratch:
        own = materialise(common.per_task(docs, _describer(k), f"{common.ID} long, digest long, n long, fp1 long, fp2 long, sig array<int>"), "sets")
        usable = own.where("doc_id IS NOT NULL AND n > 0")
        # min(sig) is any signature of the set: they are equal
        sets = usable.groupBy("fp1", "fp2", "n").agg(F.min(common.ID).alias("first"), F.count_distinct(common.ID).alias("copies"), F.min("sig").alias("sig"))
        sets = materialise(sets.withColumn("id", F.monotonically_increasing_id()), "distinct-sets")
        groups = candidate_groups(sets, recall, similarity)
        found = materialise(links(docs.where("doc_id IS NOT NULL"), sets, groups, similarity, k), "links")
        total = found.groupBy("id").agg(F.sum("links").alias("links"))
        classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
        members = classes.join(sets.select(F.col("id").alias("node"), "first"), "node")
        heads = members.groupBy("component").agg(F.min(F.struct("first", "node")).alias("head"))
        classes = classes.join(heads, "component").select("node", "head")
        known = sets.select("fp1", "fp2", "n", "id", "first", "copies").join(total, "id", "left").join(classes, F.col("id") == F.col("node"), "left")
        known = known.select(
            "fp1", "fp2", "n", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("head.first", "first").alias("class_first"), (F.coalesce("head.node", "id") == F.col("id")).alias("stands"),
        )
        rows = own.select(common.ID, "digest", "n", "fp1", "fp2").join(known, ["fp1", "fp2", "n"], "left")
        return scratch.keep(materialise(rows, "classified"))


def ngram_join(
    df: DataFrame, similarity: float = 0.8, k: int = 5, recall: float = 0.999, id_col: str = common.ID, text_col: str = common.TEXT
) -> DataFrame:
    """``doc_id, class_id, links, copies`` for every row of ``df``.

    Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing
    A-Z; a text of fewer than ``k`` words is one shingle.  ``class_id`` is the
    smallest id of the documents that chains of links (similarity at or above
    the threshold) connect; ``links`` counts the different shingle sets a
    document is linked to, ``copies`` the documents that share its own set
    (itself included).  A null or wordless text links to nothing and is its own
    class; a row without id has class null, 0 links and 0 copies; repeated rows
    give a row each and count as one document; rows of one id with different
    texts are documents of their own; an empty table gives none; other columns
    of ``df`` are ignored.
    """
    rows = _classified(df, similarity, k, recall, id_col, text_col)
    has_id = F.col(common.ID).isNotNull()
    return rows.select(
        common.ID,
        F.when(has_id, F.coalesce("class_first", common.ID)).alias("class_id"),
        F.when(has_id, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("links"),
        F.when(has_id, F.coalesce("copies", F.lit(1))).otherwise(0).cast("long").alias("copies"),
    )


def one_of_each(df: DataFrame, similarity: float = 0.8, k: int = 5, recall: float = 0.999, id_col: str = common.ID, text_col: str = common.TEXT) -> DataFrame:
    """The rows of ``df``, all columns, whose document is the first of its
    class: the smallest id, and of one id's texts in a class one.  Of repeated
    rows one stays; rows without id stay; a wordless text is its own class.
    Rows of one id with texts of different classes stay for each.  Columns may
    have any names."""
    rows = _classified(df, similarity, k, recall, id_col, text_col).where("doc_id IS NOT NULL")
    alone = rows.where("n = 0").select(common.ID, "digest")
    heads = rows.where(F.col("stands") & (F.col(common.ID) == F.col("first"))).groupBy(common.ID, "fp1", "fp2", "n").agg(F.min("digest").alias("digest"))
    name = "_" * (1 + max(len(c) for c in df.columns))
    first = alone.unionAll(heads.select(common.ID, "digest")).distinct().toDF(f"{name}id", f"{name}digest")
    keyed = df.withColumns({f"{name}i": F.col(f"`{id_col}`").cast("long"), f"{name}d": F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))})
    kept = keyed.join(first, (F.col(f"{name}i") == F.col(f"{name}id")) & (F.col(f"{name}d") == F.col(f"{name}digest")), "left_semi")
    kept = kept.dropDuplicates([f"{name}i", f"{name}d"]).drop(f"{name}i", f"{name}d")
    return kept.unionByName(df.where(F.col(f"`{id_col}`").isNull()))
