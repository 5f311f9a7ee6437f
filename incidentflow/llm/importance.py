"""Operator 13: importance resampling towards a target distribution.

Every run of one or two words is hashed to a bucket; buckets are counted over
all documents and over all target texts, and a document's weight is the mean
gain of its features.  Words become arrays: the checksum of a run is composed
from its words' registers (a checksum is linear, so the register of the first
part is moved on by the length of the second through tables).

The draw is an exact top share by weight and a Gumbel number of the id, taken by
parallel sorting by regular sampling: every task sorts its rows and writes them
as a run; every g-th row of each run is a sample, evenly spaced samples are the
splitters; the runs' stretches between two splitters meet in one segment and are
merged there, and the prefix sums of the segments' sizes make a place in a
segment an exact rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import Words
from incidentflow.session import materialise

# ------------------------------------------------------- checksums as arrays
_ALL = np.uint32(0xFFFFFFFF)
_SHORT = 64


def _byte_table() -> np.ndarray:
    """The register after one byte, for each low byte of the register."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_STEP = _byte_table()


def _step(register: np.ndarray, byte) -> np.ndarray:
    return _STEP[(register ^ byte) & np.uint32(255)] ^ (register >> np.uint32(8))


def _apply(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A linear map given by its values on each of the four bytes."""
    r = register.astype(np.int64)
    return tables[..., 0, r & 255] ^ tables[..., 1, r >> 8 & 255] ^ tables[..., 2, r >> 16 & 255] ^ tables[..., 3, r >> 24]


def _zero_maps() -> tuple[np.ndarray, np.ndarray]:
    """The register moved on by 0 to 63 zero bytes, and by 64, 128, 256, ...
    of them (up to 2**40)."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    short = [one]
    for _ in range(_SHORT - 1):
        short.append(_step(short[-1], np.uint32(0)))
    power = _step(short[-1], np.uint32(0))
    powers = [power]
    for _ in range(34):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(short), np.stack(powers)


_MOVE, _MOVE_POWERS = _zero_maps()


def _moved(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers moved on by ``n`` zero bytes each."""
    r, low = register.astype(np.int64), n % _SHORT
    out = _MOVE[low, 0, r & 255] ^ _MOVE[low, 1, r >> 8 & 255] ^ _MOVE[low, 2, r >> 16 & 255] ^ _MOVE[low, 3, r >> 24]
    high, k = n // _SHORT, 0
    while high.any():
        odd = np.flatnonzero(high & 1)
        out[odd] = _apply(_MOVE_POWERS[k], out[odd])
        high, k = high >> 1, k + 1
    return out


def _registers(words: Words) -> np.ndarray:
    """Each word's register from zero; long words by themselves."""
    n = words.end - words.start
    out = np.zeros(len(n), dtype=np.uint32)
    at = np.flatnonzero(n <= _SHORT)
    for j in range(_SHORT):
        at = at[n[at] > j]
        if not len(at):
            break
        out[at] = _step(out[at], words.data[words.start[at] + j].astype(np.uint32))
    long = np.flatnonzero(n > _SHORT)
    if len(long):
        whole = np.array([zlib.crc32(words.data[a:b].tobytes()) for a, b in zip(words.start[long].tolist(), words.end[long].tolist())], dtype=np.uint32)
        out[long] = ~whole ^ _moved(np.full(len(long), _ALL), n[long])
    return out


def features(words: Words, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``longest`` words: the bucket of the run that begins at
    each word, and whether it stays inside its text."""
    if not len(words.start):
        return
    own, size = _registers(words), words.end - words.start
    register = _moved(np.full(len(own), _ALL), size) ^ own
    last = words.first[words.doc + 1]
    at = np.arange(len(own))
    yield (~register).astype(np.int64) % buckets, np.ones(len(own), dtype=bool)
    for k in range(1, longest):
        whole = at + k < last
        nxt = np.minimum(at + k, len(own) - 1)
        register = _moved(_step(register, np.uint32(32)), size[nxt]) ^ own[nxt]
        yield (~register).astype(np.int64) % buckets, whole


# ------------------------------------------------------------------- weights
def bucket_counts(df: DataFrame, longest: int = 2, buckets: int = 10_000, text_col: str = common.TEXT) -> np.ndarray:
    """Features of all texts by bucket.  A task sends one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for part in common.slices(batches, common.TEXT, 1 << 22):
            for bucket, whole in features(Words(part.column(0)), longest, buckets):
                seen += np.bincount(bucket[whole], minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "n"])

    found = common.per_task(df.select(F.col(text_col).alias(common.TEXT)).where(F.col(common.TEXT).isNotNull()), run, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Floored, scaled log ratio of the target's and the source's smoothed
    bucket shares."""
    n, s, t = len(source), source.astype(np.float64), target.astype(np.float64)
    return np.floor(scale * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, longest: int = 2, id_col: str = common.ID, text_col: str = common.TEXT) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row (the floored mean
    gain of its features; without any: 0)."""
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for part in common.slices(batches, common.TEXT, 1 << 22):
            words = Words(part.column(1))
            n, total = np.zeros(words.n_docs, dtype=np.int64), np.zeros(words.n_docs, dtype=np.int64)
            for bucket, whole in features(words, longest, len(value)):
                upto = np.concatenate([[0], np.cumsum(np.where(whole, value[bucket], 0))])
                total += upto[words.first[1:]] - upto[words.first[:-1]]
                upto = np.concatenate([[0], np.cumsum(whole)])
                n += upto[words.first[1:]] - upto[words.first[:-1]]
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words.count.astype(np.int64)), pa.array(n), pa.array(weight)],
                names=[common.ID, "n_words", "n_features", "weight"],
            )

    rows = common.texts(df, id_col, text_col)
    kind = rows.schema[common.ID].dataType.simpleString()
    return common.per_task(rows, run, f"{common.ID} {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: int = 7, scale: int = 1000) -> Column:
    """A floored, scaled Gumbel number of the id: the same for the same id and
    seed.  A null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# ------------------------------------------------- sorting by regular sampling
_KEY = ["score", common.ID, "n_features", "_pos"]
_RUN = 33  # a row's _pos is its run's number above this many bits, then its place in the run


def _after(score, doc, n_features, pos) -> tuple:
    """A row's place in the order: higher scores, then smaller ids (null last),
    then fewer features, then the run and the place in it."""
    return (-score, doc is None, 0 if doc is None else doc, n_features, pos)


def _cut(batch: pa.RecordBatch, splitters: list[tuple]) -> np.ndarray:
    """The segment of each row (how many splitters it comes after): a run is
    sorted, so only the splitters that fall into a stretch of one are looked up."""
    run = batch.column("_pos").to_numpy() >> _RUN
    edge = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    out = np.zeros(batch.num_rows, dtype=np.int32)
    columns = [batch.column(c) for c in _KEY]

    def key(i: int) -> tuple:
        return _after(*[c[i].as_py() for c in columns])

    for a, b in zip(edge[:-1], edge[1:]):
        out[a:b] = low = bisect_left(splitters, key(a))
        for s in range(low, bisect_left(splitters, key(b - 1))):
            out[a + bisect_right(range(a, b), splitters[s], key=key) : b] = s + 1
    return out


def draw(
    rows: DataFrame, eligible: Column, percent: int, segment_rows: int = 50_000, most_segments: int = 4096, samples: int = 64
) -> DataFrame:
    """``rows`` (``doc_id, n_features, weight, score`` and others) with ``rank``:
    1, 2, 3... for the ``percent`` of the eligible rows with the highest scores
    (the count rounded down), ties to the smaller id; null for all others.

    Rows that agree in everything are still told apart by their place in a
    run, so a third of all rows with one score and id spreads over segments
    like any others.  A segment has about ``segment_rows`` rows, more only
    beyond ``most_segments`` of them; the driver sees the segments' sizes and
    some ``samples`` keys a segment and one a run.
    """
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col(common.ID).asc_nulls_last(), F.col("n_features")]
    runs = rows.withColumn("_in", F.coalesce(eligible, F.lit(False))).sortWithinPartitions(F.col("_in").desc(), *order)
    runs = materialise(runs.withColumn("_pos", F.monotonically_increasing_id()), "sorted-runs")
    ranked = runs.where("_in")
    n = ranked.count()
    wanted = percent * n // 100
    segments = max(1, min(most_segments, -(-n // segment_rows)))
    splitters = []
    if segments > 1:
        gap = max(1, n // (segments * samples))
        regular = ranked.where((F.col("_pos") % F.lit(1 << _RUN)) % gap == gap // 2).select(*_KEY)
        keys = sorted(_after(*r) for r in regular.collect())
        splitters = [keys[len(keys) * k // segments] for k in range(1, segments)] if keys else []
    shared = spark.sparkContext.broadcast(splitters)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cut(batch, shared.value))], names=[*batch.schema.names, "_segment"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema.fields) + ", _segment int"
    dealt = common.per_task(ranked, cut, schema)
    sizes = {r[0]: r[1] for r in dealt.groupBy("_segment").count().collect()}
    offsets = np.cumsum([0, *(sizes.get(s, 0) for s in range(segments))]).tolist()
    last = sum(1 for o in offsets[:segments] if o < wanted)  # later segments hold no drawn row
    merged = Window.partitionBy("_segment").orderBy(*order, "_pos")
    rank = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_segment") + 1) + F.row_number().over(merged)
    drawn = dealt.where(F.col("_segment") < last).withColumn("rank", rank)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = dealt.where(F.col("_segment") >= last).unionByName(runs.where("NOT _in").withColumn("_segment", F.lit(-1)))
    return drawn.unionByName(rest.withColumn("rank", F.lit(None).cast("long"))).drop("_in", "_pos", "_segment")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    longest: int = 2,
    buckets: int = 10_000,
    seed: int = 7,
    id_col: str = common.ID,
    text_col: str = common.TEXT,
    target_text: str = common.TEXT,
    **sorting,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of
    ``docs``; ``rank`` is null where the row is not drawn.

    A null or empty text has no features, weight 0, and is never drawn (with
    ``least_words`` of 1 or more); a null id scores as empty text and comes last among
    ties; repeated rows are weighed, scored and drawn each.  An empty target
    only has the smoothing; an empty table gives no rows; other columns are ignored.
    """
    gain = gains(bucket_counts(docs, longest, buckets, text_col), bucket_counts(target, longest, buckets, target_text))
    rows = weigh(docs, gain, longest, id_col, text_col)
    rows = rows.withColumn("score", F.col("weight") + gumbel(F.col(common.ID), seed))
    return draw(rows, F.col("n_words") >= least_words, percent, **sorting)
