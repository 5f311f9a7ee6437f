"""Exact, repeatable splits and samples driven by ``md5(seed:key)``.

The order of rows inside a stratum is the md5 of ``'<seed>:<key>'`` (ties,
i.e. repeated keys, broken by the key), so every engine that has md5 gets the
same split.  Ranks inside a stratum are computed without putting a whole
stratum into one task: a stratum is cut into sub-buckets by the first hex
digits of the hash; because hex order is hash order, rank = rows of the
earlier sub-buckets + rank inside the sub-bucket.  A stratum holding a third
of the data is thus spread over many tasks, and the per-bucket counts are
small aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentflow.session import bounded_collect

SUB_DIGITS = 4
ROWS_PER_BUCKET = 1_000_000
MAX_LITERAL_GROUPS = 100_000
MAX_LITERAL_RARE = 10_000
SPLIT_NAMES = ("train", "val", "test")


def hash_order(key: str | Column, seed: int = 42) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit("None"))))


def _text(c: str) -> Column:
    """A value as text, a missing one as ``None`` (never NULL, so strata and
    fold groups always join)."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def _raw_stratum(df: DataFrame, strata_cols: list[str], label: str) -> Column:
    return F.concat_ws("__", *[_text(c) for c in strata_cols], _text(label))


def _rare(label: str) -> Column:
    return F.concat(F.lit("rare__"), _text(label))


def build_strata(df: DataFrame, strata_cols: list[str], label: str, min_count: int = 3, out: str = "stratum") -> DataFrame:
    """``<key>__<label>``; strata with fewer than ``min_count`` rows merge into
    ``rare__<label>``.  A missing key is a stratum of its own (``None``).
    The counts come from an aggregate joined back (partial aggregation, no
    window holding a whole stratum)."""
    with_raw = df.withColumn("__raw", _raw_stratum(df, strata_cols, label))
    counts = with_raw.groupBy("__raw").agg(F.count(F.lit(1)).alias("__n"))
    joined = with_raw.join(counts, "__raw")
    stratum = F.when(F.col("__n") < min_count, _rare(label)).otherwise(F.col("__raw"))
    return joined.withColumn(out, stratum).drop("__raw", "__n")


def _digits_for(n: int, rows_per_bucket: int) -> int:
    d, cap = 0, rows_per_bucket
    while n > cap and d < 8:
        d, cap = d + 1, cap * 16
    return d


def _digits_column(sizes: dict, group: str, rows_per_bucket: int) -> Column:
    digits = {g: _digits_for(n, rows_per_bucket) for g, n in sizes.items()}
    digits = {g: d for g, d in digits.items() if d}
    if not digits:
        return F.lit(0)
    lookup = F.create_map(*[F.lit(x) for kv in digits.items() for x in kv])
    return F.coalesce(F.element_at(lookup, F.col(group)), F.lit(0))


def _sub_digits(df: DataFrame, group: str, rows_per_bucket: int, max_groups: int) -> Column:
    """Hex digits of the sub-bucket per group: enough that a sub-bucket holds
    about ``rows_per_bucket`` rows.  The group sizes are one small aggregate,
    read to the driver only when there are at most ``max_groups`` groups
    (checked); otherwise every group gets ``SUB_DIGITS``."""
    sizes = bounded_collect(df.groupBy(group).agg(F.count(F.lit(1)).alias("n")), max_groups)
    if sizes is None:
        return F.lit(SUB_DIGITS)
    return _digits_column({r[group]: r["n"] for r in sizes}, group, rows_per_bucket)


def rank_by_hash(
    df: DataFrame,
    group: str,
    key: str,
    seed: int = 42,
    sub_digits: int | Column | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_groups: int = MAX_LITERAL_GROUPS,
) -> DataFrame:
    """Add ``__rank`` (1-based, by hash then key) and ``__size`` per ``group``.

    Rows are keyed by (group, first hex digits of the hash); a group gets
    as many digits as keep its sub-buckets near ``rows_per_bucket`` rows.
    The per-key counts are a small aggregate (partial aggregation map-side);
    a window over them gives each sub-bucket its offset and the group size.
    The rows then meet that table in one join on (group, sub-bucket) and are
    ranked by a window partitioned the same way, so no exchange is keyed by
    the group alone and a stratum holding a third of the rows is spread over
    many tasks.
    """
    if isinstance(sub_digits, Column):
        digits = sub_digits
    elif sub_digits is not None:
        digits = F.lit(sub_digits)
    else:
        digits = _sub_digits(df, group, rows_per_bucket, max_groups)
    h = df.withColumns({"__h": hash_order(key, seed), "__d": digits})
    h = h.withColumn("__sub", F.expr("substring(__h, 1, __d)")).drop("__d")
    per_sub = h.groupBy(group, "__sub").agg(F.count(F.lit(1)).alias("__subn"))
    before = Window.partitionBy(group).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = per_sub.select(
        group,
        "__sub",
        F.coalesce(F.sum("__subn").over(before), F.lit(0)).alias("__offset"),
        F.sum("__subn").over(whole).alias("__size"),
    )
    w_row = Window.partitionBy(group, "__sub").orderBy("__h", key)
    return (
        h.join(offsets, [group, "__sub"])
        .withColumn("__rank", F.col("__offset") + F.row_number().over(w_row))
        .drop("__h", "__sub", "__offset")
    )


def _round_share(n: Column, percent: int) -> Column:
    """round(percent/100 * n), halves up, in exact integer arithmetic."""
    # (p*n + 50) / 100 is never within 0.01 of the next integer, so floor of
    # the double quotient is the exact integer result
    return F.floor((n * F.lit(percent) + F.lit(50)) / F.lit(100)).cast("long")


def assign_split(
    df: DataFrame,
    group: str,
    key: str,
    seed: int = 42,
    percents: tuple[int, int, int] = (70, 15, 15),
    out: str = "split",
    sub_digits: int | Column | None = None,
) -> DataFrame:
    if sum(percents) != 100:
        raise ValueError("percents must add to 100")
    ranked = rank_by_hash(df, group, key, seed, sub_digits)
    n = F.col("__size")
    train_end = _round_share(n, percents[0])
    val_end = _round_share(n, percents[0] + percents[1])
    split = F.when(F.col("__rank") <= train_end, SPLIT_NAMES[0]).when(F.col("__rank") <= val_end, SPLIT_NAMES[1]).otherwise(SPLIT_NAMES[2])
    return ranked.withColumn(out, split).drop("__rank", "__size")


def stratified_split(
    df: DataFrame,
    key: str,
    strata_cols: list[str],
    label: str,
    seed: int = 42,
    percents: tuple[int, int, int] = (70, 15, 15),
    min_count: int = 3,
    out: str = "split",
) -> DataFrame:
    """Row-level stratified train/val/test split in one pass.

    Inside each stratum rows are ordered by ``md5(seed:key)``: the first
    ``round(0.70 n)`` go to train, up to ``round(0.85 n)`` to val, the rest
    to test.  ``key`` should identify a row.
    """
    with_raw = df.withColumn("__raw", _raw_stratum(df, strata_cols, label))
    counts = bounded_collect(
        with_raw.groupBy("__raw").agg(F.count(F.lit(1)).alias("n"), F.max(_text(label)).alias("y")),
        MAX_LITERAL_GROUPS,
    )
    rare = [r["__raw"] for r in counts if r["n"] < min_count] if counts is not None else []
    if counts is None or len(rare) > MAX_LITERAL_RARE:  # too many for a literal: join the counts back
        strata = build_strata(df, strata_cols, label, min_count, out="stratum")
        return assign_split(strata, "stratum", key, seed, percents, out).drop("stratum")
    # one small aggregate gives both the rare strata and every stratum's size
    sizes: dict[str, int] = {}
    for r in counts:
        name = f"rare__{r['y']}" if r["n"] < min_count else r["__raw"]
        sizes[name] = sizes.get(name, 0) + r["n"]
    stratum = F.when(F.col("__raw").isin(rare), _rare(label)).otherwise(F.col("__raw")) if rare else F.col("__raw")
    strata = with_raw.withColumn("stratum", stratum).drop("__raw")
    digits = _digits_column(sizes, "stratum", ROWS_PER_BUCKET)
    return assign_split(strata, "stratum", key, seed, percents, out, digits).drop("stratum")


def group_split(
    df: DataFrame,
    group_key: str,
    strata_cols: list[str],
    label: str,
    seed: int = 42,
    percents: tuple[int, int, int] = (70, 15, 15),
    min_count: int = 3,
    out: str = "split",
) -> DataFrame:
    """Split whole groups (e.g. accidents), never their rows: every row of a
    group lands in the same part.  Strata and label of a group are its
    minimum / maximum over the group's rows (constant for group attributes).
    The group table is one aggregate; the split joins back on the key."""
    groups = df.groupBy(group_key).agg(
        *[F.min(c).alias(c) for c in strata_cols], F.max(F.col(label)).alias(label)
    )
    split = stratified_split(groups, group_key, strata_cols, label, seed, percents, min_count, out)
    s = split.select(F.col(group_key).alias("__gk"), out)
    # null-safe: rows without a group key form one group and are kept
    return df.join(s, df[group_key].eqNullSafe(s["__gk"])).drop("__gk")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Fixed-size repeatable sample: the ``n`` rows of smallest hash.  A
    top-k (``TakeOrderedAndProject``): each task keeps only its best ``n``."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled stratified k folds: inside each label, rows in hash order are
    dealt round-robin, so fold sizes per label differ by at most one."""
    ranked = rank_by_hash(df.withColumn("__label_group", _text(label)), "__label_group", key, seed)
    return ranked.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank", "__size", "__label_group")


def group_folds(df: DataFrame, group_key: str, label: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds of whole groups: every row of a group shares a fold
    (a group's label is its maximum)."""
    groups = df.groupBy(group_key).agg(F.max(F.col(label)).alias(label))
    folds = stratified_folds(groups, group_key, label, k, seed, out).select(F.col(group_key).alias("__gk"), out)
    return df.join(folds, df[group_key].eqNullSafe(folds["__gk"])).drop("__gk")
