"""Operator 1: URL filter by rules and, where no rule fits, boosted trees.

A rule is a host and a path prefix; the longest that fits decides.  URLs that
a rule decides are the labelled ones: gradient-boosted trees learn from their
lexical features (lengths, depth, digit ratio, entropy, parameter counts and
the block rates of host and path suffixes) and judge all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentflow.session import materialise

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffix statistics: of what their keys are made, each as a column over host and path.
SUFFIXES = {
    "host_1": "substring_index(_host, '.', -1)",
    "host_2": "substring_index(_host, '.', -2)",
    "path_start": "split_part(_path, '/', 2)",
    "path_end": r"regexp_extract(_path, '\\.([^./]{1,8})$', 1)",
}
#: Parts into which hosts are dealt for the training rows' rates.
FOLDS = 5
FEATURES = [
    "url_len", "host_len", "path_len", "query_len", "depth", "host_labels", "digit_ratio", "entropy", "params", "hyphens", "escapes",
    "has_fragment", "has_www", "mean_segment", *[f"rate_{s}" for s in SUFFIXES],
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule (``host/path``) that fits, as a struct of rule and
    verdict; null if none does.  A rule fits its host and all subdomains where
    the path starts with the rule's."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # the last branch tried first is the longest; equal rules: the first given
    for rule, verdict in sorted(dict(reversed(rules)).items(), key=lambda r: (len(r[0]), r[0])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    chars = F.split(text, "")
    bits = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda total, c: total + F.size(F.filter(chars, lambda x: x == c)) * F.log2(F.size(F.filter(chars, lambda x: x == c)).cast("double")),
    )
    return F.when(F.length(text) > 0, F.log2(F.length(text).cast("double")) - bits / F.length(text)).otherwise(0.0)


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of ``_url``, ``_host`` and ``_path``, and the suffix keys."""
    url = F.coalesce("_url", F.lit(""))
    count = lambda pattern, c=url: F.regexp_count(c, F.lit(pattern))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    made = {
        "url_len": F.length(url),
        "host_len": F.length("_host"),
        "path_len": F.length("_path"),
        "query_len": F.length(query),
        "depth": count("/", F.col("_path")),
        "host_labels": count(r"[^.]+", F.col("_host")),
        "digit_ratio": count("[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "params": count("=", query),
        "hyphens": count("[-_]"),
        "escapes": count("%"),
        "has_fragment": F.contains(url, F.lit("#")),
        "has_www": F.startswith("_host", F.lit("www.")),
        "mean_segment": F.length("_path") / F.greatest(count("/", F.col("_path")), F.lit(1)),
    }
    return df.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in made.items()} | {f"key_{s}": F.expr(e) for s, e in SUFFIXES.items()})


def suffix_sums(labelled: DataFrame, suffix: str, fold: bool) -> DataFrame:
    """Blocked and all labelled URLs of each suffix (and fold)."""
    by = [F.expr(SUFFIXES[suffix]).alias(f"key_{suffix}"), *([F.col("fold")] if fold else [])]
    name = "own" if fold else "all"
    return labelled.groupBy(*by).agg(F.sum("label").alias(f"{name}_blocked"), F.count("*").alias(f"{name}_n"))


def with_rates(df: DataFrame, sums: dict[str, DataFrame], prior: float, smooth: float, own: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds each suffix's smoothed block rate; unseen suffixes have the prior.
    With ``own`` (the sums by suffix and fold; rows need a ``fold``) a row's
    rate leaves out all URLs of its fold, whole hosts with its own among them,
    so that it does not repeat the row's label.  The tables grow with the
    labelled URLs: Spark chooses how to join them."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    for s, table in sums.items():
        df = df.join(table, f"key_{s}", "left")
        blocked, n, drop = zero("all_blocked"), zero("all_n"), ["all_blocked", "all_n"]
        if own is not None:
            df = df.join(own[s], [f"key_{s}", "fold"], "left")
            blocked, n, drop = blocked - zero("own_blocked"), n - zero("own_n"), [*drop, "own_blocked", "own_n"]
        df = df.withColumn(f"rate_{s}", (blocked + smooth * prior) / (n + smooth)).drop(*drop)
    return df


def judge(
    df: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", most_rows: int = 20_000, trees: int = 20, depth: int = 4, smooth: float = 10.0
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` for every row.

    ``rules`` are (``host/path``, verdict) pairs, written by hand: they become
    part of the plan.  At most about ``most_rows`` labelled URLs, chosen by a
    hash of the URL, train the trees (a URL that repeats counts once).  The
    suffixes' block rates are those of all labelled URLs; for a training row
    those of other hosts' (hosts are dealt to ``FOLDS`` folds by a hash, and a
    row's own fold is left out), as they are for a URL of a new host.
    ``block_score`` is the trees' probability of ``block``, null where a rule
    decides.  Without labelled URLs of both verdicts, what no rule decides gets
    the one verdict that there is, or ``allow``.  A null URL, or one without
    ``://``, has an empty host and path; repeated rows and null ids give a row
    each, an empty table none; other columns are ignored.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"))
    rows = rows.withColumn("_rule", longest_rule(rules, F.col("_host"), F.col("_path")))
    labelled = rows.where("_rule IS NOT NULL").select("_url", "_host", "_path", F.pmod(F.xxhash64("_host"), F.lit(FOLDS)).alias("fold"), (F.col("_rule.verdict") == BLOCK).cast("double").alias("label")).distinct()
    labelled = materialise(labelled, "urls")
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    result = [F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule")]
    if not 0 < blocked < n:
        only = BLOCK if n and blocked == n else ALLOW
        return rows.select(*result, F.coalesce("_rule.verdict", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    share = min(1.0, most_rows / n)
    sample = materialise(lexical(labelled.where(F.pmod(F.xxhash64("_url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))), "url-sample")
    prior = blocked / n
    sums = {x: materialise(suffix_sums(labelled, x, False), "url-suffixes") for x in SUFFIXES}
    own = {x: materialise(suffix_sums(labelled, x, True), "url-fold-suffixes") for x in SUFFIXES}
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees_of = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, featuresCol="features", labelCol="label")
    model = trees_of.fit(assemble.transform(with_rates(sample, sums, prior, smooth, own)).select("features", "label"))
    judged = model.transform(assemble.transform(with_rates(lexical(rows), sums, prior, smooth)))
    score = vector_to_array("probability")[1]
    return judged.select(
        *result,
        F.coalesce("_rule.verdict", F.when(score >= 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.when(F.col("_rule").isNull(), score).alias("block_score"),
    )
