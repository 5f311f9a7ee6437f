import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incidentflow.llm import importance
from incidentflow.llm.common import Words
from tests.llm.fixtures import SCHEMA, WORD, documents, lower, prose


def _features(text, longest=2):
    w = WORD.findall(lower(text))
    runs = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(w)


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, x, _ in rows:
        s.update(_features(x)[0])
    for _, x in target:
        t.update(_features(x)[0])
    a, b = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (a + 10_000) / ((s[k] + 1) * (b + 10_000)))) for k in range(10_000)]
    out = []
    for i, x, _ in rows:
        f, n = _features(x)
        weight = sum(gain[k] for k in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n >= 20])
    ranked = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(ranked[: 25 * len(ranked) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


TARGET = [(1, prose(3, 80)), (2, None), (3, ""), (4, "zx " * 30)]


@pytest.mark.parametrize("sizes", [{}, {"segment_rows": 7, "samples": 4}, {"segment_rows": 1, "most_segments": 5}])
def test_resample_equals_brute_force(spark, sizes):
    rows = documents() + [(100 + i, prose(i % 30, 15 + i % 40), 0) for i in range(150)] + [(99, prose(8, 40), 0)] * 80
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit(1), "score": F.lit("x"), "_pos": F.lit(0), "weight": F.lit(0)})
    got = importance.resample(df.repartition(5), spark.createDataFrame(TARGET, "item_id long, text string"), **sizes)
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str) == brute(rows, TARGET)


def test_checksums_of_runs():
    pick = random.Random(1)
    texts = ["".join(pick.choice("ab 1Zé中\n-") for _ in range(pick.randrange(400))) for _ in range(60)]
    texts += ["x" * 63 + " " + "y" * 64 + " " + "z" * 65 + " " + "w" * 5000 + " v", "", "one"]
    words = Words(pa.array(texts))
    got = Counter()
    for bucket, whole in importance.features(words, 3, 2**32):
        got.update(bucket[whole].tolist())
    want = Counter()
    for t in texts:
        w = WORD.findall(lower(t))
        want.update(zlib.crc32(" ".join(w[i : i + k]).encode()) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert got == want


def test_equal_rows_spread_over_segments(spark):
    """A third of the rows agree in score and id: they still lie in many segments."""
    rows = [(5, 1, 0, 100)] * 300 + [(i, 1, 0, i % 50 * 7) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long").repartition(6)
    out = importance.draw(df, F.lit(True), 100, segment_rows=50)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 901))
    order = sorted(rows, key=lambda r: (-r[3], r[0]))
    assert [(r.score, r.doc_id) for r in out.orderBy("rank").collect()] == [(r[3], r[0]) for r in order]
    keys = sorted(importance._after(r[3], r[0], r[1], k) for k, r in enumerate(rows))
    splitters = [keys[900 * k // 18] for k in range(1, 18)]
    table = sorted(((*r, k) for k, r in enumerate(rows)), key=lambda r: importance._after(r[3], r[0], r[1], r[4]))
    batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in table]) for c in (3, 0, 1, 4)], names=importance._KEY)
    assert np.bincount(importance._cut(batch, splitters)).max() <= 51


def test_nothing_to_draw(spark):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    assert importance.resample(spark.createDataFrame([], SCHEMA), target).count() == 0
    out = importance.resample(spark.createDataFrame([(1, "few words", 0), (2, None, 0)], SCHEMA), target.limit(0)).collect()
    assert {(r.doc_id, r.n_features, r["rank"]) for r in out} == {(1, 3, None), (2, 0, None)}
