import itertools
import math
import re

from pyspark.sql import functions as F

from incidentflow.llm import filter_audit
from tests.llm.fixtures import documents, prose


def brute(rows, good, toxic):
    """Every filter applied to every order, row by row."""
    texts = {}
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""] = min(texts.get(t or "", i), i)
    marks = []
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * (i is not None and t in texts and texts[t] < i)
        marks.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {m[0] for m in marks}:
        own = [m for m in marks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[1]]
                shapley[f] += len(gone)
                left = [m for m in left if f not in m[1]]
                again = sum(f in m[1] for m in own) - len(gone)
                out[part, order, k + 1] = [len(left), len(gone), again, sum(m[1] == f for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return out


def cases():
    rows = [(i, t, ["a", "b", None, ""][k % 4]) for k, (i, t, _) in enumerate(documents())]
    rows += [(200 + k, "word " * (150 + 30 * k) + "#" * (k % 2), "a") for k in range(5)]
    rows += [(300 + k, "Loud LOUD " + prose(300, 220), "c") for k in range(40)] + [(300, "Loud LOUD " + prose(300, 220), "c")]
    return rows


def _flags(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return filter_audit.label_flags(labels, {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 320, 3)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (301, None, None)]


def _rows(out):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in out.collect()}


def test_audit_equals_brute_force(spark):
    rows = cases()
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, source string, n int, part string, digest int")
    filters, states = filter_audit.failure_states(docs, _flags(spark, LABELS), F.col("source"))
    good, toxic = {i for i, q, _ in LABELS if q == 1 and i is not None}, {i for i, _, x in LABELS if x == 1 and i is not None}
    out = filter_audit.audit(states, filters)
    assert _rows(out) == brute(rows, good, toxic)
    assert out.count() == 600 * 4


def test_paths_through_a_layer_are_all_orders():
    for n in range(1, 7):
        reach, leave = filter_audit.path_counts(n)
        assert reach[-1] == leave[0] == math.factorial(n)
        for size in range(n):
            through = [reach[s] * leave[s | 1 << f] for s in range(1 << n) if s.bit_count() == size for f in range(n) if not s >> f & 1]
            assert sum(through) == math.factorial(n)


def test_other_filters_and_named_orders(spark):
    states = spark.createDataFrame([("p", 0, 5, 2), ("p", 1, 3, 1), ("p", 3, 2, 0), ("p", 6, 4, 4)], "part string, mask int, n long, kept_words long")
    out = filter_audit.audit(states, ["X", "Y", "Z"], orders=["ZXY"]).orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant, r.unique_fails, r.kept_words_lost) for r in out] == [(10, 4, 0, 0, 4), (5, 5, 0, 3, 1), (5, 0, 6, 0, 0)]
    # Z and Y share the 4 rows, X and Y the 2; X has 3 of its own: over 6 orders
    assert [r.shapley for r in out] == [12, 24, 18]


def test_without_rows_or_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    none = _flags(spark, [])
    filters, states = filter_audit.failure_states(docs, none, F.col("source"))
    assert filter_audit.audit(states, filters).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    filters, states = filter_audit.failure_states(one, none, F.col("source"), copies=None)
    out = filter_audit.audit(states, filters).collect()
    assert filters == list("ABCD") and len(out) == 96 and {r.part for r in out} == {""} and sum(r.good_lost for r in out) == 0
