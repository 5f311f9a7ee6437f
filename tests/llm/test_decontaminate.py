from incidentflow.llm import decontaminate
from tests.llm.fixtures import SCHEMA, WORD, documents, lower, prose


def brute(rows, items, window=10):
    found = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[a : a + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t, _ in rows:
        w = WORD.findall(lower(t))
        hit, its = set(), set()
        for n in {len(k) for k in found}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in found:
                    hit.update(range(a, a + n))
                    its |= found[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), sorted(its)))
    return out


def cases():
    rows = documents()
    items = [(1, prose(500, 40)), (2, "A b, C"), (3, None), (4, ""), (10, prose(500, 40)), (None, "only one word of nine stands in this"), (5, "zzz"), (5, "zzz")]
    piece = " ".join(items[0][1].split()[10:27])
    rows += [(70, prose(501, 30) + " " + piece + " " + prose(502, 30), 0), (71, piece, 0), (72, "x a B c y", 0), (73, " ".join(piece.split()[:9]), 0)]
    rows += [(74, items[0][1] + items[0][1], 0), (75, "Only one WORD of nine stands in this, zzz", 0), (75, "Only one WORD of nine stands in this, zzz", 0)]
    return rows, items


def _found(out):
    return sorted(((r.doc_id, r.n_words, sum(h.stop - h.start for h in r.hits), r["items"]) for r in out.collect()), key=str)


def test_hits_equal_brute_force(spark):
    rows, items = cases()
    out = decontaminate.contamination(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert _found(out) == sorted(brute(rows, items), key=str)


def test_blocks_of_the_benchmark_give_the_same(spark):
    rows, items = cases()
    out = decontaminate.contamination(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), block_words=1)
    assert _found(out) == sorted(brute(rows, items), key=str)


def test_drop_keeps_clean_rows_whole(spark):
    rows, items = cases()
    df, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    expected = sorted((r for r, b in zip(rows, brute(rows, items)) if not b[2]), key=str)
    for words in (1, 2_000_000):
        assert sorted(map(tuple, decontaminate.drop_contaminated(df, bench, block_words=words).collect()), key=str) == expected


def test_empty_tables(spark):
    rows, items = cases()
    df, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    out = decontaminate.contamination(df, bench.limit(0))
    assert out.count() == len(rows) and out.where("size(hits) > 0").count() == 0
