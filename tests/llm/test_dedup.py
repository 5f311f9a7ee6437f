import random
from collections import Counter, defaultdict

from incidentflow.llm import ngram_join, substring_dedup
from incidentflow.llm.components import components
from tests.llm.fixtures import SCHEMA, WORD, documents, edited, lower, prose


def brute_join(rows, similarity=0.8, k=5):
    sets = {}
    for i, t, _ in rows:
        w = WORD.findall(lower(t))
        if i is not None:
            sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else None
    members = defaultdict(list)
    for i, s in sets.items():
        members[s if s else i].append(i)
    own = sorted(members, key=lambda s: min(members[s]))
    parent = list(range(len(own)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links = Counter()
    for a in range(len(own)):
        for b in range(a):
            x, y = own[a], own[b]
            if isinstance(x, frozenset) and isinstance(y, frozenset) and len(x & y) >= similarity * len(x | y):
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    out = {}
    for a, s in enumerate(own):
        for i in members[s]:
            out[i] = (min(members[own[find(a)]]), links[a], len(members[s]))
    return [(i, *out[i]) if i is not None else (None, None, 0, 0) for i, _, _ in rows]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_join_equals_brute_force(spark):
    rows = documents()
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert _sorted(got) == _sorted(brute_join(rows))


def test_large_groups_are_split_and_lose_no_link(spark, monkeypatch):
    """With a tiny limit, groups go through all levels and pairs of blocks."""
    monkeypatch.setattr(ngram_join, "SMALL", 8)
    monkeypatch.setattr(ngram_join, "WHOLE", 8)
    monkeypatch.setattr(ngram_join, "DEPTH", 2)
    text = prose(900, 150)
    rows = [(i, edited(text, 75, i), 0) for i in range(90)] + [(200 + i, prose(300 + i, 80), 0) for i in range(40)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert _sorted(got) == _sorted(brute_join(rows))


def test_one_of_each_keeps_columns_and_rows_without_id(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    first = sorted({i for i, c, _, _ in brute_join(rows) if i is not None and i == c})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == first
    assert kept.where("doc_id IS NULL").count() == 2


def test_join_of_nothing(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert _sorted(ngram_join.ngram_join(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect()) == [(1, 1, 0, 1)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(51)) and all(got[200 + i] == 100 for i in range(30)) and got[100] == 100


def test_runs_reach_the_recall():
    assert ngram_join.runs_for(0.999, 0.8) >= 14
    assert abs(ngram_join.survival(0.8, 1) - (1 - (0.75 * 0.2 + 0.25 * 0.04))) < 1e-12
    for s in (0.5, 0.6, 0.7, 0.9):
        assert (1 - ngram_join.survival(s, ngram_join.DEPTH)) ** ngram_join.runs_for(0.999, s) <= 0.001


def test_recall_at_the_threshold(spark, monkeypatch):
    """10,000 sets, half of them a pair at the threshold: small buckets are
    split through all levels, and 0.9 of the pairs at least are found."""
    monkeypatch.setattr(ngram_join, "SMALL", 16)
    pick, rows, pairs = random.Random(6), [], set()
    for i in range(2500):
        words = [f"w{pick.randrange(10**6)}" for _ in range(94)]
        # 90 shingles; one replaced word spoils five, the two texts share 85 or 80 of 95 or 100
        other = list(words)
        for at in (20, 60)[: 1 + i % 2]:
            other[at] = f"w{pick.randrange(10**6)}"
        rows += [(2 * i, " ".join(words), 0), (2 * i + 1, " ".join(other), 0)]
        pairs.add((2 * i, 2 * i + 1))
    rows += [(10_000 + i, " ".join(f"w{pick.randrange(10**6)}" for _ in range(60)), 0) for i in range(5000)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, SCHEMA)).where("class_id <> doc_id").collect()
    found = {(r.class_id, r.doc_id) for r in got}
    assert found <= pairs  # nothing else is linked
    assert len(found) >= 0.99 * len(pairs)


def test_one_id_with_other_texts_and_columns_of_any_name(spark):
    near = edited(prose(40, 120), 100, 1)
    rows = [(5, prose(40, 120)), (5, prose(41, 120)), (5, prose(41, 120)), (3, near), (9, prose(41, 120)), (7, None), (7, ""), (7, "!"), (None, prose(41, 120))]
    df = spark.createDataFrame([(i, t, k, "x", k, 1.0) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _row int, _first string, id int, `a.b` double")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(str((r.doc_id, r.text or "")) for r in kept.collect())  # an empty text and none are one document
    # 5 has two texts: one is a near copy of 3's, the other comes first of its class
    assert got == sorted(map(str, [(3, near), (5, prose(41, 120)), (7, ""), (7, "!"), (None, prose(41, 120))]))


PASSAGE = " ".join(f"Sentence number {i} of a passage says this and that again." for i in range(7))


def test_later_passages_are_cut_and_clean_texts_stay(spark):
    clean = prose(1, 200)
    rows = [(3, "Before. " + PASSAGE + " After three.", 1), (1, PASSAGE, 1), (2, clean, 1), (9, "Start here. " + PASSAGE + " " + PASSAGE, 1), (4, None, 1), (5, "", 1), (None, PASSAGE, 1)]
    rows += [(6, "Same line. Again.\nown words of six here", 1), (7, "Same line. Again.\nother words of seven", 1)]
    out = {r.doc_id: r for r in substring_dedup.dedup_spans(spark.createDataFrame(rows, SCHEMA)).where("doc_id IS NOT NULL").collect()}
    assert out[1].text == PASSAGE and out[2].text == clean and out[1].n_removed == 0
    assert "passage" not in out[3].text and out[3].text.startswith("Before.") and out[3].text.endswith("After three.")
    assert "passage" not in out[9].text and out[9].n_removed == 14
    assert out[4].text is None and out[4].n_sentences == 0 and out[5].text == ""
    assert out[6].text == rows[7][1] and out[7].text == rows[8][1]  # short stretches stay


def test_rows_without_id_stay_and_repeated_rows_agree(spark):
    rows = [(None, PASSAGE, 1), (None, PASSAGE, 1), (1, PASSAGE, 1), (1, PASSAGE, 1), (2, PASSAGE, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_tokens", "n_removed")
    out = substring_dedup.dedup_spans(df)
    assert out.columns == ["doc_id", "text", "n_sentences", "n_removed"]
    by = defaultdict(list)
    for r in out.collect():
        by[r.doc_id].append(r.text)
    assert by[None] == [PASSAGE] * 2 and by[1] == [PASSAGE] * 2 and by[2] == [""]
    assert substring_dedup.dedup_spans(df.limit(0)).count() == 0


def test_columns_of_any_name(spark):
    text = "doc string, digest string, _doc string, _positions string, pos int, `a.b` double"
    rows = [(1, PASSAGE), (2, "Mine. " + PASSAGE), (3, "Other. Words.")]
    df = spark.createDataFrame([(t, i, "d", "g", "x", "p", k, 0.5) for k, (i, t) in enumerate(rows)], f"`t.t` string, id long, {text}")
    out = substring_dedup.dedup_spans(df, id_col="id", text_col="t.t")
    assert out.columns == [*df.columns, "n_sentences", "n_removed"]
    assert {r.id: r["t.t"].strip() for r in out.collect()} == {1: PASSAGE, 2: "Mine.", 3: "Other. Words."}
    cut = substring_dedup.cut_passages(df, id_col="id", text_col="t.t")
    assert cut.columns == df.columns and {r.id: r["a.b"] for r in cut.collect()} == {1: 0.5, 2: 0.5, 3: 0.5}
    assert {r.id: r["t.t"].strip() for r in cut.collect()} == {1: PASSAGE, 2: "Mine.", 3: "Other. Words."}


def brute_passages(rows, k=51):
    """Texts as words, without those in a window that occurs before."""
    first, out = {}, []
    for i, t, _ in sorted(rows):
        w = t.split()
        gone = set()
        for p in range(len(w) - k + 1):
            place = first.setdefault(tuple(w[p : p + k]), (i, p))
            if place[0] != i or p - place[1] >= k:
                gone.update(range(p, p + k))
        out.append((i, [x for p, x in enumerate(w) if p not in gone]))
    return dict(out)


def _stage(spark, rows):
    import corpus_pipeline

    df = spark.createDataFrame([(i, t, len(t)) for i, t, _ in rows], "doc_id long, text string, n_chars int")
    return {r.doc_id: r for r in corpus_pipeline.cut_repeats(spark, df, "").collect()}


def _unmarked(seed, n):
    return " ".join(f"{w}{seed}" for w in prose(seed, n).replace(".", "").replace(",", "").split())


def test_passages_without_whole_sentences_are_cut(spark):
    """One sentence of 51 words, 60 and 300 words set into running text, exact
    copies without ends, a text that repeats itself, and 50 words that stay."""
    one, mid, long, fifty = _unmarked(1, 51), _unmarked(2, 60), _unmarked(3, 300), _unmarked(4, 50)
    own = [_unmarked(10 + i, 40) for i in range(12)]
    rows = [(1, one), (2, f"{own[0]} {mid} {own[1]}"), (3, f"{own[2]} {long} {own[3]}."), (4, f"{own[4]} {fifty} {own[5]}"), (5, one + "."), (6, f"{own[6]} {mid} {own[7]}")]
    rows += [(7, f"{own[8]}\n{long}\n{own[9]}"), (8, one), (9, f"{own[10]} {fifty} {own[11]}"), (10, " ".join(["again"] * 130)), (11, f"{mid} {mid}"), (12, ""), (13, one.upper())]
    rows = [(i, t, 0) for i, t in rows]
    expected = brute_passages(rows)
    assert expected[6] == (own[6] + " " + own[7]).split() and expected[8] == [] and len(expected[10]) == 51
    got = _stage(spark, rows)
    assert {i: r.text.split() for i, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_passages_equal_brute_force(spark):
    rows = [(i, t, n) for i, t, n in documents() if i not in (None, 0, 50, 60)]
    out = substring_dedup.cut_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.text.split() for r in out} == brute_passages(rows)


def test_passages_of_rows_without_id_stay_and_repeated_rows_agree(spark):
    text = _unmarked(5, 80)
    rows = [(None, text, 1), (1, text, 1), (1, text, 1), (2, text, 1), (3, None, 1)]
    out = substring_dedup.cut_passages(spark.createDataFrame(rows, SCHEMA))
    assert _sorted(out.collect()) == _sorted([(None, text, 1), (1, text, 1), (1, text, 1), (2, "", 1), (3, None, 1)])
    assert substring_dedup.cut_passages(out.limit(0)).count() == 0


def test_passages_with_short_whole_sentences_are_cut(spark):
    """Whole sentences of 20 words between two that begin and end differently."""
    passage = f"{_unmarked(30, 20)}. {_unmarked(31, 10)}. {_unmarked(32, 10)}. {_unmarked(33, 20)}"
    rows = [(1, f"{_unmarked(34, 9)} {passage} {_unmarked(35, 9)}.", 0), (2, f"{_unmarked(36, 9)} {passage} {_unmarked(37, 9)}.", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.text for r in substring_dedup.dedup_spans(df).collect()} == {i: t for i, t, _ in rows}
    assert {i: r.text for i, r in _stage(spark, rows).items()} == {1: rows[0][1], 2: f"{_unmarked(36, 9)} {_unmarked(37, 9)}."}
