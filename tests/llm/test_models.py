import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incidentflow.llm import gru_lm, queries, toxicity, transcripts, url_filter
from incidentflow.llm.common import crc_mod
from tests.llm.fixtures import SCHEMA, documents, lower, prose


def _auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    p = label.sum()
    return (order[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


# ------------------------------------------------------------------ toxicity
def test_grammar_names_clauses():
    def kind(*classes):
        state = 0
        for c in classes:
            state = toxicity.GRAMMAR[state, c]
        k = toxicity.KIND_OF[state]
        return toxicity.KINDS[k] if k >= 0 else None

    O, I, T, G, N, R = range(6)
    assert kind(O, G, O) is None
    assert kind(G, O, I) == ("insult", "target", "direct")
    assert kind(G, O, N, O, I) == ("insult", "target", "negated")
    assert kind(N, O, O, O, O, I) == ("insult", "none", "direct")
    assert kind(R, G, I) == ("insult", "target", "reported")
    assert kind(T, G) == ("threat", "target", "direct")
    assert kind(I, N, I) == ("insult", "none", "direct")


def _by_hand(text):
    """Matched clauses and word weights by kind, clause by clause."""
    words_in = {w: c for c, ws in toxicity.LISTS.items() for w in ws.split()}
    counts, heavy, summed = Counter(), Counter(), Counter()
    for clause in re.split(r"[.!?;:\n]+", lower(text)):
        kinds = [words_in.get(w, 0) for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", clause)]
        hot = [k for k in kinds if k in (toxicity.INSULT, toxicity.THREAT)]
        if not hot:
            continue
        state = 0
        for k in kinds:
            state = toxicity.GRAMMAR[state, k]
        kind = toxicity.KINDS[toxicity.KIND_OF[state]]
        counts[kind] += 1
        heavy[kind[2]] = max(heavy[kind[2]], 2.0)
        summed[kind[2]] += 2.0 * len(hot)
    out = [math.log1p(counts[k]) for k in toxicity.KINDS]
    for soft in toxicity.SOFT:
        out += [heavy[soft], math.log1p(summed[soft])]
    return out


def test_every_weight_goes_through_its_clause():
    texts = ["You are an idiot.", "You are not an idiot.", "He said you are an idiot.", "A fine day.", "You idiot! you are not stupid, he said you are stupid", "", "idiot " * 5]
    got = toxicity.Lexicon().features(toxicity.Words(pa.array(texts)))
    for t, x in zip(texts, got):
        assert x.tolist() == pytest.approx(_by_hand(t)), t
    score, _ = toxicity.Model(toxicity.Lexicon(), toxicity.DEFAULT).score(toxicity.Words(pa.array(texts)))
    assert score[0] > score[2] > score[3] and score[0] > score[1] > score[3]


def test_learned_words_and_stems_are_found(spark):
    docs, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = prose(1000 + i, 60)
        if bad:
            text += [" grumblot", f" zerbix{prose(i, 1).strip('., ')}"][i // 5 % 2] + " " + prose(i, 20)
        docs.append((i, text, 0))
        if i < 250:
            labels.append((i, int(bad)))
    docs += [(400, None, 0), (401, "", 0), (None, "grumblot", 0), (0, docs[0][1], 0)]
    labels += [(None, 1), (3, None), (1, 0)]
    df, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    out = toxicity.score(df, model).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and 250 <= r.doc_id < 300]
    assert _auc(np.array([r.score for r in held]), np.array([int(r.doc_id % 5 == 0) for r in held])) > 0.95
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.score < 0.5}


def test_without_labels_the_fixed_lists_hold(spark):
    df = spark.createDataFrame([(1, "You are an idiot.", 0), (2, "A fine day.", 0)], SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    score = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert score[1] > score[2]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_held_out_toxicity(spark):
    """On the test table few labels exist; the English lexicon carries it."""
    path = "/root/testdata/sf0.01"
    out = queries.op10_toxicity(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert _auc(out.score.to_numpy(), out.toxic.to_numpy()) > 0.75
    assert ((out.predicted == 1) & (out.toxic == 0)).sum() <= 2


# ---------------------------------------------------------------- url filter
RULES = queries.URL_RULES


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [(r, v) for r, v in RULES if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    best = max(fits, key=lambda r: len(r[0]), default=(None, None))
    return host, path, *best


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM", "http://a.example.com/", "https://www.example.com/en/x?q=1#f", "http://WWW.www.example.com/en/",
    "http://example.com/en", "http://example.com/EN/", "ftp://x.net/es/1", "http://net/fr/", "http://notnet/fr/", "a://b://c/d", "http://x.org/a//b;c?d=/e",
    "http://com/", "http://h.com:80/x", "http://x.net/fr\n/\ny", "http://" + "a" * 3000 + ".org/" + "1" * 3000, "http://x.net?u=/es/",
]


def test_rules_and_verdicts(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, "http://q.org/1", "x"), (3, URLS[3], "x")]
    rows += [(100 + i, f"http://{h}.example.{t}/{p}/{i}", "x") for i, (h, t, p) in enumerate((h, t, p) for h in "abcdef" for t in ("com", "net", "org") for p in ("en", "es", "fr", "de"))]
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        url = next(u for i, u, _ in rows if i == r.page_id)
        host, path, rule, verdict = brute_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert (r.block_score is None) == (rule is not None)


def test_one_verdict_or_none(spark):
    df = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.org/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(df, RULES).collect()} == {1: "allow", 2: "allow"}
    assert {r.page_id: r.verdict for r in url_filter.judge(df, [("a.com/", "block")]).collect()} == {1: "block", 2: "block"}
    assert url_filter.judge(df.limit(0), RULES).count() == 0


def test_entropy(spark):
    got = [r.e for r in spark.createDataFrame([("",), ("aaaa",), ("abab",), ("abcd",)], "u string").select(url_filter.entropy(F.col("u")).alias("e")).collect()]
    assert got == pytest.approx([0, 0, 1, 2])


def _trees(monkeypatch):
    """Keeps the fitted trees of the next call."""
    kept, real = [], url_filter.GBTClassifier.fit
    monkeypatch.setattr(url_filter.GBTClassifier, "fit", lambda self, df: kept.append(real(self, df)) or kept[-1])
    return kept


def test_trees_judge_urls_of_a_rule_they_never_saw(spark, monkeypatch):
    """Blocked URLs look alike on every host (deep, many digits and
    parameters) and share no path; one host has no rule and its URLs are judged."""
    pick, rows = np.random.default_rng(4), []
    for i in range(3000):
        bad = i % 3 == 0
        name = "".join(pick.choice(list("bcdefgh"), 8))
        path = f"/a{pick.integers(10**9)}/{pick.integers(10**9)}?a={i}&b={pick.integers(99)}&c=1" if bad else f"/{name}/page-{name[:4]}"
        rows.append((i, f"http://h{i % 6}.com{path}"))
    rules = [(f"h{k}.com/a", "block") for k in range(5)] + [(f"h{k}.com/", "allow") for k in range(5)]
    kept = _trees(monkeypatch)
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule IS NULL").collect()
    assert len(out) == 500
    right = sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in out)
    assert right >= 0.95 * len(out)
    weight = dict(zip(url_filter.FEATURES, kept[0].featureImportances.toArray()))
    assert sum(w for f, w in weight.items() if not f.startswith("rate_")) > 0.2


def test_rates_cover_labelled_urls_outside_the_sample_and_leave_out_the_own_fold(spark, monkeypatch):
    rows = [(i, f"http://s{i // 4}.com/{'bad' if i % 4 < i // 4 % 4 else 'ok'}/{i}") for i in range(400)]
    seen, real = [], url_filter.with_rates

    def with_rates(df, *more):
        seen.append(real(df, *more))
        return seen[-1]

    monkeypatch.setattr(url_filter, "with_rates", with_rates)
    rules = [("com/bad", "block"), ("com/", "allow")]
    assert url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, most_rows=40, trees=2).count() == 400
    bad = lambda u: "/bad/" in u
    prior = sum(bad(u) for _, u in rows) / 400
    train, judged = seen
    for r in judged.select("_url", "rate_host_2").collect():
        k = int(re.search(r"s(\d+)", r._url)[1])
        assert r.rate_host_2 == pytest.approx((k % 4 + 10 * prior) / 14)
    sampled = train.select("_url", "rate_host_2").collect()
    assert 10 < len(sampled) < 100
    assert [r.rate_host_2 for r in sampled] == pytest.approx([prior] * len(sampled))  # a host's own URLs are all there is of it
    fold = {r.u: r.f for r in judged.select(F.col("_url").alias("u"), F.pmod(F.xxhash64("_host"), F.lit(url_filter.FOLDS)).alias("f")).collect()}
    for r in train.select("_url", "rate_host_1").collect():
        others = [bad(u) for _, u in rows if fold[u] != fold[r._url]]
        assert r.rate_host_1 == pytest.approx((sum(others) + 10 * prior) / (len(others) + 10))


# --------------------------------------------------------------- transcripts
def test_roles_are_recovered_from_held_out_conversations(spark):
    out = queries.op6_chat_format(spark, "/root/testdata/sf0.01")
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").distinct().count()
    held = out.where("held_out").agg(F.avg(F.col("as_given").cast("double"))).first()[0]
    assert out.count() == turns and held > 0.85


def test_pieces_decode_as_one_sequence(spark, monkeypatch):
    rows = [(c, t, None, ("User: " if t % 9 == 0 else "") + prose(c * 100 + t, 5 + 30 * (t % 2))) for c in (1, 2) for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    model = transcripts.model_from({(-1, 1, 2): 9, (-1, 2, 1): 9, (1, 1, 0): 5, (1, 2, 3): 5})
    whole = sorted((r.conv_id, r.turn, r.role) for r in transcripts.parse(transcripts.turns(df), model).collect())
    monkeypatch.setattr(transcripts, "PIECE", 7)
    assert whole == sorted((r.conv_id, r.turn, r.role) for r in transcripts.parse(transcripts.turns(df), model).collect())


def test_turns_without_numbers_are_dealt_into_pieces(spark, monkeypatch):
    """A conversation whose turns have no number, or all the same, is cut by rows."""
    monkeypatch.setattr(transcripts, "PIECE", 50)
    rows = [(1, None, None, f"Human: {i:04d}" if i % 2 else f"{i:04d} Sure, here it is.") for i in range(400)]
    rows += [(2, 7, None, f"{i:04d} {prose(i, 6)}") for i in range(300)] + [(3, i, None, prose(i, 5)) for i in range(120)]
    parsed = transcripts.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    sizes = parsed.groupBy("key", "piece").count().collect()
    assert max(r["count"] for r in sizes) == 50 and len(sizes) == 8 + 6 + 3


def test_roles_equal_viterbi_over_whole_conversations(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "PIECE", 16)
    pick = np.random.default_rng(8)
    rows = []
    for c in range(6):
        for t in range(int(pick.integers(1, 90))):
            mark = ["User: ", "Assistant: ", "", "", "", "System: "][pick.integers(6)]
            rows.append((c, t, ["user", "assistant", None][pick.integers(3)], mark + prose(c * 1000 + t, int(pick.integers(1, 40))) + ["?", ".", ""][pick.integers(3)]))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parsed = transcripts.turns(df)
    model = transcripts.fit(parsed)
    got = {(r.conv_id, r.turn): r.role for r in transcripts.parse(parsed, model).collect()}
    for c in range(6):
        texts = [t for i, _, _, t in rows if i == c]
        emit = []
        for i, t in enumerate(texts):
            emit.append([sum(table[role, v] for table, v in zip(model.emits, transcripts.features(t, i == 0))) for role in range(len(transcripts.ROLES))])

        def total(path):
            return sum(e[r] for e, r in zip(emit, path)) + sum(model.moves[a, b] for a, b in zip([transcripts.START, *path], path))

        best = [(model.moves[transcripts.START, r] + emit[0][r], [r]) for r in range(len(transcripts.ROLES))]
        for e in emit[1:]:
            best = [max(((s + model.moves[p[-1], r] + e[r], [*p, r]) for s, p in best), key=lambda x: x[0]) for r in range(len(transcripts.ROLES))]
        found = [transcripts.ROLES.index(got[c, t]) for t in range(len(texts))]
        assert total(found) == pytest.approx(max(s for s, _ in best))  # as good as the best path (ties may differ)


def test_markers_and_odd_rows(spark):
    rows = [(1, 0, None, "Human: hi"), (1, 1, None, "**Assistant:** hello"), (1, 1, None, "**Assistant:** hello"), (1, 2, None, None), (None, 0, "user", "x"), (None, None, None, ""), (2, None, "bot?", "[User]: q?")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    parsed = transcripts.turns(df)
    model = transcripts.fit(parsed)
    out = {(r.conv_id, r.turn): r for r in transcripts.parse(parsed, model).collect()}
    assert len(out) == 6
    assert (out[1, 0].role, out[1, 1].role, out[1, 0].text, out[1, 1].text) == ("user", "assistant", "hi", "hello")
    assert out[1, 1].rendered == "<|im_start|>assistant\nhello<|im_end|>\n" and out[2, None].text == "q?"
    empty = transcripts.turns(df.limit(0))
    assert transcripts.parse(empty, transcripts.fit(empty)).count() == 0


# ------------------------------------------------------------ language model
def test_base_counts_and_held_out_gain(spark):
    rows = documents() + [(500 + i, prose(i % 40, 150), 0) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = gru_lm.score(df, train=crc_mod(F.col("doc_id"), 5) != 1, most_head=50, n_words=30, n_tails=8).collect()
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, t, _ in rows:
        own = tokens(t)
        expected.append((str(i), held(i), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got) == sorted(expected)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_network_probabilities_sum_to_one_and_gradients_hold():
    from incidentflow.llm.common import HashTable

    counts = np.array([50, 40, 30, 20, 10, 5, 4, 3])
    vocab = gru_lm.Vocabulary(HashTable(np.arange(1, 9, dtype=np.uint64)), counts, 6, np.zeros(65_536, dtype=np.int64), np.array([8.0, 2.0]), 162, 8)
    net = gru_lm.Network(vocab, 5)
    pick = np.random.default_rng(0)
    for n in net.NAMES:
        if not n.endswith("_b"):
            getattr(net, n)[...] = pick.normal(0, 0.4, getattr(net, n).shape)
    h = pick.normal(0, 1, (1, 5)).astype(np.float32)
    words = sum(math.exp(net.outputs(h, np.array([0]), np.array([w]), None)[0][0]) for w in range(6))
    tails = sum(math.exp(net.outputs(h, np.array([1 + c]), np.array([-1]), None)[0][0]) for c in range(2))
    assert words + tails == pytest.approx(1, abs=1e-5)

    x, fresh = pick.integers(0, 8, (6, 3)), np.zeros((6, 3), dtype=bool)
    fresh[3, 1] = True
    cls, word = pick.integers(0, 3, 18), np.zeros(18, dtype=np.int64)
    word = np.where(cls == 0, pick.integers(0, 6, 18), -1)

    def loss():
        states, _ = net.forward(x, fresh, np.zeros((3, 5), dtype=np.float32), False)
        return -net.outputs(states[1:].reshape(-1, 5), cls, word, None)[0].sum()

    grad = {n: np.zeros_like(getattr(net, n)) for n in net.NAMES}
    states, held = net.forward(x, fresh, np.zeros((3, 5), dtype=np.float32), True)
    _, dh = net.outputs(states[1:].reshape(-1, 5), cls, word, grad)
    net.backward(x, fresh, states, held, dh.reshape(6, 3, 5), grad)
    for n in net.NAMES:
        at = tuple(s // 3 for s in getattr(net, n).shape)
        old = getattr(net, n)[at]
        getattr(net, n)[at] = old + 1e-2
        up = loss()
        getattr(net, n)[at] = old - 1e-2
        down = loss()
        getattr(net, n)[at] = old
        assert grad[n][at] == pytest.approx((up - down) / 2e-2, abs=5e-2), n


def test_network_knows_2047_words_and_48_endings(spark):
    text = " ".join(f"word{i}{'abcdefgh'[i % 8]}{'klmnopqrst'[i // 8 % 10]}" for i in range(3000))
    df = spark.createDataFrame([(text,)], "text string")
    vocab, _ = gru_lm.fit(df, gru_lm.count_words(df), rounds=0)
    assert vocab.n_words == 2048 and len(vocab.tail_mass) == 48


def test_small_partitions_train(spark):
    """No partition has the 4,096 targets of a full step."""
    df = spark.createDataFrame([(prose(i % 10, 100),) for i in range(40)], "text string").repartition(20)
    vocab, start = gru_lm.fit(df, gru_lm.count_words(df), rounds=0)
    flat = gru_lm._train_round(df, vocab, start, 512, 16, 0.01)
    assert np.abs(flat[: len(start.flat())] - start.flat()).max() > 1e-4


def test_state_is_carried_across_windows():
    ids = np.array([1, 2, 3, 1, 2, 0, 3, 3, 0])
    first = np.array([0, 6, 9])
    from incidentflow.llm.common import HashTable

    vocab = gru_lm.Vocabulary(HashTable(np.arange(1, 5, dtype=np.uint64)), np.array([9, 8, 7, 6]), 4, np.zeros(65_536, dtype=np.int64), np.array([1.0]), 30, 4)
    net = gru_lm.Network(vocab, 4)
    net.class_w[...] = np.random.default_rng(1).normal(0, 1, net.class_w.shape)
    net.word_w[...] = np.random.default_rng(2).normal(0, 1, net.word_w.shape)
    out = [gru_lm.score_on(net, gru_lm.lay_out(ids, np.zeros(9, np.int64), ids, first, lanes), 9, window) for lanes in (1, 2) for window in (1, 2, 50)]
    assert all(np.allclose(out[0], o, atol=1e-5) for o in out)


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert gru_lm.score(none, train=F.lit(True)).count() == 0
    alone = gru_lm.score(spark.createDataFrame([(1, "a b", 0)], SCHEMA), train=F.lit(False)).first()
    assert (alone.n_tokens, alone.n_known) == (3, 0) and abs(alone.base_score) < 1e-12 and abs(alone.score) < 1e-12
