import hashlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from incidentflow.llm import byte_bpe, token_counts
from tests.llm.fixtures import SCHEMA, documents, prose

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _key(row):
    return tuple((x is None, x) for x in row)


def test_counts_are_the_library_s(spark):
    rows = documents()
    tok = Tokenizer.from_file(WORDS)
    expected = []
    for i, t, _ in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 2048))
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), WORDS).collect()
    assert sorted(map(tuple, got), key=_key) == sorted(expected, key=_key)


def test_counts_with_a_small_table_of_known_words(spark):
    rows = documents()[:12]
    df = spark.createDataFrame(rows, SCHEMA)
    small = token_counts.count_tokens(df, WORDS, most_known=5)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, token_counts.count_tokens(df, WORDS).collect()))


def test_ids_are_the_library_s_and_decode(spark):
    rows = documents()
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    out = byte_bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), RANKS, keep_ids=True, keep_decoded=True).collect()
    expected = []
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((i, len(ids), sha, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r)[:4] for r in out), key=_key) == sorted(expected, key=_key)
    for r in out:
        text = r.decoded.encode()
        pieces = [enc.decode_single_token_bytes(x) for x in r.ids]
        assert b"".join(pieces) == text
        assert all(text[o : o + len(p)] == p for o, p in zip(r.offsets, pieces))


@pytest.mark.parametrize("text", ["'s", "x's's", "x''s", "\n's", " 's", "a  ", "  a", "'rex 're", "\n\n b", "é's 1's", "\0\0a"])
def test_boundaries_follow_the_pattern(text):
    import regex

    cuts = byte_bpe.boundaries("\0" + text.replace("\0", "\1"))[1:] - 1
    assert cuts.tolist() == [m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)]


def test_long_pretokens_merge_as_short_ones_do():
    coder = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS))
    for seed in range(5):
        piece = prose(seed, 60).replace(" ", "").encode()[:390]
        assert coder.merge(piece) == coder.merge_long(piece)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_counts.count_tokens(none, WORDS).count() == 0
    assert byte_bpe.encode_documents(none, RANKS).count() == 0
