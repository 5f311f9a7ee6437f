"""Operator 5: byte-level BPE encoding and decoding without regex.

Pre-tokenisation works on arrays: a table gives every code point its class,
every position becomes a transition function of a small automaton, and a
blocked associative scan over the functions' composition table yields the
state before each character, hence the boundaries.  The slices between them
go through a bounded table of known pre-tokens and, where new, pair merging.
Ids are decoded again by the vocabulary's byte offsets.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from incidentflow.llm import common

# ------------------------------------------------------------ the automaton
#: Character classes: letter, number, the space, other white space, other, a new text.
LETTER, NUMBER, SPACE, WHITE, OTHER, TEXT_START = range(6)
#: States: after a boundary that the next character must start; inside a run of
#: letters, numbers or other; after a space that a run may take in; inside white
#: space; one or two letters of a contraction still to come.
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, AFTER_SPACE, IN_WHITE, ONE_MORE, TWO_MORE = range(8)
N_STATES = 8
_RUN = {LETTER: IN_LETTER, NUMBER: IN_NUMBER, OTHER: IN_OTHER}
#: The contractions of the pattern, without their apostrophe.
SHORT_CONTRACTIONS = ("s", "t", "m", "d")
LONG_CONTRACTIONS = ("re", "ve", "ll")


def step(state: int, kind: int, contraction: int, last_white: bool) -> tuple[int, bool]:
    """Next state, and whether the character begins a pre-token.

    ``contraction`` is 1 or 2 at an apostrophe followed by that many letters
    of a contraction; ``last_white`` marks white space that text follows."""
    if kind == TEXT_START:
        return FRESH, True
    if state in (ONE_MORE, TWO_MORE) and kind == LETTER:
        return (FRESH if state == ONE_MORE else ONE_MORE), False
    if kind in (SPACE, WHITE):
        # the last of several stands alone, or with what follows if it is a space
        begins = state != IN_WHITE or last_white
        if not last_white:
            return IN_WHITE, begins
        return (AFTER_SPACE if kind == SPACE else FRESH), begins
    if state == AFTER_SPACE:
        return _RUN[kind], False
    begins = state != _RUN[kind]
    if begins and contraction:
        return (ONE_MORE if contraction == 1 else TWO_MORE), True
    return _RUN[kind], begins


#: Symbols: a class with what looking ahead has to add to it.
SYMBOLS = [(k, 0, False) for k in range(6)] + [(SPACE, 0, True), (WHITE, 0, True), (OTHER, 1, False), (OTHER, 2, False)]
LAST_SPACE, LAST_WHITE, SHORT, LONG = 6, 7, 8, 9


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All transition functions that symbols compose to: the function of each
    symbol, the table ``first, then -> composed``, each function's values, and
    whether a symbol begins a pre-token in a state."""
    base = [tuple(step(s, *symbol)[0] for s in range(N_STATES)) for symbol in SYMBOLS]
    found = {tuple(range(N_STATES)): 0}
    order = [tuple(range(N_STATES))]
    for f in order:
        for g in base:
            h = tuple(g[f[s]] for s in range(N_STATES))
            if h not in found:
                found[h] = len(order)
                order.append(h)
    table = np.array([[found[tuple(g[f[s]] for s in range(N_STATES))] for g in order] for f in order], dtype=np.uint16)
    begins = np.array([[step(s, *symbol)[1] for s in range(N_STATES)] for symbol in SYMBOLS])
    return np.array([found[f] for f in base], dtype=np.uint16), table, np.array(order, dtype=np.uint8), begins


_OF_SYMBOL, _COMPOSE, _VALUES, _BEGINS = _monoid()
_CLASS: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point, from Unicode's categories."""
    if not _CLASS:
        out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
        for c in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                out[c] = LETTER if kind == "L" else NUMBER
        # fixed values: Unicode's White_Space
        out[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
        out[32] = SPACE
        _CLASS.append(out)
    return _CLASS[0]


def states_before(symbols: np.ndarray, block: int = 512) -> np.ndarray:
    """The automaton's state before each symbol: an associative scan of the
    transition functions, within blocks, over the blocks, and back."""
    n = len(symbols)
    rows = -(-n // block)
    fn = np.zeros(rows * block, dtype=np.uint16)  # function 0 is the identity
    fn[:n] = _OF_SYMBOL[symbols]
    fn = np.ascontiguousarray(fn.reshape(rows, block).T)
    flat = _COMPOSE.ravel()
    width = len(_COMPOSE)
    for i in range(1, block):
        fn[i] = flat[fn[i - 1].astype(np.int32) * width + fn[i]]
    entry = np.empty(rows, dtype=np.uint8)
    state = FRESH
    for r, f in enumerate(fn[-1].tolist()):
        entry[r] = state
        state = _VALUES[f, state]
    after = _VALUES.ravel()[fn.astype(np.int32) * N_STATES + entry]
    before = np.empty_like(after)
    before[0], before[1:] = entry, after[:-1]
    return before.T.ravel()[:n]


def boundaries(text: str) -> np.ndarray:
    """Where pre-tokens begin in ``text``, in which each text is preceded by
    one NUL that counts as its start (so every NUL inside a text must have
    been replaced)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbol = classes()[points]
    symbol[points == 0] = TEXT_START
    white = (symbol == SPACE) | (symbol == WHITE)
    last = np.zeros(len(white), dtype=bool)
    last[:-1] = white[:-1] & ~white[1:] & (symbol[1:] != TEXT_START)
    symbol[last & (symbol == SPACE)] = LAST_SPACE
    symbol[last & (symbol == WHITE)] = LAST_WHITE
    padded = np.concatenate([points, np.zeros(2, dtype=np.uint32)])
    at = np.flatnonzero(points == ord("'"))
    if len(at):
        follows = np.isin(padded[at + 1], [ord(c) for c in SHORT_CONTRACTIONS])
        symbol[at[follows]] = SHORT
        for a, b in LONG_CONTRACTIONS:
            symbol[at[(padded[at + 1] == ord(a)) & (padded[at + 2] == ord(b))]] = LONG
    return np.flatnonzero(_BEGINS[symbol, states_before(symbol)])


# ------------------------------------------------------------- the encoder
class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        pieces = [b""] * size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.piece_len = np.array([len(p) for p in pieces], dtype=np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        """Empties the table of known pre-tokens: their ids, one after the other."""
        self.known: dict[str, int] = {}
        self.printed: list[str] = []
        self.ids: list[int] = []
        self.offset: list[int] = [0]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: while a pair is in the vocabulary, the one of
        the lowest rank (leftmost first) is merged."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 400:
            return self.merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pair = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while pair and (low := min(pair)) < 1 << 30:
            i = pair.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
        return [ranks[p] for p in parts]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list: a pre-token of n bytes in n log n."""
        import heapq

        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        before, alive = list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two has grown meanwhile
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def learn(self, word: str) -> int:
        ids = self.merge(word.encode("utf-8", "surrogatepass"))
        self.ids.extend(ids)
        self.offset.append(len(self.ids))
        self.printed.append(",".join(map(str, ids)))
        self.known[word] = at = len(self.printed) - 1
        return at

    def encode(self, texts: list[str], most_known: int) -> list[np.ndarray]:
        """For each text the indexes of its pre-tokens in the table."""
        if len(self.known) > most_known:
            self.forget()
        joined = "\0" + "\0".join(t.replace("\0", "\1") if "\0" in t else t for t in texts)
        cuts = boundaries(joined)
        # NUL and U+0001 are of one class, so the cuts hold for the text as it is
        plain = "\0" + "\0".join(texts) if any("\0" in t for t in texts) else joined
        get, learn = self.known.get, self.learn
        out, at, k = [], 0, 0
        ends = np.append(cuts[1:], len(plain))
        starts = np.searchsorted(cuts, np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])) if texts else []
        stops = [*starts[1:], len(cuts)]
        for a, b in zip(starts, stops):
            # the first cut is the text's own start mark
            words = [plain[i:j] for i, j in zip(cuts[a + 1 : b].tolist(), ends[a + 1 : b].tolist())]
            out.append([k if (k := get(w)) is not None else learn(w) for w in words])
        return out

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of texts, given their ids one after the other: each id's
        bytes are gathered by their offset in the vocabulary."""
        size = self.piece_len[ids]
        end = np.cumsum(size)
        where = np.repeat(self.piece_at[ids] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
        data = self.piece_bytes[where].tobytes()
        edges = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:])]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_LOADED: dict[str, Encoder] = {}
OUT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    df: DataFrame, vocabulary: str, id_col: str = common.ID, text_col: str = common.TEXT, keep_ids: bool = False, keep_decoded: bool = False, most_known: int = 250_000
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row: the
    digests of the decimal ids joined by commas and of the bytes the ids
    decode to.  ``keep_ids`` adds ``ids`` (array of int) and ``offsets`` (where
    each id's bytes begin in the text), ``keep_decoded`` adds ``decoded``.

    ``vocabulary`` is a rank file on the driver, broadcast as a table of a few
    MB; ``most_known`` bounds the pre-tokens a worker remembers.  A null text
    is empty: 0 ids, the digests of nothing.  Repeated rows and null ids give a
    row each, an empty table none; other columns are ignored.
    """
    ranks = read_ranks(vocabulary)
    shared, name = df.sparkSession.sparkContext.broadcast(ranks), f"{vocabulary}:{len(ranks)}:{hash(frozenset(ranks.items()))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _LOADED:
            _LOADED[name] = Encoder(shared.value)
        coder = _LOADED[name]
        for part in common.slices(batches, common.TEXT, 1 << 21):
            words = coder.encode(part.column(1).to_pylist(), most_known)
            printed = coder.printed.__getitem__
            ids_digest = [hashlib.sha256(",".join(map(printed, w)).encode()).hexdigest() for w in words]
            offset = np.array(coder.offset)
            table = np.array(coder.ids, dtype=np.int32)
            which = np.fromiter((k for w in words for k in w), dtype=np.int64, count=sum(map(len, words)))
            size = offset[which + 1] - offset[which]
            end = np.cumsum(size)
            ids = table[np.repeat(offset[which] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
            per_text = np.diff(np.concatenate([[0], end])[np.concatenate([[0], np.cumsum([len(w) for w in words])])])
            decoded = coder.decode(ids, per_text)
            columns = [part.column(0), pa.array(per_text, pa.int64()), pa.array(ids_digest), pa.array([hashlib.sha256(b).hexdigest() for b in decoded])]
            if keep_ids:
                rows = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
                began = np.cumsum(coder.piece_len[ids]) - coder.piece_len[ids]
                began = began - np.repeat(np.concatenate([[0], np.cumsum([len(b) for b in decoded])])[:-1], per_text)
                columns += [pa.ListArray.from_arrays(rows, pa.array(ids)), pa.ListArray.from_arrays(rows, pa.array(began.astype(np.int32)))]
            if keep_decoded:
                columns.append(pa.array([b.decode("utf-8", "replace") for b in decoded]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = common.texts(df, id_col, text_col)
    kind = rows.schema[common.ID].dataType.simpleString()
    schema = f"{common.ID} {kind}, {OUT}" + ", ids array<int>, offsets array<int>" * keep_ids + ", decoded string" * keep_decoded
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    return common.per_task(rows, run, schema)
