"""Removal of repeated passages by recompression.

Recompression turns each document's words into ever longer symbols: in each round every maximal run of one symbol is
named, then every pair of a left and a right symbol (a coin that the symbol's name tosses decides its side). A symbol's
naming depends on a known stretch of words around it; inside any two occurrences of a passage the symbols whose
stretches lie within are the same. Names are hashes of what they stand for, so equal things have equal names everywhere;
what the rounds over Spark add is which names are in use in more than one document.

Rounds over Spark, each of which sends names to fragments (ranges of the hash) and gets an answer for each:

1. Naming, `ROUNDS` times. Every window of `size` words that is still in question picks one symbol of this round, by a
   rule that sees nothing outside the window (the highest level, the least hash, the leftmost). Symbols of one document
   only are told apart from shared ones; windows that picked one of the former repeat nowhere and are out. The next round
   goes on with the longer symbols of the windows that are left.
2. Stretches. Neighbouring windows mostly share their symbol: one symbol stands for several windows. Of each shared
   top symbol the whole stretch of windows that picked it is compared (128 bits of two independent word hashes): a stretch
   that a smaller document has too is repeated as a whole.
3. Ends. Where a symbol has several stretches, as at the ends of repeats, each window is compared on its own (128 bits).

Documents are dealt out by groups of bounded bytes in one shuffle of the texts, which all rounds reuse. A group sends a
fragment one block for all its names, and each name once: a passage that all documents hold is one entry for each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, Words, arrow_rows, chunks, lean, lean_groups, mix, odd_keys, pack, parallelism, place, text_buffers, unpack, windows

#: Rounds of recompression.
ROUNDS = 2
#: Bytes of text in a group: what one Python call holds, a longer text alone. And text for each fragment of the names.
GROUP_BYTES = 1 << 20
FRAGMENT_BYTES = 64 << 20
_STEP = U(0x9E3779B97F4A7C15)
#: Bits of a symbol's rank that hold its place, so that the leftmost of equal ones is least.
_PLACE = 28


@dataclass
class Symbols:
    """A level: names, spans [s, e) and the stretches [ds, de) that their naming depends on; first/last of a row."""

    name: np.ndarray
    s: np.ndarray
    e: np.ndarray
    ds: np.ndarray
    de: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _runs(x: Symbols, seed: int) -> Symbols:
    """Names each maximal run; one of length 1 keeps its name, but that depends on its neighbours from now on."""
    begin = np.ones(len(x.name), bool)
    begin[1:] = (x.name[1:] != x.name[:-1]) | x.first[1:]
    a = np.flatnonzero(begin)
    b = np.concatenate([a[1:], [len(x.name)]]) - 1
    size = b - a + 1
    name = np.where(size > 1, mix(x.name[a] * odd_keys(1, seed)[0] + size.astype(U) * _STEP), x.name[a])
    ds = np.where(x.first[a], x.s[a] - 1, x.ds[np.maximum(a - 1, 0)])
    de = np.where(x.last[b], x.e[b] + 1, x.de[np.minimum(b + 1, len(x.name) - 1)])
    return Symbols(name, x.s[a], x.e[b], ds, de, x.first[a], x.last[b])


def _pairs(x: Symbols, seed: int) -> Symbols:
    """Names each pair of a left symbol and a right one behind it."""
    right = (mix(x.name + _times(seed)) & U(1)).astype(bool)
    n = len(x.name)
    joins = np.zeros(n, bool)
    joins[:-1] = ~right[:-1] & right[1:] & ~x.last[:-1]
    joined = np.zeros(n, bool)
    joined[1:] = joins[:-1]
    # alone, a left symbol depends on what stands behind it, a right one on what stands before it
    ds = np.where(right & ~joined, np.where(x.first, x.s - 1, x.ds[np.maximum(np.arange(n) - 1, 0)]), x.ds)
    de = np.where(~right & ~joins, np.where(x.last, x.e + 1, x.de[np.minimum(np.arange(n) + 1, n - 1)]), x.de)
    a = np.flatnonzero(~joined)
    b = a + joins[a]
    k1, k2 = odd_keys(2, seed + 500)
    name = np.where(joins[a], mix(x.name[a] * k1 + x.name[b] * k2), x.name[a])
    return Symbols(name, x.s[a], x.e[b], ds[a], de[b], x.first[a], x.last[b])


def levels(h: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    """The symbols after each round, lowest first (the words with their runs named come before the first pairs)."""
    n = len(h)
    at = np.arange(n)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    some = np.diff(bounds) > 0
    first[bounds[:-1][some]] = True
    last[bounds[1:][some] - 1] = True
    x = Symbols(h, at, at + 1, at, at + 1, first, last)
    out = []
    for k in range(rounds):
        x = _runs(x, 100 + k)
        out.append(x)
        x = _pairs(x, 200 + k)
        out.append(x)
    return out


_BASE = 0xB5297A4D3F84D5B5


def _times(k: int) -> np.uint64:
    """k times the golden ratio, modulo 2^64."""
    return U(k * 0x9E3779B97F4A7C15 % (1 << 64))


def _prefix(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of h[i] * base^i and the powers of the base's inverse, for hashes of any stretch of words."""
    power = np.cumprod(np.concatenate([[U(1)], np.full(len(h), U(_BASE))]))
    inverse = np.cumprod(np.concatenate([[U(1)], np.full(len(h), U(pow(_BASE, -1, 1 << 64)))]))
    return np.concatenate([[U(0)], np.cumsum(h * power[:-1])]), inverse


def _stretch(prefix: tuple[np.ndarray, np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words begin:end."""
    total, inverse = prefix
    return (total[end] - total[begin]) * inverse[begin]


def _least(rank: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least rank of each range lo:hi that is not empty."""
    size = hi - lo
    out = np.zeros(len(lo), U)
    table, width = rank, 1
    while True:
        now = (size >= width) & (size < 2 * width)
        out[now] = np.minimum(table[lo[now]], table[hi[now] - width])
        if not (size >= 2 * width).any():
            return out
        table = np.minimum(table[:len(table) - width], table[width:])
        width *= 2


class Picker:
    """The symbols of some texts, ready for windows to pick from."""

    def __init__(self, h: np.ndarray, bounds: np.ndarray, size: int, rounds: int = ROUNDS):
        self.size = size
        self.one, inside = windows(h, bounds, size, seed=1)
        self.all = np.flatnonzero(inside)
        prefix, n = _prefix(h), len(h)
        self.levels = []
        # runs are named on the way; what windows pick are the symbols that a round ends with
        for level, x in enumerate(levels(h, bounds, rounds)[1::2] if len(self.all) else []):
            # a symbol goes by its name and the words that its naming depends on: the same in equal windows, and rarer
            full = mix(x.name + _stretch(prefix, np.maximum(x.ds, 0), np.minimum(x.de, n)) + _times(level + 1))
            # how many symbols have a stretch that begins before, or ends up to, each word
            before = np.cumsum(np.bincount(x.ds + 1, minlength=n + 2)).astype(np.int32)
            upto = np.cumsum(np.bincount(x.de, minlength=n + 2)).astype(np.int32)
            rank = (full >> U(_PLACE) << U(_PLACE)) | (np.arange(len(full)).astype(U) & U((1 << _PLACE) - 1))
            self.levels.append((full, x.s, before, upto, rank))

    def pick(self, rounds: int, w: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(windows, symbol, place): of each window its first word, the symbol it picks and that symbol's place.

        w: the first words of the windows in question, by default of all within a row. A window without a symbol (inside
        a long run) is its own.
        """
        w = self.all if w is None else w
        symbol, at = self.one[w], w.copy()
        todo = np.arange(len(w))
        for full, starts, before, upto, rank in reversed(self.levels[:rounds]):
            lo, hi = before[w[todo]], upto[w[todo] + self.size]
            some = hi > lo
            found = todo if some.all() else todo[some]
            if len(found):
                best = (_least(rank, lo[some], hi[some]) & U((1 << _PLACE) - 1)).astype(np.int64)
                symbol[found], at[found] = full[best], starts[best]
            todo = todo[~some]
            if not len(todo):
                break
        return w, symbol, at


def pick(h: np.ndarray, bounds: np.ndarray, size: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What all windows of some texts pick; see `Picker`."""
    return Picker(h, bounds, size, rounds).pick(rounds)


@dataclass
class Anchors:
    """Symbols picked: the row, the symbol, the windows first..last that picked it, and a hash of their whole stretch."""

    row: np.ndarray
    symbol: np.ndarray
    first: np.ndarray
    last: np.ndarray
    block: np.ndarray


def anchors(h: np.ndarray, bounds: np.ndarray, size: int, w: np.ndarray, symbol: np.ndarray, at: np.ndarray) -> Anchors:
    """The stretches of windows w that picked a symbol at one place; h: the word hashes that the stretches are named by."""
    if not len(w):
        none = np.zeros(0, np.int64)
        return Anchors(none, none.astype(U), none, none, none.astype(U))
    row = np.searchsorted(bounds, w, "right") - 1
    new = np.ones(len(w), bool)
    new[1:] = (symbol[1:] != symbol[:-1]) | (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (w[1:] != w[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.concatenate([a[1:], [len(w)]]) - 1
    begin, end = w[a], w[b] + size
    block = mix(_stretch(_prefix(h), begin, end) + (at[a] - begin).astype(U) * _STEP + (end - begin).astype(U) * U(0xC2B2AE3D27D4EB4F))
    return Anchors(row[a], symbol[a], w[a], w[b], block)


# ------------------------------------------------------------------ groups

def _cat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _by_fragment(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each fragment's entries begin and end in an order by fragment."""
    start = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else np.zeros(0, np.int64)
    return start, np.append(start[1:], len(f))


def _answers(table: pa.Table, kind: int) -> bytes:
    """The answers of one kind to a group, in the order of fragments."""
    if not table.num_rows:
        return b""
    here = np.flatnonzero(table.column("kind").to_numpy() == kind)
    order = here[np.argsort(table.column("f").to_numpy()[here], kind="stable")]
    data = table.column("data")
    return b"".join(data[int(k)].as_py() for k in order)


def _bits(table: pa.Table, kind: int, f: np.ndarray) -> np.ndarray:
    """Answers of one bit, which are padded to bytes for each fragment."""
    raw = np.unpackbits(np.frombuffer(_answers(table, kind), np.uint8)).astype(bool)
    a, b = _by_fragment(f)
    width = -(-(b - a) // 8) * 8
    at = np.cumsum(width) - width
    return raw[np.repeat(at - a, b - a) + np.arange(len(f))] if len(f) else np.zeros(0, bool)


class Group:
    """The documents of a group and what the rounds so far have said of them."""

    def __init__(self, texts: pa.Table, answers: pa.Table, size: int, fragments: int):
        self.size, self.fragments, self.answers = size, fragments, answers
        self.ids = texts.column("_id").to_numpy()
        self.parts: list[tuple[int, Words, np.ndarray]] = []
        raw, offsets = text_buffers(texts.column("_text"))
        for a, b in chunks(offsets):
            w = Words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            self.parts.append((a, w, w.hashes()))

    def picked(self, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(windows, symbols, places) of each part in round k: those that all rounds before left in question."""
        pickers = [Picker(h, w.bounds, self.size, min(k + 1, ROUNDS)) for _, w, h in self.parts]
        out = [p.pick(1) for p in pickers]
        for j in range(k):
            names, _ = self.names(out)
            shared = _bits(self.answers, j, (names >> U(32)).astype(np.int64))
            kept = []
            for (w, symbol, at), p in zip(out, pickers):
                # neighbours mostly picked the same: each run of them is looked up once
                new = np.ones(len(w), bool)
                new[1:] = symbol[1:] != symbol[:-1]
                stay = shared[np.searchsorted(names, place(symbol[new], self.fragments))] if len(w) else np.zeros(0, bool)
                stay = stay[np.cumsum(new) - 1]
                w, symbol, at = w[stay], symbol[stay], at[stay]
                kept.append(p.pick(j + 2, w) if j + 1 < ROUNDS else (w, symbol, at))
            out = kept
        return out

    def names(self, picks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Fragment and fingerprint of the symbols picked, and how many documents of the group have each."""
        both = []
        for (w, symbol, _), (a, words, _) in zip(picks, self.parts):
            row = np.searchsorted(words.bounds, w, "right") - 1 + a
            new = np.ones(len(w), bool)
            new[1:] = (symbol[1:] != symbol[:-1]) | (row[1:] != row[:-1])
            both.append(np.stack([place(symbol[new], self.fragments), row[new].astype(U)]))
        key, row = np.concatenate(both, 1) if both else np.zeros((2, 0), U)
        order = np.argsort(key, kind="stable")  # rows are in order already
        key, row = key[order], row[order]
        once = np.ones(len(key), bool)
        once[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        return np.unique(key[once], return_counts=True)

    def anchors(self) -> list[Anchors]:
        self.second = [w.hashes(71) for _, w, _ in self.parts]
        return [anchors(h, words.bounds, self.size, *p) for p, (_, words, _), h in zip(self.picked(ROUNDS), self.parts, self.second)]

    def windows_of(self, k: int, an: Anchors, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(window, row, key, key) of all windows of the given anchors of part k; the keys come from independent word hashes."""
        a, words, h = self.parts[k]
        n = an.last[which] - an.first[which] + 1
        at = np.repeat(an.first[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return at, np.repeat(an.row[which], n) + a, windows(h, words.bounds, self.size, seed=1)[0][at], windows(self.second[k], words.bounds, self.size, seed=2)[0][at]


def _entries(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, and the smallest document of each."""
    order = np.lexsort((doc, k2, k1))
    k1, k2, doc = k1[order], k2[order], doc[order]
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    return k1[new], k2[new], doc[new]


def _where(known: tuple[np.ndarray, np.ndarray], k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """The index of each key among known ones, which hold all of them in order."""
    a1, a2 = known
    pair = np.dtype([("a", "<u8"), ("b", "<u8")])
    table, wanted = np.empty(len(a1), pair), np.empty(len(k1), pair)
    table["a"], table["b"], wanted["a"], wanted["b"] = a1, a2, k1, k2
    both, which = np.unique(np.concatenate([table, wanted]), return_inverse=True)
    at = np.zeros(len(both), np.int64)
    at[which[:len(table)]] = np.arange(len(table))
    return at[which[len(table):]]


_SENT = "f bigint, g bigint, block binary"
_BACK = "g bigint, kind int, f bigint, data binary"


def _blocks(group: int, f: np.ndarray, pack_one) -> pa.Table:
    a, b = _by_fragment(f)
    return pa.table({"f": pa.array(f[a].astype(np.int64)), "g": pa.array(np.full(len(a), group, np.int64)), "block": pa.array([pack_one(x, y) for x, y in zip(a, b)], pa.binary())})


def _name_of(table: pa.Table) -> int:
    return table.column("_g")[0].as_py()


# ------------------------------------------------------------------ on DataFrames

def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without an id: their words are counted and kept."""
    for batch in batches:
        words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([0] * len(words), pa.int64()), pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string())],
                                         names=["id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """Per row: the id, n_words, n_removed and kept_text (the kept words with one space between).

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes if a window of `size` words over it also starts in a document
    with a smaller id; all windows are judged on the input. Null and empty texts have no words. The id is an integer;
    a row with a null id loses nothing and takes nothing from others; rows that repeat an id take nothing from each
    other. Other columns are not read; an empty table gives an empty result.
    """
    arrow_rows(docs.sparkSession, 2000)
    parts = parallelism(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    groups, fragments = max(1, -(-total // GROUP_BYTES)), max(1, -(-total // FRAGMENT_BYTES))
    # rows that repeat an id are spread by their texts
    dealt = rows.filter("_id is not null").select(F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).alias("_g"), "_id", "_text").repartition(parts, "_g").groupBy("_g")

    def name(k: int):
        def send(texts: pa.Table, answers: pa.Table) -> pa.Table:
            if not texts.num_rows:
                return _blocks(0, np.zeros(0, np.int64), None)
            group = Group(texts, answers, size, fragments)
            names, docs_of = group.names(group.picked(k))
            return _blocks(_name_of(texts), (names >> U(32)).astype(np.int64), lambda x, y: pack(names[x:y].astype(np.uint32), docs_of[x:y]))
        return send

    def shared(k: int):
        def add(table: pa.Table) -> pa.Table:
            found = [unpack(b) for b in table.column("block").to_pylist()]
            r, times = np.concatenate([x for x, _ in found]), np.concatenate([t for _, t in found])
            _, which = np.unique(r, return_inverse=True)
            more = (np.bincount(which, times) >= 2)[which]
            data = [np.packbits(x).tobytes() for x in np.split(more, np.cumsum([len(x) for x, _ in found])[:-1])]
            return _reply(table, k, data)
        return add

    def _reply(table: pa.Table, kind: int, data: list[bytes]) -> pa.Table:
        return pa.table({"g": table.column("g"), "kind": pa.array([kind] * len(data), pa.int32()), "f": table.column("f"), "data": pa.array(data, pa.binary())})

    def place_of(k1: np.ndarray) -> np.ndarray:
        return (place(k1, fragments) >> U(32)).astype(np.int64)

    def sent(texts: pa.Table, keys: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Table:
        k1, k2, lo = keys
        return _blocks(_name_of(texts), place_of(k1), lambda x, y: k1[x:y].tobytes() + k2[x:y].tobytes() + np.diff(lo[x:y], prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())

    def received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        k1, k2, lo = [], [], []
        for block in table.column("block").to_pylist():
            n = len(block) // 24
            k1.append(np.frombuffer(block, "<u8", n))
            k2.append(np.frombuffer(block, "<u8", n, 8 * n))
            lo.append(np.cumsum(np.ascontiguousarray(np.frombuffer(block, np.uint8, 8 * n, 16 * n).reshape(8, n).T).view("<i8").ravel()))
        return np.concatenate(k1), np.concatenate(k2), np.concatenate(lo), np.cumsum([len(x) for x in k1])[:-1].tolist()

    def owners(kind: int):
        """Of each key the smallest document, as what to add to the group's own; for stretches, whether the symbol has others."""
        def add(table: pa.Table) -> pa.Table:
            k1, k2, lo, cuts = received(table)
            order = np.lexsort((lo, k2, k1))
            s1, s2 = k1[order], k2[order]
            new = np.ones(len(order), bool)
            new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
            which = np.cumsum(new) - 1
            owner = np.empty(len(order), np.int64)
            owner[order] = lo[order][new][which]
            data = [np.ascontiguousarray(x.astype("<i8")).tobytes() for x in np.split(owner - lo, cuts)]
            if kind == ROUNDS:
                first = np.ones(len(order), bool)
                first[1:] = s1[1:] != s1[:-1]
                symbol = np.cumsum(first) - 1
                many = np.empty(len(order), bool)
                many[order] = (np.bincount(symbol, new) > 1)[symbol]
                data = [d + m.astype(np.uint8).tobytes() for d, m in zip(data, np.split(many, cuts))]
            return _reply(table, kind, data)
        return add

    def stretch_keys(group: Group, found: list[Anchors]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _entries(_cat([an.symbol for an in found], U), _cat([an.block for an in found], U), _cat([group.ids[an.row + a] for an, (a, _, _) in zip(found, group.parts)], np.int64))

    def stretches(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _blocks(0, np.zeros(0, np.int64), None)
        group = Group(texts, answers, size, fragments)
        return sent(texts, stretch_keys(group, group.anchors()))

    def judged(group: Group) -> tuple[list[Anchors], list[np.ndarray], list[np.ndarray]]:
        """The anchors; which are repeated as a whole; which have to be looked at window by window."""
        found = group.anchors()
        k1, k2, lo = stretch_keys(group, found)
        a, b = _by_fragment(place_of(k1))
        raw, at, owner, many = _answers(group.answers, ROUNDS), 0, [], []
        for n in (b - a).tolist():
            owner.append(np.frombuffer(raw, "<i8", n, at))
            many.append(np.frombuffer(raw, np.uint8, n, at + 8 * n))
            at += 9 * n
        owner, many = _cat(owner, np.int64) + lo, _cat(many, np.uint8).astype(bool)
        full, alone = [], []
        for an, (first, _, _) in zip(found, group.parts):
            i = _where((k1, k2), an.symbol, an.block)
            full.append(owner[i] < group.ids[an.row + first])
            alone.append(~full[-1] & many[i])
        return found, full, alone

    def window_keys(group: Group, found: list[Anchors], alone: list[np.ndarray]) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        each = [group.windows_of(k, an, np.flatnonzero(which)) for k, (an, which) in enumerate(zip(found, alone))]
        return each, _entries(_cat([x[2] for x in each], U), _cat([x[3] for x in each], U), _cat([group.ids[x[1]] for x in each], np.int64))

    def ends(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _blocks(0, np.zeros(0, np.int64), None)
        group = Group(texts, answers, size, fragments)
        found, _, alone = judged(group)
        return sent(texts, window_keys(group, found, alone)[1])

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        n_words, n_removed, kept = [], [], []
        if texts.num_rows:
            group = Group(texts, answers, size, fragments)
            found, full, alone = judged(group)
            each, (k1, k2, lo) = window_keys(group, found, alone)
            owner = np.frombuffer(_answers(answers, ROUNDS + 1), "<i8") + lo
            for (a, w, _), an, whole, (at, row, one, two) in zip(group.parts, found, full, each):
                gone = np.zeros(len(w) + 1, np.int64)
                np.add.at(gone, an.first[whole], 1)
                np.add.at(gone, an.last[whole] + size, -1)
                at = at[owner[_where((k1, k2), one, two)] < group.ids[row]]
                np.add.at(gone, at, 1)
                np.add.at(gone, at + size, -1)
                stay = np.cumsum(gone[:-1]) == 0
                data, bounds = w.raw.tobytes(), w.bounds
                lost = np.concatenate([[0], np.cumsum(~stay)])[bounds]
                for k in range(len(bounds) - 1):
                    words = data[w.offsets[k]:w.offsets[k + 1]].split()
                    if lost[k + 1] > lost[k]:
                        words = [x for x, ok in zip(words, stay[bounds[k]:bounds[k + 1]].tolist()) if ok]
                    kept.append(b" ".join(words))
                n_words += np.diff(bounds).tolist()
                n_removed += np.diff(lost).tolist()
        return pa.table([texts.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept_text"])

    def asked(send, add, known: DataFrame | None) -> DataFrame:
        """All answers that a group has after this round."""
        if known is None:
            blocks = dealt.applyInArrow(lean_groups(lambda texts: send(texts, texts.slice(0, 0))), _SENT)
        else:
            blocks = dealt.cogroup(known.groupBy("g")).applyInArrow(lean_groups(send), _SENT)
        new = blocks.groupBy("f").applyInArrow(lean_groups(add), _BACK)
        return new if known is None else known.union(new)

    known = None
    for k in range(ROUNDS):
        known = asked(name(k), shared(k), known)
    known = asked(stretches, owners(ROUNDS), known)
    known = asked(ends, owners(ROUNDS + 1), known)
    out = "id bigint, n_words bigint, n_removed bigint, kept_text string"
    result = dealt.cogroup(known.groupBy("g")).applyInArrow(lean_groups(cut), out).union(rows.filter("_id is null").mapInArrow(lean(_alone), out))
    return result.select(F.col("id").cast(id_type).alias(id_col), "n_words", "n_removed", "kept_text")
