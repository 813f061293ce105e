"""SentencePiece models on the tokenizers library.

The model file is parsed here (a small protobuf reader, no sentencepiece needed), and the parts are rebuilt: the
normaliser (precompiled character map, white-space removal, dummy prefix), the metaspace marker, unigram scores or the
merges that a BPE model's scores imply, and byte fallback. Where no piece has a marker behind another character, a text
falls into segments that no piece crosses; each distinct segment is then encoded once by the library's threads and the
results are put together by array operations. Words are told apart by 64-bit hashes of their bytes and lengths.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers

from .common import Words, arrow_rows, chunks, lean, text_buffers

MARK = "▁"
# Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Words kept for later batches of the same worker; beyond it the cache starts anew, which changes no result.
CACHE = 250_000
#: Bytes of text that are encoded at once.
GROUP_BYTES = 1 << 20
#: Segments handed to the library at once.
SEGMENTS = 20_000


# ------------------------------------------------------------------ the model file

def wire(data: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    """(field, value) of a protobuf message: ints for varints, bytes for strings and messages, floats for 32 bits."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at:at + n]
            at += n
        elif kind == 5:
            yield key >> 3, struct.unpack("<f", data[at:at + 4])[0]
            at += 4
        elif kind == 1:
            at += 8
        else:
            raise ValueError("not a SentencePiece model")


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False


def parse_model(data: bytes) -> Model:
    m = Model()
    for n, value in wire(data):
        if n == 1:
            f = dict(wire(value))
            m.pieces.append((f.get(1, b"").decode(), f.get(2, 0.0), f.get(3, NORMAL)))
        elif n == 2:
            f = dict(wire(value))
            m.kind, m.byte_fallback, m.suffix = f.get(3, UNIGRAM), bool(f.get(35, 0)), bool(f.get(24, 0))
        elif n == 3:
            f = dict(wire(value))
            m.charsmap, m.dummy_prefix, m.squeeze, m.escape = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
    if m.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if m.suffix:
        raise ValueError("models with the marker behind a word are not supported")
    return m


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, by the piece's score: what a BPE model's scores stand for."""
    vocab = {p for p, _, kind in pieces if kind in (NORMAL, USER)}
    order = sorted((i for i, x in enumerate(pieces) if x[2] in (NORMAL, USER) and len(x[0]) > 1), key=lambda i: -pieces[i][1])
    return [(p[:k], p[k:]) for p in (pieces[i][0] for i in order) for k in range(1, len(p)) if p[:k] in vocab and p[k:] in vocab]


def build(m: Model) -> Tokenizer:
    """A tokenizer of the library for texts whose spaces are marks already and that have their dummy prefix."""
    if m.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        core = models.BPE(vocab=vocab, merges=merges(m.pieces), unk_token=next((p for p, _, k in m.pieces if k == UNKNOWN), None), fuse_unk=True, byte_fallback=m.byte_fallback, cache_capacity=0)
    else:
        unk = next((i for i, x in enumerate(m.pieces) if x[2] == UNKNOWN), None)
        core = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=unk, byte_fallback=m.byte_fallback)
    t = Tokenizer(core)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence(steps)
    user = [AddedToken(p, normalized=False, special=False) for p, _, k in m.pieces if k == USER]
    if user:
        t.add_tokens(user)
    return t


class Processor:
    """Encodes and decodes batches of texts as the model file's own library does."""

    def __init__(self, data: bytes):
        # the library's threads: as many as the task's worker may use, two at least
        os.environ.setdefault("RAYON_NUM_THREADS", str(max(2, int(os.environ.get("OMP_NUM_THREADS") or 2))))
        self.model = parse_model(data)
        self.tokenizer = build(self.model)
        self.precompiled = normalizers.Precompiled(self.model.charsmap) if self.model.charsmap else None
        kinds = {k for _, _, k in self.model.pieces}
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _, k in self.model.pieces if k in (NORMAL, USER))
        #: whether texts can be cut before each run of marks
        self.cut = not crossing and USER not in kinds and self.model.escape
        self._forget()

    def _forget(self) -> None:
        #: of each word known: its hash (sorted), where its ids begin in the pool, how many, and whether they decode to it
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)
        self.pool = np.zeros(0, np.int32)

    def normalise(self, text: str) -> str:
        """The text as the model sees it, before spaces become marks."""
        m = self.model
        if self.precompiled is not None:
            text = self.precompiled.normalize_str(text)
        if m.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return text

    def _segments(self, text: str) -> list[str]:
        """Segments of the escaped text with its dummy prefix; they are its concatenation."""
        text = self.normalise(text)
        if not text:
            return []
        if self.model.escape:
            plain = (" " if self.model.dummy_prefix else "") + text
            text = plain.replace(" ", MARK)
        elif self.model.dummy_prefix:
            text = " " + text
        if not self.cut:
            return [text]
        if MARK + MARK not in text and text[0] == MARK and text[-1] != MARK:
            return [MARK + w for w in text[1:].split(MARK)]
        return [s for s in re.findall(f"{MARK}*[^{MARK}]*", text) if s]

    def _encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, whole) of segments, by the library's threads; whole: decoding the ids gives the segment back."""
        flat, sizes, whole = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for at in range(0, len(segments), SEGMENTS):
            some = segments[at:at + SEGMENTS]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
            whole.append(np.fromiter(map(eq, self._surface(ids), some), bool, len(some)))
        return np.concatenate(flat), np.concatenate(sizes), np.concatenate(whole)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, whole) of any texts: normalised, cut into segments, each distinct segment encoded once.

        Decoding acts on each segment alone, so a text is whole if its segments are.
        """
        parts = [self._segments(t) for t in texts]
        number = {s: k for k, s in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        flat, sizes, whole = self._encode(list(number))
        which = np.fromiter((number[s] for p in parts for s in p), np.int64, sum(map(len, parts)))
        return _gather(flat, np.cumsum(sizes) - sizes, sizes, whole, which, np.array([len(p) for p in parts], np.int64))

    def _encode_words(self, raw: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for texts that are words with one space between, by the hashes of the words."""
        kinds, first, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE:
            self._forget()
        i = np.searchsorted(self.keys, kinds)
        known = self.keys[np.minimum(i, len(self.keys) - 1)] == kinds if len(self.keys) else np.zeros(len(kinds), bool)
        if not known.all():
            new = first[~known]
            data = raw.tobytes()
            flat, sizes, whole = self._encode([MARK + data[a:b].decode() for a, b in zip(w.start[new].tolist(), w.end[new].tolist())])
            to = i[~known]
            self.keys = np.insert(self.keys, to, kinds[~known])
            self.at = np.insert(self.at, to, len(self.pool) + np.cumsum(sizes) - sizes)
            self.size, self.whole = np.insert(self.size, to, sizes), np.insert(self.whole, to, whole)
            self.pool = np.concatenate([self.pool, flat])
        return _gather(self.pool, self.at, self.size, self.whole, np.searchsorted(self.keys, kinds)[which], np.diff(w.bounds))

    def encode_batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, whole): ids of text i are ids[offsets[i]:offsets[i + 1]]; whole: they decode to its normal form."""
        raw, offsets = text_buffers(column)
        n = len(offsets) - 1
        plain = np.full(n, self.cut and self.model.dummy_prefix and not self.model.squeeze and self.precompiled is None)
        if plain.any() and len(raw):
            space = raw == 32
            odd = np.zeros(len(raw), bool)
            odd[1:] = space[1:] & space[:-1]
            odd[:-2] |= (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)
            some = np.diff(offsets) > 0
            odd[offsets[:-1][some]] |= space[offsets[:-1][some]]
            odd[offsets[1:][some] - 1] |= space[offsets[1:][some] - 1]
            plain &= np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) == 0
        results = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool))] * 2
        if plain.all():
            results[0] = self._encode_words(raw, Words(raw, offsets, space=_SPACE))
        else:
            inside = pa.array(column).filter(pa.array(plain))
            own, at = text_buffers(inside)
            results[0] = self._encode_words(own, Words(own, at, space=_SPACE))
            results[1] = self.encode_texts([t or "" for t in column.filter(pa.array(~plain)).to_pylist()])
        if plain.all():
            ids, sizes, whole = results[0]
        else:
            sizes, whole = np.zeros(n, np.int64), np.zeros(n, bool)
            for (_, s, ok), rows in zip(results, (plain, ~plain)):
                sizes[rows], whole[rows] = s, ok
            ids = np.zeros(int(sizes.sum()), np.int32)
            line = np.repeat(plain, sizes)
            ids[line], ids[~line] = results[0][0], results[1][0]
        return ids, np.concatenate([[0], np.cumsum(sizes)]), whole

    def _surface(self, ids: list[list[int]]) -> list[str]:
        """What the library decodes for the ids of whole segments, with marks."""
        return [x.replace(" ", MARK) if self.model.escape else x for x in self.tokenizer.decode_batch(ids, skip_special_tokens=False)]

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        """The texts that lists of ids stand for, without the dummy prefix."""
        texts = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [t.removeprefix(" ") for t in texts] if self.model.dummy_prefix else texts


# ------------------------------------------------------------------ on DataFrames

_SPACE = np.arange(256) == 32

_LOADED: dict[str, Processor] = {}


def _processor(data: bytes) -> Processor:
    key = hashlib.sha256(data).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Processor(data)
    return _LOADED[key]


def _gather(pool, at, size, whole, which, counts):
    """(ids, sizes, whole) of texts that are `counts` segments each; which: the number of each segment."""
    own = size[which]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    ids = pool[np.repeat(at[which] - (ends - own), own) + np.arange(total)]
    words = np.concatenate([[0], np.cumsum(counts)])
    damaged = np.concatenate([[0], np.cumsum(~whole[which])])[words]
    return ids, np.diff(np.concatenate([[0], ends])[words]), np.diff(damaged) == 0


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_tokens, token_ids, and whether decoding them gives the model's normal form of the text.

    Null and empty texts have no tokens and round trip. The model file (some MB at most) is read once on the driver
    and sent with the tasks. Other columns are not read. Rows that repeat an id give a row each; an empty table gives an
    empty result.
    """
    with open(model_path, "rb") as f:
        data = f.read()
    arrow_rows(docs.sparkSession, 1000)
    sent = docs.sparkSession.sparkContext.broadcast(data)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _processor(sent.value)
        for batch in batches:
            _, ends = text_buffers(batch.column(1))
            for a, b in chunks(ends, GROUP_BYTES):
                ids, offsets, same = p.encode_batch(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)), pa.array(same)],
                                                 names=[id_col, "n_tokens", "token_ids", "round_trip"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, n_tokens bigint, token_ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row: the id and the text that the token ids stand for; null or no ids give an empty text."""
    with open(model_path, "rb") as f:
        data = f.read()
    sent = tokens.sparkSession.sparkContext.broadcast(data)
    id_type = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _processor(sent.value)
        for batch in batches:
            texts = p.decode_batch([x or [] for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return tokens.select(id_col, ids_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, text string")
