"""Benchmark decontamination with spaced seeds.

Test items and documents are word sequences (lower case; white space and punctuation separate words). A seed is a fixed
mask of word positions: words at other positions may differ. The hashes of every document position under every mask are
joined with the hashes of the test items; each hit fixes an item and a diagonal, and the words along that diagonal are
compared. An overlap is a stretch in which every window of `MIN_WORDS` words has at most three substituted ones; of an
item with fewer words the whole, with three substitutions in thirteen words allowed in proportion (rounded down).

The masks find every window of 13 words with up to three substituted words (a test tries all of them). A shorter item is
cut into one piece more than it may have substitutions: one of them is intact, and the pieces are its seeds. So no
overlap is missed.

Test sets of up to `BLOCK_BYTES` of text, whose size is looked at first, are prepared once and broadcast: one pass over
the documents without a shuffle. Larger ones are joined by seed in Spark, and the pairs found are verified on both texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U, Words, arrow_rows, chunks, lean, mix, odd_keys, text_buffers, unquoted
from .toxicity import _EDGE

#: Positions that a seed looks at: of windows of 13 words, then the pieces of shorter items.
LONG = ((0, 1, 2, 4, 5), (0, 1, 6, 8, 9), (0, 1, 3, 4, 5))
PIECES = tuple(tuple(range(k)) for k in range(1, 5))
MASKS = LONG + PIECES
MIN_WORDS = 13
#: Equal words in a window of MIN_WORDS: up to three may be substituted.
LEAST_EQUAL = MIN_WORDS - 3
#: Test text that is prepared and broadcast as a whole.
BLOCK_BYTES = 4 << 20
#: Tasks over which documents of one text, or of one seed, are spread.
SALTS = 8


def allowed(size: int) -> int:
    """Words that may be substituted in an item of fewer than MIN_WORDS words."""
    return (MIN_WORDS - LEAST_EQUAL) * size // MIN_WORDS


def _words(texts: pa.Array | pa.ChunkedArray) -> Words:
    raw, offsets = text_buffers(pc.utf8_lower(texts))
    return Words(unquoted(raw), offsets, space=_EDGE)


def _hashed(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    x = np.zeros(len(at), U)
    for m, key in zip(MASKS[k], odd_keys(len(MASKS[k]), 90 + k)):
        x += h[at + m] * key
    return mix(x + U(k))


def _seeds(h: np.ndarray, bounds: np.ndarray, masks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, hash) of the seeds of each of the masks that lie within one row."""
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    for k in masks:
        at = np.flatnonzero(np.arange(len(h)) + MASKS[k][-1] + 1 <= row_end)
        yield at, _hashed(h, at, k)


def _item_seeds(h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(mask, position, hash) of test items: all positions of long ones, the pieces of short ones."""
    size = np.diff(bounds)
    row_end = np.repeat(bounds[1:], size)
    long = np.repeat(size >= MIN_WORDS, size)
    for k in range(len(LONG)):
        at = np.flatnonzero(long & (np.arange(len(h)) + MASKS[k][-1] + 1 <= row_end))
        yield k, at, _hashed(h, at, k)
    pieces: dict[int, list[int]] = {}
    for row in np.flatnonzero((size > 0) & (size < MIN_WORDS)).tolist():
        cuts = np.linspace(0, size[row], allowed(int(size[row])) + 2).round().astype(int)
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pieces.setdefault(len(LONG) + y - x - 1, []).append(int(bounds[row]) + x)
    for k, at in sorted(pieces.items()):
        yield k, np.array(at), _hashed(h, np.array(at), k)


@dataclass
class Tests:
    """A block of test items: their words' hashes and, sorted, their seeds."""

    ids: list
    words: np.ndarray
    bounds: np.ndarray
    keys: np.ndarray
    where: np.ndarray
    filter: np.ndarray
    masks: list[int]


def prepare(ids: list, texts: list[str | None]) -> Tests:
    w = _words(pa.array(texts, pa.string()))
    h = w.hashes()
    found = [x for x in _item_seeds(h, w.bounds) if len(x[1])]
    where = np.concatenate([a for _, a, _ in found]) if found else np.zeros(0, np.int64)
    keys = np.concatenate([k for _, _, k in found]) if found else np.zeros(0, U)
    order = np.argsort(keys, kind="stable")
    bits = np.zeros(1 << min(24, max(10, int(16 * len(keys)).bit_length())), bool)
    bits[(keys & U(len(bits) - 1)).astype(np.int64)] = True
    return Tests(ids, h, w.bounds, keys[order], where[order], bits, sorted({k for k, _, _ in found}))


def overlaps(w: Words, t: Tests) -> list[tuple[int, int, int, int, int, int]]:
    """(row, item, first word in the row, first word in the item, words, equal words) of each verified overlap."""
    if not len(t.keys):
        return []
    h = w.hashes()
    hits = [np.zeros((0, 2), np.int64)]
    for at, key in _seeds(h, w.bounds, t.masks):
        some = np.flatnonzero(t.filter[(key & U(len(t.filter) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(t.keys, key[some]), np.searchsorted(t.keys, key[some], "right")
        n = hi - lo
        first = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hits.append(np.stack([np.repeat(at[some], n), t.where[first]], 1))
    both = np.concatenate(hits)
    if not len(both):
        return []
    row_of = np.searchsorted(w.bounds, both[:, 0], "right") - 1
    item_of = np.searchsorted(t.bounds, both[:, 1], "right") - 1
    diagonal = (both[:, 0] - w.bounds[row_of]) - (both[:, 1] - t.bounds[item_of])
    out = []
    for row, item, d in np.unique(np.stack([row_of, item_of, diagonal], 1), axis=0).tolist():
        a, b = w.bounds[row], t.bounds[item]
        size = int(t.bounds[item + 1] - b)
        begin, end = max(0, -d), min(size, int(w.bounds[row + 1] - a) - d)
        same = h[a + d + begin:a + d + end] == t.words[b + begin:b + end]
        if size < MIN_WORDS:
            if len(same) == size and same.sum() >= size - allowed(size):
                out.append((row, item, d, 0, size, int(same.sum())))
            continue
        total = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(total[MIN_WORDS:] - total[:-MIN_WORDS] >= LEAST_EQUAL) if len(same) >= MIN_WORDS else np.zeros(0, int)
        if len(good):  # windows that overlap or touch make one stretch; each stretch is an overlap
            cuts = np.flatnonzero(np.diff(good) > MIN_WORDS)
            for x, y in zip(good[np.concatenate([[0], cuts + 1])].tolist(), good[np.concatenate([cuts, [len(good) - 1]])].tolist()):
                out.append((row, item, d + begin + x, begin + x, y + MIN_WORDS - x, int(total[y + MIN_WORDS] - total[x])))
    return out


def _scan(texts: pa.Array, t: Tests) -> list[tuple[int, int, int, int, int, int]]:
    raw, offsets = text_buffers(pc.utf8_lower(texts))
    return [(row + a, *rest) for a, b in chunks(offsets)
            for row, *rest in overlaps(Words(unquoted(raw[offsets[a]:offsets[b]]), offsets[a:b + 1] - offsets[a], space=_EDGE), t)]


def _small(tests: DataFrame) -> Tests | None:
    """The test items (_item, _text) prepared, if their text is within BLOCK_BYTES."""
    size = tests.agg(F.coalesce(F.sum(F.octet_length("_text") + 1), F.lit(0))).first()[0]
    if size > BLOCK_BYTES:
        return None
    rows = sorted(((r["_item"], r["_text"]) for r in tests.filter("_text <> ''").collect()), key=lambda x: (x[0] is None, x[0], x[1]))
    return prepare([i for i, _ in rows], [t for _, t in rows])


_SPAN = "doc_start bigint, item_start bigint, n_words bigint, n_equal bigint, item_words bigint"


def _joined(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """(_dk, _ik, spans) of distinct document texts and distinct item texts that overlap, by a join on seeds.

    docs: _dk, _text; tests: _ik, _text, one row for each text.
    """
    def seeds(of_items: bool, key: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = _words(batch.column(1))
                h = w.hashes()
                found = [(a, k) for _, a, k in _item_seeds(h, w.bounds)] if of_items else list(_seeds(h, w.bounds, range(len(MASKS))))
                row = np.searchsorted(w.bounds, np.concatenate([a for a, _ in found]), "right") - 1
                pair = np.unique(np.stack([row.astype(np.int64), np.concatenate([k for _, k in found]).view(np.int64)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(pair[:, 0])), pa.array(pair[:, 1])], names=[key, "seed"])
        return run

    left = docs.mapInArrow(lean(seeds(False, "_dk")), "_dk binary, seed bigint").withColumn("_s", F.pmod(F.xxhash64("_dk"), F.lit(SALTS)).cast("int"))
    right = tests.mapInArrow(lean(seeds(True, "_ik")), "_ik binary, seed bigint").withColumn("_s", F.explode(F.array(*(F.lit(k) for k in range(SALTS)))))
    pairs = left.join(right, ["seed", "_s"]).select("_dk", "_ik").distinct()
    both = pairs.join(docs.withColumnRenamed("_text", "_doc"), "_dk").join(tests.withColumnRenamed("_text", "_test"), "_ik").select("_dk", "_ik", "_doc", "_test")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans = [], []
            for k, (text, item) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                t = prepare([0], [item])
                for _, _, *numbers in _scan(pa.array([text], pa.string()), t):
                    at.append(k)
                    spans.append([*numbers, int(t.bounds[1])])
            columns = list(zip(*spans)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in columns)],
                                             names=["_dk", "_ik", "doc_start", "item_start", "n_words", "n_equal", "item_words"])

    return both.mapInArrow(lean(verify), f"_dk binary, _ik binary, {_SPAN}")


def _key(column: str):
    return F.unhex(F.sha2(column, 256))


def _distinct(frame: DataFrame, key: str) -> DataFrame:
    return frame.filter("_text <> ''").groupBy(_key("_text").alias(key)).agg(F.first("_text").alias("_text"))


def find_overlaps(docs: DataFrame, tests: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each verified overlap: the document's id, the item's id, doc_start, item_start, n_words, n_equal, item_words.

    Starts and lengths count words. An item that is found twice, or in parts, gives a row for each. Null and empty texts
    on either side overlap with nothing; items of any length are looked for, those of one to four words as they are.
    Documents or items that repeat an id, or have none, give rows of their own. If both id columns have one name, the
    item's is called `item_<name>`. Other columns are not read; empty tables give an empty result.
    """
    arrow_rows(docs.sparkSession, 1000)
    spark = docs.sparkSession
    out_item = item_col if item_col != id_col else f"item_{item_col}"
    frame = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    items = tests.select(F.col(f"`{item_col}`").alias("_item"), F.col(f"`{item_text_col}`").alias("_text"))
    numbers = [x.split()[0] for x in _SPAN.split(", ")]
    small = _small(items)
    if small is not None:
        sent = spark.sparkContext.broadcast(pickle.dumps(small))
        place = spark.createDataFrame([(k, i) for k, i in enumerate(small.ids)], f"_place bigint, _item {items.schema['_item'].dataType.simpleString()}")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pickle.loads(sent.value)
            for batch in batches:
                if found := _scan(batch.column(1), t):
                    rows, which, *rest = map(list, zip(*found))
                    sizes = [int(t.bounds[i + 1] - t.bounds[i]) for i in which]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (which, *rest, sizes))], names=["_id", "_place", *numbers])

        # the items' ids are as bounded as the items
        named = frame.mapInArrow(lean(run), f"_id {frame.schema['_id'].dataType.simpleString()}, _place bigint, {_SPAN}").join(F.broadcast(place), "_place")
    else:
        keyed = items.filter("_text <> ''").select("_item", _key("_text").alias("_ik"))
        found = _joined(_distinct(frame, "_dk"), _distinct(items, "_ik"))
        held = frame.filter("_text <> ''").select("_id", _key("_text").alias("_dk"), F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_s"))
        named = held.join(found.withColumn("_s", F.explode(F.array(*(F.lit(k) for k in range(SALTS))))), ["_dk", "_s"]).join(keyed, "_ik")
    return named.select(F.col("_id").alias(id_col), F.col("_item").alias(out_item), *numbers)


def best_overlaps(docs: DataFrame, tests: DataFrame, *, id_col: str = "doc_id", item_col: str = "item_id", **names) -> DataFrame:
    """Of each document id and item id the overlap with the most equal words; the first in the document if several have.

    Rows that repeat an id count as one document (or item), rows without an id too.
    """
    found = find_overlaps(docs, tests, id_col=id_col, item_col=item_col, **names)
    w = Window.partitionBy(*found.columns[:2]).orderBy(F.desc("n_equal"), "doc_start", "item_start", "n_words")
    return found.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def drop_contaminated(docs: DataFrame, tests: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that overlap with no test item, with all their columns; null and empty texts stay."""
    arrow_rows(docs.sparkSession, 1000)
    spark, names = docs.sparkSession, docs.columns
    items = tests.select(F.col(f"`{item_col}`").alias("_item"), F.col(f"`{item_text_col}`").alias("_text"))
    small = _small(items)
    if small is None:
        found = _joined(_distinct(docs.select(F.col(f"`{text_col}`").alias("_text")), "_dk"), _distinct(items, "_ik")).select("_dk").distinct()
        every = found.select(F.col("_dk").alias("_gone"), F.explode(F.array(*(F.lit(k) for k in range(SALTS)))).alias("_spread"))
        own = F.pmod(F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString())), F.lit(SALTS)).cast("int")
        return docs.join(every, (_key(f"`{text_col}`") == F.col("_gone")) & (own == F.col("_spread")), "left_anti")
    at, sent = names.index(text_col), spark.sparkContext.broadcast(pickle.dumps(small))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pickle.loads(sent.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[x[0] for x in _scan(batch.column(at), block)]] = False
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(lean(run), docs.schema)
