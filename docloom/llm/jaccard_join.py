"""Exact n-gram Jaccard join by vertical partitioning.

Every document is the set of its distinct n-word shingles, named by 64-bit hashes; equal sets are one class from the
start. The space of shingles is cut vertically into fragments (ranges of the hash), and everything that is counted over
shingles is counted in each fragment separately:

1. Frequencies. Groups of sets (of bounded bytes) send each fragment one block: the fingerprints of their shingles,
   sorted, as differences. A fragment adds its blocks up and answers each with one byte a shingle: 0 for a shingle of
   one set only, else the logarithm of its frequency. Frequency, then hash, is the global order.
2. Prefixes. In any global order two sets with similarity t share a shingle among the first |x| - ceil(t |x|) + 1 of
   either. Shingles of one set only need no partner, so a set with fewer than ceil(t |x|) others is out: of unrelated
   texts almost all are. The rest send their prefix (shingle, size, position) and their segments, one for each fragment.
3. Representatives. Of the sets that hold a prefix shingle, those nearest its front are heads, one for each band of
   sizes; each set is paired with the heads that it shares most with. Components of the links found this way already
   hold the bulk of a group of near copies, in a number of pairs that is linear in the prefixes.
4. The rest. Only sets of different components are still paired, where a shared prefix shingle meets the length and
   position bound (1 + the words behind it must reach the overlap needed). A group that is one component by then pairs
   nothing.
5. Overlaps. For each pair and fragment the segments' common shingles are counted; the partial counts are summed for
   each pair and compared with the threshold in whole numbers.

A shingle's frequency travels with its rows, so that the rows of a hot one are split into blocks of about `HOT` on both
sides of every join, and a head with many members is sent to each block of them. Nothing that grows with the data is
broadcast or collected. Step 4 is quadratic only in sets that pass its bounds, are not similar to a common head, and
share shingles that are not rarer than 1 - t of either set: texts made of common phrases alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U, Words, arrow_rows, chunks, lean, lean_groups, materialize, pack, parallelism, place, signed, text_buffers, unpack, windows
from .components import components, spread_join

#: Bytes of text in a group, and shingles in a fragment when frequencies are counted: what one Python call holds.
GROUP_BYTES = 1 << 20
FRAGMENT_SHINGLES = 4 << 20
#: Bits of the hash that name the fragment in which a pair's overlap is counted.
SEGMENT_BITS = 2
#: A shingle that more sets hold is hot: its rows are split into blocks of this size.
HOT = 2048
#: Heads that a set is compared with before the exact rest.
HEADS = 2
#: Salts of the rows of one class.
SALTS = 16


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer than n words has one for its whole sequence."""
    w = Words(raw, offsets, lower=True)
    h = w.hashes()
    full, inside = windows(h, w.bounds, n, seed=4)
    short = [windows(h, w.bounds, k, seed=40 + k)[0] for k in range(1, n)]
    out = []
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(full[a:b - n + 1]))
        elif b > a:
            out.append(short[b - a - 1][a:a + 1].copy())
        else:
            out.append(np.zeros(0, U))
    return out


def sets_of(texts: pa.Array | pa.ChunkedArray, n: int) -> list[np.ndarray]:
    raw, offsets = text_buffers(texts)
    return [s for a, b in chunks(offsets) for s in shingle_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)]


def set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def document_sets(docs: DataFrame, *, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, n_shingles, sid, text) of each row: sid is null for an empty set, text is kept once for each set and task."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            sizes, ids, first = [], [], []
            for s in sets_of(batch.column(1), n):
                sid = set_id(s) if len(s) else None
                sizes.append(len(s))
                ids.append(sid)
                first.append(sid is not None and sid not in sent)
                if first[-1]:
                    sent.add(sid)
            text = pc.if_else(pa.array(first, pa.bool_()), batch.column(1), pa.scalar(None, batch.column(1).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), text], names=["id", "n_shingles", "sid", "text"])
            if len(sent) > 200_000:  # a text sent again is dropped later
                sent.clear()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {id_type}, n_shingles bigint, sid binary, text string")


# ------------------------------------------------------------------ frequencies by fragment

def frequency_code(times: np.ndarray) -> np.ndarray:
    """0 for one set, else 1 + eighths of an octave above two; a byte."""
    return np.where(times < 2, 0, np.minimum(1 + np.floor(8 * np.log2(np.maximum(times, 2) / 2)), 255)).astype(np.uint8)


def blocks_of(code: np.ndarray, hot: int) -> np.ndarray:
    """Into how many blocks of `hot` rows those of a shingle of this frequency are split."""
    return np.maximum(1, np.ceil(2.0 ** ((code.astype(float) + 8) / 8) / hot)).astype(np.int32)


def _distinct(table: pa.Table, n: int) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct sets of a group, in an order that depends on them alone."""
    own: dict[bytes, int] = {}
    for k, sid in enumerate(table.column("sid").to_pylist()):
        own.setdefault(sid, k)
    ids = sorted(own)
    return ids, sets_of(table.column("text").take(pa.array([own[x] for x in ids], pa.int64())), n)


def candidate_sets(rows: DataFrame, *, n: int, percent: int, hot: int = HOT) -> DataFrame:
    """Prefix rows (sid, n, token, pos, blocks) and segment rows (sid, n, f, grams) of sets that may have a partner.

    rows: `document_sets`, already written.
    """
    parts = parallelism(rows.sparkSession)
    texts = rows.filter("text is not null")
    size, shingles = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    groups, fragments = max(1, -(-size // GROUP_BYTES)), max(1, -(-shingles // FRAGMENT_SHINGLES))
    dealt = texts.select(F.pmod(F.xxhash64("sid"), F.lit(groups)).alias("_g"), "sid", "text").repartition(parts, "_g").groupBy("_g")

    def tally(table: pa.Table) -> pa.Table:
        _, sets = _distinct(table, n)
        code, times = np.unique(place(np.concatenate(sets), fragments), return_counts=True)
        f = (code >> U(32)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        ends = np.concatenate([start[1:], [len(f)]])
        r = code.astype(np.uint32)
        return pa.table({"f": f[start], "g": np.full(len(start), table.column("_g")[0].as_py(), np.int64), "block": pa.array([pack(r[a:b], times[a:b]) for a, b in zip(start, ends)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        found = [unpack(b) for b in table.column("block").to_pylist()]
        r, times = np.concatenate([x for x, _ in found]), np.concatenate([t for _, t in found])
        _, which = np.unique(r, return_inverse=True)
        code = frequency_code(np.bincount(which, times))[which]
        cuts = np.cumsum([len(x) for x, _ in found])[:-1]
        return pa.table({"g": table.column("g"), "f": table.column("f"), "codes": pa.array([c.tobytes() for c in np.split(code, cuts)], pa.binary())})

    blocks = dealt.applyInArrow(lean_groups(tally), "f bigint, g bigint, block binary")
    codes = blocks.groupBy("f").applyInArrow(lean_groups(add), "g bigint, f bigint, codes binary").withColumnRenamed("g", "_g")

    def prefixes(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sets = _distinct(left, n) if left.num_rows else ([], [np.zeros(0, U)])
        token, size = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(right.column("f").to_numpy())
        answers = right.column("codes").to_pylist()
        code = np.frombuffer(b"".join(answers[k] for k in order.tolist()), np.uint8)
        code = code[np.unique(place(token, fragments), return_inverse=True)[1]]
        live = np.bincount(owner, code > 0, len(size)).astype(np.int64)
        need = -(-percent * size // 100)
        use = (code > 0) & (live >= need)[owner]
        token, owner, code = token[use], owner[use], code[use]
        order = np.lexsort((token, code, owner))
        who = owner[order]
        first = np.searchsorted(who, np.arange(len(size)))
        pos = (size - live)[who] + np.arange(len(who)) - first[who] + 1
        front = pos <= (size - need)[who] + 1
        at, pos = order[front], pos[front]
        names = pa.array(ids, pa.binary())
        # a set without a shared shingle in its prefix was left out above; segments are sorted by shingle
        by = np.lexsort((token, owner))
        f = (token[by] >> U(64 - SEGMENT_BITS)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (owner[by][1:] != owner[by][:-1])])) if len(by) else np.zeros(0, np.int64)
        held = owner[by][start]
        grams = pa.ListArray.from_arrays(pa.array(np.append(start, len(by)), pa.int32()), pa.array(signed(token[by])))
        none, m = (lambda kind, k: pa.nulls(k, kind)), len(at)
        one = pa.table({"sid": names.take(pa.array(owner[at])), "n": pa.array(size[owner[at]].astype(np.int32)), "token": pa.array(signed(token[at])), "pos": pa.array(pos.astype(np.int32)),
                        "blocks": pa.array(blocks_of(code[at], hot)), "f": none(pa.int32(), m), "grams": none(pa.list_(pa.int64()), m)})
        m = len(start)
        two = pa.table({"sid": names.take(pa.array(held)), "n": pa.array(size[held].astype(np.int32)), "token": none(pa.int64(), m), "pos": none(pa.int32(), m),
                        "blocks": none(pa.int32(), m), "f": pa.array(f[start].astype(np.int32)), "grams": grams})
        return pa.concat_tables([one, two])

    return dealt.cogroup(codes.groupBy("_g")).applyInArrow(lean_groups(prefixes), "sid binary, n int, token bigint, pos int, blocks int, f int, grams array<bigint>")


# ------------------------------------------------------------------ pairs

def _salts(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def _own(sid: str) -> Column:
    return F.pmod(F.xxhash64(sid), F.col("blocks")).cast("int")


def _reachable(percent: int) -> str:
    """Length and position bound: this shared shingle, if it is the first, and all behind it suffice for the overlap."""
    return f"(1 + least(nx - px, ny - py)) * {100 + percent}L >= {percent}L * (nx + ny)"


def head_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny, blocks): each set with the heads that it shares most prefix shingles with."""
    banded = prefix.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent))))
    heads = banded.groupBy("token", "blocks", "band").agg(F.min(F.struct("pos", F.xxhash64("sid").alias("h"), "sid", "n")).alias("head"))
    # sizes of linked sets differ by one band at most (two, for the sake of rounding)
    heads = heads.select("token", _salts(F.col("blocks")).alias("salt"), "band", "head").select(
        "token", "salt", F.explode(F.array(*(F.col("band") + d for d in range(-2, 3)))).alias("band"), F.col("head.sid").alias("y"), F.col("head.n").alias("ny"), F.col("head.pos").alias("py"))
    members = banded.select("token", _own("sid").alias("salt"), "band", F.col("sid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), "blocks")
    met = members.join(heads, ["token", "salt", "band"]).filter("x <> y").filter(_reachable(percent))
    pairs = met.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.max("blocks").alias("blocks"), F.count(F.lit(1)).alias("shared"))
    return pairs.withColumn("_r", F.row_number().over(Window.partitionBy("x").orderBy(F.desc("shared"), "y"))).filter(F.col("_r") <= HEADS).drop("_r", "shared")


def other_pairs(prefix: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """(x, y, nx, ny, blocks): all pairs of sets of different components that a prefix shingle brings within reach."""
    rows = prefix.join(named, prefix.sid == named.node, "left").select("token", "sid", "n", "pos", "blocks", F.coalesce("label", "sid").alias("comp"))
    stats = rows.groupBy("token", "blocks").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min(F.struct("pos", "sid", "comp"))["comp"].alias("lead"))
    stats = stats.filter("c0 <> c1").select("token", "lead", _salts(F.col("blocks")).alias("salt"))
    mixed = rows.withColumn("salt", _own("sid")).join(stats, ["token", "salt"])
    # of each pair, one set is outside the lead's component: only those are held against all
    left = mixed.filter("comp <> lead").select("token", F.col("salt").alias("sx"), _salts(F.col("blocks")).alias("sy"), F.col("sid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("comp").alias("cx"), "blocks")
    right = mixed.select("token", _salts(F.col("blocks")).alias("sx"), F.col("salt").alias("sy"), F.col("sid").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("comp").alias("cy"), (F.col("comp") == F.col("lead")).alias("led"))
    met = left.join(right, ["token", "sx", "sy"]).filter("cx <> cy and (led or x < y)").filter(_reachable(percent))
    return met.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.max("blocks").alias("blocks"))


def links_of(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that are similar. Overlaps are counted in each fragment and summed for each pair."""
    units = pairs.withColumn("salt", _own("x"))
    xs = units.join(segments.select(F.col("sid").alias("x"), "f", F.col("grams").alias("gx")), "x")
    wanted = units.select("y", "blocks", "salt").distinct()
    ys = wanted.join(segments.select(F.col("sid").alias("y"), "f", F.col("grams").alias("gy")), "y")
    partial = xs.join(ys, ["y", "blocks", "salt", "f"]).select("x", "y", "nx", "ny", F.size(F.array_intersect("gx", "gy")).alias("both"))
    whole = partial.groupBy("x", "y").agg(F.sum("both").alias("both"), F.first("nx").alias("nx"), F.first("ny").alias("ny"))
    return whole.filter(f"both > 0 and 100 * both >= {percent} * (nx + ny - both)").select(F.col("x").alias("a"), F.col("y").alias("b"))


def split_sets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefix rows and segment rows of `candidate_sets`."""
    return sets.filter("token is not null").select("token", "sid", "n", "pos", "blocks"), sets.filter("token is null").select("sid", "f", "grams")


def set_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the sets that any link touches. sets: `candidate_sets`, already written."""
    prefix, segments = split_sets(sets)
    links = materialize(links_of(head_pairs(prefix, percent), segments, percent), "links")
    named = components(links)
    more = materialize(links_of(materialize(other_pairs(prefix, named, percent), "pairs"), segments, percent), "links")
    if more.isEmpty():
        return named
    # links between components, by their names: the components of these and the ones before make the whole
    names = named.withColumnRenamed("node", "n")
    outer = more.join(names, more.a == names.n, "left").select(F.coalesce("label", "a").alias("a"), "b").join(names, F.col("b") == names.n, "left").select("a", F.coalesce("label", "b").alias("b"))
    joined = components(outer)
    inner = named.union(joined.select("node", "node")).groupBy("node").agg(F.min("label").alias("label"))
    return materialize(spread_join(inner, joined.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "node").select("node", F.coalesce("top", "label").alias("label")), "names")


# ------------------------------------------------------------------ documents

def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85, hot: int = HOT) -> DataFrame:
    """Per row: the id, n_shingles and component_id, the smallest id that links reach.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z became lower case. Two documents link when 100 * |intersection| >=
    percent * |union| of their sets. Null, empty and blank texts have an empty set and are linked with nothing. Equal
    sets link. A null id is never the smallest: the component of rows without any id is null. Rows that repeat an id
    are documents of their own with one name. Other columns are not read; an empty table gives an empty result. Very
    long texts are read whole, one at a time.
    """
    arrow_rows(docs.sparkSession, 2000)
    rows = materialize(document_sets(docs, id_col=id_col, text_col=text_col, n=n), "rows")
    named = set_components(materialize(candidate_sets(rows, n=n, percent=percent, hot=hot), "sets"), percent)
    # rows of one set, and sets of one component, are combined by salt before they meet, and learn the result by salt
    salted = rows.select("id", "n_shingles", "sid", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    some = salted.filter("sid is not null").groupBy("sid", "salt").agg(F.min("id").alias("least"))
    classes = some.groupBy("sid").agg(F.min("least").alias("least")).join(named, F.col("sid") == F.col("node"), "left").select("sid", "label", "least")
    linked = classes.filter("label is not null")
    tops = linked.groupBy("label").agg(F.min("least").alias("top"))
    named_by = classes.filter("label is null").select("sid", F.col("least").alias("first")).union(spread_join(linked, tops, "label", "sid").select("sid", F.col("top").alias("first")))
    by_salt = some.select("sid", "salt").join(named_by, "sid")
    return salted.join(by_salt, ["sid", "salt"], "left").select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose id is the smallest of its component, with the columns of docs.

    Ids should be unique; rows without an id stay. See `jaccard_components`.
    """
    ids = jaccard_components(docs, id_col=id_col, text_col=text_col, n=n, percent=percent)
    gone = ids.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
