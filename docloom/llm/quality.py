"""Quality by pairwise ranking in the manner of Bradley and Terry.

A text's worth is a linear function of its features: style (kinds of characters, word lengths, repetition) and hashed
words and character n-grams, as logarithms of counts over the text's norm. That a better text is preferred to a worse one
has the probability sigmoid of the difference of their worths. The weights come from all preference pairs (each text of
label 1 against each of label 0) by the logistic loss on feature differences. The worth at the quantile that label 0 takes
of the training texts is the cut: scores are scaled so that it has score 0.3.

Every labelled text is learned from; nothing is sampled. Texts are packed into blocks of counts once. Each step of the fit
runs over all blocks twice: the worths of each class are gathered in fine bins, which stand for the other side of all
pairs, then the gradient is summed. Sums are whole numbers (fixed point), so their order does not matter.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, Words, arrow_rows, chunks, lean, materialize, mix, text_buffers

CUT = 0.3
#: The fit ends after so many steps, or when two in a row lower the loss by less than this share of it.
STEPS, GAIN = 60, 1e-4
#: Steps that the fit remembers for the curvature.
MEMORY = 10
#: Bins of worths lie between -REACH and REACH, so many for each unit; the mean of a bin stands for its texts, beyond REACH too.
REACH, FINE = 64, 32
#: Fractional bits of sums.
BITS = 24
#: Blocks of up to so many bytes in all are fitted on in the driver, larger ones in Spark, by the same steps.
DRIVER_BYTES = 16 << 20
#: Up to so many labels are broadcast to the texts; more are joined by a shuffle.
BROADCAST_LABELS = 500_000


def _kind(test) -> np.ndarray:
    return np.fromiter((test(c) for c in range(256)), bool, 256)


_KINDS = [
    _kind(lambda c: 65 <= c <= 90), _kind(lambda c: 97 <= c <= 122), _kind(lambda c: 48 <= c <= 57), _kind(lambda c: c >= 128),
    _kind(lambda c: c in b"#$%&*+=@\\^_`~<>{}[]/|"), _kind(lambda c: c in b".,;:!?"), _kind(lambda c: c == 10), _kind(lambda c: c in b"\"'()-"),
]
_CLASS = np.full(256, len(_KINDS), np.uint8)
for _k, _t in enumerate(_KINDS):
    _CLASS[_t] = _k
#: Class of the symbols that prose hardly has.
_SYMBOLS = 4
WIDTH = len(_KINDS) + 7
#: Hashed n-grams fall into so many buckets; a bucket is used if it tells the classes apart by so many standard errors.
BUCKETS = 1 << 16
STRENGTH = 4.0
#: Bytes of a character n-gram.
GRAM = 4


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Style of each text: shares of kinds of bytes, word lengths, repetition. Empty texts have zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH))
    size = np.maximum(np.diff(offsets), 1)
    step = len(_KINDS) + 1
    rows = np.repeat(np.arange(n, dtype=np.int64) * step, np.diff(offsets))
    out[:, :step - 1] = np.sqrt(np.bincount(rows + _CLASS[raw], minlength=n * step).reshape(n, step)[:, :-1] / size[:, None])
    w = Words(raw, offsets)
    count = np.diff(w.bounds)
    some = np.maximum(count, 1)
    if len(w):
        h, row, length = w.hashes(3), w.rows, w.end - w.start
        mean = np.bincount(row, length, n) / some
        square = np.bincount(row, length.astype(float) ** 2, n) / some
        same = np.concatenate([[False], (h[1:] == h[:-1]) & (row[1:] == row[:-1])])
        order = np.lexsort((h, row))
        hs, rs = h[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])]))
        runs = np.diff(np.concatenate([first, [len(hs)]]))
        distinct = np.bincount(rs[first], minlength=n)
        top = np.zeros(n)
        np.maximum.at(top, rs[first], runs)
        last = raw[w.end - 1]
        tail = np.bincount(row, _CLASS[last] == _SYMBOLS, n) / some
        k = len(_KINDS)
        out[:, k] = np.log1p(mean)
        out[:, k + 1] = np.log1p(np.sqrt(np.maximum(square - mean ** 2, 0)))
        out[:, k + 2] = np.sqrt(np.bincount(row, same, n) / some)
        out[:, k + 3] = np.where(count > 0, np.log(np.maximum(distinct, 1)) / np.log(some + 1.0), 0)
        out[:, k + 4] = np.where(count > 5, top / some, 0)
        out[:, k + 5] = np.sqrt(tail)
        out[:, k + 6] = np.log1p(count) / 10
    return out


def _counts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of each text's words and character n-grams (ASCII in lower case), by row."""
    w = Words(raw, offsets, lower=True)
    lanes = np.ndarray((len(raw),), "<u4", np.append(w.raw, np.zeros(4, np.uint8)), strides=(1,)).astype(U)
    row_of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    inside = np.arange(len(raw)) + GRAM <= np.repeat(offsets[1:], np.diff(offsets))
    key = np.concatenate([mix(lanes[inside] + U(1 << 40)), w.hashes(5)]) & U(BUCKETS - 1)
    both, count = np.unique(np.concatenate([row_of[inside], w.rows]) * BUCKETS + key.astype(np.int64), return_counts=True)
    return both // BUCKETS, both % BUCKETS, count


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of each text's words and character n-grams; each row has norm 1."""
    row, bucket, count = _counts(raw, offsets)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, len(offsets) - 1))
    return row, bucket, value / norm[row]


@dataclass
class Block:
    """Features of some texts: labels, style, and of row i the buckets and counts from ends[i - 1] to ends[i]."""

    y: np.ndarray
    style: np.ndarray
    ends: np.ndarray
    bucket: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> Block:
        row, bucket, count = _counts(raw, offsets)
        return cls(y.astype(np.uint8), features(raw, offsets), np.cumsum(np.bincount(row, minlength=len(y))), bucket.astype(np.uint16), count.astype(np.min_scalar_type(int(count.max(initial=0)))))

    def packed(self) -> list[bytes]:
        """Columns as bytes; buckets as differences in two planes, of which the upper is nearly all zeros."""
        steps = np.diff(self.bucket, prepend=np.uint16(0)).astype("<u2").view(np.uint8).reshape(-1, 2).T
        return [a.tobytes() for a in (self.y, self.style, self.ends.astype(np.int64), steps, self.count)]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Block:
        y, style, ends, steps = (np.frombuffer(b, t) for b, t in zip(parts, (np.uint8, np.float64, np.int64, np.uint8)))
        low, high = steps.reshape(2, -1).astype(np.uint16)
        bucket = np.cumsum(low | (high << np.uint16(8)), dtype=np.uint16)
        return cls(y, style.reshape(-1, WIDTH), ends, bucket, np.frombuffer(parts[4], f"u{max(len(parts[4]) // max(len(bucket), 1), 1)}"))

    def __post_init__(self) -> None:
        size = np.diff(self.ends, prepend=0)
        self.some = np.flatnonzero(size > 0)
        self.size, self.start = size[self.some], self.ends[self.some] - size[self.some]

    @cached_property
    def value(self) -> np.ndarray:
        most = int(self.count.max(initial=0))
        return np.log1p(np.arange(most + 1)).take(self.count) if most < 1 << 16 else np.log1p(self.count.astype(float))

    @cached_property
    def norm(self) -> np.ndarray:
        return np.sqrt(self._rows(self.value * self.value))

    def _rows(self, x: np.ndarray) -> np.ndarray:
        """Sums of x over each row that has n-grams."""
        return np.add.reduceat(x, self.start) if len(self.some) else np.zeros(0)

    def worth(self, model: Model) -> np.ndarray:
        out = (_style(self.style, model.mean, model.scale) * model.weight).sum(1)
        out[self.some] += self._rows(self.value * model.grams.take(self.bucket)) / self.norm
        return out

    def back(self, model: Model, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gradients by style and gram weights of a sum whose derivative by each text's worth is pull."""
        by_gram = np.repeat(pull[self.some] / self.norm, self.size)
        by_gram *= self.value
        return _style(self.style, model.mean, model.scale).T @ pull, np.bincount(self.bucket, by_gram, BUCKETS)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    grams: np.ndarray
    cut: float
    slope: float

    def worth(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return Block.of(raw, offsets, np.zeros(len(offsets) - 1)).worth(self)

    def score(self, worth: np.ndarray) -> np.ndarray:
        """0 to 1; the worth at the cut has 0.3."""
        return _scaled(worth, self.cut, self.slope)

    def worths(self, texts: pa.Array) -> np.ndarray:
        raw, offsets = text_buffers(texts)
        return np.concatenate([self.worth(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in chunks(offsets)] or [np.zeros(0)])


def _scaled(worth: np.ndarray, cut: float, slope: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * (worth - cut) + np.log(CUT / (1 - CUT)), -40, 40)))


def _style(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.concatenate([z, z * z], 1)


def objective(w: np.ndarray, v: np.ndarray, z: np.ndarray, row: np.ndarray, slot: np.ndarray, value: np.ndarray, a: np.ndarray, b: np.ndarray, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss of listed preferences of texts a over texts b, and its gradients by style weights w and gram weights v: the plain form of `_loss` and `_pulls`."""
    worth = z @ w + np.bincount(row, value * v[slot], len(z))
    gap = np.clip(worth[a] - worth[b], -50, 50)
    lose = 1 / (1 + np.exp(gap))
    pull = (np.bincount(b, lose, len(z)) - np.bincount(a, lose, len(z))) / len(a)
    loss = np.log1p(np.exp(-gap)).mean() + l2 / 2 * ((w * w).sum() + (v * v).sum())
    return float(loss), z.T @ pull + l2 * w, np.bincount(slot, value * pull[row], len(v)) + l2 * v


# ------------------------------------------------------------------ sums over all blocks

#: A run over all blocks: a function of a block, and one that joins two of its results.
Over = Callable[[Callable[[Block], tuple], Callable[[tuple, tuple], tuple]], tuple]


def _add(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def _fixed(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (1 << BITS)).astype(np.int64)


def _float(x: np.ndarray) -> np.ndarray:
    return x / (1 << BITS)


def _here(blocks: list[Block]) -> Over:
    return lambda f, join: reduce(join, map(f, blocks))


_PARTS = ("y", "style", "ends", "bucket", "count")


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for k in range(batch.num_rows):
        yield Block.unpacked([batch.column(c)[k].as_buffer() for c in range(len(_PARTS))])


def _in_spark(blocks: DataFrame) -> Over:
    """Blocks stay with the executors; each task joins its own, then tasks are joined in a tree."""
    def over(f: Callable[[Block], tuple], join: Callable[[tuple, tuple], tuple]) -> tuple:
        sent = blocks.sparkSession.sparkContext.broadcast(pickle.dumps(f.keywords))
        plain = f.func

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pickle.loads(sent.value)
            found = None
            for batch in batches:
                for b in _blocks(batch):
                    one = plain(b, **known)
                    found = one if found is None else join(found, one)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["found"])
        out = blocks.select(*_PARTS).mapInArrow(lean(run), "found binary").rdd.map(lambda r: pickle.loads(r[0])).treeReduce(join)
        sent.unpersist()
        return out
    return over


def _moments(b: Block) -> tuple:
    """Texts and buckets by class, and sums of style features and of their squares."""
    per = np.diff(b.ends, prepend=0)
    good = np.repeat(b.y == 1, per)
    by_class = [np.bincount(b.bucket[good], minlength=BUCKETS), np.bincount(b.bucket[~good], minlength=BUCKETS)]
    return np.array([(b.y == 0).sum(), (b.y == 1).sum()]), *by_class, _fixed(b.style.sum(0)), _fixed((b.style ** 2).sum(0))


def _spread(b: Block, model: Model) -> tuple:
    """How many worths fall into each bin, and their sums: for label 0, then for label 1."""
    worth = b.worth(model)
    bins = 2 * REACH * FINE
    at = np.clip(np.floor((worth + REACH) * FINE), 0, bins - 1).astype(np.int64) + bins * (b.y == 1)
    return np.bincount(at, minlength=2 * bins).reshape(2, -1), _fixed(np.bincount(at, worth, 2 * bins)).reshape(2, -1)


def _means(spread: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean worth, share of the class's texts) of the bins in use, for label 0 and label 1."""
    return [(_float(total[n > 0]) / n[n > 0], n[n > 0] / n.sum()) for n, total in zip(*spread)]


def _loss(spread: tuple) -> float:
    """The mean over all pairs of what preferring label 1 costs."""
    (at0, share0), (at1, share1) = _means(spread)
    return float(share1 @ np.logaddexp(0, at0[None, :] - at1[:, None]) @ share0)


_GRID = np.linspace(-REACH, REACH, 2 * REACH * FINE * 2 + 1)


def _pulls(spread: tuple) -> np.ndarray:
    """For label 0 and label 1: the derivative of the sum of pairs by a text's worth, on the grid, as if its class had no other."""
    (at0, share0), (at1, share1) = _means(spread)

    def chance(gap: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(gap, -50, 50)))
    grid = _GRID[:, None]
    return np.stack([chance(at1[None, :] - grid) @ share1, -(chance(grid - at0[None, :]) @ share0)])


def _slope(b: Block, model: Model, pulls: np.ndarray, kept: np.ndarray) -> tuple:
    """Sums of the gradient by style weights and by the weights of the grams kept."""
    worth = b.worth(model)
    by_style, by_gram = b.back(model, np.where(b.y == 1, np.interp(worth, _GRID, pulls[1]), np.interp(worth, _GRID, pulls[0])))
    return _fixed(by_style), _fixed(by_gram[kept])


def _ordered(b: Block, model: Model, low: float, high: float) -> tuple:
    """Worths between two bounds in equal bins: texts of label 0 and 1, least and greatest of each bin; texts of both labels below."""
    worth = b.worth(model)
    bins = 4096
    inside = (worth >= low) & (worth <= high)
    x, y = worth[inside], b.y[inside]
    at = np.clip((x - low) / max(high - low, 1e-300) * bins, 0, bins - 1).astype(np.int64)
    least, most = np.full(bins, np.inf), np.full(bins, -np.inf)
    np.minimum.at(least, at, x)
    np.maximum.at(most, at, x)
    over = worth[worth > high]
    return (np.stack([np.bincount(at[y == k], minlength=bins) for k in (0, 1)]), np.array([((worth < low) & (b.y == k)).sum() for k in (0, 1)]), least, most, np.array([over.min(initial=np.inf)]))


def _join_ordered(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], np.minimum(a[2], b[2]), np.maximum(a[3], b[3]), np.minimum(a[4], b[4])


def _costs(b: Block, model: Model, slopes: tuple) -> tuple:
    """The log loss of the scores at some slopes, summed for each label."""
    worth = b.worth(model)
    out = np.zeros((2, len(slopes)))
    for k, slope in enumerate(slopes):
        p = _scaled(worth, model.cut, slope)
        out[:, k] = np.bincount(b.y, -np.log(np.clip(np.where(b.y == 1, p, 1 - p), 1e-9, 1)), 2)
    return (_fixed(out),)


def _cut(over: Over, model: Model, texts: np.ndarray, share_bad: float) -> float:
    """Halfway between the worth at which the texts so far, each class weighed by its share, make up share_bad, and the next worth."""
    weight = np.array([share_bad, 1 - share_bad]) / np.maximum(texts, 1)
    low, high = -1e300, 1e300
    (_, _, least, most, _) = over(partial(_ordered, model=model, low=low, high=high), _join_ordered)
    low, high = float(least.min()), float(most.max())
    while True:
        inside, below, least, most, after = over(partial(_ordered, model=model, low=low, high=high), _join_ordered)
        mass = weight @ (below[:, None] + np.cumsum(inside, 1))
        used = np.flatnonzero(inside.sum(0))
        at = used[min(int(np.searchsorted(mass[used], share_bad - 1e-12)), len(used) - 1)]
        n = int(inside[:, at].sum())
        later = used[used > at]
        upper = float(least[later[0]]) if len(later) else float(after[0])
        if least[at] == most[at]:
            # of equal worths only the last is followed by another worth
            last = n == 1 or mass[at] - weight.min() < share_bad - 1e-12
            this = float(least[at])
            return (this + (upper if last and np.isfinite(upper) else this)) / 2
        low, high = float(least[at]), float(most[at])


def _fit(over: Over, share_bad: float | None, steps: int, l2: float) -> Model:
    texts, df0, df1, total, square = (lambda n, good, bad, t, q: (n, bad, good, _float(t), _float(q)))(*over(partial(_moments), _add))
    bad, good = int(texts[0]), int(texts[1])
    if not good or not bad:
        return _single(bad == 0)
    share_bad = bad / (good + bad) if share_bad is None else share_bad
    mean = total / (good + bad)
    scale = np.maximum(np.sqrt(np.maximum(square / (good + bad) - mean ** 2, 0)), 1e-3)
    share = np.clip((df1 + df0) / (good + bad), 1e-6, 1 - 1e-6)
    kept = np.flatnonzero(np.abs(df1 / good - df0 / bad) / np.sqrt(share * (1 - share) * (1 / good + 1 / bad)) >= STRENGTH)

    def model_of(x: np.ndarray) -> Model:
        grams = np.zeros(BUCKETS)
        grams[kept] = x[2 * WIDTH:]
        return Model(mean, scale, x[:2 * WIDTH], grams, 0.0, 1.0)

    def measured(x: np.ndarray) -> tuple[float, tuple]:
        spread = over(partial(_spread, model=model_of(x)), _add)
        return _loss(spread) + l2 / 2 * float(x @ x), spread

    def gradient(x: np.ndarray, spread: tuple) -> np.ndarray:
        # a text of the rarer label weighs more; by how many texts there are, so that fixed point keeps its digits
        each = (good + bad) / np.array([[bad], [good]])
        by_style, by_gram = over(partial(_slope, model=model_of(x), pulls=_pulls(spread) * each, kept=kept), _add)
        return _float(np.concatenate([by_style, by_gram])) / (good + bad) + l2 * x

    model = model_of(_descend(measured, gradient, np.zeros(2 * WIDTH + len(kept)), steps))
    model.cut = _cut(over, model, texts, share_bad)
    slopes = (0.1, 0.2, 0.3, 0.5, 0.8, 1.2, 2.0, 3.0)
    costs = _float(over(partial(_costs, model=model, slopes=slopes), _add)[0])
    model.slope = slopes[int(np.argmin(costs[0] * share_bad / bad + costs[1] * (1 - share_bad) / good))]
    return model


def _descend(measured: Callable, gradient: Callable, x: np.ndarray, steps: int) -> np.ndarray:
    """The minimum by limited-memory BFGS with backtracking."""
    loss, spread = measured(x)
    g = gradient(x, spread)
    past: deque = deque(maxlen=MEMORY)
    still = 0
    for _ in range(steps):
        q, back = g.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (s @ y)
            q -= a * y
            back.append(a)
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(float(np.sqrt(g @ g)), 1e-12)
        for (s, y), a in zip(past, reversed(back)):
            q += s * (a - (y @ q) / (s @ y))
        t, fall = 1.0, float(g @ q)
        while True:
            to = x - t * q
            new, spread = measured(to)
            if new <= loss - 1e-4 * t * fall or t < 1e-3:
                break
            t /= 3
        if new >= loss:
            break
        ng = gradient(to, spread)
        if (to - x) @ (ng - g) > 1e-12:
            past.append((to - x, ng - g))
        still = still + 1 if loss - new < GAIN * loss else 0
        x, g, loss = to, ng, new
        if still == 2:
            break
    return x


def _single(good: bool) -> Model:
    """The model of texts of one label only."""
    return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(2 * WIDTH), np.zeros(BUCKETS), -1.0 if good else 1.0, 4.0)


def fit(sample: list[tuple[int, str]], share_bad: float | None = None, *, steps: int = STEPS, l2: float = 1e-3) -> Model:
    """A model from (label, text) pairs; share_bad: the share of texts that the cut leaves below, by default that of label 0."""
    if not sample:
        return _single(True)
    raw, offsets = text_buffers(pa.array([t for _, t in sample], pa.string()))
    y = np.array([int(label) for label, _ in sample])
    return _fit(_here([Block.of(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], y[a:b]) for a, b in chunks(offsets)]), share_bad, steps, l2)


def held_out(column):
    """Documents whose labels are never learned: the CRC-32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, *, id_col: str, label_col: str, text_col: str, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """(label, text) of every document with a text and a label of 0 or 1; rows that repeat an id and a label count once among the labels."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_id is not null and _label in (0, 1)").distinct()
    few = known.limit(broadcast_labels + 1).count() <= broadcast_labels
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null")
    return texts.join(F.broadcast(known) if few else known.hint("shuffle_merge"), "_id").select("_label", "_text")


def fit_on(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text", driver_bytes: int = DRIVER_BYTES, broadcast_labels: int = BROADCAST_LABELS) -> Model:
    """A model from every labelled document. Blocks of features go to the shared folder; only sums of fixed size, or all blocks if they are small, reach the driver."""
    spark = docs.sparkSession
    arrow_rows(spark, 1000)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy()
            raw, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets):
                parts = Block.of(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], y[a:b]).packed()
                yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, parts))], pa.int64()), *(pa.array([p], pa.binary()) for p in parts)], names=["size", *_PARTS])

    texts = labelled_texts(docs, labels, id_col=id_col, label_col=label_col, text_col=text_col, broadcast_labels=broadcast_labels)
    blocks = materialize(texts.mapInArrow(lean(pack), "size long, " + ", ".join(f"{n} binary" for n in _PARTS)), "quality")
    # a block has about a megabyte
    arrow_rows(spark, 8)
    size = blocks.agg(F.sum("size")).first()[0]
    if size is None:
        return _single(True)
    if size <= driver_bytes:
        return _fit(_here([Block.unpacked(list(r)) for r in blocks.select(*_PARTS).collect()]), None, STEPS, 1e-3)
    return _fit(_in_spark(blocks), None, STEPS, 1e-3)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, score (0 to 1) and predicted (1 if the score is 0.3 or more).

    Whole texts are read; null and empty texts have zero features and a finite score. Texts of any length
    are read a few at a time. Ties get equal scores. Rows that
    repeat an id give a row each; other columns are not read.
    """
    arrow_rows(docs.sparkSession, 1000)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for batch in batches:
            s = m.score(m.worths(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=[id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, score double, predicted int")
