"""Toxicity by cumulative-link ordinal regression.

A text's severity grade is one of 0 (none) to 3. One weight vector over sparse features (words and word beginnings,
log counts) is shared by all thresholds: P(grade <= k) = sigmoid(theta_k - w x), theta ascending. The result is the
expected severity. Labels are yes or no, so grades are made: a toxic training text gets 1 to 3 by the tercile of how many of
its words are typical of toxic texts. Severity is thus an amount, not a density: a longer text with as dense a share of such
words is the more severe. (Shares of words, or of the densest stretch, told toxic from clean texts worse.)
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, Words, arrow_rows, chunks, lean, mix, text_buffers, trim, unquoted
from .sampling import bounded_sample, split_of

GRADES = 4
#: How far a feature must tell the classes apart, as a multiple of what chance gives the best of so many features. Of the
#: bounds tried, the one that does best on texts not fitted on is taken: with few labels a strict one misses too much.
CHANCES = (1.0, 0.5)
#: A feature needs this many training texts.
LEAST = 4
#: Bytes at the beginning of a word that are features of their own.
STEMS = (4, 5, 6)

_EDGE = np.zeros(256, bool)
# ASCII white space, punctuation and control characters separate words here.
_EDGE[[c for c in range(128) if not chr(c).isalnum()]] = True


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature hash, count) of each distinct feature of each text, sorted by row."""
    w = Words(unquoted(raw), offsets, lower=True, space=_EDGE)
    h, size = w.hashes(11), w.end - w.start
    rows = w.rows
    padded = np.zeros(len(w.raw) + 16, np.uint8)
    padded[:len(w.raw)] = w.raw
    lanes = np.ndarray((len(w.raw) + 8,), "<u8", padded, strides=(1,))
    head = lanes[w.start] if len(w) else np.zeros(0, U)
    hs, rs = [h], [rows]
    for n in STEMS:
        long = size >= n
        hs.append(mix((head[long] & U((1 << (8 * n)) - 1)) + U(n << 56)))
        rs.append(rows[long])
    return np.concatenate(rs), np.concatenate(hs), np.diff(w.bounds)


def _counts(row: np.ndarray, key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    both, n = np.unique(row.astype(np.int64) * width + key, return_counts=True)
    return both // width, both % width, n


@dataclass
class Model:
    keys: np.ndarray
    weight: np.ndarray
    theta: np.ndarray
    threshold: float

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """w x of each text."""
        n = len(offsets) - 1
        if not len(self.keys):
            return np.zeros(n)
        row, h, _ = features(raw, offsets)
        i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[i] == h
        r, j, c = _counts(row[hit], i[hit], len(self.keys))
        return np.bincount(r, np.log1p(c) * self.weight[j], n)

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade by text."""
        upto = 1 / (1 + np.exp(-np.clip(self.theta[None, :] - score[:, None], -50, 50)))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), upto, np.ones((len(score), 1))], 1), axis=1)


def objective(w: np.ndarray, theta: np.ndarray, r: np.ndarray, j: np.ndarray, x: np.ndarray, grade: np.ndarray, share: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Loss and gradient (weights, then thresholds) of the cumulative logits over sparse features (r, j, x)."""
    z = np.clip(theta[None, :] - np.bincount(r, x * w[j], len(grade))[:, None], -50, 50)
    upto = grade[:, None] <= np.arange(len(theta))[None, :]
    loss = (np.log1p(np.exp(np.where(upto, -z, z))) * share[:, None]).sum() + l2 / 2 * (w * w).sum()
    g = (1 / (1 + np.exp(-z)) - upto) * share[:, None]
    return float(loss), np.concatenate([np.bincount(j, x * (-g.sum(1))[r], len(w)) + l2 * w, g.sum(0)])


def fit(sample: list[tuple[int, str]], *, steps: int = 400, l2: float = 1e-3, chance: float = CHANCES[0]) -> Model:
    """A model from (0 or 1, text) pairs. With one class only, no text is toxic (or, if all are, every text)."""
    y = np.array([int(label) for label, _ in sample])
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0, U), np.zeros(0), np.full(GRADES - 1, -9.0 if len(y) and y[0] else 9.0), 0.5)
    raw, offsets = text_buffers(pa.array([t for _, t in sample], pa.string()))

    def parts():
        """(row, hash, count) of the distinct features, a few MB of text at a time."""
        for a, b in chunks(offsets):
            row, h, _ = features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, int)
            yield row[first] + a, h[first], np.diff(np.concatenate([first, [len(h)]]))

    known, texts = np.zeros(0, U), np.zeros(0, np.int64)
    for _, h, _ in parts():
        known, which = np.unique(np.concatenate([known, h]), return_inverse=True)
        texts = np.bincount(which, np.concatenate([texts, np.ones(len(h), np.int64)]), len(known)).astype(np.int64)
    keys = known[texts >= LEAST]
    del known, texts
    found = []
    for row, h, c in parts():
        i = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        hit = keys[i] == h if len(keys) else np.zeros(len(h), bool)
        found.append((row[hit], i[hit], c[hit]))
    r, j, c = (np.concatenate(x) for x in zip(*found))
    df1, df0 = np.bincount(j, y[r], len(keys)), np.bincount(j, 1 - y[r], len(keys))
    p1, p0 = (df1 + 0.5) / (y.sum() + 1), (df0 + 0.5) / ((1 - y).sum() + 1)
    odds = np.log(p1 / (1 - p1)) - np.log(p0 / (1 - p0))
    # how far a feature's texts lean to one class, in standard errors; beyond what chance gives among so many features
    ones, zeros = y.sum(), (1 - y).sum()
    lean = (df1 / ones - df0 / zeros) / np.sqrt(np.maximum(df1 + df0, 1) / (1.0 * ones * zeros))
    strength = np.abs(lean)
    kept = np.flatnonzero(strength > chance * np.sqrt(2 * np.log(max(len(keys), 2))))
    slot = np.full(len(keys), -1)
    slot[kept] = np.arange(len(kept))
    use = slot[j] >= 0
    r, j, c, odds = r[use], slot[j[use]], c[use], odds[kept]
    x = np.log1p(c)
    # grades of toxic texts
    hits = np.bincount(r, np.where(odds[j] > 2.5, c, 0), len(y))
    cuts = np.quantile(hits[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 1, 1 + (hits[:, None] > cuts[None, :]).sum(1), 0)
    # full gradient with Adam; both classes weigh the same in the first threshold
    w, theta = np.zeros(len(kept)), np.array([1.0, 2.0, 3.0])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    state = [np.zeros(len(w) + 3), np.zeros(len(w) + 3)]
    for step in range(1, steps + 1):
        _, grad = objective(w, theta, r, j, x, grade, share, l2)
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad ** 2
        move = 0.05 * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        w, theta = w - move[:-3], np.maximum.accumulate(theta - move[-3:])
    return Model(keys[kept], w, theta, 0.5)


def calibrate(m: Model, sample: list[tuple[int, str]], share_toxic: float) -> tuple[float, float]:
    """(threshold, F1): the threshold of p_toxic with the best F1 on texts not fitted on, each class weighing as much as among all labels."""
    y = np.array([int(label) for label, _ in sample])
    if len(set(y.tolist())) < 2:
        return 0.5, 0.0
    raw, offsets = text_buffers(pa.array([t for _, t in sample], pa.string()))
    p = 1 - m.grades(np.concatenate([m.score(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in chunks(offsets)]))[:, 0]
    weight = np.where(y == 1, share_toxic / y.sum(), (1 - share_toxic) / (1 - y).sum())
    tries = np.linspace(0.02, 0.98, 97)
    f1 = np.array([2 * weight[(p >= t) & (y == 1)].sum() / (weight[p >= t].sum() + share_toxic) for t in tries])
    good = tries[f1 >= f1.max() - 1e-9]
    return float(good[len(good) // 2]), float(f1.max())


def fit_calibrated(sample: list[tuple[int, str]], share_toxic: float) -> Model:
    """Four fifths of the sample fit a model for each of `CHANCES`, the others its threshold; the best F1 on these wins, the strictest of equals."""
    fitted, other = [x for x in sample if split_of(x[1])], [x for x in sample if not split_of(x[1])]
    best, most = None, -1.0
    for chance in CHANCES:
        m = fit(fitted, chance=chance)
        m.threshold, f1 = calibrate(m, other, share_toxic)
        if f1 > most + 1e-9:
            best, most = m, f1
    return best


def fit_on(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """A model from a bounded sample of the labelled documents; the share of toxic ones is counted over all labels."""
    total, toxic = labels.filter(F.col(label_col).isNotNull()).agg(F.count(F.lit(1)), F.sum(F.col(label_col).cast("int"))).first()
    sample = bounded_sample(labels, docs, id_col=id_col, label_col=label_col, per_class=2500, class_bytes=7_000_000)
    model = fit_calibrated(sample, (toxic or 0) / max(total, 1))
    trim()
    return model


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Per row: the id, severity (expected grade, 0 to 3), grade (the likeliest), p_toxic and toxic.

    Whole texts are read. Null and empty texts have no features and get the model's base rate, so they are not toxic
    unless all training texts were. Rows that repeat an id give a row each. With `keep`, the columns of docs stand
    before these (a column of docs with one of these names is replaced).
    """
    arrow_rows(docs.sparkSession, 1000)
    names = ["severity", "grade", "p_toxic", "toxic"]
    own = [f.name for f in docs.schema.fields if f.name not in names] if keep else [id_col]
    frame = docs.select(*(F.col(f"`{c}`") for c in own), F.col(text_col).alias("_scored"))
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]), "severity double, grade int, p_toxic double, toxic boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for batch in batches:
            raw, offsets = text_buffers(batch.column(batch.num_columns - 1))
            s = np.concatenate([m.score(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in chunks(offsets)] or [np.zeros(0)])
            p = m.grades(s)
            bad = 1 - p[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p @ np.arange(GRADES)), pa.array(p.argmax(1).astype(np.int32)), pa.array(bad), pa.array(bad >= m.threshold)],
                                             names=[*own, *names])

    return frame.mapInArrow(lean(run), schema)


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of docs that the model does not call toxic, with all their columns; see `predict`. No shuffle."""
    arrow_rows(docs.sparkSession, 1000)
    sent, at = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model)), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        for batch in batches:
            raw, offsets = text_buffers(batch.column(at))
            s = np.concatenate([m.score(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in chunks(offsets)] or [np.zeros(0)])
            yield batch.filter(pa.array(1 - m.grades(s)[:, 0] < m.threshold))

    return docs.mapInArrow(lean(run), docs.schema)
