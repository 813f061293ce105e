"""Language identification with interpolated Kneser-Ney character models.

One model for each language, up to `ORDER` characters. The models of all languages stand in sorted arrays of n-gram
hashes: `keys` with a column of discounted probabilities for each language, and `contexts` with a column of
interpolation weights. A text is given to the language with the lowest cross-entropy for each character; how far the
entropies lie apart, on a temperature calibrated on other texts than those counted, gives the score, and an entropy
above a bound calibrated there means that no learned language fits (of a sample so small that no text is left for it, the counted ones calibrate). All letters of the counted texts are learned; only beyond
65,534 distinct ones, more than the Basic Multilingual Plane has, would the rarest share one symbol.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, arrow_rows, lean, mix
from .sampling import bounded_sample, split_of

ORDER = 4
UNDETERMINED = "und"
#: Most documents and bytes of one language that the models count.
PER_LANGUAGE = 800
LANGUAGE_BYTES = 2_500_000
#: Bits of a symbol; four symbols fill 64 bits.
_SYMBOL = 16
_UNKNOWN = (1 << _SYMBOL) - 1
_PAD = " " * (ORDER - 1)
_LETTER: np.ndarray | None = None


def letters() -> np.ndarray:
    """Of each code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, bounds, has_letter): lower-cased texts as symbol numbers; runs of non-letters are one 0, each text has ORDER - 1 leading zeros."""
    low = [_PAD + t.lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))])
    sym = table[code]
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    for k in range(ORDER - 1):
        keep[off[:-1] + k] = True
    at = np.concatenate([[0], np.cumsum(keep)])[off]
    sym = sym[keep]
    alpha = np.add.reduceat(sym != 0, at[:-1]) > 0 if len(texts) else np.zeros(0, bool)
    return sym, at, alpha


def grams(sym: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the n-gram of order ORDER that ends at each symbol behind the padding."""
    code = np.zeros(len(sym), U)
    for k in range(ORDER):
        code[k:] |= sym[:len(sym) - k].astype(U) << U(_SYMBOL * k)
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    real = np.ones(len(sym), bool)
    for k in range(ORDER - 1):
        real[at[:-1] + k] = False
    return rows[real], code[real]


def _hash(code: np.ndarray, order: int) -> np.ndarray:
    return mix(mix(code) + U(order))


@dataclass
class Models:
    languages: list[str]
    alphabet: np.ndarray
    keys: np.ndarray
    direct: np.ndarray
    contexts: np.ndarray
    weight: np.ndarray
    temperature: float = 1.0
    bound: float = 99.0

    def table(self) -> np.ndarray:
        """Symbol of each code point: 0 for what is no letter, _UNKNOWN for letters not learned."""
        table = np.where(letters(), _UNKNOWN, 0).astype(np.uint16)
        table[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        return table

    def log2(self, code: np.ndarray) -> np.ndarray:
        """log2 of the probability of each n-gram's last symbol behind the others, by language."""
        p = np.full((len(code), len(self.languages)), 1.0 / (len(self.alphabet) + 2))
        for n in range(1, ORDER + 1):
            own = code & U((1 << (_SYMBOL * n)) - 1)
            p *= _lookup(self.contexts, self.weight, _hash(own >> U(_SYMBOL), n), 1.0)
            p += _lookup(self.keys, self.direct, _hash(own, n), 0.0)
        return np.log2(p)

    def entropies(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits for each symbol by text and language, symbols of each text, has_letter)."""
        sym, at, alpha = symbols(texts, table)
        rows, code = grams(sym, at)
        kinds = np.unique(code)
        which = np.searchsorted(kinds, code)
        bits = -self.log2(kinds)
        both, times = np.unique(rows * max(len(kinds), 1) + which, return_counts=True)
        row, which = both // max(len(kinds), 1), both % max(len(kinds), 1)
        size = np.maximum(np.bincount(row, times, len(texts)), 1)
        h = np.stack([np.bincount(row, times * bits[which, k], len(texts)) for k in range(len(self.languages))], 1) if len(self.languages) else np.zeros((len(texts), 0))
        return h / size[:, None], size, alpha

    def decide(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, fits): the score is the calibrated probability of that language."""
        return np.argmin(h, 1), 1 / _odds(h, size, self.temperature).sum(1), h.min(1) <= self.bound


def _odds(h: np.ndarray, size: np.ndarray, temperature: float) -> np.ndarray:
    """Of each language, how likely it is beside the best one: symbols of one text are not independent, hence the root."""
    gap = (h - h.min(1, keepdims=True)) * np.sqrt(size)[:, None] * temperature
    return np.exp2(-np.minimum(gap, 200))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    out = np.full((len(wanted), values.shape[1]), default)
    if len(keys):
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[i] == wanted
        out[hit] = values[i[hit]]
    return out


def fit(sample: list[tuple[str, str]]) -> Models:
    """Models from (language, text) pairs: four fifths of the texts are counted, the others calibrate."""
    languages = sorted({lang for lang, _ in sample})
    split = {lang: [t for la, t in sample if la == lang and split_of(t)] for lang in languages}
    # texts are counted or calibrate, never both; a language whose texts would all calibrate has them counted instead
    counted = [(la, t) for la, t in sample if split_of(t) or not split[la]]
    other = [(la, t) for la, t in sample if not split_of(t) and split[la]] or counted
    seen = np.zeros(0x110000, np.int64)
    for _, text in counted:
        c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        np.add.at(seen, c, 1)
    alphabet = np.flatnonzero(letters() & (seen > 0))
    alphabet = np.sort(alphabet[np.argsort(-seen[alphabet], kind="stable")][:_UNKNOWN - 1])
    m = Models(languages, alphabet, *(np.zeros(0, U), np.zeros((0, len(languages)))) * 2)
    table, parts = m.table(), ([], [])
    for k, lang in enumerate(languages):
        _, code = grams(*symbols([t for la, t in counted if la == lang], table)[:2])
        gram, count = np.unique(code, return_counts=True)
        for n in range(ORDER, 0, -1):
            if n < ORDER:  # lower orders count how many symbols an n-gram has been seen behind
                gram, count = np.unique(gram & U((1 << (_SYMBOL * n)) - 1), return_counts=True)
            ones, twos = (count == 1).sum(), (count == 2).sum()
            d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones and twos else 0.5
            ctx, which = np.unique(gram >> U(_SYMBOL), return_inverse=True)
            total, types = np.bincount(which, count), np.bincount(which)
            parts[0].append((k, _hash(gram, n), (count - d) / total[which]))
            parts[1].append((k, _hash(ctx, n), d * types / total))
    arrays = []
    for part, default in zip(parts, (0.0, 1.0)):
        keys = np.unique(np.concatenate([h for _, h, _ in part])) if part else np.zeros(0, U)
        values = np.full((len(keys), len(languages)), default)
        for k, h, v in part:
            values[np.searchsorted(keys, h), k] = v
        arrays += [keys, values]
    m.keys, m.direct, m.contexts, m.weight = arrays
    if other:
        h, size, _ = m.entropies([t for _, t in other], table)
        truth = np.array([languages.index(la) for la, _ in other])
        losses = {}
        for t in (0.02, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0):
            p = _odds(h, size, t)
            losses[t] = -np.log(np.maximum(p[np.arange(len(p)), truth] / p.sum(1), 1e-12)).mean()
        m.temperature = min(losses, key=losses.get)
        m.bound = float(np.quantile(h.min(1), 0.995) * 1.15)
    return m


def predict(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text", reject: bool = True) -> DataFrame:
    """Per row: the id, lang_pred, score and fits.

    A null text or one without a letter is `und` with score 0. With `reject`, so is a text that no learned language
    fits; without, it keeps the nearest language and `fits` is false. Ties go to the language that sorts first. If no
    language was learned, all rows are `und`. Rows that repeat an id give a row each. Only the text is looked at.
    """
    arrow_rows(docs.sparkSession, 1000)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(models))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(sent.value)
        table, names = m.table(), np.array([*m.languages, UNDETERMINED], object)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            lang, score, fits = [], [], []
            at = 0
            while at < len(texts):
                to, total = at, 0
                while to < len(texts) and (to == at or total + len(texts[to]) <= 4_000_000):
                    total += len(texts[to])
                    to += 1
                h, size, alpha = m.entropies(texts[at:to], table)
                if len(m.languages):
                    best, s, ok = m.decide(h, size)
                else:
                    best, s, ok, alpha = np.zeros(to - at, int), np.zeros(to - at), np.zeros(to - at, bool), np.zeros(to - at, bool)
                known = alpha & (ok | (not reject))
                lang += names[np.where(known, best, len(m.languages))].tolist()
                score += np.where(known, s, 0.0).tolist()
                fits += (alpha & ok).tolist()
                at = to
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.bool_())], names=[id_col, "lang_pred", "score", "fits"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, lang_pred string, score double, fits boolean")


def held_out(column):
    """Documents that are never learned from: the CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, language_bytes: int = LANGUAGE_BYTES) -> Models:
    """Models from a bounded sample of the labelled rows of docs."""
    return fit(bounded_sample(docs, docs, id_col=id_col, label_col=lang_col, text_col=text_col, per_class=per_language, class_bytes=language_bytes))
