"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over each text finds anchors: at-signs, plus signs, schemes and identifier cues;
runs of digits are anchors too. Deterministic parsers expand around an anchor to the left and right, decide where the item ends and
validate it (octets, Luhn, digit counts, IBAN's mod 97). Nothing else of the text is looked at in Python, and no stretch
of a text is scanned again for each anchor in it.

Kinds `email`, `ip`, `card` and `phone` are the base; `iban`, `secret` and `url` are added by this method.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, lean

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "secret", "url")

# Cues of schemes and identifiers.
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "mailto:")
SECRET_CUES = ("AKIA", "ghp_", "sk-", "xoxb-", "eyJ", "-----BEGIN ", "password", "passwd", "secret", "token", "api_key")
IBAN_CUES = ("IBAN", "iban")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_URL = re.compile(r"[^\x00-\x20\"'<>\\^`{|}\x7f]+")
_SECRET = re.compile(r"(?:password|passwd|secret|token|api_key)\x20?[=:]\x20?[\"']?[A-Za-z0-9_/+.-]{8,}|AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xoxb-[A-Za-z0-9-]{20,}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+|-----BEGIN [A-Z ]*PRIVATE KEY-----")
_IBAN = re.compile(r"[\x20:]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_TOKEN = re.compile(r"[A-Za-z0-9_-]+")
_ANCHOR = {"@": 1, "+": 2} | {s: 4 for s in SCHEMES} | {s: 5 for s in SECRET_CUES} | {s: 6 for s in IBAN_CUES}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in _ANCHOR.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    t = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all items in code points, by kind as listed, then start.

    For each kind of the base, what its pattern would find from left to right without overlap: an item that fails
    its validation is dropped, but the search goes on behind it.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS + MORE_KINDS}
    mail_end = ip_end = card_end = url_end = secret_end = jwt_end = 0
    for run in _DIGITS.finditer(text):
        start, end = run.span()
        if start >= ip_end and text.startswith(".", end) and (m := _IP.match(text, start)):
            ip_end = m.end()
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                found["ip"].append(m.span())
        if start >= card_end and (m := _CARD.match(text, start)):
            card_end = m.end()
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    for at, (kind, size) in anchors.iter(text):
        start = at - size + 1
        if kind == 1:
            left = start
            while left > mail_end and text[left - 1] in _LOCAL:
                left -= 1
            if left < start and (m := _DOMAIN.match(text, start + 1)):
                mail_end = m.end()
                found["email"].append((left, mail_end))
        elif kind == 2:
            if m := _PHONE.match(text, start):
                if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                    found["phone"].append(m.span())
        elif kind == 4:
            if start >= url_end and (m := _URL.match(text, at + 1)):
                url_end = at + 1 + len(m.group().rstrip(".,;:!?)]"))
                if url_end > at + 1:
                    found["url"].append((start, url_end))
        elif kind == 5:
            if start < secret_end or start < jwt_end and text.startswith("eyJ", start):
                continue
            if m := _SECRET.match(text, start):
                secret_end = m.end()
                found["secret"].append(m.span())
            elif text.startswith("eyJ", start):
                # what follows the run of token characters decides, for every cue of this kind in it alike
                jwt_end = _TOKEN.match(text, start).end()
        elif m := _IBAN.match(text, at + 1):
            end = m.end(1)
            while end - m.start(1) >= 15 and not iban_valid(text[m.start(1):end]):
                end -= 1
            if end - m.start(1) >= 15:
                found["iban"].append((m.start(1), end))
    return [(k, s, e) for k, spans in found.items() for s, e in spans]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, spans array<struct<kind,start,end>> of its whole text, and the text with items masked.

    Null and empty texts have no spans and an empty masked text. Other columns are not read. Rows that repeat an id
    give a row each; an empty table gives an empty result.
    """
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    arrow_rows(docs.sparkSession, 1000)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            spans = [find(t, anchors) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], item),
                pa.array([masked(t, x) for t, x in zip(texts, spans)], pa.string()),
            ], names=[id_col, "spans", "masked"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>, masked string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each item replaced by its kind in angle brackets; of overlapping items the first counts."""
    if not spans:
        return text
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
            at = e
    return "".join([*out, text[at:]])


def pii_digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans, and all spans as one string (see `find_pii`)."""
    arrow_rows(docs.sparkSession, 1000)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            counts, digests, spans = [[] for _ in BASE_KINDS], [], []
            for text in batch.column(1).to_pylist():
                all_spans = find(text, anchors) if text else []
                base = [x for x in all_spans if x[0] in BASE_KINDS]
                for k, kind in enumerate(BASE_KINDS):
                    counts[k].append(sum(x[0] == kind for x in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(all_spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                             names=[id_col, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    return docs.select(id_col, text_col).mapInArrow(lean(run), f"`{id_col}` {id_type}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
