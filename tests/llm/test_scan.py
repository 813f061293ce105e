"""Operators that look at each text alone: personal data, benchmark overlaps, archives, tokens."""

import base64
import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import decontaminate, pii, spm, warc
from docloom.llm.common import Words, shared_dir
from docloom.llm.queries import MODEL

from .data import corpus, frame, words

PATTERNS = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}
TEXTS = ["+12", "a@b@c.d", "1.2.3.4.5.6.7.8", "1..2.3.4.5", "4111 1111 1111 1111", "x@y.z@q.r", "300.1.1.1 1.2.3.4", "+1 (23) 45-67 89+44 123 456 78.",
         "4111-1111-1111-1111 5", "a.b@c-d.e-.f.", "@@a@b.c..d", "+1+23456789 ", "é@b.cc ü+4912345678 0000.1.2.3", "00000000000000000 1", "1" * 400 + ".1.1.1", "", "no data"]


def base_truth(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_against_the_patterns():
    import random

    rng = random.Random(5)
    made = ["".join(rng.choice("0123456789.@+- ab()%") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    anchors = pii.automaton()
    for text in TEXTS + made:
        assert [x for x in pii.find(text, anchors) if x[0] in pii.BASE_KINDS] == base_truth(text), text


def test_pii_frames(spark):
    rows = [(1, "mail me@x.org, GB IBAN DE89 3704 0044 0532 0130 00 or http://a.b/c?d.", None, None, None), (2, None, None, None, None), (2, "", None, None, None), (3, "AKIA" + "A" * 16, None, None, None)]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect() if r.masked or r.doc_id != 2}
    assert got[1].masked == "mail <EMAIL>, GB IBAN <IBAN> or <URL>." and [s.kind for s in got[3].spans] == ["secret"]
    digest = {r.doc_id: r for r in pii.pii_digest(frame(spark, rows)).collect()}
    assert digest[1].n_email == 1 and digest[1].base_sha256 == hashlib.sha256(b"email:5:13").hexdigest()
    assert digest[2].n_email == 0 and digest[2].spans == "" and digest[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.pii_digest(frame(spark, rows).filter("false")).count() == 0


# ------------------------------------------------------------------ benchmark overlaps

def test_masks_find_every_window_with_three_substitutions():
    n = decontaminate.MIN_WORDS
    for wrong in itertools.combinations(range(n), 3):
        assert any(all(o + p not in wrong for p in mask) for mask in decontaminate.LONG for o in range(n - mask[-1]))


def test_pieces_find_every_short_item_with_its_substitutions():
    for n in range(1, decontaminate.MIN_WORDS):
        words = [f"w{k}" for k in range(n)]
        t = decontaminate.prepare([0], [" ".join(words)])
        for wrong in itertools.combinations(range(n), decontaminate.allowed(n)):
            text = " ".join(["a", "b", *("other" if k in wrong else x for k, x in enumerate(words)), "c"])
            assert [x[1:] for x in decontaminate._scan(pa.array([text]), t)] == [(0, 2, 0, n, n - len(wrong))]


def overlap_truth(text, item):
    """Whether some diagonal has a stretch of 13 words with at most three substituted ones, or the whole short item, in proportion."""
    def plain(t):
        return re.sub("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\u2000-\u206f]", " ", (t or "").lower()).split()
    a, b = plain(text), plain(item)
    size = min(13, len(b))
    return size > 0 and any(sum(a[p + k] != b[q + k] for k in range(size)) <= 3 * size // 13 for p in range(len(a) - size + 1) for q in range(len(b) - size + 1))


def test_overlaps(spark, monkeypatch):
    import random

    rng = random.Random(8)
    items = [(k, " ".join(f"t{k}x{j}" for j in range(rng.choice([1, 2, 4, 6, 9, 13, 20, 45])))) for k in range(25)] + [(90, None), (91, ""), (92, "zu kurz")]
    rows = []
    for i in range(60):
        w = [f"d{rng.randint(0, 500)}" for _ in range(rng.randint(0, 60))]
        if i % 3 and items[i % 25][1]:
            own = items[i % 25][1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = "other"
            at = rng.randint(0, len(w))
            w[at:at] = [rng.choice([x, x.upper() + ",", f"\u201c{x}\u201d", f"\u2014{x}"]) for x in own]
        rows.append((i, " ".join(w), None, None, None))
    rows += [(100, None, None, None, None), (101, "", None, None, None)]
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    true = {(i, k) for i, t, *_ in rows for k, item in items if overlap_truth(t, item)}
    for block in (decontaminate.BLOCK_BYTES, 10):  # broadcast as a whole, then joined by seed
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = {(r.doc_id, r.item_id): r for r in decontaminate.best_overlaps(frame(spark, rows), tests).collect()}
        assert got.keys() == true and len({r.n_words for r in got.values()}) > 4
        clean = {r.doc_id for r in decontaminate.drop_contaminated(frame(spark, rows), tests).collect()}
        assert clean == {i for i, *_ in rows} - {i for i, _ in got} and {100, 101} <= clean
        none = tests.filter("false")
        assert decontaminate.find_overlaps(frame(spark, rows), none).count() == 0 and decontaminate.drop_contaminated(frame(spark, rows), none).count() == len(rows)
        assert decontaminate.find_overlaps(frame(spark, rows).filter("false"), tests).count() == 0


def test_every_part_of_an_item_is_an_overlap_and_ids_may_repeat_or_lack(spark, monkeypatch):
    item = [f"w{k}" for k in range(60)]
    text = " ".join([*item[:15], *(f"x{k}" for k in range(21)), *item[36:]])
    docs = frame(spark, [(1, text, None, None, None), (1, text, None, None, None), (None, text, None, None, None)])
    for block in (decontaminate.BLOCK_BYTES, 10):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = sorted((r.doc_id or 0, r.doc_id_item, r.doc_start, r.item_start, r.n_words) for r in decontaminate.find_overlaps(docs, spark.createDataFrame([(7, " ".join(item))], "doc_id bigint, text string"), item_col="doc_id").withColumnRenamed("item_doc_id", "doc_id_item").collect())
        assert got == sorted([(i, 7, 0, 0, 18) for i in (0, 1, 1)] + [(i, 7, 33, 33, 27) for i in (0, 1, 1)])


# ------------------------------------------------------------------ archives

PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (5, None, "<p>same</p>"), (3, "http://a/3", None), (4, "http://a/4", ""), (6, "http://a/é\r\nx: y", "ünï😀"), (6, "http://again", "ünï😀"), (None, "http://none", "<p>same</p>"), (7, "u", "x" * 300_000)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(3)
    got = warc.warc_round_trip(pages).collect()
    assert len(got) == len(PAGES)
    best = {1: 5, 2: 5, None: 5, 3: 4}
    for r in got:
        texts = {t or "" for p, _, t in PAGES if p == r.page_id}
        assert {(len(t.encode()), digest(t)) for t in texts} == {(r.payload_bytes, r.payload_digest)}
        assert (r.record_type, r.refers_to) == (("revisit", best[r.page_id]) if r.page_id in best else ("response", None))
    assert warc.warc_round_trip(pages.filter("false")).count() == 0


def test_warc_small_payloads_and_selected_reads(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    folder = shared_dir(spark, "test-warc")
    index = warc.write_warc(pages, folder, min_bytes=11)
    kinds = {r.page_id: r.record_type for r in index.collect()}
    assert kinds[3] == kinds[4] == "response" and kinds[1] == "revisit"
    some = warc.read_warc(index.filter("page_id in (6, 7)"), folder).collect()
    assert sorted(len(r.payload) for r in some) == [len("ünï😀".encode())] * 2 + [300_000]


def test_damaged_record_is_seen():
    good = warc.record_bytes("response", "u", b"abc", {"WARC-Payload-Digest": "sha1:x"})
    assert warc.parse_record(good)[1] == b"abc"
    with pytest.raises(Exception):
        warc.parse_record(good[:-9])


# ------------------------------------------------------------------ tokens

need_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no model file here")
ODD = ["", "a", " ", " a", "a ", "  a   b", "▁x", "a▁▁b", "\n\n\t x", "😀é\u0000z", "    ", "aaaaaaa", "<s>", "</s> <unk>", "<0x0A>", "a\n b", "   def f(x):\n        return   x\n", "ab " * 900]


@need_model
def test_tokens_equal_those_of_the_models_own_library(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ODD + [t or "" for _, t, *_ in corpus()]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)] + [(9999, None, None, None, None)]
    got = {r.doc_id: r for r in spm.encode(frame(spark, rows), MODEL).collect()}
    for k, t in enumerate(texts):
        assert got[k].token_ids == own.encode(t) and got[k].n_tokens == len(got[k].token_ids) and got[k].round_trip
    assert got[9999].token_ids == [] and got[9999].round_trip
    back = {r.doc_id: r.text for r in spm.decode(spark.createDataFrame([(k, r.token_ids) for k, r in got.items()], "doc_id bigint, token_ids array<int>"), MODEL).collect()}
    assert all(back[k] == t.replace("▁", " ") for k, t in enumerate(texts)) and back[9999] == ""
    assert spm.encode(frame(spark, rows).filter("false"), MODEL).count() == 0


def test_unigram_model_is_rebuilt():
    """A small unigram model, written as the file format has it, against a Viterbi search."""
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [("▁", -3.0, 1), ("▁a", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -3.5, 1), ("▁ab", -5.5, 1), ("abb", -4.0, 1)]

    def field(n, kind, payload):
        return bytes([n << 3 | kind]) + payload

    import struct

    def message(body):
        return bytes([len(body)]) + body
    data = b"".join(field(1, 2, message(field(1, 2, message(p.encode())) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k])))) for p, s, k in pieces)
    data += field(2, 2, message(field(3, 0, b"\x01") + b"\x98\x02\x01")) + field(3, 2, message(field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")))
    p = spm.Processor(data)
    assert p.model.kind == spm.UNIGRAM and p.model.byte_fallback and not p.model.squeeze
    scores = {x: s for x, s, k in pieces if k == 1}

    def best(text):
        table = [(0.0, [])] + [(-1e9, [])] * len(text)
        for e in range(1, len(text) + 1):
            table[e] = max(((table[b][0] + scores[text[b:e]], table[b][1] + [text[b:e]]) for b in range(e) if text[b:e] in scores), key=lambda x: x[0], default=(-1e9, []))
        return table[-1][1]
    names = [x for x, _, _ in pieces]
    for text in ("ab", "abb ab", "a  b", "bab aabb"):
        ids, offsets, whole = p.encode_batch(pa.array([text]))
        assert [names[i] for i in ids] == best("▁" + text.replace(" ", "▁")) and whole.all()
    ids, _, whole = p.encode_batch(pa.array(["é"]))
    assert [names[i] for i in ids] == ["▁", "<0xC3>", "<0xA9>"] and whole.all()


# ------------------------------------------------------------------ the word kernel

def test_words_and_hashes():
    texts = ["", " a ", "a b\tc", "ääh  öö", "x" * 100 + " y", None, "A\x0bB\x0cC"]
    column = pa.array(texts)
    from docloom.llm.common import text_buffers

    raw, offsets = text_buffers(column)
    w = Words(raw, offsets)
    found = [[raw[s:e].tobytes().decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
    assert found == [words(t) for t in texts]
    h = w.hashes()
    seen = {}
    for word, value in zip([x for f in found for x in f], h.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    part = column.slice(2, 3)
    raw, offsets = text_buffers(part)
    assert np.diff(Words(raw, offsets).bounds).tolist() == [3, 2, 2]


def test_pii_scans_no_stretch_again_for_each_cue():
    import time

    anchors = pii.automaton()
    times = {}
    for text in ("eyJ" * 350_000, "eyJa.eyJ" * 120_000, "sk-" * 350_000, "1" * 1_000_000, "1." * 500_000, "+1 " * 350_000, "a@" * 500_000, "http://" * 150_000, "-----BEGIN " * 90_000, "IBAN " * 200_000):
        began = time.perf_counter()
        pii.find(text, anchors)
        times[text[:12]] = time.perf_counter() - began
    assert max(times.values()) < 12, times
    token = "eyJhbGci.eyJzdWIi.c2ln"
    assert [x[0] for x in pii.find(f"eyJeyJ {token} eyJx.{token}", anchors)] == ["secret", "secret"]
