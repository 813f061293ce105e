"""Exact copies, near copies and repeated passages against brute force, and the odd cases of each."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from docloom.llm import exact_dedup, jaccard_join, substring_dedup
from docloom.llm.common import pack, unpack
from docloom.llm.components import components

from .data import LOWER, SPACE, corpus, frame, words


def exact_truth(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = {}
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            out[i] = (keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_exact_dedup(spark):
    rows = corpus() + [(7, None, None, None, None), (None, "a  b", "x", "y", 1), (8, "a b", None, None, None)]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == exact_truth(rows)


def test_exact_dedup_rows_that_repeat_and_clashing_columns(spark):
    rows = [(1, "a", 5), (1, "a", 6), (None, "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, keep_id int")
    got = sorted(exact_dedup.exact_dedup(docs).collect(), key=str)
    assert [r.kept for r in got] == [True, True, True] and {r.group_size for r in got} == {1, 2}
    kept = exact_dedup.drop_copies(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "z"), (1, "a")] and kept[0].asDict().keys() == {"doc_id", "text", "keep_id"}
    assert exact_dedup.exact_dedup(docs.filter("false")).count() == 0 and exact_dedup.drop_copies(docs.filter("false")).count() == 0


def test_drop_copies_keeps_the_text_as_it_was(spark):
    rows = [(2, "a \n b", "en", "s", 5), (5, "a b", "de", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (6, "c", "en", "s", 1)]
    got = {r.doc_id: tuple(r) for r in exact_dedup.drop_copies(frame(spark, rows)).collect()}
    assert got == {2: rows[0], 3: rows[2], 6: rows[4]}


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.exact_dedup(frame(spark, corpus(10)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ------------------------------------------------------------------ repeated passages

def passage_truth(rows, size=13):
    own = {}
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for k in range(len(w) - size + 1):
            own.setdefault(tuple(w[k:k + size]), i)
    out = {}
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and own[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_remove_repeats(spark, seed):
    rows = corpus(150, seed)
    rows.append((None, rows[3][1], None, None, None))
    got = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == passage_truth(rows)


def test_remove_repeats_other_sizes_and_empty(spark):
    rows = corpus(60, 5)
    got = substring_dedup.remove_repeats(frame(spark, rows), size=8).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == passage_truth(rows, 8)
    assert substring_dedup.remove_repeats(frame(spark, rows).filter("false")).count() == 0


def test_rows_that_repeat_an_id_take_nothing_from_each_other(spark):
    text = " ".join(f"w{k}" for k in range(20))
    got = substring_dedup.remove_repeats(frame(spark, [(1, text, None, None, None), (1, text, None, None, None), (2, text, None, None, None)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 20)]


def test_equal_windows_pick_equal_symbols():
    rng = np.random.default_rng(0)
    for trial in range(60):
        h = rng.integers(0, [3, 30, 10 ** 6][trial % 3], 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h[200:240] = h[50:90]
        bounds = np.array([0, 150, 150, 400])
        for rounds in (1, 2, 3):
            w, symbol, place = substring_dedup.pick(h, bounds, 13, rounds)
            assert len(w) == (150 - 12) + (250 - 12)
            seen = {}
            for a, s, p in zip(w.tolist(), symbol.tolist(), place.tolist()):
                key = tuple(h[a:a + 13].tolist())
                assert seen.setdefault(key, (s, p - a)) == (s, p - a)


# ------------------------------------------------------------------ near copies

def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def component_truth(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return {i: (len(s), least.get(root(k))) for k, (i, s) in enumerate(sets)}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, n, percent):
    rows = corpus(150, 9) + [(None, "only here", None, None, None)]
    got = jaccard_join.jaccard_components(frame(spark, rows), n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == component_truth(rows, n, percent)


def test_jaccard_large_group_with_hot_shingles(spark):
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 5)):
            w[k] = f"e{rng.integers(0, 3)}"
        rows.append((i, " ".join(w[:rng.integers(80, 121)]), None, None, None))
    for hot in (3, 2048):
        got = jaccard_join.jaccard_components(frame(spark, rows), hot=hot).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == component_truth(rows, 4, 85)


def test_jaccard_null_and_repeated_ids_and_long_texts(spark):
    long = " ".join(f"v{k % 7}x{k}" for k in range(30_000))
    rows = [(None, "one two three four five", None, None, None)] * 40 + [(7, "ONE two three four five", None, None, None)] * 3 + [(7, "other words", None, None, None), (9, long, None, None, None), (3, long + " more", None, None, None), (None, None, None, None, None)]
    got = sorted((r.doc_id or -1, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect())
    assert got == sorted([(-1, 2, 7)] * 40 + [(7, 2, 7)] * 3 + [(7, 1, 7), (9, 29997, 3), (3, 29998, 3), (-1, 0, -1)])


def test_unrelated_texts_with_stock_phrases_are_not_compared(spark):
    rng = np.random.default_rng(6)
    phrases = [" ".join(f"s{p}w{k}" for k in range(8)) for p in range(500)]
    rows = [(i, " ".join([*(f"u{i}n{k}" for k in range(12 if i % 2 else 60)), *(phrases[p] for p in rng.integers(0, 500, 5))]), None, None, None) for i in range(20_000)]
    prefix, _ = jaccard_join.split_sets(_written(spark, jaccard_join.candidate_sets(_written(spark, jaccard_join.document_sets(frame(spark, rows), id_col="doc_id", text_col="text", n=4)), n=4, percent=85)))
    assert jaccard_join.head_pairs(prefix, 85).count() + jaccard_join.other_pairs(prefix, components(spark.createDataFrame([], "a binary, b binary")), 85).count() < 100


def test_independent_texts_of_few_words_are_compared_within_reach_only(spark):
    rng = np.random.default_rng(7)
    after = rng.integers(0, 60, (60, 3))  # a chain with three followers for each word
    rows = []
    for i in range(1000):
        w = [int(rng.integers(0, 60))]
        for _ in range(80):
            w.append(int(after[w[-1], rng.integers(0, 3)]))
        rows.append((i, " ".join(f"c{x}" for x in w), None, None, None))
    prefix, _ = jaccard_join.split_sets(_written(spark, jaccard_join.candidate_sets(_written(spark, jaccard_join.document_sets(frame(spark, rows), id_col="doc_id", text_col="text", n=4)), n=4, percent=85)))
    alone = components(spark.createDataFrame([], "a binary, b binary"))
    assert jaccard_join.other_pairs(prefix, alone, 85).count() < 1000 * 999 // 2 // 10
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == component_truth(rows, 4, 85)


def _written(spark, df):
    return jaccard_join.materialize(df, "test")


def test_jaccard_empty_and_keep_one(spark):
    rows = [(3, "A b c d e f", None, None, None), (2, "a B c d e f", None, None, None), (4, None, None, None, None), (5, " ", None, None, None), (6, "q", None, None, None), (1, "Q", None, None, None)]
    kept = jaccard_join.keep_one(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 4, 5] and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    assert jaccard_join.jaccard_components(frame(spark, rows).filter("false")).count() == 0


def test_blocks_of_fingerprints():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 1000):
        r = np.unique(rng.integers(0, 1 << 32, size)).astype(np.uint32)
        times = rng.integers(1, 400, len(r))
        again, seen = unpack(pack(r, times))
        assert (again == r).all() and (seen == np.minimum(times, 255)).all()
    code = jaccard_join.frequency_code(np.array([1, 2, 3, 4, 10 ** 6, 10 ** 15]))
    assert code.tolist()[:2] == [0, 1] and (np.diff(code.astype(int)) > 0).all()
    assert (jaccard_join.blocks_of(code, 2048)[:4] == 1).all() and jaccard_join.blocks_of(code, 2048)[4] >= 10 ** 6 / 2048


def test_components(spark):
    links = [(f"{k * 37 % 101:03d}", f"{(k + 1) * 37 % 101:03d}") for k in range(60)] + [("a", "b"), ("b", "a"), ("c", "c"), ("b", "d")]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    chain = {got[x] for x, _ in links[:60]}
    assert len(chain) == 1 and got["a"] == got["b"] == got["d"] and "c" not in got
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
    odd = components(spark.createDataFrame([("a", None), (None, "b"), (None, None), ("a", "c"), *((f"h{k}", "hub") for k in range(500))], "a string, b string")).collect()
    assert {r.node: r.label for r in odd} == {"a": "a", "c": "a", "hub": "h0", **{f"h{k}": "h0" for k in range(500)}}
