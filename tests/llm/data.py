"""Small corpora for the operators, and brute-force versions to hold them against."""

import random
import re

SPACE = re.compile(r"[\x20\x09-\x0d]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def corpus(n=120, seed=3):
    """Documents with copies, near copies, shared passages, runs, junk, nulls and blanks; ids are not in order."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for k in range(n):
        kind = k % 12
        fresh = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 12, 13, 14, 40, 90, 200]))]
        if kind == 0 and texts:
            fresh = words(rng.choice(texts))
        elif kind in (1, 2) and texts:
            fresh = words(rng.choice(texts))
            for _ in range(max(1, len(fresh) // 60)):
                if fresh:
                    fresh[rng.randrange(len(fresh))] = rng.choice(vocabulary)
        elif kind == 3:
            fresh = fresh[:30] + passage[rng.randint(0, 10):] + fresh[30:]
        elif kind == 4:
            fresh = [fresh[0]] * 30 + fresh[1:9] + ["x", "y"] * 15
        elif kind == 5:
            fresh = [w.upper() for w in fresh]
        text = rng.choice([" ", " ", "\n", "  ", "\t"]).join(fresh)
        texts.append({6: None, 7: "", 8: " \n\t "}.get(k % 40, text) if k % 40 in (6, 7, 8) else text)
    ids = list(range(1000, 1000 + n))
    rng.shuffle(ids)
    return [(i, t, rng.choice(["en", None]), None, None if t is None else len(t)) for i, t in zip(ids, texts)]


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)
