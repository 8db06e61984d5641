"""Small inputs and brute-force versions that the tests share."""

import hashlib
import random
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(rng, n, letters="abcdeé"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(n)]


def edge_texts():
    return [None, "", " \n\t", "x", "a b c", "é" * 3000, "ab " * 4000, "x" * 20000]


def frame(spark, texts, ids=None, **more):
    """Documents with columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "L", "S", len(t or ""), 1, "k", b"x") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sig int, key string, cover binary").repartition(3)


def covered(texts, window):
    seen, raws, out = Counter(), [(t or "").encode() for t in texts], []
    for b in raws:
        for i in range(len(b) - window + 1):
            seen[b[i : i + window]] += 1
    for b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, k=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_classes(rows):
    sets = [shingles(t) for _, t in rows]
    root, degree = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), 1 << 60), rows[i][0])
    return [(rows[i][0], least[find(i)], degree[i], len(sets[i])) for i in range(len(rows))]


def near_texts(seed=3):
    rng, out = random.Random(seed), []
    for _ in range(30):
        base = words(rng, rng.choice([3, 5, 6, 20, 60, 200]))
        for _ in range(rng.choice([1, 2, 3, 40])):
            x = list(base)
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = words(rng, 1)[0]
            out.append(" ".join(x))
    return out
