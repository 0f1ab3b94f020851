"""Small document tables and plain versions of what the operators compute."""

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark, rows, parts=3):
    """rows: (doc_id, text) or (doc_id, text, lang, source). The column "copy" clashes with names of operators."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(parts)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    letters = str.maketrans("0123456789", "bcdfghjkmp")
    return " ".join("w" + str(rng.randrange(words)).translate(letters) for _ in range(n))


def words_of(text):
    return WORD.findall((text or "").encode().translate(FOLD))


def shingles(text, width=5):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def linked_components(rows, percent=75):
    """doc_id -> (set size, smallest linked id), all pairs compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: (len(s), top(i)) for i, s in sets}
