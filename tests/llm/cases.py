"""Small tables with every oddity the operators must take, and plain-Python helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    words = [f"w{r.randrange(vocabulary)}é" if r.random() < 0.1 else f"w{r.randrange(vocabulary)}" for _ in range(n)]
    return " ".join(words)


def edited(text, seed, changes):
    r = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
    return " ".join(words)


def odd_texts():
    base, long_text = prose(1, 200), prose(2, 30_000, 5_000)
    texts = [None, "", " \t\n ", "one", "One", "two words", "a a a a", "a " * 60, "ab " * 40 + "c", base, base, base.upper()]
    texts += [edited(base, k, k % 14) for k in range(40)]
    texts += [long_text, edited(long_text, 3, 40), long_text + " tail", prose(5, 12), prose(6, 13), prose(6, 13), prose(7, 14)]
    texts += [prose(8, 60) + " " + base + " " + prose(9, 60), " x y 中文 \U0001f600", "   lead " + base, base + "\n"]
    return texts


def odd_docs(spark, extra=("component_id", "key", "n_shingles")):
    """Documents with nulls, copies, near copies, very long texts, and columns that clash."""
    rows = [(k, t, "en" if k % 3 else None, "src0", None if t is None else len(t)) for k, t in enumerate(odd_texts())]
    rows += [rows[9], rows[9], rows[4]]
    df = spark.createDataFrame([r + ("clash",) * len(extra) for r in rows], DOC_SCHEMA + "".join(f", {c} string" for c in extra))
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def with_null_id(spark):
    return spark.createDataFrame([(None, prose(1, 30), None, None, None), (None, prose(1, 30), None, None, None), (1, prose(1, 30), None, None, None), (2, None, None, None, None)], DOC_SCHEMA)


def groups(pairs, vertices):
    """Least reachable vertex of each vertex, by union-find."""
    parent = {v: v for v in vertices}

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in vertices}
