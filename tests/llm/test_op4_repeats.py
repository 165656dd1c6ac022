import hashlib

import cases
import numpy as np
import pyarrow as pa
import pytest
from stagefare.llm import op4_repeats as op
from stagefare.llm.queries import op4_substring_dedup
from stagefare.llm.text import mix, words


def brute(rows):
    split = [(d, cases.WORD.findall(t or "")) for d, t in rows]
    owner = {}
    for d, w in split:
        for i in range(len(w) - 12 if d is not None else 0):
            key = tuple(w[i : i + 13])
            owner[key] = min(owner.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 12 if d is not None else 0):
            if owner[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def test_odd_documents_match_brute_force(spark):
    docs = cases.odd_docs(spark, ("anchors", "gone", "name", "one"))
    got = sorted(map(tuple, op.remove_repeats(docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] > 0 for r in got) > 30


def test_given_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, op4_substring_dedup(spark, sf_dir).collect()), key=str)
    assert got == [r[:4] for r in brute([(r.doc_id, r.text) for r in docs.collect()])]


def test_empty_and_null_ids(spark):
    assert op.remove_repeats(cases.no_docs(spark)).collect() == []
    docs = cases.with_null_id(spark)
    got = sorted(map(tuple, op.remove_repeats(docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r[2] == 0 for r in got)


@pytest.mark.parametrize("text", [cases.prose(1, 300, 6), "a " * 100, "a b " * 60, cases.prose(4, 400, 2), cases.prose(5, 300)])
def test_equal_windows_have_equal_anchors(text):
    """Wherever a window stands, its anchor is the same; edges of documents included."""
    w = text.split()
    shifted = [" ".join(w[k : k + 40]) for k in range(0, len(w) - 40, 7)] + [text, "q " + text, "q a " + text + " a r"]
    found = words(pa.array(shifted))
    names = mix(found.names())
    spans = op._Spans(names, op._BASES[0])
    anchor, starts = op.anchors(found, names, spans), op.window_starts(found)
    at = np.flatnonzero(starts)
    seen = {}
    for name, i in zip(spans.name(at, at + 13).tolist(), at.tolist(), strict=True):
        assert seen.setdefault(name, anchor[i]) == anchor[i]
    assert (anchor[at] != 0).all()
