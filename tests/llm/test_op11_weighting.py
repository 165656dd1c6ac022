import math
import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from stagefare.llm import op11_weighting as op
from stagefare.llm.queries import op11_context_weighting


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class Tree:
    """Context-tree weighting by its recursive definition, one bit sequence per (context, place)."""

    def __init__(self, order):
        self.order, self.zeros, self.ones = order, Counter(), Counter()
        self.children, self.known = {}, {}

    def steps(self, text):
        words = cases.WORD.findall(lowered(text))
        data = bytes([0xFE]) * self.order + " ".join(words).encode() + b"\xff"
        for t in range(self.order, len(data)):
            place = 1
            for k in range(7, -1, -1):
                bit = data[t] >> k & 1
                yield [(data[t - d : t], place) for d in range(self.order + 1)], bit
                place = place * 2 + bit

    def learn(self, text):
        for path, bit in self.steps(text):
            for k, node in enumerate(path):
                (self.ones if bit else self.zeros)[node] += 1
                if k < self.order:
                    self.children.setdefault(node, set()).add(path[k + 1])

    def own(self, node):
        a, b = self.zeros[node], self.ones[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def longer(self, node):
        return sum(self.weighted(c) for c in sorted(self.children.get(node, ())))

    def weighted(self, node):
        if node not in self.known:
            own = self.own(node)
            if len(node[0]) == self.order:
                self.known[node] = own
            else:
                low, high = sorted((own, self.longer(node)))
                self.known[node] = high + math.log1p(math.exp(low - high)) - math.log(2)
        return self.known[node]

    def ahead(self, path, k=0):
        node = path[k]
        a, b = self.zeros[node], self.ones[node]
        if not a + b:
            return 0.5
        estimate = (b + 0.5) / (a + b + 1)
        if k == self.order:
            return estimate
        weight = 1 / (1 + math.exp(min(700, self.longer(node) - self.own(node))))
        return weight * estimate + (1 - weight) * self.ahead(path, k + 1)

    def score(self, text):
        total = 0.0
        for path, bit in self.steps(text):
            p = self.ahead(path)
            total += math.log10(p if bit else 1 - p)
        return total


def brute(rows, order):
    tree, c, docs = Tree(order), Counter(), 0
    for d, t in rows:
        if not held(d):
            tree.learn(t)
            c.update(cases.WORD.findall(lowered(t)))
            docs += 1
    n, v = sum(c.values()) + docs, len(c) + (docs > 0)
    out = []
    for d, t in rows:
        words = cases.WORD.findall(lowered(t))
        of = [c[w] for w in words] + [docs]
        base = sum(math.log10((k + 1) / (n + 1 * (v + 1))) for k in of)
        out.append((d, held(d), len(of), sum(k > 0 for k in of), n, base, tree.score(t)))
    return sorted(out, key=lambda r: str(r[:5]) + f"{r[5]:.3f}")


def compare(got, want):
    got = sorted(map(tuple, got), key=lambda r: str(r[:5]) + f"{r[5]:.3f}")
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert a[6] == pytest.approx(b[6], rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("order", [2, 5])
def test_odd_documents_match_the_recursion(spark, order):
    docs = cases.odd_docs(spark, ("part", "run", "slot", "stream")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    docs = docs.filter("text is null or length(text) < 3000")
    got = op.score(docs, op.Plan(order=order, parts=5, run_bytes=4000)).collect()
    assert all(r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / size(r, docs), rel=1e-3) for r in got[:1])
    compare([tuple(r)[:7] for r in got], brute([(r.doc_id, r.text) for r in docs.collect()], order))


def size(row, docs):
    """Bytes that a document's score is about, its end sign included; of documents named once."""
    text = docs.filter(f"doc_id = {row.doc_id}").first().text
    return len(" ".join(cases.WORD.findall(lowered(text))).encode()) + 1


def test_runs_and_partitions_change_nothing(spark):
    docs = cases.odd_docs(spark)
    one = op.score(docs, op.Plan(parts=1)).collect()
    many = op.score(docs.repartition(7), op.Plan(parts=11, run_bytes=1)).collect()
    key = lambda r: (str(r.doc_id), r.n_tokens, round(r.score, 3))
    for a, b in zip(sorted(one, key=key), sorted(many, key=key), strict=True):
        assert tuple(a)[:5] == tuple(b)[:5]
        assert a.score == pytest.approx(b.score, rel=1e-6) and a.base_score == pytest.approx(b.base_score)


def test_merging_by_groups_changes_nothing(spark, monkeypatch):
    docs = cases.odd_docs(spark)
    whole = {(r.doc_id, r.n_tokens): r.score for r in op.score(docs).collect()}
    monkeypatch.setattr("stagefare.llm.runs.FAN", 3)
    merged = op.score(docs, op.Plan(run_bytes=1)).collect()
    assert all(r.score == pytest.approx(whole[r.doc_id, r.n_tokens], rel=1e-6) for r in merged)


def test_nothing_to_learn_from_or_score(spark):
    assert op.score(cases.no_docs(spark)).collect() == []
    only = spark.createDataFrame([(None, "ab"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r)[:7] for r in op.score(only).select("n_tokens", "n_known", "train_tokens", "base_score", "score").collect())
    assert [r[:4] for r in got] == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
    assert [r[4] for r in got] == pytest.approx([-8 * math.log10(2), -24 * math.log10(2)])


def test_probabilities_of_the_next_byte_sum_to_one():
    stream = op.stream_of(pa.array(["the cat sat on the mat", "the dog", ""]))
    _, grams = op.grams_of(stream, 0, len(stream), 5)
    keys, counts = op.summed(grams, np.ones(len(grams)))
    levels = op.subtree(keys, counts, 5, 2)
    node = [op.parents(n.keys).astype(np.int64) for n in levels[-1]]
    columns = [np.concatenate([getattr(n, c) for n in levels[-1]]) for c in ("zeros", "ones", "weighted")]
    top = op.top_of(np.concatenate(node), *columns)
    for context in (0xFEFEFEFEFE, int.from_bytes(b"t eht"[::1], "big"), int.from_bytes(b"zzzzz", "big")):
        every = np.arange(256, dtype=np.uint64) | np.uint64(context << 8)
        assert (10 ** op.log10_of(every, levels, top, 5)).sum() == pytest.approx(1)


def test_given_documents(spark, sf_dir):
    """Every row is scored; held-out texts cost few bits a byte, learned ones fewer."""
    rows = op11_context_weighting(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    kept, learned = ([r for r in rows if r.held_out == side] for side in (True, False))
    assert len(kept) > len(rows) / 10
    mean = lambda part: sum(r.bits_per_byte for r in part) / len(part)
    assert 0.5 < mean(learned) < mean(kept) < 3
