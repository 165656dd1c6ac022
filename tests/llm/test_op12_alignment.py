import hashlib
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from stagefare.llm import op12_alignment as op
from stagefare.llm.queries import op12_tokenizer_alignment
from tokenizers import Tokenizer


def byte_signs():
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs, extra = {}, 256
    for b in range(256):
        if b in visible:
            signs[chr(b)] = b
        else:
            signs[chr(extra)] = b
            extra += 1
    return signs


def brute(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    signs = byte_signs()
    docs = []
    for _, text in rows:
        tokens = ([], [])
        if text:
            whole = (" " + text).encode()
            a = [(t, bytes(signs[c] for c in first.id_to_token(t))) for t in first.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for t in second.encode(text):
                piece = second.id_to_piece(t)
                b.append((t, bytes([int(piece[3:5], 16)]) if second.is_byte(t) else piece.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                tokens = (a, b)
        ends = []
        for side in tokens:
            total, of = 0, []
            for t, raw in side:
                total += len(raw)
                of.append((total, t))
            ends.append(of)
        shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, start = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(t) for e, t in side if start < e <= end) for side in ends))
            start = end
        links = [(a, b) for x, a in ends[0] for y, b in ends[1] if x == y] if len(ends[0]) < 3000 else links_of(ends)
        docs.append((len(tokens[0]), len(tokens[1]), len(shared), links, ";".join(groups)))
    count = Counter(link for *_, links, _ in docs for link in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (doc_id, _), (n_a, n_b, groups, links, listed) in zip(rows, docs, strict=True):
        digest = hashlib.sha256(listed.encode()).hexdigest() if n_a else ""
        best = sum(count[x] == most[x[1]] for x in links)
        out.append((doc_id, n_a, n_b, groups, len(links), best, sum(count[x] for x in links), digest))
    return sorted(out, key=str)


def links_of(ends):
    of = dict(ends[1])
    return [(a, of[e]) for e, a in ends[0] if e in of]


ODD = [
    " lead", "two  spaces   three", "tab\tline\r\nfeed\n\n", "▁ already", "x▁y", "éè 中文 \U0001f600‍", "café",
    "ﬁ ligature Ａ", "<|endoftext|> </s> <s> <unk> <0x41>", "a\x00b", "   ", "\n", "don't we'll I'M", "12345 67.8 -- ...", " nbsp em",
    "aaaa" * 200, "e" * 5000, "การ العر", "�￾", "ab" * 3 + " the the the",
]


def odd(spark):
    docs = cases.odd_docs(spark, ("part", "run", "n_a")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    docs = docs.filter("text is null or length(text) < 3000")
    more = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    return docs.unionByName(more, allowMissingColumns=True)


def test_odd_documents_match_brute_force(spark):
    docs = odd(spark)
    got = sorted(map(tuple, op.count_links(docs.repartition(3), op.Plan(parts=5, run_bytes=2000)).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[1] == 0 for r in got) > 4 and sum(r[5] < r[4] for r in got) > 5


def test_runs_partitions_and_merges_change_nothing(spark, monkeypatch):
    docs = cases.odd_docs(spark)
    want = sorted(map(tuple, op.count_links(docs).collect()), key=str)
    monkeypatch.setattr("stagefare.llm.runs.FAN", 3)
    got = op.count_links(docs.repartition(9), op.Plan(parts=2, run_bytes=1)).collect()
    assert sorted(map(tuple, got), key=str) == want
    assert max(r[1] for r in want) > 30_000


def test_no_rows(spark):
    assert op.count_links(cases.no_docs(spark)).collect() == []


@pytest.mark.parametrize("frame", [1, 3, 50, 10_000])
def test_merge_of_runs_by_frames(frame, monkeypatch):
    monkeypatch.setattr(op, "FRAME", frame)
    r = np.random.default_rng(frame)
    rows, want = [], Counter()
    for k in range(9):
        n = int(r.integers(0, 400)) if k else 0
        pairs = np.unique((r.integers(0, 12, n).astype(np.uint64) << np.uint64(32)) | r.integers(0, 90, n).astype(np.uint64))
        counts = r.integers(1, 6, len(pairs))
        rows.append(op.frames(pairs, counts))
        want.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
    found = list(op.merged_pairs(rows))
    assert [int(p) for pairs, _ in found for p in pairs] == sorted(want)
    assert {int(p): int(c) for pairs, counts in found for p, c in zip(pairs, counts, strict=True)} == want
    sides = [{int(p) >> 32 for p in pairs} for pairs, _ in found]
    assert all(not a & b for a, b in zip(sides[:-1], sides[1:], strict=True))
    most = {}
    for p, c in want.items():
        most[p >> 32] = max(most.get(p >> 32, 0), c)
    for pairs, counts in found:
        assert op.highest(pairs, counts).tolist() == [want[int(p)] == most[int(p) >> 32] for p in pairs]


def test_given_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sorted(map(tuple, op12_tokenizer_alignment(spark, sf_dir).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs])
