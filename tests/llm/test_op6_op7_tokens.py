import random
import zlib
from collections import defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from stagefare.llm import op6_packing, op7_store
from stagefare.llm.queries import op6_packing_tiers, op7_token_store
from stagefare.llm.tokens import VOCABULARY, Encoder
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    tool = Tokenizer.from_file(VOCABULARY)
    tool.encode_special_tokens = True
    return lambda text: tool.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_strings():
    r = random.Random(5)
    signs = "ab'sTtreVEll 12  \n\t é!.,- ’ß½中\U0001f600\x1c​　'"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(1500)]
    texts += ["".join(r.choice("a' sre\n") for _ in range(r.randrange(30))) for _ in range(1500)]
    return [*texts, *cases.odd_texts(), "<|endoftext|> x", "  ", "'s", "x's'll 're"]


def test_ids_are_the_library_s(library):
    tool, texts = Encoder(VOCABULARY), odd_strings()
    for k in range(0, len(texts), 501):
        part = texts[k : k + 501]
        ids, bounds = tool.encode(pa.array(part, pa.string()))
        for row, text in enumerate(part):
            assert ids[bounds[row] : bounds[row + 1]].tolist() == library(text), repr(text)


def check_pieces(rows, docs, library, tasks):
    expected = defaultdict(list)
    for d, t in docs:
        expected[d].append([*library(t), op6_packing.END_ID])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for d, copies in expected.items():
        for ids in copies:
            covered = [0] * len(ids)
            for r in pieces[d, len(ids)]:
                assert r.ids_crc32 in {crc(c[r.start : r.start + r.length]) for c in copies}
                for i in range(r.start, r.start + r.length):
                    covered[i] += 1
            assert set(covered) == {sum(len(c) == len(ids) for c in copies)}
    short = 0
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in s]).tolist()
        assert [r.offset for r in s] == [0, *ends[:-1]] and ends[-1] <= s[0].tier <= 2048
        assert len({(r.tier, r.step) for r in s}) == 1
        short += ends[-1] < s[0].tier
    assert short <= tasks
    full = defaultdict(int)
    for s in sequences.values():
        full[s[0].step] += s[0].tier
    assert max(full.values()) <= op6_packing.STEP_IDS


def test_packing_odd_documents(spark, library):
    docs = cases.odd_docs(spark, ("ids", "start", "tier")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    docs = docs.repartition(3)
    rows = op6_packing.pack(docs).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], library, 3)
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    assert op6_packing.pack(cases.no_docs(spark)).collect() == []


def test_packing_given_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op6_packing_tiers(spark, sf_dir).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], library, docs.rdd.getNumPartitions())


@pytest.mark.parametrize("lengths", [[1100] * 500, [2047] * 9, [1] * 5000, [256, 512, 1024, 2048, 4096], [700, 3], list(range(1, 2049, 7))])
def test_waiting_is_less_than_a_window(lengths):
    windows, waiting = op6_packing.pack_block([(k, 0, n) for k, n in enumerate(lengths)])
    assert sum(p[2] for p in waiting) < 2048
    assert all(sum(p[2] for p in w) in op6_packing.TIERS for w in windows)
    assert sum(p[2] for w in windows for p in w) + sum(p[2] for p in waiting) == sum(lengths)


def stored(docs, library):
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library(t), op7_store.END_ID]
        out.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_store_given_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = sorted(map(tuple, op7_token_store(spark, sf_dir).collect()))
    assert got == stored([(r.doc_id, r.text) for r in docs], library)


def test_store_odd_documents(spark, library):
    docs = cases.odd_docs(spark, ("ids", "keys", "shard")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, op7_store.round_trip(docs).collect()), key=lambda r: r[1])
    assert got == stored(rows, library)
    assert op7_store.round_trip(cases.no_docs(spark)).collect() == []


def test_look_up_knows_what_is_there(spark, tmp_path):
    docs = spark.range(0, 6000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    op7_store.write(docs, str(tmp_path / "store"))
    found = op7_store.look_up(spark, str(tmp_path / "store"), spark.range(-10, 7000).withColumnRenamed("id", "doc_id"))
    rows = {r.doc_id: r for r in found.collect()}
    assert sorted(rows) == list(range(0, 6000, 2))
    assert all(r.start == 3 * (d // 2) and r["size"] == 3 and r["count"] == 1 for d, r in rows.items())


def test_reading_goes_by_the_index(spark, tmp_path):
    """An index entry that points elsewhere is seen, be it to the next document or into the middle of one."""
    docs = spark.range(0, 300).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    path = str(tmp_path / "store")
    op7_store.write(docs, path)
    keys = docs.select("doc_id")
    assert op7_store.read_back(spark, path, keys.limit(10)).count() == 10
    plan = op7_store.read_back(spark, path, keys)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    index = spark.read.parquet(f"{path}/index").toPandas()
    for name, by in (("start", 3), ("start", 1), ("marks", 1)):
        wrong = index.copy()
        kind = "<u4" if name == "marks" else "<i8"
        values = np.frombuffer(wrong[name][0], kind).copy()
        values[0] += by
        wrong.at[0, name] = values.tobytes()
        schema = spark.read.parquet(f"{path}/index").schema
        spark.createDataFrame(wrong, schema).write.mode("overwrite").parquet(f"{path}/index")
        if name == "marks":
            assert op7_store.read_back(spark, path, keys).count() == 299
        else:
            with pytest.raises(Exception, match="does not hold its key"):
                op7_store.read_back(spark, path, keys).collect()


def test_keys_over_several_blocks(spark, library, monkeypatch):
    rows = [(7, f"text {k} " * 40) for k in range(400)] + [(None, f"none {k}") for k in range(60)] + [(k, "x") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = stored(rows, library)
    for most in (64 << 20, 0):
        monkeypatch.setattr(op7_store, "BROADCAST_BYTES", most)
        got = sorted(map(tuple, op7_store.round_trip(docs).collect()), key=lambda r: r[1])
        assert got == wanted


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 1500])
def test_perfect_hash_is_minimal(size):
    r = random.Random(size)
    keys = np.array(sorted({r.randrange(2**63) for _ in range(size)}), np.uint64)
    for shift in range(20 if size < 100 else 3):
        own = keys + np.uint64(shift)
        assert sorted(op7_store.PerfectHash.build(own).slots(own).tolist()) == list(range(size))


def test_perfect_hash_of_many_buckets():
    for first in range(0, 400_000, 1000):
        keys = np.arange(first, first + 1000, dtype=np.uint64)
        assert len(np.unique(op7_store.PerfectHash.build(keys).slots(keys))) == 1000
