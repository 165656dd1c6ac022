import zlib

import cases
import numpy as np
from stagefare.llm import op2_toxicity, op5_language
from stagefare.llm.queries import op2_toxicity_fm, op5_language_id


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_toxicity_on_held_out_documents(spark, sf_dir):
    rows = {r.doc_id: r for r in op2_toxicity_fm(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (remainder(d, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in rows.items())
    clean = [d for d, t in labels.items() if not t]
    assert np.mean([rows[d].predicted for d in clean]) < 0.05
    insulted = [r.doc_id for r in docs if labels.get(r.doc_id) and "idiot" in r.text.lower()]
    assert all(rows[d].predicted for d in insulted if d in rows)


def test_labels_of_held_out_documents_are_not_used(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    one, two = (sorted(map(tuple, op2_toxicity.rate(docs, x).collect())) for x in (labels, flipped))
    assert one == two


def test_machine_learns_what_pairs_mean():
    """Two terms that are harmless alone and toxic together: no additive weights can say so."""
    r = np.random.default_rng(1)
    parts, y = [], []
    for _ in range(3000):
        insult, group = r.random(2) < 0.5
        parts.append(np.unique([*([1] if insult else []), *([2] if group else []), *r.integers(10, 400, 20)]))
        y.append(float(insult and group))
    bounds = np.append(0, np.cumsum([len(p) for p in parts]))
    machine = op2_toxicity.fit(np.concatenate(parts), bounds, np.array(y))
    score = machine.score(*machine.features(np.concatenate(parts), bounds), len(parts))
    assert ((score >= 0.5) == (np.array(y) == 1)).mean() > 0.99


def test_toxicity_odd_documents(spark, sf_dir):
    labels = spark.createDataFrame([(k, 1, None if k % 5 == 3 else k % 2) for k in range(40)] + [(4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = cases.odd_docs(spark, ("toxic", "score", "terms")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    rows = op2_toxicity.rate(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert op2_toxicity.rate(cases.no_docs(spark), labels).collect() == []
    assert all(r.score < 1e-6 for r in op2_toxicity.rate(docs, labels.limit(0)).collect())
    assert op2_toxicity.remove(docs, labels.limit(0)).count() == docs.count()


def test_language_on_held_out_documents(spark, sf_dir):
    rows = {r.doc_id: r for r in op5_language_id(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    held = [r for r in docs if remainder(r.doc_id, 4) == 2]
    assert len(rows) == len(docs) and all(rows[r.doc_id].held_out == (remainder(r.doc_id, 4) == 2) for r in docs)
    assert np.mean([rows[r.doc_id].lang_pred == r.lang for r in held]) > 0.95


def test_language_odd_documents(spark):
    docs = cases.odd_docs(spark, ("lang_pred", "score", "place")).unionByName(cases.with_null_id(spark), allowMissingColumns=True)
    rows = op5_language.identify(docs).collect()
    texts = docs.select("text").collect()
    assert len(rows) == len(texts)
    assert sum(r.lang_pred == "und" for r in rows) == sum(not any(c.isalpha() for c in t.text or "") for t in texts)
    assert all(0 <= r.score <= 1 for r in rows)
    assert op5_language.identify(cases.no_docs(spark)).collect() == []
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in op5_language.identify(unlabelled).collect()} == {"und"}


def test_profiles_are_bundles_of_bound_letters():
    import pyarrow as pa

    vectors, lettered = op5_language.profiles(pa.array(["ab  c", None, "12!", "AB c", "é"]))
    letters = op5_language._letters()
    a, b, c, gap = (letters[k] for k in (1, 2, 3, 0))
    two, one = (lambda x: np.roll(x, 2)), (lambda x: np.roll(x, 1))
    bundle = two(gap) * one(a) * b + two(a) * one(b) * gap + two(gap) * one(c) * gap
    assert np.allclose(vectors[0], bundle / np.linalg.norm(bundle), atol=1e-5) and np.allclose(vectors[0], vectors[3])
    assert lettered.tolist() == [True, False, False, True, True]


def _pair_texts(rule, count=3000):
    r = np.random.default_rng(1)
    parts, y = [], []
    for _ in range(count):
        one, two = r.random(2) < 0.5
        parts.append(np.unique([*([1] if one else []), *([2] if two else []), *r.integers(10, 400, 20)]))
        y.append(float(rule(one, two)))
    return parts, np.array(y)


def _flat(parts):
    return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def test_machine_learns_pairs_that_tell_nothing_alone():
    """Toxic with both terms or neither: each alone is equally common on both sides."""
    parts, y = _pair_texts(lambda a, b: a == b)
    machine = op2_toxicity.fit(*_flat(parts[:2000]), y[:2000])
    assert {1, 2} <= set(machine.kept.tolist()) and len(machine.kept) < 10
    score = machine.score(*machine.features(*_flat(parts)), len(parts))
    assert ((score >= 0.5) == (y == 1))[2000:].mean() > 0.99


def test_effects_that_add_up_make_no_pair():
    r = np.random.default_rng(5)
    one = r.random(6000) < 0.5
    two = np.where(one, r.random(6000) < 0.8, r.random(6000) < 0.2)  # the terms go together
    y = (r.random(6000) < 0.1 + 0.3 * one + 0.3 * two).astype(float)
    parts = [np.unique([*([1] if a else []), *([2] if b else []), 3]) for a, b in zip(one, two)]
    flat, bounds = _flat(parts)
    found, number = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(6000), np.diff(bounds))
    assert not op2_toxicity.joint_terms(owner, number, y, np.bincount(number)).any()


def test_score_is_the_sum_over_all_pairs():
    r = np.random.default_rng(2)
    kept = np.array([3, 5, 8, 13, 21, 34])
    machine = op2_toxicity.Machine(kept, -0.3, r.normal(size=6), r.normal(size=(6, 4)))
    parts = [np.unique(r.integers(0, 40, r.integers(0, 30))) for _ in range(200)]
    found = machine.score(*machine.features(*_flat([*parts, np.zeros(0, np.int64)])), 201)
    for part, score in zip([*parts, []], found):
        own = [k for k, term in enumerate(kept) if term in part]
        total = machine.bias + sum(machine.weights[k] for k in own)
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                total += sum(machine.factors[a][f] * machine.factors[b][f] for f in range(4))
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_repeated_ids_learn_from_one_text(spark):
    docs = spark.createDataFrame([(k, t) for k in range(200) for t in ("calm words", f"zz{k % 2} word")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)], "doc_id long, quality int, toxic int")
    one, two = (op2_toxicity.learn(d, labels) for d in (docs, docs.repartition(7)))
    assert len(one.kept) == 2 and np.array_equal(one.weights, two.weights)
