"""The whole pipeline over the given tables, every stage against what its input says."""

import sys
from pathlib import Path

import cases

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from stagefare.llm import op1_pii, op2_toxicity, op3_decontaminate
from stagefare.llm.tables import materialize, read
from stagefare.llm.tokens import encoder


def shingles(text, n=5):
    words = cases.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def kept_of(rows):
    """The least document of every group of texts that share 80 % of their shingles."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    ids = sorted(sets)
    pairs = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {v for v, least in cases.groups(pairs, ids).items() if v == least}


def test_every_stage_does_its_work_and_run_is_their_chain(spark, sf_dir):
    given = read(spark, sf_dir, "documents")
    seen, docs = {}, given
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        seen[name] = docs
        assert k + 1 == len(corpus_pipeline.STAGES) or docs.columns == given.columns
    rows = {name: df.collect() for name, df in seen.items()}
    start = given.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "personal-data", "packing"]

    rated = {r.doc_id: r.predicted for r in op2_toxicity.rate(given, read(spark, sf_dir, "labels")).collect()}
    assert {r.doc_id for r in rows["toxicity"]} == {d for d, toxic in rated.items() if not toxic}
    assert sorted(rows["toxicity"]) == sorted(r for r in start if not rated[r.doc_id])

    kept = kept_of(rows["toxicity"])
    assert sorted(rows["near-duplicates"]) == sorted(r for r in rows["toxicity"] if r.doc_id in kept)
    assert len(kept) < len(rows["toxicity"])

    leaked = {r.doc_id for r in op3_decontaminate.find(seen["near-duplicates"], read(spark, sf_dir, "benchmark")).collect()}
    assert leaked
    assert sorted(rows["decontamination"]) == sorted(r for r in rows["near-duplicates"] if r.doc_id not in leaked)

    before = {r.doc_id: r for r in rows["decontamination"]}
    assert sorted(before) == sorted(r.doc_id for r in rows["personal-data"])
    for r in rows["personal-data"]:
        assert not op1_pii.base_spans(r.text) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        if not any(c in "0123456789@[(" for c in before[r.doc_id].text):
            assert r.text == before[r.doc_id].text

    texts = {r.doc_id: r.text for r in rows["personal-data"]}
    pieces = {}
    for r in rows["packing"]:
        pieces.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    assert pieces.keys() == texts.keys()
    for d, own in pieces.items():
        assert [i for _, ids in sorted(own) for i in ids] == [*encoder()._whole(texts[d]).tolist(), 1]

    whole = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sum(r.length for r in whole.collect()) == sum(len(ids) for own in pieces.values() for _, ids in own)
    assert {r.doc_id for r in whole.select(*columns).collect()} == texts.keys()
