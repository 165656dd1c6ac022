import os
import random
import subprocess
import sys

import cases
import numpy as np
import pyarrow as pa
import pytest
from stagefare.llm import op3_decontaminate as op3
from stagefare.llm import op8_embeddings as op8
from stagefare.llm.queries import op3_benchmark_decontamination, op8_embedding_dedup


def bare(text):
    return bytes(b for b in op3._MAPPED[np.frombuffer((text or "").encode(), np.uint8)] if b)


def least_edits(item, text):
    """Edit distance of an item from the nearest part of a text, cell by cell."""
    row = np.zeros(len(text) + 1, int)
    letters = np.frombuffer(text, np.uint8)
    for i, sign in enumerate(item, 1):
        step = np.append(i, np.minimum(row[:-1] + (letters != sign), row[1:] + 1))
        row = np.minimum.accumulate(step - np.arange(len(step))) + np.arange(len(step))
    return int(row.min())


def brute(docs, items):
    out = set()
    for d, t in docs:
        text = bare(t)
        for i, item in items:
            item = bare(item)
            if len(item) >= op3.MIN_ITEM and least_edits(item, text) <= op3.edits_allowed(len(item)):
                out.add((d, i))
    return out


def noisy(text, seed, edits):
    r, signs = random.Random(seed), list(text)
    for _ in range(edits):
        at = r.randrange(len(signs))
        signs[at] = r.choice(["", "q", signs[at] + "z"])
    return "".join(signs)


def test_items_within_their_edit_budget_are_found(spark):
    items = [(k, cases.prose(k + 50, 12 + k)) for k in range(8)] + [(90, "short"), (91, None), (92, ""), (93, cases.prose(50, 12))]
    docs = []
    for k in range(60):
        item = items[k % 8][1]
        docs.append((k, cases.prose(200 + k, k * 3) + " " + noisy(item, k, k // 4).upper() + "!!" + cases.prose(300 + k, 9)))
    docs += [(70, None), (71, ""), (72, "q" * 9_000), (73, (items[3][1] + " ") * 40), (None, items[2][1]), (0, docs[0][1])]
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    rows = op3.find(table, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items)
    whole = {d: t for d, t in docs}
    for r in rows:
        found = bare(whole[r.doc_id][r.start : r.end])
        assert least_edits(bare(dict(items)[r.item_id]), found) <= r.edits or r.edits == 0
    kept = op3.remove(table, benchmark)
    assert kept.columns == table.columns
    flagged = {r.doc_id for r in rows}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in flagged)
    assert op3.find(cases.no_docs(spark), benchmark).collect() == [] and op3.find(table, benchmark.limit(0)).collect() == []


def test_given_benchmark(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in op3_benchmark_decontamination(spark, sf_dir).collect()}
    assert {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text} <= got
    few = [(d.doc_id, d.text) for d in docs if len(d.text) < 1500][:40]
    assert brute(few, [(i.item_id, i.text) for i in items]) == {g for g in got if g[0] in {d for d, _ in few}}


CASED = [
    "¿Cuándo empezó la construcción del ferrocarril según él, y qué ocasión única celebró María después?",
    "Où l'élève a-t-elle été préparée à l'épreuve, et à quelle époque a-t-on dépêché Hélène là-bas ?",
    "Größere Städte äußern überall höchst ungewöhnliche Wünsche: müßte man für Straßenbäume Gebühren erhöhen?",
    "Почему летним вечером над рекой долго стоит густой туман и не слышно птиц?",
    "ᾳ τίνος ΐσως ΰδωρ ᾀδουσιν οἱ ποιηταὶ τῆς Ἑλλάδος ŉ ǰ ﬁ ﬀ",
    "Işıklı kıyıların yakınında İstanbul'un ılık kış akşamları nasıl kısalır?",
]


def test_case_of_letters_beyond_ascii_hides_nothing(spark):
    docs = []
    for k, item in enumerate(CASED):
        for n, form in enumerate((item, item.upper(), item.lower(), item.swapcase())):
            docs.append((10 * k + n, "Éé " + cases.prose(k, 30) + " ÀÉ " + form + " Öö " + cases.prose(k + 9, 20)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(CASED)), "item_id long, text string")
    rows = op3.find(table, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, d // 10) for d, _ in docs}
    whole = dict(docs)
    for r in rows:
        assert r.edits == 0
        if r.doc_id % 10 < 2:
            found, item = (x.upper().casefold() for x in (whole[r.doc_id][r.start : r.end], CASED[r.item_id]))
            assert found.strip(" ¿?") == item.strip(" ¿?")
    assert op3.remove(table, benchmark).count() == 0


def test_folding_matches_python_and_keeps_places():
    import pyarrow as pa

    signs = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    data, place, bounds = op3.reduced(pa.array(signs))
    starts = np.cumsum([0, *(len(c.encode()) for c in signs)])
    for k, c in enumerate(signs):
        expected = bytes(b for b in c.upper().casefold().encode() if b >= 128 or chr(b).isalnum())
        assert data[bounds[k] : bounds[k + 1]].tobytes() == expected, hex(ord(c))
    assert (np.diff(place) >= 0).all()
    assert (np.searchsorted(starts, place, side="right") - 1 == np.repeat(np.arange(len(signs)), np.diff(bounds))).all()


def test_a_region_may_start_inside_a_character(spark):
    item = "é" + cases.prose(77, 14).replace("é", "e")
    text = "ñ©" + item[1:]
    table = spark.createDataFrame([(1, text), (2, item[1:]), (3, "x" + item[1:] + "ñ")], "doc_id long, text string")
    rows = op3.find(table, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted({r.doc_id for r in rows}) == [1, 2, 3]


def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "Wer bist du?"), (2, "12 + 7 = 19"), (3, "Élan"), (4, "Who wrote Hamlet, then"), (5, "首都是哪里"), (6, "?!"), (7, "élan")]
    docs = [(1, "so: WER BIST DU, sag"), (2, "x 12+7=19."), (3, "l'ÉLAN vital"), (4, "who wrote hamlet then?"), (5, "中国的首都是哪里呢")]
    docs += [(6, "wer bist duo, 12+7=198, élans, bwho wrote hamlet then"), (7, "?! wer bist"), (8, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = op3.find(table, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 2), (3, 3), (3, 7), (4, 4), (5, 5)}
    assert {docs[r.doc_id - 1][1][r.start : r.end] for r in rows} == {"WER BIST DU", "12+7=19", "ÉLAN", "who wrote hamlet then", "首都是哪里"}
    assert sorted(r.doc_id for r in op3.remove(table, benchmark).collect()) == [6, 7, 8]


def vectors(seed=4):
    r = np.random.default_rng(seed)
    rows = []
    for g in range(60):
        centre = r.standard_normal(24)
        for k in range(1 + g % 7 * 3):
            spread = (0.0, 0.05, 0.1, 0.16)[k % 4]
            rows.append((len(rows), (centre + spread * r.standard_normal(24)).astype(np.float32).tolist(), g % 3))
    return rows


def links(rows):
    def usable(v, label):
        return v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, np.float32).astype(float), c) for i, v, c in rows if i is not None and usable(v, c)]
    out = []
    for k, (a, x, c) in enumerate(good):
        for b, y, d in good[:k]:
            if c == d and len(x) == len(y) and a != b and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                out.append((a, b))
    return out


def check(got, rows):
    pairs = links(rows)
    component = cases.groups(pairs, {i for i, _, _ in rows if i is not None})
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
            continue
        assert r.n_links == sum(r.vec_id in p for p in pairs)
        assert r.component_id == component[r.vec_id] and r.kept == (r.vec_id == r.component_id)


def test_embeddings_match_brute_force(spark, monkeypatch):
    rows = vectors()
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 24, 1), (n + 3, [float("nan")] * 24, 1), (n + 4, [None, 1.0], 1), (n + 5, rows[3][1], None), (None, rows[3][1], 0), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows] + [(*rows[5], 1, 2)], "vec_id long, embedding array<float>, label int, n long, codes int")
    got = op8.cluster(table).collect()
    assert len(got) == len(rows)
    check(got, rows)
    monkeypatch.setattr(op8, "CHUNK", 4)  # many chunks to a bucket
    check(op8.cluster(table).collect(), rows)
    assert op8.cluster(table.limit(0)).collect() == []


def test_given_embeddings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = op8_embedding_dedup(spark, sf_dir).collect()
    assert len(got) == len(rows)
    check(got, [(r.vec_id, r.embedding, r.label) for r in rows])


REPETITIVE = ["a" * 400, "abc" * 130, "ha" * 60 + cases.prose(3, 10), cases.prose(4, 12)]


@pytest.mark.parametrize("expanded", [7, 1000, 1 << 19])
def test_repetitive_texts_by_slices(monkeypatch, expanded):
    """Slices change nothing: every item within its edits is found wherever a text repeats itself."""
    monkeypatch.setattr(op3, "EXPANDED", expanded)
    texts = ["a" * 1500, "abc" * 400, "x" + "a" * 395 + "bb" + "a" * 30, "ha" * 300 + " " + cases.prose(3, 10), "b" * 700, "acb" * 200, "q" + cases.prose(4, 12) + "a" * 380]
    items = op3.Items.of(list(range(len(REPETITIVE))), pa.array(REPETITIVE))
    got = {(row, item) for row, item, *_ in items.search(pa.array(texts))}
    assert got == brute(list(enumerate(texts)), list(enumerate(REPETITIVE)))
    assert len(got) > 4


def test_candidates_are_those_of_all_pairs(monkeypatch):
    """Bands by counting every pair of equal q-grams at once, of texts with runs, copies and edits."""
    r = random.Random(8)
    items = [cases.prose(20 + k, 14) for k in range(5)] + REPETITIVE
    texts = [noisy(r.choice(items), k, k % 6) + r.choice(["", "a" * 300, "abc" * 50, cases.prose(k, 20)]) for k in range(30)]
    found = op3.Items.of(list(range(len(items))), pa.array(items))
    data, _, bounds = op3.reduced(pa.array(texts))
    whole = sorted(map(tuple, found.candidates(data, bounds).tolist()))
    want = []
    for t in range(len(texts)):
        text = data[bounds[t] : bounds[t + 1]].tobytes()
        for i, x in enumerate(found.bytes_):
            item, allowed = x.tobytes(), op3.edits_allowed(len(x))
            width, bands = 2 * allowed + 1, {}
            for p in range(len(item) - op3.Q + 1):
                for at in range(len(text) - op3.Q + 1):
                    if item[p : p + op3.Q] == text[at : at + op3.Q]:
                        band = (at - p + len(item)) // width
                        bands.setdefault(band, set()).add(p)
                        bands.setdefault(band - 1, set()).add(p)
            for band, places in bands.items():
                if len(places) >= len(item) - op3.Q + 1 - allowed * op3.Q:
                    low = band * width - len(item)
                    want.append((t, i, low, low + 2 * width - 1))
    assert whole == sorted(want)


def test_two_megabytes_of_one_letter_stay_in_memory():
    """In a process of its own: the peak beyond what imports take stays below 1 GB."""
    code = """
import resource, pyarrow as pa
from stagefare.llm import op3_decontaminate as op3
items = op3.Items.of([1, 2], pa.array(["a" * 400, "abc" * 130]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text, item in (("a" * (2 << 20), 1), ("abc" * 700_000, 2)):
    found = items.search(pa.array([text]))
    assert {f[1] for f in found} == {item} and all(f[4] == 0 for f in found), found[:3]
    assert found[0][2] < 400 and found[-1][3] > len(text) - 800
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ":".join(sys.path)}, timeout=300, check=True)
    assert int(done.stdout) < 1000


def test_vectors_of_any_scale_link(spark):
    """Finite entries whose squares are not: their cosine is one all the same."""
    base = [0.3, -0.7, 0.2, 0.9]
    rows = [(k, [x * scale for x in base], 1) for k, scale in enumerate((1.0, 1e200, 1e-200, 1e307, 5e-300))] + [(9, [-x * 1e200 for x in base], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in op8.cluster(df).collect()}
    assert got == {k: (4, 0) for k in range(5)} | {9: (0, 9)}
