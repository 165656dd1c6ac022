from collections import defaultdict

import cases
from stagefare.llm import op9_jaccard
from stagefare.llm.op9_jaccard import cluster, shingle_sets  # noqa: F401
from stagefare.llm.queries import op9_jaccard_join


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = cases.WORD.findall(lower)
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    common = defaultdict(int)
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                common[a, b] += 1
    links = [
        (sets[a][0], sets[b][0])
        for (a, b), n in common.items()
        if 100 * n >= 90 * (len(sets[a][1]) + len(sets[b][1]) - n)
    ]
    component = cases.groups(links, {d for d, _ in sets})
    return sorted((d, len(s), component[d]) for d, s in sets)


def test_odd_documents_match_brute_force(spark):
    docs = cases.odd_docs(spark)
    got = cluster(docs).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got)) == expected
    assert len({c for _, _, c in expected}) < len(expected) - 20  # near copies were found


def test_given_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = op9_jaccard_join(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_many_components_in_one_bucket(spark):
    """Texts that share most sketch words but do not all link keep the links not to a hub."""
    base = cases.prose(3, 120, 10**6)
    rows = []
    for group in range(6):
        start = cases.edited(base, group, 7)
        rows += [(100 * group + k, cases.edited(start, 1000 * group + k, k % 2)) for k in range(5)]
    rows.reverse()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, cluster(docs).collect())) == brute(rows)


def test_an_id_with_two_texts_joins_their_components(spark):
    one, two = cases.prose(1, 40), cases.prose(2, 40)
    rows = [(5, one), (7, two), (7, one), (9, two), (11, cases.prose(3, 40))]
    got = cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (7, 5), (7, 5), (9, 5), (11, 11)]


def test_empty_and_null_ids(spark):
    assert cluster(cases.no_docs(spark)).collect() == []
    got = sorted(map(tuple, cluster(cases.with_null_id(spark)).collect()), key=str)
    assert [r for r in got if r[0] is None] == [(None, 28, None)] * 2
    assert (1, 28, 1) in got and (2, 0, 2) in got


def test_a_group_of_several_chunks_just_below_the_threshold(spark, monkeypatch):
    """Most pairs share sketch words but do not link; the few links between chunks are found."""
    monkeypatch.setattr(op9_jaccard, "CHUNK", 5)
    base = cases.prose(4, 90, 10**6)
    rows = [(k, cases.edited(base, k, 3)) for k in range(60)]
    rows += [(1000 + k, cases.edited(t, 2000 + k, 1)) for k, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert 5 < len({c for _, _, c in expected}) < 75
    assert sorted(map(tuple, cluster(docs).collect())) == expected


def test_only_near_members_of_a_bucket_are_dealt_with_their_texts(spark, monkeypatch):
    """Texts that share a passage meet in buckets, but those that nothing is near to go no further than their sketches."""
    monkeypatch.setattr(op9_jaccard, "SKETCHES", 7)
    passage = cases.prose(11, 90, 10**6)
    rows = [(k, f"{passage} {cases.prose(100 + k, 14, 10**6)}") for k in range(60)]
    base = cases.prose(4, 90, 10**6)
    rows += [(200 + k, cases.edited(base, k, 1)) for k in range(20)]
    rows += [(400, cases.prose(12, 9000, 10**6)), (401, cases.edited(cases.prose(12, 9000, 10**6), 2, 200))]
    rows += [(rows[3][0], cases.edited(rows[3][1], 5, 2)), (rows[65][0], cases.prose(13, 40))]
    held, write = {}, op9_jaccard.materialize

    def counted(df, name, *a):
        out = write(df, name, *a)
        held[name] = out.count()
        return out

    monkeypatch.setattr(op9_jaccard, "materialize", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted({(r.doc_id, r.component_id) for r in cluster(docs).collect()})
    assert got == sorted({(d, c) for d, _, c in brute(rows)})
    assert 0 < held["near"] < held["open"]


def brute_by(rows, words, percent):
    """As ``brute``, for any length of shingles and threshold, over all pairs."""
    sets = []
    for d, t in rows:
        w = cases.WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((d, {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())))
    links = [(d, e) for k, (d, a) in enumerate(sets) for e, b in sets[:k] if a & b and 100 * len(a & b) >= percent * len(a | b)]
    component = cases.groups(links, {d for d, _ in sets})
    return sorted((d, len(s), component[d]) for d, s in sets)


def test_other_rules_match_brute_force(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(cases.odd_texts()) if len(t or "") < 10_000]
    for n in (5, 6, 9, 20, 60, 130):
        base = cases.prose(n, n, 10**6)
        rows += [(1000 * n + k, cases.edited(base, k, k % 7)) for k in range(14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = set()
    for words, percent, chunk in ((5, 80, 256), (5, 80, 4), (3, 90, 256), (1, 55, 256)):
        monkeypatch.setattr(op9_jaccard, "CHUNK", chunk)
        got = sorted(map(tuple, cluster(docs, op9_jaccard.Rule(words, percent)).collect()))
        assert got == brute_by(rows, words, percent), (words, percent)
        found.add(tuple(got))
    assert len(found) == 3


def test_the_stage_takes_five_words_and_eight_tenths(spark):
    """Two changed words in 100 leave 0.82 of the 5-word shingles: below 0.9, so once both stayed."""
    import corpus_pipeline

    base = [f"v{k}" for k in range(100)]
    near, far = [*base], [*base]
    near[30], near[70] = "x", "y"
    far[20], far[50], far[80] = "x", "y", "z"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, cases.prose(5, 80)), (4, " ".join(far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [c for _, _, c in brute_by(rows, 5, 80)] == [1, 1, 3, 4]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3, 4]


def test_one_row_of_each_group_stays(spark):
    """Rows that repeat an id, and rows without one, do not stay beside their copies."""
    one, two, three = cases.prose(1, 40), cases.prose(2, 40), cases.prose(3, 40)
    rows = [(5, one, "b"), (5, one, "a"), (7, one, "c"), (None, one, "d"), (None, two, "e"), (None, two, "f"), (9, three, "g")]
    rows += [(None, cases.edited(two, 1, 0) + " end", "h"), (None, None, "i"), (None, " ", "j"), (11, None, "k"), (12, "", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = op9_jaccard.keep_one(docs, op9_jaccard.Rule(5, 80))
    assert got.columns == docs.columns
    kept = sorted((r.component_id, r.doc_id) for r in got.collect())
    assert [k for k in kept if k[0] not in "efh"] == [("a", 5), ("g", 9), ("i", None), ("j", None), ("k", 11), ("l", 12)]
    assert len([k for k in kept if k[0] in "efh"]) == 1
