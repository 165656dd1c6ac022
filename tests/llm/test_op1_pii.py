import hashlib
import random
import re

import cases
from stagefare.llm import op1_pii
from stagefare.llm.queries import op1_pii_boosting

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def checksum_ok(digits):
    doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def brute(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and checksum_ok(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *m.span()))
    return out


TEXTS = [
    "mail a@b.c@d.e and x.y%z@host-1.example.com. Or é@b.c, a@b, @b.c, a@.c, q@b.c.d-.e@f.g",
    "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.256 01.002.0003.4 1.2.3 0000000000000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004 378282246310005 12 3  4111111111111111 1",
    "+1 (017) 555-7713 +49 (((((( +123 +44 20 7946 0958 ext +1234567890123456 ++12 345 678 90",
    "name (at) host (dot) com; call 00 49 30 123456; é\U0001f600 a@b.cd 4111111111111111",
    "1" * 20_000, "1." * 5_000, "a@" * 3_000, "a" * 30_000 + "@b.c", "+1" * 3_000, None, "",
]


def test_base_spans_match_the_patterns():
    for text in TEXTS:
        assert op1_pii.base_spans(text or "") == brute(text), (text or "")[:60]


def check(rows, docs):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
    expected = []
    for d, t in docs:
        base = brute(t)
        written = ",".join(f"{op1_pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        counts = [sum(s[0] == k for s in base) for k in range(4)]
        expected.append((d if d is not None else -1, *counts, hashlib.sha256(written.encode()).hexdigest()))
    assert got == sorted(expected)


def test_odd_documents(spark):
    rows = [(k, t, None, None, None, "clash") for k, t in enumerate(TEXTS * 2)] + [(None, TEXTS[0], None, None, None, "x"), (0, TEXTS[0], None, None, None, "x")]
    docs = spark.createDataFrame(rows, cases.DOC_SCHEMA + ", spans string")
    check(op1_pii.find(docs).collect(), [(r[0], r[1]) for r in rows])
    assert op1_pii.find(cases.no_docs(spark)).collect() == []


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = op1_pii_boosting(spark, sf_dir).collect()
    check(rows, [(r.doc_id, r.text) for r in docs])
    texts = {r.doc_id: r.text for r in docs}
    for r in rows:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        base = {f"{op1_pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(texts[r.doc_id])}
        assert base <= {":".join(s) for s in spans}


def test_redaction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in op1_pii.redact(docs).collect():
        assert brute(r.text) == [] and r.n_chars == len(r.text)
        if not brute(before[r.doc_id]) and not re.search("[0-9@]", before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_trees_learn_and_thresholds_hold():
    good = [f"call +1 (555) 0{k:02d}-12{k:02d} now 4111 1111 1111 1111" for k in range(90)]
    bad = [f"no 12{k:02d} 34 567 890 1234 56{k:02d}" for k in range(90)]
    rows = [(op1_pii.features(t, s), op1_pii.confirmed(op1_pii.base_spans(t), s)) for t in good + bad for s in op1_pii.proposals(t)]
    import numpy as np

    x, y = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
    score = op1_pii.Boosted.fit(x, y).score(x)
    assert ((score >= 0.5) == (y == 1)).mean() > 0.97


VARIANTS = {
    "write to name (at) host (dot) com today": "name (at) host (dot) com",
    "jane.doe[at]mail[dot]co[dot]uk": "jane.doe[at]mail[dot]co[dot]uk",
    "phone (017) 555-7713, after six": "(017) 555-7713",
    "call 00 49 30 123456; or not": "00 49 30 123456",
    "it is +44/20/7946/0958.": "+44/20/7946/0958",
    "pay with 4111.1111.1111.1111 now": "4111.1111.1111.1111",
    "and 5500/0000/0000/0004 too": "5500/0000/0000/0004",
}
LOOK_ALIKES = [
    "on 2024-06-15 12 people came", "from 1990-1995 to 2001-2004", "pay with 4111.1111.1111.1112 now", "look (at) page 5",
    "version 1.20.3.4000", "sums of 1,234,567,890", "(1998-2004)", "no 12 345 678 9012", "id 0012345678", "12.10.2024",
]


def test_variants_that_the_base_misses_are_found_and_look_alikes_are_not(spark, sf_dir):
    for table in (cases.no_docs(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        detector = op1_pii.learn(table)
        for text, span in VARIANTS.items():
            base, whole = detector.spans(text)
            assert base == [] and span in [text[a:b] for _, a, b in whole], (text, whole)
            assert span not in op1_pii.redacted(text, whole)
        for text in LOOK_ALIKES:
            assert detector.spans(text) == ([], []), text


# The same string after a word that goes with its kind, and after one that does not.
TOLD = [
    ("please call {} today", "the order {} today", "555-012-7713"),
    ("on mobile {} or so", "for invoice {} or so", "415 555 0199"),
    ("the server {} is down", "scores {} came in", "10,0,0,7"),
    ("pay with {} now", "parcel {} now", "4111.1111.1111.1111"),
    ("phone {}, after six", "ticket {}, after six", "(017) 555-7713"),
]


def test_words_around_decide_between_equal_strings(spark, sf_dir):
    for table in (cases.no_docs(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        detector = op1_pii.learn(table)
        for fitting, foreign, inside in TOLD:
            assert inside in [fitting.format(inside)[a:b] for _, a, b in detector.spans(fitting.format(inside))[1]], fitting
            assert detector.spans(foreign.format(inside)) == ([], []), foreign
        first = len(op1_pii.features("x", (0, 0, 1)))
        used = {int(f) for feature, limit, _ in detector.model.trees for f, cut in zip(feature, limit, strict=True) if cut < float("inf")}
        assert used & {*range(first, first + 4)}, "no tree looks at the words around"


def test_added_spans_are_right(spark, sf_dir):
    """Strings put into given documents, each after a fitting and a foreign word: recall and precision of what is added."""
    docs = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text and len(r.text) < 4000]
    detector = op1_pii.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    r = random.Random(99)
    found = wanted = added = 0
    for text in docs[:100]:
        at = text.find(" ", len(text) // 2) + 1
        for kind, form in op1_pii.shapes(r):
            for words, good in ((op1_pii._FITTING[kind], True), (op1_pii._FOREIGN[kind], False)):
                lead = text[:at] + r.choice(words) + " "
                base, whole = detector.spans(lead + form + " " + text[at:])
                new = [s for s in whole if s not in base and s[0] == kind and s[1] < len(lead) + len(form) and s[2] > len(lead)]
                wanted += good
                found += good and (kind, len(lead), len(lead) + len(form)) in new
                added += len(new)
    assert found > 0.9 * wanted and found > 0.95 * added, (found, wanted, added)
