"""Personal data by candidate gradient boosting.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed patterns and checks.
Beside it, generators of high recall propose overlapping spans of the same kinds: written-out
addresses, dotted numbers, digit groups with any separators. Each proposal gets features of its format and
of what stands around it; boosted trees score it, and those above a threshold for their kind
are added, unless they overlap a base span of their kind. Base spans always stay.

The trees are fitted on proposals from about TRAINING documents at most, spread over all by a hash of
``doc_id``, and on CANDIDATES of them at most (bounds on the fit alone; every text is searched).
Only what the base misses is learned, as only that is offered: proposals that overlap no base span of their
kind. What a string means follows from its form *and* from the words around it: base spans are rewritten in forms that the
base misses, and strings of forms that name nothing by themselves (digit groups, numbers between commas) are made, and all are put
where they stood, after a word that goes with their kind ("call", "server"), and after one that goes with something
else ("order", "version"). After the latter none is personal data; the others are by themselves only if their
form is a known one (``known``). The patterns of these forms are no features: the trees see counts of signs, and what
the words before and after a proposal have told about its kind in a third of the examples (``Odds``, learned as
log odds by kind and word). A fixed stock of such strings and look-alikes goes into every fit, so a
table without base spans teaches them too. The threshold of a kind is the
least at which PRECISION holds on the proposals left out of the fit; without one, nothing
is added. The model is a few small trees.

Defined results: a null text counts as empty; a text without finds has counts of 0, an empty ``spans`` and
the hash of nothing; repeated rows are each searched; no rows give no rows; other columns are
ignored by the search and kept by the redaction.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import bounded
from .tables import texts
from .text import blocks, utf8

KINDS = ("email", "ip", "card", "phone")
TRAINING, CANDIDATES = 20_000, 40_000
PRECISION = 0.98
ROUNDS, DEPTH, RATE, BINS = 60, 4, 0.3, 32

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match always starts at the first digit of a run: tried anywhere else it would have been tried there.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# High-recall proposals; all repetitions are bounded.
_PROPOSED = {
    "email": (
        re.compile(r"[^\s@]{1,64}@[^\s@]{1,128}"),
        re.compile(r"(?i)[a-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[a-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[a-z0-9-]{1,63}){1,4}"),
    ),
    "ip": (re.compile(r"(?<![0-9])[0-9]{1,5}(?:[.,][0-9]{1,5}){3,7}"),),
    "card": (re.compile(r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,20}"),),
    "phone": (re.compile(r"(?:\+|00|\()?[0-9][0-9 ()./-]{6,22}[0-9]"),),
}
# Words that go with each kind, and words that go with other things made of digits or signs.
_FITTING = {
    0: ("mail", "e-mail:", "write to", "contact", "reply to", "reach me:"),
    1: ("server", "host", "ip", "address", "node", "gateway", "ping"),
    2: ("card", "visa", "pay with", "credit card", "charged to", "card no."),
    3: ("call", "phone", "tel.", "fax", "mobile", "dial", "whatsapp"),
}
_OTHER = ("order", "invoice", "ticket", "part", "reference", "lot", "tracking", "parcel", "serial", "isbn", "build", "section")
_FOREIGN = {
    0: ("concert", "picnic", "match", "party", "game"),
    1: ("version", "release", "scores", "sums", "chapter", *_OTHER),
    2: ("version", "meter", "barcode", *_OTHER),
    3: ("version", "account", "article", *_OTHER),
}

# What tells the variants of base spans: separators in brackets, 00 and a country, an area in brackets.
_BRACKETED = re.compile(r"(?i) ?[\[(](at|dot)[\])] ?")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_ABROAD = re.compile(r"00[ ()./-]{0,2}[1-9]")
_AREA = re.compile(r"\([0-9]{2,5}\)")
# Digits by kind.
_COUNTS = ((0, 64), (4, 12), (13, 19), (9, 15))
# Base spans of a document that are rewritten for the fit, and characters of context.
REWRITTEN, CONTEXT = 16, 64

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: its local part reaches back to the last match."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            after = found.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and start."""
    spans = [(0, a, b) for a, b in _emails(text)]
    for found in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found[0].split(".")):
            spans.append((1, *found.span()))
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *found.span()))
    for found in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in found[0]) <= 15:
            spans.append((3, *found.span()))
    return spans


def proposals(text: str) -> list[Span]:
    spans = {(k, *m.span()) for k, kind in enumerate(KINDS) for p in _PROPOSED[kind] for m in p.finditer(text)}
    return sorted(spans)


def features(text: str, span: Span) -> list[float]:
    """What the trees see of a proposal: its kind, its format, and what stands around it."""
    kind, start, end = span
    inside = text[start:end]
    digits = re.sub(r"[^0-9]", "", inside)
    parts = re.findall(r"[0-9]+", inside)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    host = inside.rpartition("@")[2]
    return [
        kind,
        len(inside),
        len(digits),
        sum(c.isalpha() for c in inside),
        inside.count("@"),
        inside.count("."),
        inside.count(","),
        inside.count("-"),
        inside.count(" "),
        inside.count("("),
        inside.count("["),
        inside.startswith("+"),
        inside.startswith("0"),
        inside.startswith("("),
        luhn(digits) if digits else 0,
        min(999, max((int(p[:4]) for p in parts), default=0)),
        len(parts),
        len(parts[0]) if parts else 0,
        len(max(parts, key=len, default="")),
        len(min(parts, key=len, default="")),
        len(parts[-1]) if parts else 0,
        "." in host.strip("."),
        len(host.rpartition(".")[2]),
        all(c in _LOCAL or c == "@" for c in inside),
        before.isalnum(),
        after.isalnum(),
        inside.count("/"),
        len(re.findall(r"[A-Za-z]+", inside)),
    ]


_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
# Words before a proposal that are looked at, and how far.
_WORDS, _REACH = 3, 40


def around(text: str, span: Span) -> list[str]:
    """The nearest words before a proposal, nearest first, and the one after it, marked; in lower case."""
    _, start, end = span
    before = [w.lower() for w in _WORD.findall(text[max(0, start - _REACH) : start])][: -_WORDS - 1 : -1]
    after = _WORD.search(text, end, end + _REACH // 2)
    return [*before, *([">" + after[0].lower()] if after else [])]


@dataclass
class Odds:
    """Log odds that a proposal of a kind is personal data, by kind and word around it; rare words tell nothing."""

    of: dict[tuple[int, str], float] = field(default_factory=dict)

    @classmethod
    def learn(cls, rows: list[tuple[int, list[str], int]]) -> Odds:
        counts: dict[tuple[int, str], list[int]] = {}
        total = [[1, 1] for _ in KINDS]
        for kind, words, label in rows:
            total[kind][label] += 1
            for word in {*words}:
                counts.setdefault((kind, word), [0, 0])[label] += 1
        return cls({
            key: float(np.log((pos + 0.5) / (neg + 0.5)) - np.log(total[key[0]][1] / total[key[0]][0]))
            for key, (neg, pos) in counts.items()
            if neg + pos >= 8
        })

    def features(self, kind: int, words: list[str]) -> list[float]:
        """What the nearest word, all before, the worst of them, and the one after tell."""
        told = [self.of.get((kind, w), 0.0) for w in words if w[0] != ">"]
        after = [self.of.get((kind, w), 0.0) for w in words if w[0] == ">"]
        return [told[0] if told else 0.0, sum(told), min(told, default=0.0), after[0] if after else 0.0]


def confirmed(spans: list[Span], span: Span) -> bool:
    """Whether base spans of its kind cover most of a proposal and it most of them."""
    kind, start, end = span
    shared = [(min(end, b) - max(start, a), b - a) for k, a, b in spans if k == kind and a < end and start < b]
    return any(10 * s >= 9 * max(n, end - start) for s, n in shared)


def known(kind: int, inside: str) -> bool:
    """Whether a proposal that the base misses is written as one of the known variants."""
    digits = re.sub(r"[^0-9]", "", inside)
    if kind == 0:
        plain = _BRACKETED.sub(lambda m: "@" if m[1].lower() == "at" else ".", inside)
        return plain != inside and _ADDRESS.fullmatch(re.sub(r" ?\. ?", ".", plain)) is not None
    if not _COUNTS[kind][0] <= len(digits) <= _COUNTS[kind][1]:
        return False
    if kind == 2:
        return luhn(digits)
    return kind == 3 and bool(_ABROAD.match(inside) and not inside.isdigit() or _AREA.match(inside) or inside.startswith("+"))


def variants(kind: int, inside: str) -> list[str]:
    """A base span in forms that the base misses."""
    if kind == 0:
        at, dot = inside.replace("@", " (at) "), inside.rpartition("@")
        host = dot[2].replace(".", " (dot) ")
        return [f"{dot[0]} (at) {host}", f"{dot[0]}[at]{dot[2].replace('.', '[dot]')}", at, f"{dot[0]}(AT){dot[2].replace('.', '(DOT)')}"]
    digits = re.sub(r"[^0-9]", "", inside)
    if kind == 2:
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [sign.join(parts) for sign in (".", "/", "  ", " - ")]
    if kind == 3:
        rest = re.sub(r"[ ().-]+", " ", inside[1:]).strip()
        area = re.search(r"\([0-9]{2,5}\).*", inside)
        return ["00" + rest, "00 " + rest, "+" + rest.replace(" ", "/"), *([area[0]] if area else [])]
    return []


def _offered(text: str) -> list[Span]:
    """Proposals that overlap no base span of their kind."""
    base = base_spans(text)
    return [s for s in proposals(text) if not any(k == s[0] and a < s[2] and s[1] < b for k, a, b in base)]


# One example: features of the form, words around, label.
Example = tuple[list[float], list[str], int]


def shapes(r: random.Random) -> list[tuple[int, str]]:
    """Strings whose form alone names nothing: what stands around them decides."""
    digit = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    part = lambda: str(r.randrange(256))
    return [
        (3, f"{digit(3)}-{digit(3)}-{digit(4)}"),
        (3, f"{r.randrange(1, 10)}{digit(2)} {digit(3)} {digit(4)}"),
        (3, f"{r.randrange(1, 10)}{digit(9)}"),
        (1, ",".join(part() for _ in range(4))),
        (1, ".".join([part(), part(), str(r.randrange(256, 999)), part()])),
    ]


def _placed(kind: int, before: str, form: str, after: str, decided: bool, r: random.Random) -> Iterator[Example]:
    """Examples of a string where it stood, after a fitting word and after a foreign one."""
    fitting, foreign = r.choice(_FITTING[kind]) + r.choice((" ", ": ")), r.choice(_FOREIGN[kind]) + r.choice((" ", ": ", " no. "))
    for lead, fits in (("", decided), (fitting, True), (foreign, False)):
        whole = before + lead + form + after
        span = (kind, len(before) + len(lead), len(before) + len(lead) + len(form))
        for found in _offered(whole):
            if found[1] < span[2] and span[1] < found[2] and found[0] == kind:
                yield features(whole, found), around(whole, found), int(fits and confirmed([span], found))


def _labelled(text: str) -> Iterator[Example]:
    """What the base misses in a text, and strings put into it where base spans stand."""
    for span in _offered(text):
        yield features(text, span), around(text, span), int(known(span[0], text[span[1] : span[2]]))
    for kind, start, end in base_spans(text)[:REWRITTEN]:
        before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        r = random.Random(f"{start}:{text[start:end]}")
        for form in variants(kind, text[start:end]):
            yield from _placed(kind, before, form, after, known(kind, form), r)
        for other, form in shapes(r):
            yield from _placed(other, before, form, after, False, r)


def _stock() -> list[Example]:
    """Labelled proposals that go into every fit."""
    r = random.Random(1)
    digit = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    found = []
    for k in range(300):
        name = f"{r.choice(['ann', 'j.lee', 'info', 'max_w', 'x'])}{k}@{r.choice(['mail', 'host-1', 'example', 'a.bc'])}.{r.choice(['com', 'org', 'de', 'co.uk'])}"
        card = digit(r.choice([12, 13, 14, 15, 15, 15, 18]))
        card = next(card + d for d in "0123456789" if luhn(card + d))
        phone = r.choice([
            f"+{r.randrange(1, 99)} ({digit(3)}) {digit(3)}-{digit(4)}",
            f"+{r.randrange(1, 99)} {digit(2)} {digit(r.choice([4, 6, 7]))}",
            "+" + r.choice(" -.").join([str(r.randrange(1, 999)), *(digit(r.randrange(2, 6)) for _ in range(r.randrange(2, 5)))]),
        ])
        wrong = card[:-1] + str((int(card[-1]) + 1 + k % 9) % 10)
        near = [
            f"{r.randrange(1900, 2030)}-{r.randrange(10, 13)}-{r.randrange(10, 29)} {r.randrange(10, 24)}",
            f"{r.randrange(10, 29)}.{r.randrange(10, 13)}.{r.randrange(1900, 2030)}",
            f"{r.randrange(1000, 2000)}-{r.randrange(2000, 3000)}",
            f"({r.randrange(1900, 2030)}-{r.randrange(1900, 2030)})",
            *(sign.join(wrong[i : i + 4] for i in range(0, len(wrong), 4)) for sign in (".", "/", " ", "  ")),
            f"{digit(2)} {digit(3)} {digit(3)} {digit(4)}".lstrip("0 "),
            f"00{digit(7)}",
            f"({digit(3)}) {digit(4)}",
            f"{r.randrange(9)}.{r.randrange(99)}.{r.randrange(9)}.{r.randrange(300, 9999)}",
            f"{r.randrange(99)},{r.randrange(999)},{r.randrange(999)},{r.randrange(999)}",
            f"look (at) page{k}",
            f"{k}@{k}",
            f"@{k}@host",
        ]
        for text in (name, card, phone, *near):
            fitting = [f"{w} " for words in _FITTING.values() for w in words]
            lead = r.choice([r.choice(["", "and ", "an old one: ", "it is ", "then ", "no. ", "see "]), r.choice(fitting)])
            found += _labelled(lead + text + r.choice(["", " ", ". ", ", then", "; it", " too", " now"]))
        for kind, form in shapes(r):
            found += _placed(kind, r.choice(["", "and ", "it is ", "so ", "the ", "please ", "or the ", "my ", "on "]), form, r.choice(["", " then", ", or not", "."]), False, r)
    return found


@dataclass
class Boosted:
    """Boosted trees of one depth: by tree, a feature and a limit for each inner node, then the leaves."""

    bias: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for feature, limit, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
            total += leaves[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Boosted:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        model = cls(float(np.log(share / (1 - share))))
        limits = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1), method="lower"))[:-1] for c in x.T]
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(limits, x.T, strict=True)], axis=1)
        for _ in range(ROUNDS):
            p = model.score(x)
            slope, curve = p - y, p * (1 - p)
            inner = 2**DEPTH - 1
            feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for f, edges in enumerate(limits):
                    if not len(edges):
                        continue
                    at = (node - first) * (BINS + 1) + bins[:, f]
                    g, h = (np.bincount(at, w, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1) for w in (slope, curve))
                    gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    cut = gain[:, : len(edges)].argmax(axis=1)
                    value = gain[np.arange(count), cut]
                    for n in np.flatnonzero(value > best):
                        best[n], feature[first + n], limit[first + n] = value[n], f, edges[cut[n]]
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
            leaf = node - inner
            g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
            model.trees.append((feature, limit, -RATE * g / (h + 1)))
        return model


@dataclass
class Detector:
    model: Boosted
    odds: Odds
    thresholds: np.ndarray  # by kind; above 1 where nothing is added

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans and all spans of a text, by kind and start."""
        base = base_spans(text)
        offered = _offered(text)
        if not offered or not self.model.trees:
            return base, base
        score = self.model.score(np.array([[*features(text, s), *self.odds.features(s[0], around(text, s))] for s in offered], np.float64))
        return base, sorted({*base, *(s for s, v in zip(offered, score, strict=True) if v >= self.thresholds[s[0]])})


def _with_digits(block: pa.RecordBatch) -> np.ndarray:
    """Rows that hold a digit or an ``@``, without which no pattern or proposal matches, or ``at`` in brackets."""
    data, rows = utf8(block.column("text"))
    wanted = np.zeros(256, bool)
    wanted[[*b"0123456789@[("]] = True
    return np.flatnonzero(np.diff(np.append(0, np.cumsum(wanted[data]))[rows]))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch):
            found = [x for row in _with_digits(block).tolist() for x in _labelled(block.column("text")[row].as_py())]
            seen, words, labels = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([[float(v) for v in f] for f in seen], pa.list_(pa.float64())),
                    pa.array(words, pa.list_(pa.string())),
                    pa.array(labels, pa.int32()),
                ],
                names=["features", "words", "label"],
            )


def learn(docs: DataFrame, most: int = TRAINING) -> Detector:
    """Fit trees and thresholds on a bounded sample of ``documents(doc_id, text)``."""
    sample = bounded(texts(docs), "doc_id", most).mapInArrow(_examples, "features array<double>, words array<string>, label int")
    # Sorted by their hash, so that any split of the input gives the same sample in the same order.
    order = F.xxhash64("features", "words", "label")
    rows = sample.withColumn("order", order).orderBy("order", "features", "words").limit(CANDIDATES).toArrow()
    given = zip(*(rows.column(c).to_pylist() for c in ("features", "words", "label")), strict=True)
    # A third tells what words mean, a third fits the trees, a third sets the thresholds.
    every = [*_stock(), *given]
    odds = Odds.learn([(int(f[0]), words, label) for f, words, label in every[::3]])
    rest = [x for k, x in enumerate(every) if k % 3]
    x = np.array([[*f, *odds.features(int(f[0]), words)] for f, words, _ in rest], np.float64)
    y = np.array([label for *_, label in rest], np.float64)
    fitted = np.arange(len(x)) % 2 == 0
    model = Boosted.fit(x[fitted], y[fitted])
    score, truth, kind = model.score(x[~fitted]), y[~fitted], x[~fitted, 0]
    thresholds = np.full(len(KINDS), 2.0)
    for k in range(len(KINDS)):
        own = np.argsort(-score[kind == k], kind="stable")
        ranked = score[kind == k][own]
        right = np.cumsum(truth[kind == k][own]) / np.arange(1, len(own) + 1)
        last = np.append(ranked[1:] < ranked[:-1], True)[: len(own)]
        good = np.flatnonzero((right >= PRECISION) & last & (ranked >= 0.5))
        if len(good):
            thresholds[k] = ranked[good[-1]]
    return Detector(model, odds, thresholds)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def find(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """Counts, hash of base spans, all spans and their number of every row of ``documents(doc_id, text)``."""
    docs = texts(docs)
    detector = detector or learn(docs)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            for block in blocks(batch):
                counts = np.zeros((len(KINDS), block.num_rows), np.int64)
                digests, spans = [nothing] * block.num_rows, [""] * block.num_rows
                number = np.zeros(block.num_rows, np.int64)
                for row in _with_digits(block).tolist():
                    base, whole = detector.spans(block.column("text")[row].as_py())
                    for kind, _, _ in base:
                        counts[kind, row] += 1
                    digests[row] = hashlib.sha256(_written(base).encode()).hexdigest()
                    spans[row] = _written(whole)
                    number[row] = len(whole)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(number)],
                    names=[p.split()[0] for p in FOUND.split(", ")],
                )

    return docs.mapInArrow(found, FOUND)


def redacted(text: str, spans: list[Span]) -> str:
    """A text with its spans replaced by their kinds; spans that overlap become one, named by the first."""
    out, last = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= last:
            out.append(text[last:start])
            out.append(f"[{KINDS[kind].upper()}]")
        last = max(last, end)
    out.append(text[last:])
    return "".join(out)


def redact(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """The documents with all their columns, personal data in ``text`` replaced; ``n_chars`` follows if there is one."""
    detector = detector or learn(docs)
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                rows = _with_digits(block).tolist()
                column = block.column("text").to_pylist()
                sizes = block.column("n_chars").to_pylist() if "n_chars" in names else None
                for row in rows:
                    spans = detector.spans(column[row])[1]
                    if spans:
                        column[row] = redacted(column[row], spans)
                        if sizes:
                            sizes[row] = len(column[row])
                arrays = list(block.columns)
                arrays[names.index("text")] = pa.array(column, block.column("text").type)
                if sizes:
                    arrays[names.index("n_chars")] = pa.array(sizes, block.column("n_chars").type)
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(cleaned, docs.schema)
