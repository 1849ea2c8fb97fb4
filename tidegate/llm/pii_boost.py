"""Personal data: generous candidate generators, boosted trees, calibrated thresholds.

Base spans come from fixed patterns and checks and are always kept. Besides,
generators with high recall propose overlapping spans that a pattern alone cannot
settle: phone numbers without the plus, addresses with "at" and "dot", card
numbers with other separators, and so on. Boosted trees score them by features of
their format and of the words around them, and a threshold for each kind, calibrated on
rows the trees have not seen, selects those to redact.

No spans are labelled, so the trees learn from the base spans: a base span is a
positive as it stands and in several free formats (plus sign, separators or
at-sign changed), and a negative in formats with what makes it valid broken (a part of an address too large, commas between its parts, a wrong check digit,
a number cut to a date or a range of pages). A candidate that touches no base span is a negative if its format
is not that of its kind (``plausible``); if it is, nobody knows, and it teaches nothing: free
formats that a corpus holds are not learned as clean text. Candidates of all documents are stored, equal ones (features, span and
words around it) once with a count, so copies of a text teach once. By a bit of their
hash half of them are for the trees, of which each kind gives, of positives and of
negatives each, an equal part of ``SAMPLE``, in the order of the hash. All of the
other half, each as often as it occurs, count for the thresholds, as histograms of
their scores.

Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.boosting import Boosted, boost
from tidegate.llm.frames import fields, stored

KINDS = ["email", "ip", "card", "phone"]
#: Candidates for the trees, from all kinds, positives and negatives.
SAMPLE = 20_000
#: Least share of true positives among what a threshold selects, on held-out candidates.
PRECISION = 0.95
#: No threshold is lower: what is likelier no personal data stays.
LEAST = 0.5
#: Bins of scores for the thresholds: lower edges, a hundredth apart on the scale the trees add up on.
EDGES = 1 / (1 + np.exp(-np.linspace(-30, 30, 6_001)))

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number pattern cannot start within a run of digits unless it could at the run's start.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What a text has that holds a loose e-mail address, and one that holds a loose number.
AT = re.compile(r"@|\(at\)|\[at\]|[ ]at[ ]", re.IGNORECASE)
DIGIT = re.compile(r"[0-9]")

LOOSE = [
    re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[ ]?(?:@|\(at\)|\[at\]|[ ]at[ ])[ ]?[A-Za-z0-9-]{1,63}"
        # A plain dot has spaces on both sides or none: "at noon. Then" is no address.
        r"(?:(?:\.|[ ]\.[ ]|[ ]?(?:\(dot\)|\[dot\]|[ ]dot[ ])[ ]?)[A-Za-z0-9-]{1,63}){1,4}",
        re.IGNORECASE,
    ),
    re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ ]?[.,\[\]]+[ ]?[0-9]{1,3}){3}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,3}[0-9]{2,4}){3,4}(?![0-9])"),
    re.compile(r"(?<![0-9+])\(?[0-9]{2,5}[)\x20./-]{1,2}[0-9]{2,5}(?:[\x20./-]{1,2}[0-9]{2,5}){0,3}(?![0-9])"),
]
#: Words before a span that speak for a kind, in the order of KINDS.
CUES = [
    {"email", "mail", "mailto", "contact", "correo", "courriel"},
    {"ip", "host", "server", "address", "adresse", "from"},
    {"card", "visa", "credit", "karte", "carte", "tarjeta"},
    {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
]
WINDOW = 40

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start: leftmost, not overlapping within a kind."""
    found: list[Span] = []
    if "@" in text:
        done = 0
        for match in DOMAIN.finditer(text):
            at = match.start()
            # The local part is the run of its characters up to the at-sign.
            start = done + len(text[done:at].rstrip(LOCAL))
            if start < at:
                found.append((0, start, match.end()))
                done = match.end()
    for match in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in match.group().split(".")):
            found.append((1, *match.span()))
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in match.group()) <= 15:
                found.append((3, *match.span()))
    return found


def loose_spans(text: str) -> list[Span]:
    implied = [AT, *[DIGIT] * (len(LOOSE) - 1)]  # each is part of every match of its pattern
    return [
        (kind, *m.span())
        for kind, pattern in enumerate(LOOSE)
        if implied[kind].search(text)
        for m in pattern.finditer(text)
    ]


def plausible(kind: int, span: str) -> bool:
    """Whether a candidate has a format of its kind, free ones included."""
    digits = re.sub(r"[^0-9]", "", span)
    groups = re.findall(r"[0-9]+", span)
    if kind == 0:
        return bool(re.search(r"[A-Za-z]{2,24}$", span))
    if kind == 1:
        return "," not in span and all(int(g) <= 255 for g in groups)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    sizes = [len(g) for g in groups]
    spoken = len(groups) > 2 or span.startswith(("(", "0"))  # else a range of two numbers
    return 8 <= len(digits) <= 15 and spoken and sizes not in ([4, 2, 2], [2, 2, 4])


def disturbed(kind: int, span: str) -> list[str]:
    """A base span as it looks in freer hands."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 0:
        local, _, host = span.rpartition("@")
        name, short = re.sub(r"[0-9]", "", local) or local, ".".join(host.split(".")[-2:])
        return [
            f"{local} at {host}".replace(".", " dot "), f"{name} at {short}", f"{name} @ {host}",
            f"{local} (at) {short}", f"{name}[at]{short}", f"{name}(at){host.replace('.', '(dot)')}",
        ]
    if kind == 1:
        return [span.replace(".", dot) for dot in (" . ", "[.]", ". ")]
    if kind == 2:
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [gap.join(fours) for gap in (".", "/", "_", "  ", " - ")]
    bare = re.sub(r"^\+[0-9]*[ ]?", "", span)
    groups = re.findall(r"[0-9]+", bare)
    return [bare, "-".join(groups), ".".join(groups), "0" + " ".join(groups)]


def broken(kind: int, span: str) -> list[str]:
    """A base span as something else: in formats that writers use, but not valid."""
    digits = re.sub(r"[^0-9]", "", span)
    turn = zlib.crc32(span.encode())
    if kind == 0:
        local, _, host = span.rpartition("@")
        name, short = re.sub(r"[0-9]", "", local) or local, ".".join(host.split(".")[-2:-1])
        last = str(turn % 100)
        return [f"{local} at {short}.{last}", f"{name} @ {host}.{last}", f"{name} at {last[0]}.{turn // 100 % 60}", f"{name}@{short}.{last}"]
    if kind == 1:
        parts = span.split(".")
        large = [*parts]
        large[turn % 4] = str(256 + turn // 4 % 744)
        return [".".join(large), " . ".join(large), "[.]".join(large), ", ".join(parts), ",".join(parts)]
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 9) % 10)
        fours = [wrong[i : i + 4] for i in range(0, len(wrong), 4)]
        return [gap.join(fours) for gap in ("", " ", "-", ".", "/", "_")]
    a, b, c = digits[-2:], digits[-4:-2], digits[-7:-4]
    long = "/".join([digits[-4:], digits[-6:-2], digits[-8:-4], digits[-5:-1]])
    return [long, f"{a}-{c}", f"{c}-{b}{a}", f"20{a}-{b}-{c[:2]}", f"{a}/{b}/20{c[:2]}", f"19{a}-20{b}", f"{b}.{a}", f"{b}.{a}.19{c[:2]}"]


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format and context of one candidate; nothing here looks at where it stands."""
    digits = re.sub(r"[^0-9]", "", span)
    groups = re.findall(r"[0-9]+", span)
    near = re.findall(r"[^\W\d_]+", before.lower())[-4:]
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(sum(c.isalpha() for c in span)),
        float(span.count(".") + span.lower().count("dot")),
        float(span.count(",")),
        float(len(groups[0]) if groups else 0),
        float(len(groups[-1]) if groups else 0),
        float(span.startswith(("(", "0"))),
        float(sum(c in " -/()" for c in span)),
        float(bool(AT.search(span))),
        float(len(digits) >= 12 and luhn(digits)),
        float(max((int(g[-4:]) for g in groups), default=0)),
        float(all(int(g[-4:]) <= 255 for g in groups)),
        float(len(re.split(r"[^A-Za-z]+", span)[-1])),
        *[float(bool(cues & set(near))) for cues in CUES],
        float(before[-1:].isspace() or not before),
        float(after[:1].isspace() or not after),
        float(before[-1:] in ("=", '"', "'", "/", "#", "_")),
        float(any(w in ("page", "version", "license", "token", "password", "id") for w in near)),
    ]


def around(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - WINDOW) : start], text[end : end + WINDOW]


class Taken:
    """Parts of a text that are taken, without overlap and in order, so that a look takes a bisection."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda x: x[1:]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)  # the parts before it start before ``end``
        return not at or self.ends[at - 1] <= start

    def take(self, start: int, end: int) -> None:
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


Example = tuple[int, bool, list[float], str]


def examples(text: str) -> Iterator[Example]:
    """What one text teaches: kind, whether it is personal data, features, the span with what is around."""
    base = base_spans(text)
    for kind, start, end in base:
        before, after = around(text, start, end)
        span = text[start:end]
        forms = [(True, x) for x in (span, *disturbed(kind, span))] + [(False, x) for x in broken(kind, span)]
        for true, form in forms:
            yield kind, true, features(kind, form, before, after), f"{before}\n{form}\n{after}"
    taken = Taken(base)
    for kind, start, end in loose_spans(text):
        span = text[start:end]
        if taken.free(start, end) and not plausible(kind, span):
            before, after = around(text, start, end)
            yield kind, False, features(kind, span, before, after), f"{before}\n{span}\n{after}"


class Selector:
    """The fitted trees and the threshold of each kind; 2 where none is precise enough."""

    def __init__(self, trees: Boosted, thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans: the base ones and selected others that touch none of them."""
        if not text:
            return [], []
        base = base_spans(text)
        taken = Taken(base)
        loose = [x for x in loose_spans(text) if taken.free(*x[1:])]
        if not loose or min(self.thresholds) > 1:
            return base, base
        table = np.array([features(k, text[s:e], *around(text, s, e)) for k, s, e in loose])
        chosen = list(base)
        scores, added = self.trees.probability(table).tolist(), Taken()
        for score, span in sorted(zip(scores, loose, strict=True), key=lambda x: (-x[0], x[1])):
            if score >= self.thresholds[span[0]] and added.free(*span[1:]):
                chosen.append(span)
                added.take(*span[1:])
        return base, sorted(chosen)


def threshold(
    scores: np.ndarray, truth: np.ndarray, precision: float = PRECISION, times: np.ndarray | None = None
) -> float:
    """The lowest score at and above which the share of true candidates is high enough; else 2.

    ``times`` says how often each candidate counts, once if left out.
    """
    order = np.argsort(-scores, kind="stable")
    times = (np.ones(len(scores)) if times is None else times)[order]
    ranked, hits, seen = scores[order], (truth[order] * times).cumsum(), times.cumsum()
    last = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True)[: len(ranked)])
    good = last[hits[last] >= precision * seen[last]] if len(ranked) else last
    return float(ranked[good[-1]]) if len(good) else 2.0


def eased(limit: float, scores: np.ndarray) -> float:
    """``limit``, half-way down (in log odds) to the next score that candidates have; ``LEAST`` at least.

    Between the two nothing was seen, and free formats score a little below those learned from.
    """
    below = scores[scores < limit]
    if limit <= 1 and len(below):
        odds = np.log([limit / (1 - limit), below.max() / (1 - below.max())])
        limit = float(1 / (1 + np.exp(-odds.mean())))
    return max(LEAST, limit)


def candidates(docs: DataFrame) -> DataFrame:
    """(place, kind, truth, features, n): the candidates of all texts, equal ones once with their number."""
    kinds = "place bigint, kind int, truth boolean, features array<double>, n bigint"

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple[int, int, bool], tuple[list[float], list[int]]] = {}
            for text in batch.column(0).to_pylist():
                for kind, true, row, seen in examples(text or ""):
                    digest = hashlib.blake2b(f"{kind} {row} {seen}".encode(), digest_size=8).digest()
                    key = int.from_bytes(digest, "big", signed=True), kind, true
                    known.setdefault(key, (row, [0]))[1][0] += 1
            places, of_kind, truth = zip(*known) if known else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places, pa.int64()),
                    pa.array(of_kind, pa.int32()),
                    pa.array(truth, pa.bool_()),
                    pa.array([row for row, _ in known.values()], pa.list_(pa.float64())),
                    pa.array([n[0] for _, n in known.values()], pa.int64()),
                ],
                names=["place", "kind", "truth", "features", "n"],
            )

    found = fields(docs, "text").mapInArrow(teach, kinds)
    return found.groupBy("place", "kind", "truth", "features").agg(F.sum("n").alias("n"))


def tree_sample(known: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and truth for the trees: of each kind and truth at most an equal part of ``sample``.

    Rows are thinned by their hash on the workers, to about twice that, and cut here.
    """
    quota, span = sample // (2 * len(KINDS)), 1 << 30
    learned = known.where("place & 1 = 0")
    at = F.pmod(F.shiftrightunsigned("place", 1), F.lit(span))
    wanted = F.lit(False)
    for kind, truth, total in learned.groupBy("kind", "truth").count().collect():
        bound = span if total <= 2 * quota else int(span * 2 * quota / total)
        wanted = wanted | ((F.col("kind") == kind) & (F.col("truth") == truth) & (at < bound))
    groups: dict[tuple[int, bool], list[tuple[int, int, list[float]]]] = {}
    for row in learned.where(wanted).select(at.alias("at"), "place", "kind", "truth", "features").collect():
        groups.setdefault((row["kind"], row["truth"]), []).append((row["at"], row["place"], row["features"]))
    chosen = [(r[2], key[1]) for key in sorted(groups) for r in sorted(groups[key])[:quota]]
    width = len(features(0, "", "", ""))
    return (
        np.array([row for row, _ in chosen], dtype=float).reshape(-1, width),
        np.array([truth for _, truth in chosen], dtype=float),
    )


def histograms(known: DataFrame, trees: Boosted) -> DataFrame:
    """(kind, truth, bin, n): how many of all held-out candidates score within each bin of EDGES."""
    shared = known.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("features")
            table = rows.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))
            scores = shared.value.probability(table) if len(rows) else np.zeros(0)
            bins = np.maximum(np.searchsorted(EDGES, scores, side="right") - 1, 0)
            columns = [batch.column("kind"), batch.column("truth"), pa.array(bins), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "truth", "bin", "n"])

    held = known.where("place & 1 = 1").select("kind", "truth", "features", "n")
    scored = held.mapInArrow(score, "kind int, truth boolean, bin bigint, n bigint")
    return scored.groupBy("kind", "truth", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Selector:
    """Trees from a bounded sample of each kind's candidates, thresholds from the candidates of all documents."""
    known = stored(candidates(docs), "candidates")
    table, truth = tree_sample(known, sample)
    trees = boost(table, truth)
    counted = histograms(known, trees).collect()
    thresholds = []
    for kind in range(len(KINDS)):
        bins = [(EDGES[r["bin"]], r["truth"], r["n"]) for r in counted if r["kind"] == kind]
        edges, true, times = np.array(bins, dtype=float).reshape(-1, 3).T
        thresholds.append(eased(threshold(edges, true, times=times), edges))
    return Selector(trees, thresholds)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with each span, and spans that overlap, replaced by the kind in brackets."""
    if not text or not spans:
        return text
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, columns: list[str], selector: Selector | None = None) -> DataFrame:
    """The named columns of ``docs`` with the personal data in ``text`` replaced; same rows.

    A null text stays null. See ``find`` for what is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(selector or fit(docs))
    chosen = fields(docs, *columns)
    at = columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = pa.array([redacted(t, shared.value.spans(t)[1]) for t in texts], pa.string())
            yield batch.set_column(at, "text", clean)

    return chosen.mapInArrow(of, chosen.schema)


def find(docs: DataFrame, selector: Selector | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of base spans, base_sha256, spans, redacted.

    A null text is empty: no spans, the digest of "", and stays null redacted. A
    null doc_id is kept. Repeated rows get equal answers. Without candidates to learn
    from only base spans come. Columns other than doc_id and text are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(selector or fit(docs))
    chosen = fields(docs, "doc_id", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, texts = [], [], [], batch.column("text").to_pylist()
            clean = []
            for text in texts:
                base, found = shared.value.spans(text)
                counts.append([sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
                clean.append(redacted(text, found))
            by_kind = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c) for c in by_kind],
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array(clean, pa.string()),
                ],
                names=names,
            )

    return chosen.mapInArrow(
        of,
        f"doc_id {kind}, "
        + ", ".join(f"n_{k} bigint" for k in KINDS)
        + ", base_sha256 string, spans string, redacted string",
    )
