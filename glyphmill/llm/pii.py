"""Operator 9: personal data by candidate gradient boosting.

Exact patterns with validators give the base spans. Generators of high recall
propose further, overlapping spans; boosted trees score each by its format and
its surroundings, and those above a threshold calibrated per kind are added.
No labelled table is needed: in every text that may hold a candidate, confirmed
spans are rewritten into forms the exact patterns miss, and the trees learn to
tell these from harmless numbers and words in the same places.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.llm.boosting import QUANTILES, Boosted, binned, constant, fit_boosted, fit_boosted_rows
from glyphmill.llm.columns import as_text, quoted, slices
from glyphmill.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
# Share of right spans among those added that the calibration asks for.
PRECISION = 0.98

Span = tuple[int, int, int]  # position in KINDS, start, end (exclusive), in code points

# The exact patterns. A match begins where a run of its characters begins, so the look-behinds
# change no match; they only keep long runs from being tried again at every character.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each ``@`` outwards in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The exact patterns, per kind leftmost and not overlapping, sorted by kind and start."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                    spans.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _digits(m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    spans.append((3, m.start(), m.end()))
    return spans


_AT = re.compile(r"@|[(\[{]\s?at\s?[)\]}]", re.IGNORECASE)
_LOOSE = (
    re.compile(
        r"[A-Za-z0-9._%+-]{1,64}\s?(?:@|[(\[{]\s?at\s?[)\]}])\s?[A-Za-z0-9-]{1,63}"
        r"(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[A-Za-z0-9-]{1,63})+",
        re.IGNORECASE,
    ),
    re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20?[.,:]\x20?[0-9]{1,3}){3}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,22}(?![0-9])"),
    re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])"),
)
_MAY_HOLD = r"@|[0-9][\x20().,:/-]{0,3}[0-9]|(?i)[(\[{]\s?at\s?[)\]}]"
_DIGIT_PAIR = re.compile(r"[0-9][\x20().,:/-]{0,3}[0-9]")


def candidates(text: str) -> list[Span]:
    """High-recall proposals of possible values, which may overlap each other and the base spans."""
    found: list[Span] = []
    end = 0
    for anchor in _AT.finditer(text):
        if anchor.start() >= end:
            m = _LOOSE[0].search(text, max(end, anchor.start() - 66), anchor.end() + 400)
            if m:
                found.append((0, m.start(), m.end()))
                end = m.end()
    if _DIGIT_PAIR.search(text):
        for kind in (1, 2, 3):
            found.extend((kind, m.start(), m.end()) for m in _LOOSE[kind].finditer(text) if _possible(kind, m[0]))
    return found


def _possible(kind: int, own: str) -> bool:
    """The kind's validator, whatever stands between the digits. It is no feature: the trees judge form and place."""
    if kind == 1:
        return all(int(g) <= 255 for g in re.findall(r"[0-9]+", own))
    digits = _digits(own)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


_HINTS = (
    re.compile(r"mail|contact|correo", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|addr", re.IGNORECASE),
    re.compile(r"card|visa|credit|carte|karte|tarjeta", re.IGNORECASE),
    re.compile(r"phone|tel|call|fax|mobil", re.IGNORECASE),
)


_BEFORE_SPACE = re.compile(r"[.,:]\s")
_AFTER_SPACE = re.compile(r"\s[.,:]")
_BRACKETED = re.compile(r"[(\[{]\s?(?:at|dot)\s?[)\]}]", re.IGNORECASE)


def _side(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def span_features(text: str, span: Span) -> list[float]:
    """Format and surroundings of a proposed span, without what a base pattern asks for."""
    kind, start, end = span
    own = text[start:end]
    digits = _digits(own)
    groups = re.findall(r"[0-9]+", own) or [""]
    between = [c for c in own if not c.isalnum()]
    before, after = text[max(0, start - 24) : start], text[end : end + 3]
    return [
        kind,
        len(own),
        len(digits),
        sum(c.isalpha() for c in own) / len(own),
        len(groups),
        max(map(len, groups)),
        min(map(len, groups)),
        len(groups[0]),
        len(groups[-1]),
        len(between),
        len(set(between)),
        own.count("."),
        own.count(" "),
        own.count(","),
        own.count(":"),
        own.count("/"),
        len(_BEFORE_SPACE.findall(own)),
        len(_AFTER_SPACE.findall(own)),
        len(_BRACKETED.findall(own)),
        "(" in own,
        _side(text[start - 1 : start] if start else ""),
        _side(text[end : end + 1]),
        any(c.isdigit() for c in before[-3:]),
        any(c.isdigit() for c in after),
        bool(_HINTS[kind].search(before)),
        sum(c.isalpha() for c in before) / max(1, len(before)),
    ]


FEATURES = tuple(f"x{i}" for i in range(26))
# Examples sent back to Spark at a time.
_EXAMPLE_ROWS = 20_000


def _overlaps(a: Span, b: Span) -> bool:
    return a[1] < b[2] and b[1] < a[2]


def _clear(spans: list[Span], others: list[Span]) -> list[Span]:
    """The spans that overlap none of the others, found by bisection."""
    ordered = sorted((start, end) for _, start, end in others)
    starts, ends = [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))
    return [c for c in spans if not (i := bisect_left(starts, c[2])) or ends[i - 1] <= c[1]]


def _covers(span: Span, other: Span) -> bool:
    """Two spans of a kind are the same but for a few characters."""
    shared = min(span[2], other[2]) - max(span[1], other[1])
    return span[0] == other[0] and shared >= 0.8 * (max(span[2], other[2]) - min(span[1], other[1]))


# The characters around a rewritten span that are looked at for proposals.
_CONTEXT = 100


def _invented(kind: int, rng: random.Random) -> str:
    """A made-up value that the exact pattern of the kind confirms."""
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    if kind == 0:
        word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
        local = rng.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}"])
        return f"{local}@{rng.choice(['', word() + '.'])}{word()}.{rng.choice(['com', 'org', 'net', 'de', 'co.uk'])}"
    if kind == 1:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        start = rng.choice("3456") + number(14)
        return next(start + c for c in "0123456789" if luhn(start + c))
    return f"+{rng.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"


def _loosened(kind: int, own: str, rng: random.Random) -> str:
    """A base span in a form its exact pattern misses."""
    if kind == 0:
        local, _, domain = own.partition("@")
        dot = rng.choice([".", " (dot) ", "(dot)", " [dot] ", "[dot]"])
        at = rng.choice([" (at) ", "(at)", " [at] ", "[at]", " {at} ", *([" @ "] if dot == "." else ["@"])])
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return rng.choice([" . ", " .", ". "]).join(own.split("."))
    digits = _digits(own)
    if kind == 2:
        return rng.choice([".", "/", "  ", ". ", "--"]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    groups = re.findall(r"[0-9]+", own)
    forms = [own[1:], "00" + own[1:]]
    if len(groups) > 2:
        forms += [f"{groups[0]} {s.join(groups[1:])}" for s in "-./ "] + [s.join(groups) for s in "-./ "]
        rest = own[1 + len(groups[0]) :].lstrip(" .-")
        forms += [rest, f"({groups[1]}) {'-'.join(groups[2:])}", *(s.join(groups[1:]) for s in "-./")]
    return rng.choice([f for f in forms if len(_digits(f)) <= 15] or [own[1:]])


def _harmless(kind: int, words: list[str], rng: random.Random) -> str:
    """Words or digits of ordinary text that a generator of the kind may propose."""
    if kind == 0:
        one, two, three = (rng.choice(words) for _ in range(3))
        return rng.choice([f"{one} @ {two}. {three}", f"{one} (at) {two}. {three}", f"{one} @{two}. {three}"])
    year, month, day = rng.randint(1900, 2060), rng.randint(1, 12), rng.randint(1, 28)
    if kind == 1:
        small = [str(rng.randint(0, 60)) for _ in range(4)]
        wide = [str(rng.randint(0, 255)) for _ in range(4)]
        return rng.choice([". ".join(small), ", ".join(small), ":".join(small), ", ".join(wide), ",".join(wide)])
    number = lambda n: str(rng.randint(10 ** (n - 1), 10**n - 1))
    if kind == 2:
        while True:
            sep = rng.choice("./-")
            date, other = (f"{year + i}{sep}{month:02d}{sep}{rng.randint(1, 28):02d}" for i in range(2))
            amount = sep.join([number(rng.randint(1, 3)), *(number(3) for _ in range(rng.randint(4, 5)))])
            made = rng.choice([f"{date} {other}", f"{date}  {other}", amount, number(rng.randint(13, 15))])
            if 13 <= len(_digits(made)) <= 19 and luhn(_digits(made)):
                return rng.choice([made, made, f"{number(1)}e{made}af"])
    sep = rng.choice("-./")
    return rng.choice(
        [
            f"{year}{sep}{month:02d}{sep}{day:02d}",
            f"{day:02d}{sep}{month:02d}{sep}{year}",
            f"{year}-{year + rng.randint(1, 20)}",
            f"{year}{sep}{month:02d}{sep}{day:02d} {rng.randint(0, 23)}",
            rng.choice(". ").join([number(rng.randint(1, 3)), number(3), number(3)]),
            number(rng.randint(7, 12)),
            f"c{number(rng.randint(7, 12))}d",
            " ".join(number(rng.randint(1, 3)) for _ in range(rng.randint(4, 5))),
        ]
    )


def _hinted(text: str, span: Span) -> bool:
    """A proposal that may well be what its generator looks for; it is no example of the contrary."""
    own, before = text[span[1] : span[2]], text[max(0, span[1] - 24) : span[1]]
    return bool(_HINTS[span[0]].search(before) or (_BRACKETED.search(own) if span[0] == 0 else own[0] in "+("))


def _examples(text: str, rng: random.Random) -> Iterator[tuple[list[float], bool]]:
    """(features, is personal data) of proposals that overlap no base span.

    The text's own proposals without a hint are counter-examples. Each base
    span, and a made-up value of each kind between two words, is rewritten in
    its place, once into a loose form and once into something harmless.
    """
    base = base_spans(text)
    for span in _clear(candidates(text), base):
        if not _hinted(text, span):
            yield span_features(text, span), False
    gaps = [m.start() + 1 for m in re.finditer(r"\s(?=\w)", text)] or [0]
    words = re.findall(r"[^\W\d_]+", text) or ["a"]
    places = [(k, s, e, text[s:e], "") for k, s, e in base]
    for kind in range(len(KINDS)):
        at = rng.choice(gaps)
        places.append((kind, at, at, _invented(kind, rng), " "))
    for kind, start, end, own, space in places:
        left, right = text[max(0, start - _CONTEXT) : start], space + text[end : end + _CONTEXT]
        for right_one, new in ((True, _loosened(kind, own, rng)), (False, _harmless(kind, words, rng))):
            here, planted = left + new + right, (kind, len(left), len(left) + len(new))
            around = base_spans(here)
            for span in candidates(here):
                if _overlaps(span, planted) and not any(_overlaps(span, b) for b in around):
                    yield span_features(here, span), right_one and _covers(span, planted)


@dataclass(frozen=True)
class SpanModel:
    trees: Boosted
    thresholds: tuple[float, ...]  # by kind; over 1: none is added

    def added(self, text: str, base: list[Span]) -> list[tuple[Span, float]]:
        """Proposals above their threshold that overlap no base span and no better proposal."""
        # text without an anchor or two digits close together has no candidate
        found = _clear(candidates(text), base)
        if not found:
            return []
        odds = self.trees.probability(np.array([span_features(text, c) for c in found], dtype=float))
        chosen: list[tuple[Span, float]] = []
        starts: list[int] = []  # and ends of those chosen, which don't overlap each other
        ends: list[int] = []
        for i in sorted(range(len(found)), key=lambda i: (-odds[i], found[i])):
            kind, start, end = found[i]
            at = bisect_left(starts, end)
            if odds[i] >= self.thresholds[kind] and (not at or ends[at - 1] <= start):
                chosen.append((found[i], float(odds[i])))
                starts.insert(at, start)
                ends.insert(at, end)
        return chosen


def span_examples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The examples (see ``_examples``) of all whole texts that may hold a candidate.

    Columns: the features, ``y`` (is personal data) and ``second`` (the half the
    text belongs to, by its hash). Equal texts count once.
    """
    text = quoted(text_col).cast("string")
    texts = docs.select(text.alias("text")).where(F.col("text").rlike(_MAY_HOLD))
    schema = ", ".join(f"{name} double" for name in FEATURES) + ", y boolean, second boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x: list[list[float]] = []
        y: list[bool] = []
        second: list[bool] = []

        def made() -> pa.RecordBatch:
            columns = [*np.array(x, dtype=float).reshape(-1, len(FEATURES)).T, np.array(y, bool), np.array(second, bool)]
            x.clear(), y.clear(), second.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*FEATURES, "y", "second"])

        for batch in batches:
            for part in slices(batch):
                for h, own in zip(part["h"].to_pylist(), part["text"].to_pylist(), strict=True):
                    for found, right in _examples(own, random.Random(h)):
                        x.append(found)
                        y.append(right)
                        second.append(bool(h & 1))
                        if len(y) >= _EXAMPLE_ROWS:
                            yield made()
        yield made()

    return texts.select(F.xxhash64("text").alias("h"), "text").distinct().mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch[name].to_numpy() for name in FEATURES], 1)


def _binned_rows(examples: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``x binary, y boolean, n long``: equal binned examples are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([row.tobytes() for row in binned(_matrix(batch), cuts)], pa.binary())
            yield pa.RecordBatch.from_arrays([x, batch["y"]], names=["x", "y"])

    return examples.mapInArrow(run, "x binary, y boolean").groupBy("x", "y").agg(F.count("*").alias("n"))


# Scores are compared in steps of this part when thresholds are chosen, so their number has a bound.
_STEPS = 1 << 16


def _thresholds(examples: DataFrame, trees: Boosted) -> tuple[float, ...]:
    """Per kind the lowest score from which on the (smoothed) precision holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            step = np.floor(trees.probability(x) * _STEPS).astype(np.int64)
            columns = [pa.array(x[:, 0].astype(np.int64)), pa.array(step), batch["y"]]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "step", "y"])

    counts = (
        examples.mapInArrow(run, "kind long, step long, y boolean")
        .groupBy("kind", "step")
        .agg(F.count("*").alias("n"), F.count_if("y").alias("right"))
    )
    from_top = Window.partitionBy("kind").orderBy(F.desc("step"))
    precision = (F.sum("right").over(from_top) + 0.5) / (F.sum("n").over(from_top) + 1.0)
    good = counts.withColumn("precision", precision).where(F.col("precision") >= PRECISION)
    lowest = {row["kind"]: row["step"] / _STEPS for row in good.groupBy("kind").agg(F.min("step").alias("step")).collect()}
    return tuple(lowest.get(kind, 2.0) for kind in range(len(KINDS)))


def fit_spans(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Fit trees and thresholds on all whole texts that may hold a candidate.

    The examples of one half of the texts (``span_examples``) fit the trees, those
    of the other half the thresholds; they are stored, and every level of a tree
    is a pass over them (``fit_boosted_rows``). The driver gets sums only. Without
    candidates nothing is ever added.
    """
    examples = materialize(span_examples(docs, text_col), "span-examples")
    first = examples.where(~F.col("second"))
    n, right, *points = first.agg(F.count("*"), F.count_if("y"), *(F.percentile(x, QUANTILES) for x in FEATURES)).first()
    if n:
        cuts = [np.unique(p) for p in points]
        trees = fit_boosted_rows(materialize(_binned_rows(first, cuts), "span-bins"), cuts, right / n)
    else:
        trees = constant(0.5)
    return SpanModel(trees, _thresholds(examples.where("second"), trees))


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"


def find_spans(model: SpanModel, text: Column) -> Column:
    """All spans of the whole text, sorted by kind and start; null text has none.

    ``base`` marks what the exact patterns found (score 1); these always stay.
    """

    @F.arrow_udf(SPANS)
    def find(column: pa.Array) -> pa.Array:
        found = []
        for value in (text for part in slices(column) for text in part.to_pylist()):
            base = base_spans(value)
            spans = [(*b, True, 1.0) for b in base]
            spans += [(*c, False, p) for c, p in model.added(value, base)]
            found.append(
                [
                    {"kind": KINDS[k], "start": s, "end": e, "base": exact, "score": p}
                    for k, s, e, exact, p in sorted(spans)
                ]
            )
        kind = pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]
        )
        return pa.array(found, pa.list_(kind))

    return find(as_text(text))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for value, found in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
            parts, at = [], 0
            for span in sorted(found or [], key=lambda s: (s["start"], s["end"])):
                if span["start"] >= at:
                    parts += [value[at : span["start"]], f"[{span['kind']}]"]
                at = max(at, span["end"])
            out.append("".join([*parts, value[at:]]))
        return pa.array(out, pa.string())

    return run(as_text(text), spans)


def digest(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
