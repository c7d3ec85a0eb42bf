"""Personal data: base spans against plain patterns, added spans, redaction."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glyphmill.llm import pii

from samples import edge_texts, prose

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checksum(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and checksum(digits) == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        (k, m.start(), m.end())
        for k, kind in enumerate(pii.KINDS)
        for m in re.finditer(PATTERNS[kind], text)
        if valid(kind, m[0])
    ]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a_@@..-+ 0123456789()é\n%", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e_x@y.z", "@a.b", "a@b", "a@b.c.", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.0.9 1.2.3", "é😀 a+b@c-d.e",
        "4111 1111 1111 1111", "4111-1111-1111-11110", "0000000000000000", "+1 (555) 123-4567)", "+12-", "+1234567",
        "9" * 50_000, "a" * 50_000 + "@" + "b." * 100 + "c", "+" + " " * 50_000, "1." * 20_000, "@" * 20_000,
    ],
)
def test_base_spans_of_odd_texts(text):
    if len(text) < 1000:
        assert pii.base_spans(text) == brute(text)
    else:
        pii.base_spans(text), pii.candidates(text)  # in linear time


def texts(n):
    out = []
    for i in range(n):
        start = prose(i, 20)
        out += [
            f"{start} write to u{i}.x@mail{i % 7}.example.com {start}",
            f"{start} phone +1 ({200 + i % 700}) 555-{1000 + i} {start}",
            f"{start} from 10.{i % 255}.7.{(7 * i) % 255} {start}",
            f"{start} item {i} of {i * 37}, at {i % 24}:30 in 20{i % 100:02d} {start}",
        ]
    return out


@pytest.fixture(scope="module")
def model(frame_of):
    return pii.fit_spans(frame_of(list(enumerate(texts(150)))))


def test_spans_of_documents(model, edge_docs, no_docs):
    spans = pii.find_spans(model, F.col("text")).alias("spans")
    found = edge_docs.select("text", spans).collect()
    for row in found:
        kinds = [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in row["spans"]]
        assert [k for k, s in zip(kinds, row["spans"], strict=True) if s["base"]] == brute(row["text"] or "")
        assert kinds == sorted(kinds)
    assert len(found) == len(edge_texts()) and no_docs.select(spans).count() == 0


def test_clean_text_stays_and_obfuscated_mail_may_be_added(model):
    for text in (prose(900, 300), "chapter 3, 14 of 27", ""):
        assert model.added(text, pii.base_spans(text)) == []
    strange = "see who (at) mail3.example.com now"
    assert pii.candidates(strange) and pii.base_spans(strange) == []
    for span, odds in model.added(strange, []):
        assert 0 <= odds <= 1 and strange[span[1] : span[2]].startswith("who")


def test_trees_learn_a_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    trees = pii.fit_boosted(x[:3000], y[:3000])
    assert ((trees.probability(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.97
    assert pii.fit_boosted(x, np.ones(4000)).probability(x[:5]).min() > 0.99


def test_nothing_to_learn_from(frame_of, no_docs):
    for docs in (no_docs, frame_of([(1, None), (2, "no numbers")])):
        assert pii.fit_spans(docs).added("1.2.3.4 5 6 7", []) == []


def test_redaction(spark):
    text = "é a@b.cd, 10.0.0.1!"
    rows = spark.createDataFrame([(text,), (None,)], "text string")
    empty = pii.SpanModel(pii.fit_boosted(__import__("numpy").zeros((0, 1)), __import__("numpy").zeros(0)), (2.0,) * 4)
    spans = rows.select("text", pii.find_spans(empty, F.col("text")).alias("s"))
    assert [r[0] for r in spans.select(pii.redact(F.col("text"), F.col("s"))).collect()] == ["é [email], [ip]!", ""]
    digest = spans.select(pii.digest(F.col("s"))).first()[0]
    assert digest == "email:2:8,ip:10:18"


LOOSE = [
    ("email", "jane.roe (at) host (dot) com"),
    ("email", "bob [at] example [dot] org"),
    ("ip", "192 . 168 . 10 . 44"),
    ("card", "4111.1111.1111.1111"),
    ("card", "4111/1111/1111/1111"),
    ("phone", "(555) 123-4567"),
    ("phone", "1 212 555 0199"),
]
CLEAN = [
    "on 2021-03-04 we met", "from 1990-1995 in", "it cost 1.234.567 there", "meet @ home. Then we go",
    "arrive (at) home. Then we go", "numbers 12, 15, 17, 200 are", "token a3a1b97e25e5c1059743005344d08a",
]


def test_obfuscated_spans_are_added_and_clean_text_is_not(model):
    for kind, own in LOOSE:
        text = f"{prose(5, 20)} {own} {prose(6, 9)}"
        start = text.index(own)
        assert pii.base_spans(text) == []
        assert [s for s, _ in model.added(text, [])] == [(pii.KINDS.index(kind), start, start + len(own))]
    for own in CLEAN:
        text = f"{prose(5, 20)} {own} {prose(6, 9)}"
        assert pii.base_spans(text) == [] and model.added(text, []) == []
    assert all(model.added(t, pii.base_spans(t)) == [] for t in texts(50))


def test_trees_and_thresholds_learn_from_every_whole_text(spark, frame_of):
    import random

    long = [f"{prose(i, 4000)} {t} {prose(i, 100)}" for i, t in enumerate(texts(20))]
    assert min(map(len, long)) > 20_000
    short = [f"item {i}, call 555 {i:04d}" for i in range(3500)]
    rows = list(enumerate([*long, *short, *short[:50], None, "no digits"]))
    found = pii.span_examples(frame_of(rows)).collect()
    keyed = spark.createDataFrame([(t,) for t in {*long, *short}], "t string").select("t", F.xxhash64("t").alias("h"))
    wanted = [(*map(float, x), y, bool(r["h"] & 1)) for r in keyed.collect() for x, y in pii._examples(r["t"], random.Random(r["h"]))]
    assert sorted(map(tuple, found)) == sorted(wanted) and len(wanted) > 40_000 // 2
    model = pii.fit_spans(frame_of(list(enumerate(long))))
    assert max(model.thresholds) <= 1
    text = f"{prose(5, 20)} bob [at] example [dot] org {prose(6, 9)}"
    assert [text[s:e] for (_, s, e), _ in model.added(text, [])] == ["bob [at] example [dot] org"]


def test_trees_of_a_table_are_those_of_its_rows(spark):
    import numpy as np

    from glyphmill.llm import boosting

    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(3000, 4)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 2] < 0.5)).astype(float)
    own = boosting.fit_boosted(x, y, trees=4)
    cuts = [np.unique(np.quantile(c, boosting.QUANTILES, method="lower")) for c in x.T]
    rows = [(bytes(b), bool(t)) for b, t in zip(boosting.binned(x, cuts), y, strict=True)]
    table = spark.createDataFrame(rows, "x binary, y boolean").groupBy("x", "y").agg(F.count("*").alias("n"))
    given = boosting.fit_boosted_rows(table.repartition(3), cuts, y.mean(), trees=4)
    for name in ("feature", "cut", "leaf"):
        assert np.array_equal(getattr(own, name), getattr(given, name))
    assert boosting.fit_boosted_rows(table, cuts, 1.0).probability(x[:3]).min() > 0.99


def test_overlaps_are_found_among_many_spans():
    spans = [(0, 10 * i, 10 * i + 3 + i % 9) for i in range(50)]
    others = [(3, 30 * i + 2, 30 * i + 7 + 40 * (i % 2)) for i in range(20)]
    assert pii._clear(spans, others) == [c for c in spans if not any(pii._overlaps(c, b) for b in others)]
    many = "call 555 0100, " * 20_000 + "+1 555 555 0100 " * 20_000
    assert len(pii._clear(pii.candidates(many), pii.base_spans(many))) >= 20_000
