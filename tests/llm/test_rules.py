"""Quality rules: statistics by brute force, sketches, fences."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import rules

from samples import edge_texts, prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), text.count("\n") + 1, repeated, len(marked),
    )


TEXTS = ["a b c a b c", "a b a b a b", "a a a", "a a a a", "x\nx\n \n \nx", "# * $%&|<> é😀", "a b c d a b", "\x85 b", "1 2\x1c3"]


@pytest.mark.parametrize("text", [*TEXTS, *(t for _, t in edge_texts())])
def test_statistics(text):
    assert rules.text_statistics((text or "").encode()) == brute(text)


def test_edge_documents(edge_docs, no_docs):
    verdicts, fences = rules.adaptive_rules(edge_docs)
    found = verdicts.collect()
    names = [part.split()[0] for part in rules.STATISTICS.split(", ")]
    assert sorted((r["doc_id"], *(r[n] for n in names)) for r in found if r["doc_id"] is not None) == sorted(
        (i, *brute(t)) for i, t in edge_texts() if i is not None
    )
    for row in found:
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
        assert not (row["kept"] and row["base_failed"]) and row["kept"] is not None
    assert len(found) == len(edge_texts()) and fences.count() == 1
    assert rules.adaptive_rules(no_docs)[0].count() == 0


def test_sketch_quantiles_are_close(spark):
    values = np.random.default_rng(3).lognormal(0, 2, 5000)
    frame = spark.createDataFrame([(float(v),) for v in [*values, 0.0]], "v double")
    row = frame.select("v", rules.bucket_value(rules.bucket(F.col("v"))).alias("b"))
    for v, b in row.collect():
        assert abs(b - v) <= 0.011 * v
    assert math.isclose(rules.GROWTH, 1.02)


def test_groups_have_their_own_fences(frame_of):
    plain = [(i, prose(i, 80)) for i in range(300)]
    symbols = [(1000 + i, " ".join(w + "#" for w in prose(i, 80).split())) for i in range(300)]
    odd = (5000, " ".join(w + "###" for w in prose(7, 80).split()))
    short = [(6000, "a b")]
    docs = frame_of([*plain, odd, *short], source="a").unionByName(frame_of(symbols, source="b"))
    docs = docs.unionByName(frame_of([(7000, prose(8, 80))], lang=None, source=None))
    verdicts, fences = rules.adaptive_rules(docs)
    kept = {r["doc_id"] for r in verdicts.where("kept").collect()}
    assert kept == {i for i, _ in plain} | {i for i, _ in symbols} | {7000}
    assert fences.count() == 3


def test_sketches_merge(frame_of):
    docs = frame_of([(i, prose(i, 60)) for i in range(50)], source="a").unionByName(
        frame_of([(i, prose(i, 70)) for i in range(50, 90)], source="b")
    )
    thin = rules.statistics(docs)
    by_source = rules.sketch(thin, ("lang", "source"))
    merged = rules.merge_sketches(by_source, ("lang",))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, rules.sketch(thin, ("lang",)).collect()))


def spoilt(i, marks):
    """A text with that many symbols after every word."""
    return " ".join(w + "#" * marks for w in prose(i, 80).split())


def kept_of(docs, **kw):
    return {r["doc_id"] for r in rules.adaptive_rules(docs, **kw)[0].where("kept").collect()}


def test_a_source_with_bad_documents_cannot_lift_its_fence(frame_of):
    clean = [(s * 1000 + i, prose(s * 1000 + i, 80)) for s in range(4) for i in range(100)]
    docs = frame_of([d for d in clean if d[0] < 1000], source="s0")
    for s in range(1, 4):
        docs = docs.unionByName(frame_of([d for d in clean if d[0] // 1000 == s], source=f"s{s}"))
    # the spoilt source is the largest: a third of all rows, 30 % of its own bad
    hot = [(9000 + i, spoilt(i, 3) if i % 10 < 3 else prose(9000 + i, 80)) for i in range(200)]
    docs = docs.unionByName(frame_of(hot, source="hot"))
    good = {i for i, _ in clean} | {9000 + i for i in range(200) if i % 10 >= 3}
    assert kept_of(docs) == good


def test_a_source_of_repeated_lines_has_its_own_fence(frame_of):
    def text(i, repeated):
        lines = [" ".join(prose(i * 40 + k, 12).split()) for k in range(12)]
        return "\n".join(lines + lines[:1] * repeated)

    verse = [(i, text(i, 3 + i % 2)) for i in range(200)]
    plain = [(1000 + i, text(1000 + i, 0)) for i in range(200)]
    odd = [(5000, text(5000, 6))]
    docs = frame_of(verse, source="verse").unionByName(frame_of([*plain, *odd], source="plain"))
    limits = {"dup_line_rate": rules.Fence(spread=3.0, slack=0.1)}
    found = kept_of(docs, limits=limits, prior_docs=10)
    assert found == {i for i, _ in verse} | {i for i, _ in plain}


def test_no_group_size_changes_the_fences_over(frame_of):
    # the language is large, so its own quantiles stay where they are
    wide = [(10_000 + i, prose(i, 80)) for i in range(2000)]
    tops = []
    for size in (10, 50, 51, 199, 201, 300):
        own = [(i, spoilt(i, 1)) for i in range(size)]
        docs = frame_of(own, source="own").unionByName(frame_of(wide, source="wide"))
        _, table = rules.adaptive_rules(docs)
        tops.append(table.where("source = 'own'").first()["max_symbol_rate"])
    assert tops == sorted(tops) and tops[0] < 0.5 < 1.0 < tops[-1]
    assert tops[2] - tops[1] < 0.01 and tops[4] - tops[3] < 0.01
