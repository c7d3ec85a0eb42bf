"""Decontamination against brute force; native plan; the block guarantee."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glyphmill.llm import decontaminate

from samples import edge_texts, prose

ITEM_SCHEMA = "item_id long, text string, size int, words string"


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(pairs, items, least=0.75):
    best = {}
    for doc, text in pairs:
        words = words_of(text)
        for item, item_text in items:
            own = words_of(item_text)
            if not own:
                continue
            n, wanted = min(5, len(own)), grams(own, min(5, len(own)))
            for start in range(max(1, len(words) - len(own) + 1)):
                found = grams(words[start : start + len(own)], n)
                shared = sum((found & wanted).values())
                if shared and shared / sum((found | wanted).values()) >= least:
                    best[doc, item] = max(best.get((doc, item), 0), shared / sum((found | wanted).values()))
    return best


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "w") for i, t in items], ITEM_SCHEMA)


ITEMS = [(1, prose(50, 30)), (2, prose(51, 41) + "!"), (3, "Tiny"), (4, ""), (5, None), (6, "three little words"),
         (7, prose(1, 40)), (8, "a a a a a a a b"), (1, prose(50, 30))]


def leaked():
    first, second = prose(50, 30), prose(51, 41)
    words = second.split()
    return [
        (100, prose(60, 50) + "\n" + first.upper() + "! " + prose(61, 50)),
        (101, prose(62, 20) + " " + " ".join([*words[:20], "other", *words[21:]]) + " end"),
        (102, " ".join([*words[:10], "x", *words[11:20], "y", *words[21:30], "z", *words[31:]])),
        (103, " ".join(words[:38])),
        (104, "so tiny, a b c three little, words"),
        (105, prose(63, 3000) + " " + first),
        (106, "x " + "a " * 9 + "b"),
    ]


def test_equals_brute_force(spark, frame_of):
    pairs = leaked() + edge_texts()
    found = decontaminate.contaminated(frame_of(pairs), items_frame(spark, ITEMS)).collect()
    wanted = brute(pairs, ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(wanted)
    for row in found:
        assert row["similarity"] == pytest.approx(wanted[row["doc_id"], row["item_id"]])
    assert {100, 101, 104, 105} <= {r["doc_id"] for r in found} and 102 not in {r["doc_id"] for r in found}


def test_empty_tables(spark, frame_of, no_docs):
    items = items_frame(spark, ITEMS)
    assert decontaminate.contaminated(no_docs, items).count() == 0
    for rows in ([], [(1, None), (2, "")]):
        assert decontaminate.contaminated(frame_of(leaked()), items_frame(spark, rows)).count() == 0


def test_plan_has_no_python(spark, frame_of, monkeypatch):
    plans = []

    def spy(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame, name)

    real = decontaminate.materialize
    monkeypatch.setattr(decontaminate, "materialize", spy)
    found = decontaminate.contaminated(frame_of(leaked()), items_frame(spark, ITEMS))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert not any(re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan) for plan in plans)


def test_blocks_find_all_within_the_radius(spark):
    base = 0x0123456789ABCDEF
    rows = [(d, base ^ sum(1 << (i * 64 // d if d else 0) for i in range(d))) for d in range(decontaminate.RADIUS + 1)]
    frame = spark.createDataFrame([(d, x - (1 << 64) if x >= 1 << 63 else x) for d, x in rows], "d int, p long")
    mine = decontaminate._blocks(F.lit(base))
    met = frame.where(F.arrays_overlap(decontaminate._blocks(F.col("p")), mine)).count()
    assert met == len(rows)


def test_fingerprints_of_alike_windows_are_close(spark):
    words = prose(9, 40).split()
    near = [*words[:10], "other", *words[11:]]
    frame = spark.createDataFrame([(words, near, prose(10, 40).split())], "a array<string>, b array<string>, c array<string>")
    a, b, c = (decontaminate.fingerprint(F.col(x)) for x in "abc")
    row = frame.select(F.bit_count(a.bitwiseXOR(b)), F.bit_count(a.bitwiseXOR(c))).first()
    assert row[0] <= decontaminate.RADIUS < row[1]


def test_items_changed_or_cut_at_the_edge_equal_brute_force(spark, frame_of):
    items, pairs = [], []
    for i, (n, changed, left) in enumerate([(25, 3, 20), (40, 5, 31), (60, 8, 46)] * 30):
        words = prose(1000 + i, n).split()
        items.append((i, " ".join(words)))
        pairs.append((2 * i, " ".join([*words[: n - changed], *prose(5000 + i, changed).split()])))
        pairs.append((2 * i + 1, " ".join(words[:left])))
    # one word many times at the edge: most bits of the fingerprint differ
    words = prose(2000, 172).split()
    items.append((1000, " ".join([*words, *["x"] * 28])))
    pairs.append((1000, " ".join([*words, *["y"] * 28])))
    found = decontaminate.contaminated(frame_of(pairs), items_frame(spark, items)).collect()
    wanted = brute(pairs, items)
    assert len(wanted) >= 181 and (1000, 1000) in wanted
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(wanted)


def test_similarity_counts_repeated_elements(spark):
    pairs = [([1, 1, 2, 3], [1, 2, 2, 3]), ([5], [5]), ([7, 7, 7], [7]), ([1, 2], [3]), (list(range(300)) * 3, list(range(200)) * 4)]
    frame = spark.createDataFrame(pairs, "a array<bigint>, b array<bigint>")
    found = [r[0] for r in frame.select(decontaminate.weighted_similarity(F.col("a"), F.col("b"))).collect()]
    wanted = [sum((Counter(a) & Counter(b)).values()) / sum((Counter(a) | Counter(b)).values()) for a, b in pairs]
    assert found == pytest.approx(wanted)


def test_very_long_items_and_documents(spark, frame_of):
    words = prose(77, 20_000).split()
    changed = [w if i % 400 else "other" for i, w in enumerate(words)]
    repeated = "la la li " * 3000
    items = [(1, " ".join(words)), (2, prose(78, 30)), (3, repeated)]
    pairs = [
        (1, " ".join(words)),
        (2, prose(79, 500) + " " + " ".join(changed) + " " + prose(80, 300)),
        (3, " ".join(words[:10_000])),
        (4, prose(81, 200) + " " + prose(78, 30)),
        (5, repeated + "end"),
    ]
    found = decontaminate.contaminated(frame_of(pairs, partitions=2), items_frame(spark, items)).collect()
    best = {(r["doc_id"], r["item_id"]): (r["start"], r["similarity"]) for r in found}
    assert set(best) == {(1, 1), (2, 1), (4, 2), (5, 3)}
    assert best[1, 1] == (0, 1.0) and best[4, 2] == (200, 1.0) and best[5, 3] == (0, 1.0)
    exact = grams(changed, 5), grams(words, 5)
    assert best[2, 1] == (500, pytest.approx(sum((exact[0] & exact[1]).values()) / sum((exact[0] | exact[1]).values())))


def test_filter_grows_with_the_benchmark(spark):
    few, many = (spark.range(n).select(F.xxhash64("id").alias("h")) for n in (100, 50_000))
    assert decontaminate._bit_filter(few)[1] == 1 << 19
    table, bits = decontaminate._bit_filter(many)
    assert bits == 1 << 20
    assert many.where(decontaminate._in_filter(table, bits, F.col("h"))).count() == 50_000
    others = spark.range(1_000_000, 1_010_000).select(F.xxhash64("id").alias("h"))
    assert others.where(decontaminate._in_filter(table, bits, F.col("h"))).count() < 200
