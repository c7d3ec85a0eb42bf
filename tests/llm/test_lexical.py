"""Dual-tree search against scoring every pair; pruning; edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from glyphmill.llm import lexical

from samples import edge_texts, prose

ITEM_SCHEMA = "item_id long, text string, doc_id long, rank int"


def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def brute(docs, items, k):
    texts = [(i, terms_of(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n_docs, total = len(texts), sum(len(t) for _, t in texts)
    df = Counter(term for _, t in texts for term in set(t))
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        wanted = Counter(terms_of(text))
        for i, own in texts:
            tf, m = Counter(own), 75 + (25 * len(own) * n_docs) // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t, q in wanted.items()
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 5, 9) for i, t in items], ITEM_SCHEMA)


def found(spark, docs, items, k=20):
    rows = lexical.search(docs, items_frame(spark, items), k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, rows.collect()), key=repr)


ITEMS = [(i, prose(i, 3 + i % 40)) for i in range(30)] + [
    (50, None), (51, ""), (52, "?!"), (None, "ta re"), (53, "ta ta TA ta re"), (54, "É x 😀 a.b@c-d.org"), (55, "nowhere"),
    (3, prose(3, 6)), (3, prose(99, 6)), (7, prose(7, 10)),
]


def test_equals_brute_force(spark, frame_of):
    docs = edge_texts() + [(100 + i, prose(i, 1 + i % 60)) for i in range(400)]
    assert found(spark, frame_of(docs), ITEMS) == brute(docs, ITEMS, 20)
    assert found(spark, frame_of(docs), ITEMS, k=3) == brute(docs, ITEMS, 3)


def test_ties_go_by_id(spark, frame_of):
    docs = [(i, "same words here") for i in random.Random(0).sample(range(1000), 300)] + [(None, "same words here"), (-4, "same words here")]
    docs += [(5000 + i, "other text") for i in range(300)]
    assert found(spark, frame_of(docs), [(1, "same words")]) == brute(docs, [(1, "same words")], 20)


def test_batches_of_items_do_not_matter(spark, frame_of, monkeypatch):
    docs = [(i, prose(i, 1 + i % 60)) for i in range(200)]
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", 7)
    assert found(spark, frame_of(docs), ITEMS) == brute(docs, ITEMS, 20)


def test_huge_weights_use_integers(spark, frame_of):
    item = [(1, "rare " * 1_200_000 + "word")]
    docs = [(i, "rare word" if i < 40 else "nothing") for i in range(100)]
    assert found(spark, frame_of(docs), item) == brute(docs, item, 20)
    plan = lexical.Plan([1], [(np.array([0]), np.array([9_100_000_000]))], 1, 1, 1, 20)
    assert lexical.Items(plan).kind is np.int64


def test_empty_tables(spark, frame_of, no_docs):
    assert found(spark, no_docs, ITEMS) == []
    assert found(spark, frame_of([(1, None), (2, " ")]), ITEMS) == []
    assert found(spark, frame_of([(1, "ta re")]), []) == []


def planted(groups):
    """A plan of items on different subjects, and one tree of documents on these."""
    rng = random.Random(3)
    vocabulary = [[f"s{g}w{j}" for j in range(40)] for g in range(groups)]
    docs = [(i, " ".join(rng.choices(vocabulary[i % groups], k=30))) for i in range(2000)]
    items = [Counter(rng.choices(vocabulary[g % groups], k=8)) for g in range(64)]
    number = {t: i for i, t in enumerate(t for v in vocabulary for t in v)}
    rows = [(np.array(sorted(number[t] for t in own), np.int32), np.array([own[t] * 3000 for t in sorted(own, key=number.get)])) for own in items]
    loose = lexical.Plan(list(range(64)), rows, len(number), len(docs), 30 * len(docs), 5)
    order = lexical.tree_order(lexical.Items(loose).matrix, lexical.ITEM_LEAF)
    plan = lexical.Plan([int(i) for i in order], [rows[i] for i in order], len(number), len(docs), 30 * len(docs), 5)
    batch = pa.record_batch([pa.array([i for i, _ in docs]), pa.array([t.encode() for _, t in docs])], ["doc_id", "text"])
    vectors = pa.Table.from_batches(list(lexical._vectors({t.encode(): i for t, i in number.items()})(iter([batch]))))
    listed, counts = vectors["terms"].combine_chunks(), vectors["counts"].combine_chunks()
    sizes = np.array([len(x) for x in listed.to_pylist()])
    parts = (np.asarray(listed.flatten()), np.asarray(counts.flatten()))
    mine = lexical.Items(plan)
    return plan, mine, lexical.plant(vectors["doc_id"].to_pylist(), np.asarray(vectors["n"]), sizes, *parts, plan, mine)


def test_maxima_bound_every_pair_and_trees_survive_storing():
    plan, items, tree = planted(4)
    tree = lexical.Tree.read(tree.stored())
    every = tree.leaf(0, len(tree.ids), np.arange(plan.n_terms), np.float64)
    scores = items.matrix @ every.T
    for level in range(len(tree.nodes)):
        item_level = min(level, items.depth)
        borders = lexical.halves(len(tree.ids), lexical.LEAF)[level]
        for node in range(len(borders) - 1):
            bound = lexical._bounds(tree, items, level, node, item_level, np.arange(len(items.borders[item_level]) - 1))
            below = np.maximum.reduceat(scores[:, borders[node] : borders[node + 1]].max(1), items.borders[item_level][:-1])
            assert (bound >= below).all()


def test_pruning_skips_most_pairs_and_loses_none():
    plan, items, tree = planted(8)
    best, calls = lexical.Best(plan, items), []
    real = lexical._score_leaf
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lexical, "_score_leaf", lambda *a: calls.append(len(a[4])) or real(*a))
        lexical.search_tree(tree, items, best)
    leaves, item_leaves = len(lexical.halves(len(tree.ids), lexical.LEAF)[-1]) - 1, len(items.borders[-1]) - 1
    assert sum(calls) < 0.3 * leaves * item_leaves
    scores = (items.matrix @ tree.leaf(0, len(tree.ids), np.arange(plan.n_terms), np.float64).T).astype(int)
    for row in range(len(plan.ids)):
        wanted = sorted(zip(-scores[row], tree.ids, strict=True))[: plan.k]
        assert [(-s, i) for s, i in zip(best.found[row][0], best.found[row][2], strict=True)] == [w for w in wanted if w[0] < 0]
