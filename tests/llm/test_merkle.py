"""Merkle manifest against a plain Python tree; layout arithmetic; edge cases."""

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphmill.llm import merkle

from samples import edge_texts, prose


def h(text):
    return sha256(text.encode()).hexdigest()


def climb(nodes):
    """All levels of one tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def around(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 16
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
        i //= 16
    return out


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute(rows):
    """(id, text, source) to a sorted list of result rows."""

    def leaf(i, text, source):
        return h("".join(map(field, (i, source, text))))

    groups = {}
    for i, text, source in rows:
        groups.setdefault(source, []).append((i is not None, i or 0, leaf(i, text, source), text))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    found = []
    for s in order:
        for k, (known, i, own, text) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            i = i if known else None
            path = around(trees[s], k) + around(top, order.index(s))
            now = own
            if known and crc32(str(i).encode()) % 5 == 0 and text is not None:
                now = leaf(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in text), s)
            for left, right in path:
                now = h(left + now + right)
            proof = h("".join(a + b for a, b in path))
            found.append((i, own, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(found, key=repr)


def spark_rows(frame):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(5) == 0
    own = [F.col("doc_id"), F.col("source")]
    manifest = merkle.build_manifest(
        frame,
        merkle.leaf_digest([*own, F.col("text")]),
        changed=F.when(tampered, merkle.leaf_digest([*own, lower])),
    )
    return manifest, sorted(map(tuple, merkle.verify_rows(manifest).collect()), key=repr)


def with_sources(frame_of, rows):
    by_source = {}
    for i, text, source in rows:
        by_source.setdefault(source, []).append((i, text))
    frames = [frame_of(pairs, source=source) for source, pairs in by_source.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def test_equals_plain_python(frame_of):
    rows = [(i, text, s) for s in ("a", None, "é", "Z") for i, text in edge_texts() if len(text or "") < 5000]
    rows += [(i, "Only One", "lonely") for i in (5,)] + [(i, prose(i, 5).upper(), f"s{i % 20}") for i in range(300)]
    assert spark_rows(with_sources(frame_of, rows))[1] == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4096, 4097, 9000])
def test_sizes_up_to_several_subtrees(frame_of, n):
    rows = [(i, f"Text {i}", "one") for i in range(n)] + [(1, "x", "two")]
    manifest, found = spark_rows(with_sources(frame_of, rows))
    assert found == brute(rows) and len(manifest.forest.rounds) == (2 if n > 4096 else 1)
    assert {r[0] for r in found if not r[6]} == {i for i in range(n) if crc32(str(i).encode()) % 5 == 0}


def test_repeated_rows_and_a_hot_group(frame_of):
    rows = [(7, "same Text", "hot")] * 3000 + [(i, "b", "hot") for i in range(2000)]
    assert spark_rows(with_sources(frame_of, rows))[1] == brute(rows)


def test_empty_table(no_docs):
    manifest, found = spark_rows(no_docs)
    assert manifest.root is None and found == []


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_a_permutation_with_aligned_parts(levels):
    places = [merkle.veb_address(levels, d, np.arange(16**d)) for d in range(levels)]
    assert sorted(np.concatenate(places)) == list(range(merkle.veb_size(levels)))
    assert places[0][0] == 0
    top = levels // 2
    if top:
        size = merkle.veb_size(levels - top)
        for k in range(16**top):  # each bottom part lies in one piece
            part = [p[k * 16 ** (d - top) : (k + 1) * 16 ** (d - top)] for d, p in enumerate(places) if d >= top]
            found = np.sort(np.concatenate(part))
            assert found[0] == merkle.veb_size(top) + k * size and found[-1] == found[0] + size - 1
    assert merkle.veb_address(levels, levels - 1, 0) == places[-1][0]


def test_ragged_subtrees_keep_used_nodes_only():
    leaves = np.zeros((3, 32), np.uint8)
    assert len(merkle.build_block(leaves, 1)) == 4
    assert merkle.siblings(merkle.build_block(leaves, 1), 1, 3, 0, 2) == ("00" * 64, "")
