"""Line deduplication against plain counting."""

import re
from collections import Counter

import pytest

from glyphmill.llm import lines
from glyphmill.sources.scratch import scratch_path

from samples import edge_texts, prose


def key(line):
    stripped = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)


def brute(pairs, least, chars=1):
    counts = Counter(k for _, t in pairs for k in {key(x) for x in (t or "").split("\n")} if len(k) >= chars)
    out = []
    for i, text in pairs:
        own = (text or "").split("\n")
        kept = [x for x in own if counts[key(x)] < least]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def result(frame):
    return sorted(map(tuple, frame.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


@pytest.mark.parametrize("least,chars", [(2, 1), (3, 1), (2, 500)])
def test_edge_documents(edge_docs, least, chars):
    found = lines.dedup_lines(edge_docs, least, chars)
    assert result(found) == brute(edge_texts(), least, chars)
    assert set(edge_docs.columns) <= set(found.columns) and found.count() == edge_docs.count()
    assert found.select("`hash.ed`", "k1", "short").distinct().collect()[0][1] == 7


def test_hot_lines_and_many_batches(frame_of):
    pairs = [(i, f"Common line\n{prose(i % 40, 8)}\n  COMMON LINE \nonly {i}\n\n") for i in range(300)]
    assert result(lines.dedup_lines(frame_of(pairs), 10, batches=6)) == brute(pairs, 10)


def test_batches_leave_out_what_the_runs_know(frame_of, monkeypatch):
    pairs = [(i, f"Common line\n{prose(i % 40, 8)}\nonly {i}") for i in range(300)]
    added, add = [], lines.LineRuns.add
    monkeypatch.setattr(lines.LineRuns, "add", lambda runs, batch: (added.append(batch.count()), add(runs, batch)))
    one = result(lines.dedup_lines(frame_of(pairs), 5, batches=1))
    assert added == [900]
    assert result(lines.dedup_lines(frame_of(pairs), 5, batches=5)) == one == brute(pairs, 5)
    # the common line is known after the first batch
    assert len(added) == 6 and sum(added[1:]) < 900 - 200


def test_no_documents(no_docs):
    assert lines.dedup_lines(no_docs).count() == 0


def test_levels_merge_and_batches_are_filtered(spark):
    runs = lines.LineRuns(spark, scratch_path(spark, "runs"), fanout=2)
    schema = "h1 long, h2 long"
    for batch in range(5):
        runs.add(spark.createDataFrame([(batch, 0), (100, 0)], schema))
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # 5 runs in base 2
    assert {r[0] for r in runs.frequent(5).collect()} == {100}
    new = spark.createDataFrame([(3, 0), (7, 0), (100, 0)], schema)
    assert {r[0] for r in runs.anti_join(new).collect()} == {7}
    again = lines.LineRuns(spark, runs.root, fanout=2, levels=runs.levels)
    again.add(new)
    assert {r[0] for r in again.frequent(2).collect()} == {3, 100}
    assert lines.LineRuns(spark, scratch_path(spark, "empty")).frequent().count() == 0
    with pytest.raises(ValueError):
        lines.LineRuns(spark, "x", fanout=1)


def test_runs_are_sorted(spark):
    runs = lines.LineRuns(spark, scratch_path(spark, "runs"))
    runs.add(spark.range(1000).selectExpr("xxhash64(id) as h1", "id as h2"))
    part = spark.read.parquet(runs.levels[0][0]).selectExpr("h1", "input_file_name() as f").collect()
    by_file = {}
    for row in part:
        by_file.setdefault(row["f"], []).append(row["h1"])
    assert all(values == sorted(values) for values in by_file.values())
