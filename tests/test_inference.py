import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from glyphmill.functions.lexicon import SPANISH_POLARITY
from glyphmill.operators import models
from glyphmill.operators.entities import lexicon_entities
from glyphmill.operators.inference import infer_batches
from glyphmill.operators.schemas import output_schema
from glyphmill.operators.sentiment import lexicon_sentiment


def rows_of(frame):
    return sorted(frame.collect(), key=lambda row: int(row["id"]))


@pytest.mark.parametrize("task,native", [("sentiment", lexicon_sentiment), ("ner", lexicon_entities)])
def test_batched_model_equals_column_expressions(corpus, edge_texts, task, native):
    frame = infer_batches(corpus(edge_texts), task, mode="mock", batch_size=4)
    assert frame.schema.fieldNames() == output_schema(task).fieldNames()
    assert rows_of(frame) == rows_of(native(corpus(edge_texts)))


def test_repeated_runs_are_equal(corpus, edge_texts):
    frame = infer_batches(corpus(edge_texts), "sentiment", mode="mock")
    assert rows_of(frame) == rows_of(frame)


def test_duplicate_ids_keep_their_rows(spark):
    frame = spark.createDataFrame([("7", "bueno"), ("7", "malo"), ("7", "bueno")], "id string, text string")
    labels = sorted(row["label"] for row in infer_batches(frame, "sentiment", mode="mock").collect())
    assert labels == ["NEG", "POS", "POS"]


def test_filters_on_other_columns_run_before_the_model(corpus):
    frame = infer_batches(corpus(["a", "b"]), "sentiment", mode="mock").where("id = '1'")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("(id#")
    assert frame.count() == 1


def test_filters_on_the_prediction_do_not_run_the_model_twice(corpus):
    for frame in (
        infer_batches(corpus(["bueno", "malo", "x"]), "sentiment", mode="mock"),
        lexicon_sentiment(corpus(["bueno", "malo", "x"])),
    ):
        found = frame.where("label = 'POS' AND confidence > 0.1")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("predict(") + plan.count("regexp_extract_all") == 1
        assert [row["id"] for row in found.collect()] == ["0"]


def test_batches_respect_batch_size(corpus):
    def load():
        return lambda texts, size, length: [
            {"label": f"{len(texts)} of {size}, {length}", "confidence": 0.5} for _ in texts
        ]

    frame = infer_batches(
        corpus(["x"] * 11).coalesce(1), "sentiment", batch_size=3, max_length=5, load=load, deterministic=False
    )
    labels = sorted(row["label"] for row in frame.collect())
    assert labels == ["2 of 3, 5"] * 2 + ["3 of 3, 5"] * 9


def test_keyed_models_are_loaded_once_per_worker(spark, corpus, tmp_path):
    """More tasks than workers: set-ups and loads are counted by process id in a log."""
    log = str(tmp_path)

    def note(kind):
        import os
        import uuid

        with open(f"{log}/{kind}-{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass

    def load():
        note("load")
        return lambda texts, size, length: [{"label": "POS", "confidence": 0.5} for _ in texts]

    def run(key):
        rows = infer_batches(
            corpus(["x"] * 64).repartition(32), "sentiment", load=load, model_key=key, setup=lambda: note("setup")
        )
        assert rows.count() == 64
        rows.write.format("noop").mode("overwrite").save()

    def by_process(kind):
        found = Counter(name.split("-")[1] for name in os.listdir(log) if name.startswith(kind))
        return found

    run(f"model at {log}")
    loads, setups = by_process("load"), by_process("setup")
    assert loads and loads == setups and set(loads.values()) == {1}
    run(None)  # without a key: once per task
    assert sum(by_process("load").values()) >= sum(loads.values()) + 32


def test_loader_makes_a_model_once_per_key():
    loader, made = models.Loader(), []

    def make():
        made.append("model")
        return lambda texts, size, length: []

    first = loader.get("a", make, lambda: made.append("setup"))
    assert loader.get("a", make) is first and made == ["setup", "model"]
    assert loader.get("b", make) is not first
    spec = models.model_spec("ner", "one", mode="mock")
    assert loader.of(spec) is loader.of(models.model_spec("ner", "one", mode="mock"))
    assert loader.of(spec) is not loader.of(models.model_spec("ner", "two", mode="mock"))


def test_mode_is_settled_on_the_driver(monkeypatch, corpus):
    for there, mode in ((False, "mock"), (True, "hf")):
        monkeypatch.setattr(models, "pretrained_available", lambda there=there: there)
        assert models.settle_mode("auto") == mode
    monkeypatch.setenv(models.MODE_VARIABLE, "Mock")
    assert models.settle_mode() == "mock" and models.settle_mode("HF") == "hf"
    monkeypatch.delenv(models.MODE_VARIABLE)
    assert models.settle_mode() == "hf"
    with pytest.raises(ValueError, match="tape"):
        infer_batches(corpus(["a"]), "sentiment", mode="tape")


def test_specs_name_known_models_only(corpus):
    assert models.model_spec("ner", mode="hf") == models.ModelSpec("ner", "pretrained")
    with pytest.raises(ValueError):
        models.model_spec("summary", mode="mock")
    with pytest.raises(ValueError, match="belong to load"):
        infer_batches(corpus(["a"]), "ner", mode="mock", model_key="k")


def test_text_classifiers_get_the_limits():
    seen = {}

    def classify(texts, **options):
        seen.update(options)
        return [{"label": text.upper(), "score": len(text)} for text in texts]

    assert models.labels_from(classify)(["x", "yz"], 4, 33) == [
        {"label": "X", "confidence": 1.0}, {"label": "YZ", "confidence": 2.0},
    ]
    assert seen == {"batch_size": 4, "truncation": True, "max_length": 33}


def test_token_classifiers_give_entities():
    full = {"word": "Ruiz", "entity_group": "PER", "start": 3, "end": 7, "score": 0.75}
    answers = {"all": [full, {"entity": "LOC", "score": 0.5, "start": None}, {}], "none": []}

    def tag(texts, batch_size):
        found = [answers[text] for text in texts]
        return found[0] if len(found) == 1 else found

    predict = models.spans_from(tag)
    one, other = predict(["all", "none"], 8, 0)
    assert one["entities"][0] == {"text": "Ruiz", "type": "PER", "start": 3, "end": 7, "score": 0.75}
    assert [e["type"] for e in one["entities"]] == ["PER", "LOC", "ENTIDAD"] and one["entities"][1]["start"] == 0
    assert one["confidence"] == round(1.25 / 3, 4) and other == {"entities": [], "confidence": 0.0}
    assert predict(["all"], 8, 0) == [one] and predict(["none"], 8, 0) == [other]


def test_a_model_of_ones_own_runs_in_spark(corpus):
    def load():
        from glyphmill.operators.models import spans_from

        def tag(texts, batch_size):
            return [[{"word": t, "entity": "W", "start": 0, "end": len(t), "score": 0.5}] if t else [] for t in texts]

        return spans_from(tag)

    rows = rows_of(infer_batches(corpus(["uno", "", "tres"]), "ner", batch_size=2, load=load, model_key="words"))
    assert [[e["text"] for e in row["entities"]] for row in rows] == [["uno"], [], ["tres"]]
    assert [row["n_entities"] for row in rows] == [1, 0, 1] and rows[2]["confidence"] == 0.5


def test_lexicon_travels_with_the_model(corpus):
    frame = infer_batches(corpus(["bueno"]), "sentiment", mode="mock", lexicon=SPANISH_POLARITY)
    assert frame.select(F.col("label")).first()["label"] == "POS"


def test_texts_of_like_length_share_a_call_and_keep_their_rows(corpus):
    texts = ["x" * (1 + 97 * i % 100) for i in range(200)] + [None, ""]

    def load():
        # what a padding model reports: its text's length and the length it was padded to
        return lambda texts, size, length: [
            {"label": str(len(t)), "confidence": float(max(map(len, texts)))} for t in texts
        ]

    frame = corpus(texts).coalesce(1)
    padded = {}
    for by_length in (True, False):
        found = rows_of(infer_batches(frame, "sentiment", load=load, batch_size=16, by_length=by_length))
        assert [row["label"] for row in found] == [str(len(t or "")) for t in texts]
        assert [row["text"] for row in found] == [t or "" for t in texts]
        padded[by_length] = sum(row["confidence"] for row in found) - sum(len(t or "") for t in texts)
    assert padded[True] < padded[False] / 5


def test_spans_are_put_back_in_order(corpus):
    def load():
        def tag(texts, size, length):
            spans = [{"text": t, "type": "A", "start": 0, "end": len(t), "score": 0.5} for t in texts]
            return [{"entities": [s] * len(s["text"]), "confidence": 0.5} for s in spans]

        return tag

    texts = ["ccc", "", "a", "bbbbb", "dd", None]
    found = rows_of(infer_batches(corpus(texts), "ner", load=load, batch_size=2))
    assert [row["n_entities"] for row in found] == [len(t or "") for t in texts]
    assert all(e["text"] == row["text"] for row in found for e in row["entities"])


def test_memory_of_a_worker_does_not_grow_with_its_rows(spark):
    from pyspark.sql import functions as F

    def load():
        import pyarrow

        def model(texts, batch_size, max_length):
            return [{"label": "NEU", "confidence": pyarrow.total_allocated_bytes() / 1e6} for _ in texts]

        return model

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
        texts = spark.range(0, 6000, 1, 1).selectExpr("string(id) AS id", "repeat('x', 10000 + int(id % 90)) AS text")
        found = infer_batches(texts, "sentiment", load=load, batch_size=16)
        most, rows, wrong = found.agg(
            F.max("confidence"), F.count("*"), F.count_if(F.length("text") != 10000 + F.col("id").cast("int") % 90)
        ).first()
        assert rows == 6000 and wrong == 0
        assert most < 35  # 60 MB of text in all
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
