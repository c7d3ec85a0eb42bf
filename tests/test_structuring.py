import pytest
from pyspark.sql import functions as F

from glyphmill.functions.lexicon import SPANISH_CLINICAL, SPANISH_POLARITY, EntityLexicon, PolarityLexicon
from glyphmill.operators.entities import flatten_entities, join_entities, lexicon_entities, normalize_spans
from glyphmill.operators.models import make_model, model_spec
from glyphmill.operators.schemas import output_schema
from glyphmill.operators.sentiment import join_sentiment, lexicon_sentiment


ODD = EntityLexicon.of(
    {"X": ["i̇stanbul", "k", "ς", "σας", "Tos", "dos palabras", "", "a.c", "groß", "ſ", "of", "off"]}
)
ODD_TEXTS = ["İSTANBUL i̇stanbul istanbul", "K k Σ σ ς ΣΑΣ", "TOS Tos tos", "dos palabras", "abc a.c", "GROß GROẞ gross", "S s ſ", "off of offs"]


def row_model(task, texts, lexicon=None):
    return make_model(model_spec(task, mode="mock", lexicon=lexicon))([t or "" for t in texts], 16, 256)


def by_id(frame):
    return {int(row["id"]): row for row in frame.collect()}


def test_sentiment_labels(corpus):
    rows = by_id(
        lexicon_sentiment(
            corpus(["La ganancia crece, saldo positivo", "Cae y baja: débil", "Nada que anotar el lunes", "sube lento"])
        )
    )
    assert [rows[i]["label"] for i in range(4)] == ["POS", "NEG", "NEU", "NEU"]
    assert all(0.0 <= row["confidence"] <= 0.99 for row in rows.values())


def test_sentiment_pinned_values(corpus):
    # int("e3b0c442", 16) / 0xffffffff = 0.889417...: SHA-256 of the empty text
    rows = by_id(lexicon_sentiment(corpus([None, ""])))
    assert rows[0]["text"] == "" and rows[0]["label"] == "NEU"
    assert rows[0]["confidence"] == rows[1]["confidence"] == round(0.6 + 0.3 * (0xE3B0C442 / 0xFFFFFFFF), 4)


def test_sentiment_equals_row_model(corpus, edge_texts):
    rows = by_id(lexicon_sentiment(corpus(edge_texts)))
    for i, wanted in enumerate(row_model("sentiment", edge_texts, SPANISH_POLARITY)):
        assert (rows[i]["label"], rows[i]["confidence"]) == (wanted["label"], wanted["confidence"])


# Letters newer than the JVM's Unicode tables, which Python knows as letters already.
NEW_LETTERS = ["\U0001DF00tos bueno", "tos\U0001E030 fiebre bueno\U0001E030 malo"]


def padded(words, n=600):
    return [*words, *(f"relleno{i}" for i in range(n))]


def test_the_size_of_a_lexicon_changes_no_result(corpus, edge_texts):
    texts = [*edge_texts, *NEW_LETTERS]
    polarity = PolarityLexicon.of(["bueno", "claro"], ["malo"])
    entities = EntityLexicon.of({"S": ["tos", "fiebre"]})
    assert by_id(lexicon_sentiment(corpus(texts), polarity)) == by_id(
        lexicon_sentiment(corpus(texts), PolarityLexicon.of(padded(polarity.positive), padded(polarity.negative)))
    )
    large = lexicon_entities(corpus(texts), EntityLexicon.of({"S": padded(["tos", "fiebre"])}))
    assert by_id(lexicon_entities(corpus(texts), entities)) == by_id(large)
    assert "Python" not in large._jdf.queryExecution().executedPlan().toString()


def test_polarity_table_equals_lists(spark, corpus, edge_texts):
    rows = [(w, "positive") for w in SPANISH_POLARITY.positive] + [(w, "negative") for w in SPANISH_POLARITY.negative]
    terms = spark.createDataFrame([*rows, *rows, (None, "positive"), ("x", None)], "term string, polarity string")
    texts = [*edge_texts, "bueno", "bueno"]
    found = join_sentiment(corpus(texts), terms)
    assert found.columns == output_schema("sentiment").fieldNames()
    assert by_id(found) == by_id(lexicon_sentiment(corpus(texts)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ganancia" not in plan
    repeated = spark.createDataFrame([("1", "bueno"), ("1", "bueno"), (None, "malo"), ("1", "malo")], "id string, text string")
    labels = sorted(r["label"] for r in join_sentiment(repeated, terms).collect())
    assert labels == ["NEG", "NEG", "POS", "POS"]


def test_unusual_polarity_words_match_as_in_python(corpus):
    lexicon = PolarityLexicon.of(ODD.by_type[0][1], ["gross", "s"])
    rows = by_id(lexicon_sentiment(corpus(ODD_TEXTS), lexicon))
    for i, wanted in enumerate(row_model("sentiment", ODD_TEXTS, lexicon)):
        assert (rows[i]["label"], rows[i]["confidence"]) == (wanted["label"], wanted["confidence"]), ODD_TEXTS[i]


def test_sentiment_counts_distinct_words(corpus):
    rows = by_id(lexicon_sentiment(corpus(["bueno BUENO bueno malo lento"])))
    assert rows[0]["label"] == "NEG"


def test_sentiment_schema_and_order(corpus):
    assert lexicon_sentiment(corpus(["a"])).columns == output_schema("sentiment").fieldNames()


def test_entities_equal_row_model(corpus, edge_texts):
    frame = lexicon_entities(corpus(edge_texts))
    assert frame.columns == output_schema("ner").fieldNames()
    rows = by_id(frame)
    for i, wanted in enumerate(row_model("ner", edge_texts, SPANISH_CLINICAL)):
        found = [entity.asDict() for entity in rows[i]["entities"]]
        assert found == wanted["entities"]
        assert rows[i]["n_entities"] == len(found)
        assert rows[i]["confidence"] == wanted["confidence"]


def test_spans_point_into_the_text(corpus, edge_texts):
    for row in lexicon_entities(corpus(edge_texts)).collect():
        for entity in row["entities"]:
            assert row["text"][entity["start"] : entity["end"]] == entity["text"]


def test_no_entities_is_an_empty_list(corpus):
    row = lexicon_entities(corpus(["Visita anual, todo en orden"])).first()
    assert row["entities"] == [] and row["n_entities"] == 0 and row["confidence"] == 0.0


def test_first_type_wins(corpus):
    lexicon = EntityLexicon.of({"DRUG": ["tos"], "SYMPTOM": ["tos", "dolor"]})
    row = lexicon_entities(corpus(["dolor tos"]), lexicon).first()
    assert [e["type"] for e in row["entities"]] == ["SYMPTOM", "DRUG"]


def test_unusual_terms_match_as_in_python(corpus):
    rows = by_id(lexicon_entities(corpus(ODD_TEXTS), ODD))
    for i, wanted in enumerate(row_model("ner", ODD_TEXTS, ODD)):
        assert [e.asDict() for e in rows[i]["entities"]] == wanted["entities"], ODD_TEXTS[i]


def test_empty_lexicon(corpus):
    row = lexicon_entities(corpus(["tos"]), EntityLexicon.of({})).first()
    assert row["entities"] == [] and row["confidence"] == 0.0
    assert lexicon_sentiment(corpus(["bueno"]), PolarityLexicon.of([], [])).first()["label"] == "NEU"


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_joined_lexicon_equals_lexicon_entities(spark, corpus, edge_texts, broadcast_limit, limit):
    broadcast_limit(limit)
    listed = [(t, kind, i) for i, (kind, terms) in enumerate(SPANISH_CLINICAL.by_type) for t in terms]
    terms = spark.createDataFrame([*listed, ("tos", "OTHER", 9)], "term string, type string, priority int")
    found = join_entities(corpus(edge_texts), terms).collect()
    wanted = flatten_entities(lexicon_entities(corpus(edge_texts))).drop("ordinal").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))


def test_normalize_spans_fills_missing_fields(spark):
    schema = (
        "id string, text string, raw_spans array<struct<word:string, entity_group:string, entity:string,"
        " start:bigint, end:bigint, score:float>>"
    )
    spans = [(None, None, None, None, None, None), ("a", "G", "E", 1, 2, 0.5), ("b", None, "E", 3, 4, 0.25)]
    row = normalize_spans(spark.createDataFrame([("1", "x", spans), ("2", "y", []), ("3", "z", None)], schema)).collect()
    assert [tuple(e) for e in row[0]["entities"]] == [("", "ENTIDAD", 0, 0, 0.0), ("a", "G", 1, 2, 0.5), ("b", "E", 3, 4, 0.25)]
    assert row[0]["n_entities"] == 3 and row[0]["confidence"] == 0.25
    assert row[1]["entities"] == [] and row[1]["confidence"] == 0.0
    assert row[2]["entities"] == [] and row[2]["n_entities"] == 0 and row[2]["confidence"] == 0.0


def test_normalize_spans_without_some_fields(spark):
    frame = spark.createDataFrame([("1", "x", [("a", 0.5)])], "id string, text string, raw_spans array<struct<word:string, score:double>>")
    assert tuple(normalize_spans(frame).first()["entities"][0]) == ("a", "ENTIDAD", 0, 0, 0.5)


def test_structuring_needs_no_shuffle_and_no_python(corpus):
    for frame in (lexicon_sentiment(corpus(["a"])), lexicon_entities(corpus(["a"]))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_each_pattern_is_evaluated_once(corpus):
    plan = lexicon_entities(corpus(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("split(") == 1
    plan = lexicon_sentiment(corpus(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("sha2") == 1


def test_unused_confidence_is_pruned(corpus):
    plan = lexicon_sentiment(corpus(["a"])).select("label")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" in plan and "sha2" not in plan


def test_row_local_operators_run_on_a_stream(spark, tmp_path, corpus):
    texts = ["Excelente curso", "Pésimo", "tos y fiebre"]
    path = str(tmp_path / "in.parquet")
    corpus(texts).write.parquet(path)
    stream = spark.readStream.schema("id string, text string").parquet(path)
    structured = lexicon_entities(lexicon_sentiment(stream).withColumnRenamed("confidence", "sentiment_confidence"))
    query = structured.writeStream.format("memory").queryName("structured").trigger(availableNow=True).start()
    query.awaitTermination(60)
    rows = by_id(spark.table("structured").orderBy(F.col("id")))
    assert [rows[i]["label"] for i in range(3)] == ["POS", "NEG", "NEU"]
    assert rows[2]["n_entities"] == 2
