"""The operators as named queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import decontaminate, lexical, lines, maxent, merkle, packing, pii, quality, rules, setsketch, toxicity, urls, warc
from glyphmill.llm.columns import remainder
from glyphmill.llm.merkle_sql import manifest_sql
from glyphmill.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path).where(F.col("kind") == "record")
    return records.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op2_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(_table(spark, sf_dir, "documents"))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows a quality model may learn from."""
    return docs.where(remainder(F.col("doc_id"), 5) != 0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(learnable(docs), _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


# The rules of the contract.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

# A small labelled table from general parts of names, none of them a host of the tables that are judged.
UNWANTED_PARTS = (
    "casino poker jackpot roulette slots gambling betting bets lottery pills viagra pharma steroid porn xxx sex adult "
    "escort nude spam malware phishing warez torrent crack ads adserver clicks tracker track popup payday loans"
).split()
ORDINARY_PARTS = (
    "news library garden history recipes school music museum science theatre travel kitchen bakery hospital "
    "university research physics biology chemistry math language poetry novel archive journal sport football tennis "
    "cinema photo art gallery design house family children health doctor teacher student city village river mountain "
    "forest farm animal bird fish bread coffee tea cheese wine market bank law court police church nature climate "
    "energy car train bicycle airport hotel island beach software linux python data forum wiki blogs weather cooking "
    "fishing cycling hiking reading writing building learning spring morning mother father brother leather station"
).split()
# Parts that go with both.
SHARED_PARTS = "online best my shop world zone club king top daily 24 net pro".split()


def url_labels(spark: SparkSession) -> DataFrame:
    """Each part alone and with shared parts, below several domains and paths that tell nothing of the class."""
    places = [("", "com", "/en/12"), ("www.", "net", "/fr/345.html"), ("m.", "org", "/es/6789/"), ("blog.", "com", "/de/4")]
    rows = []
    for parts, blocked in ((UNWANTED_PARTS, 1), (ORDINARY_PARTS, 0)):
        for i, part in enumerate(parts):
            one, two, three = (SHARED_PARTS[(i + k) % len(SHARED_PARTS)] for k in (0, 4, 9))
            names = (part, f"{part}-{one}", f"{two}-{part}", f"{part}{two}", f"{three}{part}")
            # there are fewer unwanted parts, so each stands in more places
            for k, name in enumerate(names):
                for prefix, domain, path in places if blocked else [places[(i + k) % len(places)]]:
                    rows.append((f"https://{prefix}{name}.example.{domain}{path}", blocked))
    return spark.createDataFrame(rows, "url string, blocked int")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    model = urls.fit_urls(url_labels(spark))
    judged = pages.select("page_id", urls.judge_url(F.col("url"), urls.Rules(URL_RULES), model).alias("j"))
    return judged.select("page_id", "j.host", "j.path", "j.rule", "j.verdict", F.col("j.probability").alias("score"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), percent=75)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = pii.fit_spans(docs)
    found = docs.select("doc_id", pii.find_spans(model, F.col("text")).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.digest(base).cast("binary"), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts, _ = rules.adaptive_rules(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return verdicts.select("doc_id", *counts, "base_failed", "kept")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = remainder(F.col("doc_id"), 4)
    model = toxicity.fit_toxicity(docs.where(fold != 2), _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.toxicity_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(5) == 0
    manifest = merkle.build_manifest(
        docs,
        merkle.leaf_digest([*own, F.col("text")]),
        changed=F.when(tampered, merkle.leaf_digest([*own, lower])),
    )
    return merkle.verify_rows(manifest).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_maxent": op2_maxent,
    "op3_quality": op3_quality,
    "op4_urls": op4_urls,
    "op5_lines": op5_lines,
    "op6_packing": op6_packing,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_rules": op10_rules,
    "op11_toxicity": op11_toxicity,
    "op12_lexical": op12_lexical,
    "op13_merkle": op13_merkle,
}

# SQL that gives the same rows; the others are tested against plain Python.
ORACLE: dict[str, str] = {
    "op12_lexical": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
        ), b AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
        ), s AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0
        ), m AS (SELECT doc_id, 75 + (25 * len(w) * big_n) // l AS m FROM d, s WHERE len(w) > 0
        ), f AS (
            SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d)
            WHERE t IN (SELECT t FROM b) GROUP BY ALL
        ), g AS (SELECT t, count(*) AS df FROM f GROUP BY t
        ), i AS (
            SELECT item_id, t, count(*) AS q, any_value(floor(1000 * ln((2 * big_n + 2) / (2 * coalesce(df, 0) + 1))))::BIGINT AS w
            FROM b LEFT JOIN g USING (t) CROSS JOIN s GROUP BY ALL
        ), r AS (
            SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM i JOIN f USING (t) JOIN m USING (doc_id) GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM r WHERE score > 0 QUALIFY rank <= 20
    """,
    "op13_merkle": manifest_sql(),
    "op1_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages
        ), f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
        SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    ((('0x' || substr(h, 5 * g + 1, 5))::BIGINT >> s) & 31)::INTEGER + 1, 1)),
                'string_agg', '')), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM p JOIN f USING (h)
    """,
    "op5_lines": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM documents
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM f)) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                FILTER (key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
        FROM k GROUP BY doc_id
    """,
    "op7_near_duplicates": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
                THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS g
            FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b USING (g)
            WHERE a.doc_id <> b.doc_id GROUP BY ALL
        ), e AS (
            SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 75 * (a.n + b.n - k)
        ), r AS (
            SELECT doc_id AS u, doc_id AS v FROM documents
            UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v
        )
        SELECT r.u AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.v) AS component_id,
            r.u = min(r.v) AS kept
        FROM r LEFT JOIN n ON n.doc_id = r.u GROUP BY r.u
    """,
    "op8_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'),
                lambda x: x <> '') AS w FROM documents
        ), b AS (
            SELECT *, len(w) AS n, least(len(w), 5) AS g FROM (
                SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'),
                    lambda x: x <> '') AS w FROM benchmark
            ) WHERE len(w) > 0
        ), bs AS (
            SELECT item_id, w, n, g, i, array_to_string(w[i:i + g - 1], ' ') AS s
            FROM (SELECT *, unnest(range(1, n - g + 2)) AS i FROM b)
        ), ds AS (
            SELECT doc_id, g, i, array_to_string(w[i:i + g - 1], ' ') AS s
            FROM (SELECT doc_id, w, g, unnest(range(1, len(w) - g + 2)) AS i
                FROM d CROSS JOIN (SELECT DISTINCT g FROM b))
        ), a AS (
            SELECT DISTINCT ds.doc_id, bs.item_id, bs.n, bs.g, greatest(least(ds.i - bs.i, len(d.w) - bs.n), 0) AS start
            FROM ds JOIN bs USING (s, g) JOIN d USING (doc_id)
        ), x AS (
            SELECT a.*, len(d.w[start + 1:start + a.n]) AS m, b.w AS iw, d.w[start + 1:start + a.n] AS ww
            FROM a JOIN d USING (doc_id) JOIN b USING (item_id)
        ), ws AS (
            SELECT doc_id, item_id, start, s, count(*) AS c FROM (
                SELECT doc_id, item_id, start, unnest(list_transform(range(1, m - g + 2),
                    lambda i: array_to_string(ww[i:i + g - 1], ' '))) AS s FROM x) GROUP BY ALL
        ), its AS (SELECT item_id, s, count(*) AS c FROM bs GROUP BY ALL
        ), k AS (
            SELECT doc_id, item_id, start, sum(least(ws.c, its.c)) AS k FROM ws JOIN its USING (item_id, s) GROUP BY ALL
        ), r AS (
            SELECT x.doc_id, x.item_id, x.start, x.n, k::DOUBLE / ((x.m - x.g + 1) + (x.n - x.g + 1) - k) AS similarity
            FROM x JOIN k USING (doc_id, item_id, start)
        )
        SELECT doc_id, item_id, start::INTEGER AS start, n::INTEGER AS n_words, similarity FROM r
        WHERE similarity >= 0.75
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
    """,
}
