"""The queries of the catalog as plain SQL, for checking them with another engine.

Written from the definitions, not from the Spark code: windows and unnested
pieces where the operators use arrays.
"""

from __future__ import annotations

_WORD = r"[\p{L}\p{N}_]"
_DOCS = "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS text, lang, source FROM documents"
_TOKENS = f"regexp_extract_all(text, '{_WORD}+')"


def _round4(value: str) -> str:
    """Four places by the exact binary value, ties to even."""
    shifted = f"(CAST({value} * CAST(4611686018427387904 AS DOUBLE) AS HUGEINT) * 20000 + 4611686018427387904)"
    units = f"({shifted} // 9223372036854775808)"
    odd_tie = f"({shifted} % 9223372036854775808 = 0 AND {units} % 2 = 1)"
    return f"(CAST({units} - CASE WHEN {odd_tie} THEN 1 ELSE 0 END AS DOUBLE) / CAST(10000 AS DOUBLE))"


def _unit(text: str) -> str:
    return f"(CAST(CAST('0x' || substr(sha256({text}), 1, 8) AS BIGINT) AS DOUBLE) / CAST(4294967295 AS DOUBLE))"


def _dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def _sentiment(docs: str = _DOCS, name: str = "sent") -> str:
    """CTEs ending in ``sent``: the columns of ``docs`` with label and confidence."""
    margin = f"least(abs(pos - neg) * {_dbl('0.1')}, {_dbl('0.3')})"
    return f"""
{name}_t AS (SELECT *, list_distinct(list_transform({_TOKENS}, lambda t: lower(t))) AS toks FROM ({docs})),
{name}_c AS (SELECT * EXCLUDE (toks),
    len(list_filter(toks, lambda t: t IN ('the', 'and', 'de'))) AS pos,
    len(list_filter(toks, lambda t: t IN ('or', 'der', 'la', 'que'))) AS neg FROM {name}_t),
{name}_r AS (SELECT *, {_dbl('0.6')} + {_dbl('0.3')} * {_unit('text')} + {margin} AS raw FROM {name}_c),
{name} AS (SELECT * EXCLUDE (pos, neg, raw),
    CASE WHEN pos > neg THEN 'POS' WHEN neg > pos THEN 'NEG' ELSE 'NEU' END AS label,
    least({_round4('raw')}, {_dbl('0.99')}) AS confidence FROM {name}_r)"""


_LEXICON = f"""
lex_t(term, type, priority) AS (VALUES ('the', 'A', 0), ('der', 'A', 0),
    ('de', 'B', 1), ('le', 'B', 1), ('or', 'B', 1), ('the', 'B', 1)),
lex_u AS (SELECT term, arg_min(type, priority) AS type,
    {_dbl('0.7')} + {_dbl('0.29')} * {_unit('term')} AS raw FROM lex_t GROUP BY term),
lex AS (SELECT term, type, {_round4('raw')} AS score FROM lex_u)"""

_ENTITIES = f"""
docs AS ({_DOCS}),
pieces AS (SELECT id, regexp_extract_all(text, '{_WORD}+|[^\\p{{L}}\\p{{N}}_]+') AS p FROM docs),
piece AS (SELECT id, unnest(p) AS w, generate_subscripts(p, 1) AS pos FROM pieces),
placed AS (SELECT id, w, pos, sum(length(w)) OVER (PARTITION BY id ORDER BY pos) AS stop FROM piece),
{_LEXICON.strip()},
ent AS (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INTEGER) AS ordinal, w AS text,
    type, CAST(stop - length(w) AS INTEGER) AS start, CAST(stop AS INTEGER) AS "end", score
    FROM placed JOIN lex ON lower(w) = term)"""

_NER = f"""{_ENTITIES},
ent_sum AS (SELECT id, CAST(count(*) AS INTEGER) AS n_entities,
    CAST(sum(CAST(score * 9007199254740992 AS HUGEINT)) AS DOUBLE) / CAST(9007199254740992 AS DOUBLE)
        / CAST(count(*) AS DOUBLE) AS mean FROM ent GROUP BY id),
ner AS (SELECT docs.id, text, lang, source, coalesce(n_entities, 0) AS n_entities,
    CASE WHEN n_entities IS NULL THEN {_dbl('0')} ELSE {_round4('mean')} END AS confidence
    FROM docs LEFT JOIN ent_sum ON docs.id = ent_sum.id)"""

_TRUTH = "truth AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 1 THEN 'POS' ELSE 'NEG' END AS truth FROM labels)"
_PAIRS = f"WITH {_sentiment()}, {_TRUTH}, pairs AS (SELECT sent.id, label, confidence, label = truth AS correct FROM sent JOIN truth ON sent.id = truth.id)"


def _reliability(n_bins: int) -> str:
    edges = ", ".join(_dbl(repr(1.0 if i == n_bins else i * (1.0 / n_bins))) for i in range(n_bins + 1))
    return f"""binned AS (SELECT *, CAST(greatest(len(list_filter([{edges}], lambda e: e < confidence)), 1) AS INTEGER) AS bin
    FROM pairs WHERE confidence BETWEEN 0 AND 1),
rel AS (SELECT bin, avg(confidence) AS mean_confidence, avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS accuracy,
    count(*) AS n FROM binned GROUP BY bin)"""


def _numeric(batches: str) -> str:
    """One row of PSI and KS from ``batches``: a query giving ``value`` and ``is_ref``."""
    shares = ", ".join(_dbl(repr(i * (1.0 / 10))) for i in range(1, 10))
    return f"""batch AS ({batches}),
edges AS (SELECT quantile_cont({_dbl('value')}, [{shares}]) AS edges FROM batch WHERE is_ref),
totals AS (SELECT count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_new FROM batch),
binned AS (SELECT is_ref, len(list_filter(edges, lambda e: e <= value)) AS bin FROM batch, edges),
bin_n AS (SELECT bin, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS w FROM binned GROUP BY bin),
share AS (SELECT CASE WHEN r = 0 THEN 1e-6 ELSE {_dbl('r')} / n_ref END AS e,
    CASE WHEN w = 0 THEN 1e-6 ELSE {_dbl('w')} / n_new END AS a FROM bin_n, totals),
psi AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM share),
vals AS (SELECT value, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS w FROM batch GROUP BY value),
cum AS (SELECT sum(r) OVER (ORDER BY value) AS cr, sum(w) OVER (ORDER BY value) AS cw FROM vals),
ks AS (SELECT max(abs({_dbl('cr')} / n_ref - {_dbl('cw')} / n_new)) AS d FROM cum, totals),
lam AS (SELECT d, d * sqrt({_dbl('n_ref')} * n_new / (n_ref + n_new)) AS l FROM ks, totals),
pv AS (SELECT d, CASE WHEN l < 0.2 THEN 1.0 ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
    lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp({_dbl('-2')} * k * k * l * l))), 0.0), 1.0) END AS p FROM lam)"""


def _categorical(batches: str, name: str = "cat") -> str:
    """One row ``psi`` from a query giving ``category`` and ``is_ref``."""
    return f"""{name}_b AS ({batches}),
{name}_t AS (SELECT count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_new FROM {name}_b),
{name}_n AS (SELECT category, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS w
    FROM {name}_b GROUP BY category),
{name}_s AS (SELECT greatest({_dbl('r')} / n_ref, 1e-6) AS e, greatest({_dbl('w')} / n_new, 1e-6) AS a FROM {name}_n, {name}_t),
{name} AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM {name}_s)"""


_BY_LANGUAGE, _BY_SOURCE = "lang = 'en'", "source < 'src2'"
_NUMERIC_ROW = "SELECT n_ref, n_new, round(psi, 6) AS psi, round(d, 9) AS ks_stat, round(p, 9) AS ks_pvalue FROM totals, psi, pv"


def _length_batches(is_ref: str, table: str = f"({_DOCS})") -> str:
    return f"SELECT length(text) AS value, {is_ref} AS is_ref FROM {table}"


def _report(is_ref: str) -> str:
    return f"""WITH {_sentiment()}, {_numeric(_length_batches(is_ref, 'sent'))},
{_categorical(f'SELECT label AS category, {is_ref} AS is_ref FROM sent')}
SELECT n_ref, n_new, round(psi.psi, 6) AS length_psi, round(d, 9) AS length_ks_stat, round(p, 9) AS length_ks_pvalue,
    round(cat.psi, 6) AS label_psi, (psi.psi > 0.2 OR p < 0.05 OR cat.psi > 0.2) AS drift_detected
FROM totals, psi, pv, cat"""


def _summary(table: str) -> str:
    return f"""count(*) AS n, round(avg(confidence), 10) AS mean_confidence,
    round(avg(CASE WHEN confidence < 0.85 THEN 1.0 ELSE 0.0 END), 10) AS pct_low_confidence FROM {table}"""


def _metrics(table: str, sentiment: bool) -> str:
    """Long form of the summary of ``table``."""
    parts = [
        f"SELECT 'n' AS metric, {_dbl('count(*)')} AS value FROM {table}",
        f"SELECT 'mean_confidence', round(avg(confidence), 10) FROM {table}",
        f"SELECT 'pct_low_confidence', round(avg(CASE WHEN confidence < 0.85 THEN 1.0 ELSE 0.0 END), 10) FROM {table}",
    ]
    if sentiment:
        parts.append(f"SELECT 'label_counts.' || label, {_dbl('count(*)')} FROM {table} GROUP BY label")
    else:
        parts.append(f"SELECT 'coverage', round(avg(CASE WHEN n_entities > 0 THEN 1.0 ELSE 0.0 END), 10) FROM {table}")
        parts.append(f"SELECT 'total_entities', {_dbl('sum(n_entities)')} FROM {table}")
    return " UNION ALL ".join(parts)


def _stored(day_of_english: str, day_of_others: str) -> str:
    return f"""stored AS (SELECT *, 'documents' AS domain,
    CASE WHEN lang = 'en' THEN '{day_of_english}' ELSE '{day_of_others}' END AS ingest_date FROM sent)"""


def _checks(table: str, checks: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{check}' AS \"check\", count(*) AS n_failed FROM {table} WHERE {failed}"
        for column, check, failed in checks
    )


_DAY1, _DAY2, _DAY3 = "2031-02-01", "2031-02-02", "2031-02-03"
_COUNTS = "count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars"

def _failing(table: str, columns: str, checks: list[tuple[str, str, str]]) -> str:
    """Rows with the bits of the checks they fail and the checks' names."""
    bits = " + ".join(f"CASE WHEN {failed} THEN {1 << i} ELSE 0 END" for i, (_, _, failed) in enumerate(checks))
    names = ", ".join(f"CASE WHEN {failed} THEN '{column}.{check}' END" for column, check, failed in checks)
    return f"""SELECT {columns}, CAST({bits} AS BIGINT) AS broken_rules,
        array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS reasons FROM {table} WHERE {bits} <> 0"""


_BAD_SENTIMENT = f"""WITH {_sentiment()},
bad AS (SELECT CASE WHEN source <> 'src7' THEN id END AS id, CASE WHEN source <> 'src8' THEN text END AS text,
    CASE WHEN source = 'src3' THEN 'FELIZ' ELSE label END AS label,
    CASE WHEN source = 'src4' THEN 'NaN' WHEN source = 'src5' THEN '1.5' WHEN source = 'src6' THEN 'high'
        ELSE CAST(confidence AS VARCHAR) END AS confidence, lang FROM sent),
typed AS (SELECT *, TRY_CAST(confidence AS DOUBLE) AS c FROM bad)
"""
_SENTIMENT_CHECKS = [
    ("id", "type", "false"),
    ("id", "not_null", "id IS NULL"),
    ("text", "type", "false"),
    ("text", "not_null", "text IS NULL"),
    ("label", "type", "false"),
    ("label", "not_null", "label IS NULL"),
    ("confidence", "type", "confidence IS NOT NULL AND c IS NULL"),
    ("confidence", "not_null", "confidence IS NULL OR isnan(c)"),
    ("confidence", "in_range", "NOT isnan(c) AND (c < 0 OR c > 1)"),
    ("label", "allowed", "label NOT IN ('POS', 'NEU', 'NEG')"),
]

_BAD_NER = f"""WITH {_NER},
bad AS (SELECT id, text, CASE WHEN source = 'src2' THEN NULL WHEN source = 'src9' THEN n_entities > 0 ELSE false END AS odd,
    CASE WHEN source = 'src3' THEN -1 ELSE n_entities END AS n_entities,
    CASE WHEN source = 'src5' THEN -0.5 ELSE confidence END AS confidence FROM ner)
"""
_NER_CHECKS = [
    ("id", "type", "false"),
    ("id", "not_null", "id IS NULL"),
    ("text", "type", "false"),
    ("text", "not_null", "text IS NULL"),
    ("entities", "type", "false"),
    ("entities", "not_null", "odd IS NULL"),
    ("n_entities", "type", "false"),
    ("n_entities", "not_null", "n_entities IS NULL"),
    ("confidence", "type", "false"),
    ("confidence", "not_null", "confidence IS NULL"),
    ("confidence", "in_range", "confidence < 0 OR confidence > 1"),
    ("n_entities", "at_least_0", "n_entities < 0"),
    ("entities", "allowed_type", "odd"),
]

_SPANS = f"""WITH toks AS (SELECT id, lang, {_TOKENS} AS t FROM ({_DOCS})),
tok AS (SELECT id, lang, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS i FROM toks),
span AS (SELECT id, CASE WHEN length(w) > 1 THEN w ELSE '' END AS text,
    CASE WHEN length(w) > 6 THEN 'LONG' WHEN length(w) > 3 THEN 'MID' ELSE 'ENTIDAD' END AS type,
    CASE WHEN lang <> 'fr' THEN i ELSE 0 END AS start, i + length(w) AS "end",
    CASE WHEN lang <> 'de' THEN {_dbl('length(w)')} / (length(w) + 1.0) ELSE 0.0 END AS score FROM tok)
SELECT id, type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(start) AS BIGINT) AS sum_start,
    CAST(sum("end") AS BIGINT) AS sum_end, round(avg(score), 10) AS mean_score FROM span GROUP BY id, type"""

_SENTIMENT_ROWS = f"WITH {_sentiment()} SELECT id, label, confidence FROM sent"
_NER_ROWS = f"WITH {_NER} SELECT id, n_entities, confidence FROM ner"
_CONVERSATIONS = "SELECT coalesce(text, '') AS text FROM conversations"
_BENCHMARK = "SELECT coalesce(text, '') AS text FROM benchmark"

ORACLE: dict[str, str] = {
    "ingest_normalize": "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents",
    "ingest_csv": "SELECT CAST(doc_id AS VARCHAR) AS id, text FROM documents",
    "ingest_generated_ids": "SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_missing FROM conversations",
    "ingest_content_ids": "SELECT sha256(coalesce(text, '')) AS id, text FROM conversations",
    "ingest_position_ids": """SELECT 'conversations.parquet:' || CAST(row_number() OVER () - 1 AS VARCHAR) AS id, text
        FROM conversations""",
    "tokenize_counts": f"""SELECT id, CAST(len({_TOKENS}) AS INTEGER) AS n_tokens,
        CAST(len(list_distinct(list_transform({_TOKENS}, lambda t: lower(t)))) AS INTEGER) AS n_distinct FROM ({_DOCS})""",
    "sentiment_lexicon": _SENTIMENT_ROWS,
    "sentiment_lexicon_join": _SENTIMENT_ROWS,
    "ner_lexicon_entities": f'WITH {_ENTITIES} SELECT id, ordinal, text, type, start, "end", score FROM ent',
    "ner_lexicon_rows": _NER_ROWS,
    "ner_lexicon_join": f'WITH {_ENTITIES} SELECT id, text, type, start, "end", score FROM ent',
    "normalize_spans": _SPANS,
    "batch_inference": _SENTIMENT_ROWS,
    "batch_inference_entities": f'WITH {_ENTITIES} SELECT id, ordinal, text, type, start, "end", score FROM ent',
    "contract_sentiment": _BAD_SENTIMENT + _checks("typed", _SENTIMENT_CHECKS),
    "contract_ner": _BAD_NER + _checks("bad", _NER_CHECKS),
    "contract_rows_sentiment": _BAD_SENTIMENT + _failing("typed", "id, label, confidence, lang", _SENTIMENT_CHECKS),
    "contract_rows_ner": _BAD_NER + _failing("bad", "id, n_entities, confidence", _NER_CHECKS),
    "contract_values": _BAD_NER + f"""SELECT "column", "check", CAST(rank AS INTEGER) AS rank, id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY id) AS rank FROM (
            SELECT 'confidence' AS "column", 'in_range' AS "check", id, CAST(confidence AS VARCHAR) AS value
            FROM bad WHERE confidence < 0 UNION ALL
            SELECT 'n_entities', 'at_least_0', id, CAST(n_entities AS VARCHAR) FROM bad WHERE n_entities < 0)) WHERE rank <= 3
        UNION ALL SELECT 'entities', 'present', CAST(rank AS INTEGER), id, NULL FROM (
            SELECT id, row_number() OVER (ORDER BY id) AS rank FROM bad) WHERE rank <= 3""",
    "low_confidence_flag": f"WITH {_sentiment()} SELECT id, confidence, confidence < 0.85 AS low_confidence FROM sent",
    "confidence_summary": f"WITH {_sentiment()} SELECT {_summary('sent')}",
    "entity_coverage": f"""WITH {_NER} SELECT round(avg(CASE WHEN n_entities > 0 THEN 1.0 ELSE 0.0 END), 10) AS coverage,
        CAST(sum(n_entities) AS BIGINT) AS total_entities, {_summary('ner')}""",
    "label_counts": f"WITH {_sentiment()} SELECT label, count(*) AS n FROM sent GROUP BY label",
    "summary_long_form": f"WITH {_sentiment()} {_metrics('sent', True)}",
    "truth_pairs": f"{_PAIRS} SELECT * FROM pairs",
    "reliability_table": f"{_PAIRS}, {_reliability(10)} SELECT bin, round(mean_confidence, 10) AS mean_confidence, round(accuracy, 10) AS accuracy, n FROM rel",
    "reliability_of_pairs": f"{_PAIRS}, {_reliability(7)} SELECT bin, round(mean_confidence, 10) AS mean_confidence, round(accuracy, 10) AS accuracy, n FROM rel",
    "reliability_missing_labels": f"""{_PAIRS.replace('label = truth AS correct',
        "coalesce(CASE WHEN CAST(sent.id AS BIGINT) % 3 <> 0 THEN label END = truth, false) AS correct")},
        {_reliability(10)} SELECT bin, round(mean_confidence, 10) AS mean_confidence, round(accuracy, 10) AS accuracy, n FROM rel""",
    "calibration_error": f"""{_PAIRS}, {_reliability(10)} SELECT CAST(sum(n) AS BIGINT) AS n,
        round(sum(n * abs(mean_confidence - accuracy)) / sum(n), 10) AS ece FROM rel""",
    "text_length_drift": f"WITH {_numeric(_length_batches(_BY_LANGUAGE))} {_NUMERIC_ROW}",
    "text_length_drift_by_source": f"WITH {_numeric(_length_batches(_BY_SOURCE))} {_NUMERIC_ROW}",
    "numeric_drift": "WITH "
    + _numeric("SELECT CAST(l_extendedprice AS DOUBLE) AS value, l_returnflag = 'N' AS is_ref FROM lineitem")
    + f" {_NUMERIC_ROW}",
    "psi_labels": f"WITH {_sentiment()}, {_categorical(f'SELECT label AS category, {_BY_LANGUAGE} AS is_ref FROM sent')} SELECT round(psi, 6) AS psi FROM cat",
    "psi_languages": f"WITH {_categorical(f'SELECT lang AS category, {_BY_SOURCE} AS is_ref FROM ({_DOCS})')} SELECT round(psi, 6) AS psi FROM cat",
    "drift_report": _report(_BY_LANGUAGE),
    "drift_report_by_source": _report(_BY_SOURCE),
    "drift_against_profile": _report(_BY_LANGUAGE),
    "sketched_quantiles": """SELECT l_returnflag, count(*) AS n, CAST(decile AS INTEGER) AS decile, true AS within_error
        FROM lineitem CROSS JOIN range(1, 10) r(decile) GROUP BY l_returnflag, decile""",
    "sketched_drift": """SELECT count(*) FILTER (l_returnflag = 'N') AS n_ref, count(*) FILTER (l_returnflag <> 'N') AS n_new,
        true AS psi_close, true AS ks_close FROM lineitem""",
    "partition_overwrite": f"""WITH docs AS ({_DOCS}),
        parts(version, english, others, french, ingest_date) AS (VALUES
            (0, true, false, false, '{_DAY1}'), (1, true, false, false, '{_DAY1}'), (1, false, true, false, '{_DAY2}'),
            (2, false, false, true, '{_DAY1}'), (2, false, true, false, '{_DAY2}'),
            (3, false, false, true, '{_DAY1}'), (3, false, true, false, '{_DAY2}'), (3, true, false, false, '{_DAY3}'))
        SELECT version, 'documents' AS domain, ingest_date, {_COUNTS} FROM parts JOIN docs
            ON (english AND lang = 'en') OR (others AND lang <> 'en') OR (french AND lang = 'fr') GROUP BY version, ingest_date""",
    "retention": f"""WITH docs AS ({_DOCS}),
        parts(version, english, ingest_date) AS (VALUES (2, false, '{_DAY1}'), (3, false, '{_DAY1}'), (3, true, '{_DAY2}'))
        SELECT version, 'documents' AS domain, ingest_date, {_COUNTS}, 2 AS n_removed
        FROM parts JOIN docs ON english = (lang = 'en') GROUP BY version, ingest_date""",
    "metrics_by_version": f"""WITH {_sentiment()}, {_sentiment(_CONVERSATIONS, 'conv')}, {_sentiment(_BENCHMARK, 'bench')},
        d AS ({_metrics('sent', True)}), b AS ({_metrics('bench', True)}), c AS ({_metrics('conv', True)})
        SELECT 0 AS version, 'overwrite_partition' AS mode, metric, value FROM d
        UNION ALL SELECT 1, 'overwrite_partition', metric, value FROM b
        UNION ALL SELECT 2, 'overwrite_partition', metric, value FROM d
        UNION ALL SELECT 3, 'overwrite_partition', metric, value FROM c""",
    "domain_run_quarantine": f"""WITH {_sentiment()} SELECT CAST(CASE WHEN label = 'NEG' THEN 512 ELSE 0 END AS BIGINT) AS broken_rules,
        label, confidence < 0.85 AS low_confidence, count(*) AS n FROM sent GROUP BY ALL""",
    "versioned_append": f"WITH {_sentiment()}, {_stored(_DAY1, _DAY2)} SELECT domain, ingest_date, {_COUNTS} FROM stored GROUP BY domain, ingest_date",
    "versioned_overwrite": f"""WITH docs AS ({_DOCS}),
        parts(version, english, ingest_date) AS (VALUES (0, true, '{_DAY1}'), (1, true, '{_DAY1}'), (1, false, '{_DAY2}'),
            (2, false, '{_DAY3}'), (3, false, '{_DAY3}'), (3, true, '{_DAY3}'))
        SELECT version, 'documents' AS domain, ingest_date, {_COUNTS}
        FROM parts JOIN docs ON english = (lang = 'en') GROUP BY version, ingest_date""",
    "time_travel_v0": f"WITH {_sentiment()} SELECT id, label, confidence, '{_DAY1}' AS ingest_date FROM sent WHERE lang = 'en'",
    "partition_read": f"WITH {_sentiment()} SELECT label, count(*) AS n FROM sent WHERE lang <> 'en' GROUP BY label",
    "history": """SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS version, 'append' AS mode, count(*) AS n_rows
        FROM documents GROUP BY 1""",
    "domain_run_report": f"""WITH {_sentiment()}, m AS ({_metrics('sent', True)})
        SELECT 'documents' AS domain, 'sentiment' AS task, metric, value FROM m""",
    "multi_domain_report": f"""WITH {_NER}, {_sentiment(_CONVERSATIONS, 'conv')}, {_sentiment(_BENCHMARK, 'bench')},
        m AS ({_metrics('ner', False)}), c AS ({_metrics('conv', True)}), b AS ({_metrics('bench', True)})
        SELECT 'documents' AS domain, 'ner' AS task, metric, value FROM m
        UNION ALL SELECT 'conversations', 'sentiment', metric, value FROM c
        UNION ALL SELECT 'benchmark', 'sentiment', metric, value FROM b""",
}
