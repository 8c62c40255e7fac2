"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

WARC = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM p WHERE octet_length(payload) >= 100 GROUP BY payload_digest
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items)
), sizes AS (SELECT DISTINCT n FROM win),
places AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), found AS (SELECT doc_id, i, n, item_id FROM places JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
    SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)
), both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, root) AS (SELECT x, x FROM both_ways UNION SELECT y, root FROM reach JOIN both_ways ON doc_id = x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c.root, doc_id) AS component_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

HARD_NEGATIVES = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
), scores AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _vector_codes() -> str:
    """Four rounds and a last assignment, one after the other."""
    steps = []
    for n in range(5):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT vec_id, label, part, arg_min(entry, (distance, entry)) AS entry, min(distance) AS distance, any_value(piece) AS piece
    FROM (SELECT v.vec_id, v.label, v.part, v.piece, c.entry,
                 list_sum(list_transform(list_zip(v.piece, c.piece), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
          FROM v JOIN c{n} c USING (part))
    GROUP BY vec_id, label, part
)""")
        if n < 4:
            steps.append(f"""m{n} AS (
    SELECT part, entry, list(mean ORDER BY place) AS piece FROM (
        SELECT part, entry, place, floor(sum(x) / count(*)::DOUBLE)::BIGINT AS mean
        FROM (SELECT part, entry, unnest(piece) AS x, generate_subscripts(piece, 1) AS place FROM a{n}) GROUP BY part, entry, place)
    GROUP BY part, entry
), c{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.piece, c.piece) AS piece FROM c{n} c LEFT JOIN m{n} m USING (part, entry))""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE {_USABLE}
), v AS MATERIALIZED (
    SELECT vec_id, label, part, list_slice(q, part * len(q) // 4 + 1, (part + 1) * len(q) // 4) AS piece
    FROM kept, range(4) parts(part)
), c0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, piece FROM v QUALIFY entry < 256
), {", ".join(steps)},
code AS (
    SELECT vec_id, label, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
    FROM a4 GROUP BY vec_id, label
)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(piece, ','), ',' ORDER BY part, entry)) FROM c4) AS codebooks_sha256
FROM code
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_benchmark_decontamination": CONTAMINATION, "op7_warc": WARC, "op9_ngram_jaccard_join": COMPONENTS,
            "op12_hard_negatives": HARD_NEGATIVES, "op13_vector_codes": _vector_codes()}
