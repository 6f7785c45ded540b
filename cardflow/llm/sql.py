"""DuckDB SQL of the queries that plain SQL can express, over the registered views."""

SQL = {
    "op5_url_filter": """
        WITH p AS (
            SELECT page_id, html,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages
        ), l AS (
            SELECT *, bool_or(coalesce(regexp_matches(host, '(^|\\.)spam') OR length(html) < 1000, false))
                      OVER (PARTITION BY host || path) AS listed
            FROM p
        ), r AS (
            SELECT *, CASE
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
                END AS rule
            FROM l
        )
        SELECT page_id, host, path, rule, listed,
               CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
                    WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
        FROM r
    """,
    "op9_exact_dedup": """
        WITH n AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS same
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(same) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY same)
    """,
    "op11_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), tokens AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces
        ), grams AS (
            SELECT lang, 1 AS k, unnest(list_transform(range(1, len(ws) - 1 + 2), lambda i: ws[i])) AS phrase FROM tokens
            UNION ALL
            SELECT lang, 2 AS k, unnest(list_transform(range(1, len(ws) - 2 + 2), lambda i: ws[i] || ' ' || ws[i + 1])) AS phrase FROM tokens
            UNION ALL
            SELECT lang, 3 AS k, unnest(list_transform(range(1, len(ws) - 3 + 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS phrase FROM tokens
        ), f AS MATERIALIZED (
            SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL
        ), total AS (
            SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), cand AS MATERIALIZED (
            SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10
        ), parts AS (
            SELECT lang, k, phrase, a, 1 AS cut, ws[1] AS first, array_to_string(ws[2:k], ' ') AS rest FROM cand
            UNION ALL
            SELECT lang, k, phrase, a, 2, array_to_string(ws[1:2], ' '), ws[3] FROM cand WHERE k = 3
        ), cuts AS (
            SELECT p.lang, p.phrase, p.k, p.a, p.cut, l.n AS l, r.n AS r,
                   (1000000::HUGEINT * p.a * p.a) // (l.n::HUGEINT * r.n) AS score
            FROM parts p
            JOIN f l ON l.lang = p.lang AND l.phrase = p.first
            JOIN f r ON r.lang = p.lang AND r.phrase = p.rest
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), around AS (
            SELECT lang, phrase, max(a) AS a FROM (
                SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
                UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM cand WHERE k = 3
            ) GROUP BY ALL
        ), kept AS (
            SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase AND b.k = 2
            WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
        )
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, total.n AS n, score::BIGINT AS score
        FROM kept JOIN total ON total.lang = kept.lang
        QUALIFY rank <= 2000
    """,
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
                   list_dot_product(a.v, r.v)::BIGINT AS score
            FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
             AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
        QUALIFY rank <= 10
    """,
}
