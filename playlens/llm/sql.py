"""SQL for the queries that SQL can express."""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_SAID = "'<|im_end|><|im_start|>assistant ok'"

QUERIES = {
    # A turn's marks are 12 + 1 + 10 + 1 characters around role and text; a text with marks has
    # two more for the sign of its role and one per control string.
    "op6_chat_round_trip": f"""
WITH said AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', {_SAID} UNION ALL SELECT -1, 1, 'assistant', {_SAID}),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM said),
shown AS (
    SELECT *, len(regexp_extract_all(text, '<\\|\\\\*(im_start|im_end)\\|>')) AS controls,
           regexp_matches(text, '<\\|(im_start|im_end)\\|>') AS marked FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(text)
                + CASE WHEN marked THEN 2 + controls ELSE 0 END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
""",
    "op9_ngram_decontamination": f"""
WITH item AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(len(ws), 13) AS n,
           array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS w
    FROM item, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS t(i) WHERE len(ws) > 0),
doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
    SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM doc, sizes, unnest(range(1, len(ws) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, i, places.n, item_id FROM places JOIN grams
         ON places.w = grams.w AND places.n = grams.n),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit
            FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
           GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op11_filter_audit": r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
least_of AS (SELECT t, min(doc_id) AS least FROM words GROUP BY t),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
          FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t)
                   THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS f
    FROM words JOIN least_of USING (t) LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
         FROM failed GROUP BY part, f),
letter(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS o
    FROM letter a JOIN letter b ON b.l <> a.l JOIN letter c ON c.l NOT IN (a.l, b.l)
    JOIN letter d ON d.l NOT IN (a.l, b.l, c.l) JOIN letter e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT o, CAST(i AS INT) AS step, substr(o, i, 1) AS l, substr(o, 1, i - 1) AS before
          FROM orders, range(1, 6) AS t(i)),
states AS (
    SELECT part, o, step, l, n, good, toxic, f, contains(f, l) AS fails,
           len(translate(f, before, '')) < len(f) AS earlier FROM steps, sets),
audited AS (
    SELECT part, o, step, l,
           sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN f = l THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
    FROM states GROUP BY ALL)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM audited
""",
    "op12_rns_hard_negatives": """
WITH rows AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
           CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (
           PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    # A base32 digit is five of the 160 bits of the digest.
    "op13_warc_normaliser": """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digested AS (
    SELECT page_id, body, octet_length(body) AS payload_bytes,
           CAST(unhex(sha1(body)) AS BIT)::VARCHAR AS bits FROM bodies)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j:
               CAST(substr(bits, 5 * i + j + 1, 1) AS INT) * (1 << (4 - j)::INT)))::INT, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM digested WINDOW same AS (PARTITION BY body)
""",
}
