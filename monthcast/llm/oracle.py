"""DuckDB SQL of the training-data queries that SQL can express: the plain
definition of each result over whole tables, independent of the methods used.

The other queries have none: their results depend on trained models, hashes,
samples, automata or file formats; tests hold them against brute force.
"""

OP2 = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM m"""

OP7 = r"""
WITH d AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
                        FROM documents),
     p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
     g AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
     f AS (SELECT h, min(doc_id) AS first_doc FROM g GROUP BY h),
     hit AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 50)) AS at FROM g JOIN f USING (h) WHERE g.doc_id > f.first_doc),
     word AS (SELECT doc_id, unnest(w) AS one, unnest(range(1, len(w) + 1)) AS at FROM d),
     kept AS (SELECT word.doc_id, count(*) AS n, string_agg(one, ' ' ORDER BY word.at) AS t
              FROM word ANTI JOIN hit ON word.doc_id = hit.doc_id AND word.at = hit.at GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

OP9 = r"""
WITH RECURSIVE
     d AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
     g AS MATERIALIZED (
         SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
         FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
     n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
     pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
              FROM g a JOIN g b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     link AS MATERIALIZED (SELECT u, v FROM pair JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
                           WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
     reach(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
     least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
     degree AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN least ON d.doc_id = least.u LEFT JOIN degree ON d.doc_id = degree.u"""

OP4 = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
     w AS (SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                                        lambda x: x <> '') AS w FROM t),
     size AS (SELECT DISTINCT least(len(w), 5) AS k FROM w WHERE kind = 'i' AND len(w) > 0),
     runs AS (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, size WHERE kind = 'd' AND len(w) >= k
              UNION ALL SELECT kind, id, w, least(len(w), 5), unnest(range(1, len(w) - least(len(w), 5) + 2)) FROM w WHERE kind = 'i' AND len(w) > 0),
     s AS MATERIALIZED (SELECT DISTINCT kind, id, array_to_string(w[i:i + k - 1], ' ') AS shingle FROM runs),
     n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id),
     hit AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
             FROM s d JOIN s i ON d.shingle = i.shingle WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM hit JOIN n ON n.id = hit.item_id WHERE 10 * n_shared >= 8 * n_item"""

def _crc(column: str) -> str:
    """The unsigned crc32 of a string's UTF-8 bytes; ``crc_table`` is joined."""
    byte = f"CAST('0x' || substr(hex(encode({column})), 2 * i - 1, 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode({column})) + 1), lambda i: {byte})), "
            "lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)")


CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""
WITH {CRC_TABLE},
     w AS MATERIALIZED (
         SELECT k, id, unnest(list_filter(regexp_split_to_array({LOWER.format('t')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS word
         FROM (SELECT 'd' AS k, doc_id AS id, coalesce(text, '') AS t FROM documents
               UNION ALL SELECT 'b', NULL, coalesce(text, '') FROM benchmark)),
     c AS MATERIALIZED (SELECT word, {_crc('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM w), crc_table),
     n AS (SELECT bucket, count(*) FILTER (k = 'd') AS s, count(*) FILTER (k = 'b') AS t FROM w JOIN c USING (word) GROUP BY bucket),
     a AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM n),
     g AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (s_all + 10000)
                                       / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain FROM n, a),
     f AS (SELECT id AS doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
           FROM w JOIN c USING (word) JOIN g USING (bucket) WHERE k = 'd' GROUP BY id),
     r AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features,
                  coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
                  CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h
           FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id),
     z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
     o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM z WHERE n_features >= 20)
SELECT z.doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 THEN place END AS rank
FROM z LEFT JOIN o ON z.doc_id = o.doc_id"""

OP12 = f"""
WITH RECURSIVE {CRC_TABLE},
     run AS (SELECT doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents WHERE text IS NOT NULL),
     per_doc AS MATERIALIZED (SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS key FROM run WHERE length(run) >= 7 GROUP BY doc_id, run),
     h AS (SELECT run, n, {_crc('key')} AS h FROM per_doc, crc_table),
     thin AS (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
     w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM thin WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
     p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
     less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM p),
     near AS MATERIALIZED (
         SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT l.word, l.n, w.word, w.n FROM less l JOIN w ON l.rest = w.word
         UNION SELECT w.word, w.n, l.word, l.n FROM less l JOIN w ON l.rest = w.word),
     best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM near GROUP BY word),
     pick AS (SELECT b.word, n_near, top, min(near) AS near FROM best b JOIN near ON near.word = b.word AND near_n = top GROUP BY 1, 2, 3),
     form AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN near END AS form,
                                  CASE WHEN top >= 10 * n THEN top END AS form_n FROM w LEFT JOIN pick ON w.word = pick.word),
     walk(word, "at", step) AS (SELECT word, word, 0 FROM form
                              UNION ALL SELECT walk.word, form.form, step + 1 FROM walk JOIN form ON walk."at" = form.word WHERE form.form IS NOT NULL),
     root AS (SELECT word, max_by("at", step) AS root FROM walk GROUP BY word)
SELECT form.word, n, n_near, form, form_n, root FROM form JOIN root ON form.word = root.word"""

ORACLES = {"op2_warc": OP2, "op4_decontamination": OP4, "op7_substring_dedup": OP7, "op9_ngram_join": OP9,
           "op11_importance_resampling": OP11, "op12_spelling_variants": OP12}
