"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

OP2 = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, url, body, sha1(body) AS hexed, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, url, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(hexed, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least.component_id, v.vec_id = least.component_id AS kept
FROM v JOIN least ON least.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

OP9 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '(null)') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM w),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS k FROM places),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM windows, (SELECT unnest(range(0, 5)) AS j) WHERE k > 1 GROUP BY doc_id),
base AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words
         FROM w LEFT JOIN covered USING (doc_id)),
line AS (SELECT doc_id, host, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS size
         FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
common AS (SELECT host, norm FROM line GROUP BY host, norm HAVING count(DISTINCT doc_id) > 50),
gone AS (SELECT doc_id, sum(size)::BIGINT AS removed FROM line JOIN common USING (host, norm) GROUP BY doc_id),
judged AS (SELECT base.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce(removed, 0)::BIGINT AS removed_chars
           FROM base LEFT JOIN gone USING (doc_id))
SELECT *, NOT base_failed AND word_chars - removed_chars >= 0.3::DOUBLE * word_chars AS kept FROM judged
"""

OP11 = r"""
WITH term_rows AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM term_rows GROUP BY doc_id, term),
doc AS (SELECT doc_id, count(*) AS n FROM term_rows GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_all FROM doc),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, n_docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_all)))))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN doc USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

OP12 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes FROM documents),
strings AS (SELECT doc_id, i, substr(h, (2 * i + 1)::BIGINT, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 49)) AS i FROM d WHERE n_bytes >= 50)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM strings) WHERE least < doc_id),
heads AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS head FROM hits),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS z FROM (SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM heads) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM (SELECT doc_id, a, z FROM runs UNION ALL SELECT doc_id, -1, 0 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, (2 * (coalesce(z, n_bytes) - a))::BIGINT), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def sql() -> dict[str, str]:
    return {"op2_warc": OP2, "op4_embedding_join": OP4, "op9_line_rules": OP9, "op11_lexical_search": OP11, "op12_cut_repeats": OP12}
