"""SQL (DuckDB) that says the same as some of the queries, by brute force."""

from __future__ import annotations

WORDS = r"w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents), x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w)"


def runs(size: int) -> str:
    """Windows of words as lists of text, with their place."""
    return f"SELECT doc_id, pos, string_agg(word, ' ') OVER o AS run, count(*) OVER o AS n FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"


OP10 = f"""WITH {WORDS}, r AS (SELECT doc_id, pos, run FROM ({runs(13)}) WHERE n = 13),
f AS (SELECT run, min(doc_id) AS first FROM r GROUP BY run),
g AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r JOIN f USING (run), range(13) t(k) WHERE doc_id > first),
k AS (SELECT x.doc_id, count(g.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE g.pos IS NULL) AS kept FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.pos = x.pos GROUP BY x.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

#: All pairs with a shingle in common; classes by walking the links.
OP3 = f"""WITH RECURSIVE {WORDS}, s AS (SELECT DISTINCT doc_id, run FROM ({runs(5)}) WHERE n = 5 UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT w.doc_id, count(run) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b, common = x.n AND common = y.n AS same FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9
      UNION ALL SELECT x.doc_id, y.doc_id, true FROM n x JOIN n y ON x.n = 0 AND y.n = 0 AND x.doc_id <> y.doc_id),
t AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b),
i AS (SELECT doc_id, least(doc_id, min(b)) AS set_id FROM w LEFT JOIN l ON a = doc_id AND same GROUP BY doc_id)
SELECT i.doc_id, i.set_id, (SELECT min(b) FROM t WHERE a = i.doc_id) AS class_id, count(l.b) AS n_links, count(DISTINCT j.set_id) FILTER (WHERE NOT same) AS n_set_links
FROM i LEFT JOIN l ON l.a = i.doc_id LEFT JOIN (SELECT doc_id AS d, set_id FROM i) j ON j.d = l.b GROUP BY i.doc_id, i.set_id"""

_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::BIGINT >> {shift}) & 31)::INTEGER + 1, 1)" for k in range(8) for shift in (15, 10, 5, 0))
OP2 = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages), f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, {_DIGITS} AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to, url FROM p JOIN f USING (html)"""

ORACLE_SQL = {"op2_warc": OP2, "op3_jaccard": OP3, "op10_substrings": OP10}
