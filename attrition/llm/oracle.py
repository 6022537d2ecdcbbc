"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """The list of words of a text column, ASCII letters lower-cased."""
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+')"

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: str) -> str:
    """The list of search terms of a text column."""
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_TERMS}')"


def components(n: int, percent: int, columns: str) -> str:
    """Components of documents whose sets of n-word shingles have at least this similarity, by all pairs that share one."""
    return f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, {words("text")} AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + least({n}, len(w)) - 1), ' ')) AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - least({n}, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= {percent} * (any_value(na.n) + any_value(nb.n) - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
        )
        SELECT {columns}
        FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS r ON r.a = d.doc_id
    """


SQL = {
    "op3_decontamination": f"""
        WITH items AS (
            SELECT item_id, {words("text")} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), item_sh AS (
            SELECT DISTINCT item_id, least(5, len(w)) AS n, list_slice(w, i, i + least(5, len(w)) - 1) AS s
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
        ), sizes AS (
            SELECT item_id, count(*) AS n_shingles FROM item_sh GROUP BY item_id
        ), docs AS (
            SELECT doc_id, {words("text")} AS w FROM documents
        ), lengths AS (
            SELECT DISTINCT n FROM item_sh
        ), doc_sh AS (
            SELECT DISTINCT doc_id, n, list_slice(w, i, i + n - 1) AS s
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
        )
        SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles,
               count(*) / any_value(n_shingles) AS containment
        FROM doc_sh JOIN item_sh USING (n, s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id
        HAVING 10 * count(*) >= 8 * any_value(n_shingles)
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
        ), g AS (
            SELECT html, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY html
        )
        SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN g.keep <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN g.keep <> p.page_id THEN g.keep END AS refers_to
        FROM p LEFT JOIN g ON g.html = p.html
    """,
    "op6_near_duplicates": components(4, 80, "d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept"),
    "op11_ngram_join": components(3, 90, "d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id"),
    "op12_ranked_search": f"""
        WITH t AS (
            SELECT doc_id, unnest({terms("text")}) AS term FROM documents
        ), d AS (
            SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id
        ), c AS (
            SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d
        ), tf AS (
            SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, c GROUP BY term, n_docs
        ), q AS (
            SELECT item_id, term, count(*) AS repeats
            FROM (SELECT item_id, unnest({terms("text")}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY item_id, term
        ), scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (doc_id), c
            GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 10
    """,
}
