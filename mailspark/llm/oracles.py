"""SQL whose rows the queries must give, where SQL can express them."""

_SPACED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _urls(rounds: int, damping: float, threshold: float) -> str:
    """Ranks step by step, each step a table of its own."""
    low = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    link = r"""(?:href|src|HREF|SRC)\s*=\s*["'']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"''\s<>]+)"""
    steps = "".join(
        f""",
        r{i + 1} AS (SELECT kind, host, sum(s) AS s FROM (
            SELECT kind, host, s FROM r0 UNION ALL
            SELECT kind, b AS host, s * w AS s FROM r{i} JOIN ways USING (kind, host)) GROUP BY ALL)"""
        for i in range(rounds)
    )
    return f"""
        WITH p AS (SELECT page_id, html,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {low}) AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        q AS (SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM p),
        v AS (SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
                             WHEN rule IS NOT NULL THEN 'block' END AS verdict FROM q),
        e AS (SELECT a, b, count(*) AS n FROM (
                SELECT host AS a, translate(regexp_replace(b, '^.*@|:[0-9]*$', '', 'g'), {low}) AS b
                FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS b FROM v))
              WHERE a <> '' AND b <> '' AND a <> b GROUP BY ALL),
        ways AS (SELECT kind, host, b, n / sum(n) OVER (PARTITION BY kind, host) * {damping} AS w
                 FROM (SELECT 't' AS kind, a AS host, b, n FROM e UNION ALL SELECT 'd', b, a, n FROM e)),
        seeds AS (SELECT host, avg((coalesce(verdict, '') = 'allow')::INT) AS allowed,
                         avg((coalesce(verdict, '') = 'block')::INT) AS blocked FROM v WHERE host <> '' GROUP BY 1),
        r0 AS (SELECT 't' AS kind, host, allowed * (1 - {damping}) AS s FROM seeds WHERE allowed > 0 UNION ALL
               SELECT 'd', host, blocked * (1 - {damping}) FROM seeds WHERE blocked > 0){steps},
        bad AS (SELECT host FROM (
                    SELECT host, coalesce(sum(s) FILTER (kind = 't'), 0) AS t, coalesce(sum(s) FILTER (kind = 'd'), 0) AS d
                    FROM r{rounds} GROUP BY 1)
                WHERE d / (1 - {damping}) >= {threshold} AND d > t)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block'
                                                                 ELSE 'allow' END) AS verdict
        FROM v"""


ORACLES: dict[str, str] = {
    "op3_urls": _urls(rounds=8, damping=0.85, threshold=0.5),
    "op7_exact": f"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_SPACED} AS t FROM documents)
        WINDOW same AS (PARTITION BY t)""",
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY t) END AS keep FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, sha1(t) AS payload_digest,
               CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keep <> page_id THEN keep END AS refers_to
        FROM q""",
    "op10_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        g AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
              FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
                    FROM (SELECT *, least(len(w), 10) AS k FROM b WHERE len(w) > 0))),
        h AS (SELECT * FROM (
                SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
                FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
                      FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k))
              WHERE (k, gram) IN (SELECT (k, gram) FROM g)),
        c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
        n AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h JOIN g USING (k, gram)) GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit,
               coalesce(n.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(c.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op13_filters": r"""
        WITH d AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w
                   FROM (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents)),
        f AS (SELECT doc_id, part, [
                CASE WHEN len(w) < 200 THEN 'A' END,
                CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END] AS fails FROM d),
        g AS (SELECT part, [x FOR x IN fails IF x IS NOT NULL] AS fails, coalesce(good, false) AS good,
                     coalesce(toxic, false) AS toxic
              FROM f LEFT JOIN (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good,
                                       bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1) USING (doc_id)),
        h AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM g GROUP BY ALL),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT o, i AS step, o[i] AS own, o[1:i - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS i)),
        r AS (SELECT part, array_to_string(o, '') AS filter_order, step, own,
                sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, own)) AS kept,
                sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, own)) AS removed,
                sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, own)) AS redundant,
                sum(n) FILTER (fails = [own]) AS unique_fails,
                sum(good) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, own)) AS good_lost,
                sum(toxic) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, own)) AS toxic_lost
              FROM h, s GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
        FROM r""",
    "op11_phrases": r"""
        WITH p AS (SELECT lang, row_number() OVER () AS piece, piece AS t
                   FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        w AS (SELECT lang, piece, unnest(x) AS w, generate_subscripts(x, 1) AS i
              FROM (SELECT lang, piece, regexp_extract_all(t, '[^\x20\x09]+') AS x FROM p)),
        g AS (SELECT lang, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
        f1 AS (SELECT lang, a, count(*) AS f FROM g GROUP BY ALL),
        f2 AS (SELECT lang, a, b, count(*) AS f FROM g WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (SELECT lang, a, b, c, count(*) AS f FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        cuts AS (
            SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, 1 AS k, l.f AS l, r.f AS r
            FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.a = f2.a JOIN f1 r ON r.lang = f2.lang AND r.a = f2.b
            WHERE coalesce(100 * greatest((SELECT max(f) FROM f3 WHERE f3.lang = f2.lang AND f3.a = f2.a AND f3.b = f2.b),
                                          (SELECT max(f) FROM f3 WHERE f3.lang = f2.lang AND f3.b = f2.a AND f3.c = f2.b)), 0) < 50 * f2.f
            UNION ALL
            SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 1, l.f, r.f
            FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.a = f3.a JOIN f2 r ON r.lang = f3.lang AND r.a = f3.b AND r.b = f3.c
            UNION ALL
            SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, l.f, r.f
            FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.a = f3.a AND l.b = f3.b JOIN f1 r ON r.lang = f3.lang AND r.a = f3.c),
        s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY 1)
        SELECT * FROM (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank,
                              phrase, a, l, r, n.n, score FROM b JOIN n USING (lang))
        WHERE rank <= 2000""",
    "op12_topk": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, p.vec_id, list_inner_product(q.x::DOUBLE[], p.x::DOUBLE[])::BIGINT AS score
              FROM v q, v p WHERE q.vec_id % 50 = 0 AND p.r <> q.r),
        k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM k WHERE rank <= 5""",
}
