"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUP = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM worded
), classes AS (
    SELECT min(doc_id) AS c, list_sort(s) AS o, len(list_sort(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), shingles AS (
    SELECT c, n, unnest(o) AS g FROM classes
), links AS (
    SELECT x.c AS a, y.c AS b FROM shingles x JOIN shingles y ON x.g = y.g AND x.c <> y.c
    GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reached AS (
    SELECT c AS a, c AS b FROM classes
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (
    SELECT a, min(b) AS root FROM reached GROUP BY a
), named AS (
    SELECT o, root FROM classes JOIN roots ON a = c
)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(root, doc_id) AS component_id,
    doc_id = coalesce(root, doc_id) AS kept
FROM sets LEFT JOIN named ON list_sort(sets.s) = named.o
"""

TOP_K = """
WITH scaled AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM scaled q JOIN scaled c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
"""


def _mixing(sweeps: int = 8) -> str:  # so many it takes at sf0.01
    columns = {"source": 0.7, "lang": 0.7, "topic": 0.9}
    steps = [
        rf"""rows_ AS MATERIALIZED (
    SELECT doc_id, source, lang, CASE WHEN regexp_matches(t, '^[ \t\r\n]*$') THEN 'empty'
        WHEN regexp_matches(t, '[Ll]icen[cs]e') THEN 'licence'
        WHEN regexp_matches(t, '(token|password|secret|key) *[=:]') THEN 'credentials'
        WHEN regexp_matches(t, '!!') THEN 'shouting' WHEN regexp_matches(t, ' \| ') THEN 'table'
        WHEN regexp_matches(t, '###|%%%|&&&') THEN 'junk' ELSE 'prose' END AS topic,
        len(regexp_extract_all(t, '[^ \t\r\n]+')) AS n_tokens
    FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS f FROM rows_ GROUP BY ALL)"""
    ]
    for name, exponent in columns.items():
        steps.append(
            f"""t_{name} AS MATERIALIZED (SELECT {name} AS v, pow(sum(tokens), {exponent}) / sum(pow(sum(tokens), {exponent})) OVER ()
    AS share FROM c0 GROUP BY {name} HAVING sum(tokens) > 0)"""
        )
    last = "c0"
    for sweep in range(sweeps):
        for name in columns:
            new = f"c{sweep}_{name}"
            steps.append(
                f"""{new} AS MATERIALIZED (SELECT source, lang, topic, tokens,
    f * coalesce((SELECT share FROM t_{name} WHERE v IS NOT DISTINCT FROM {name})
        / nullif(sum(tokens * f) OVER (PARTITION BY {name}), 0), 0) AS f FROM {last})"""
            )
            last = new
    return f"""WITH {", ".join(steps)},
scaled AS (SELECT *, round(least(1.0, f * (1 / (SELECT max(f) FROM {last} WHERE tokens > 0))), 9) AS p FROM {last})
SELECT doc_id, r.source, r.lang, r.topic, n_tokens::BIGINT AS n_tokens, p AS probability,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < p AS sampled
FROM rows_ r JOIN scaled s ON r.source IS NOT DISTINCT FROM s.source AND r.lang IS NOT DISTINCT FROM s.lang
    AND r.topic IS NOT DISTINCT FROM s.topic"""


def _part(at: int) -> str:
    return f"('0x' || substr(md5(name), {at}, 6))::BIGINT"


URL_LISTS = rf"""
WITH captures AS (
    SELECT page_id, url, DATE '2024-01-01' + (page_id % 730)::INTEGER AS day,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.*(?::[0-9]*)?(?:[/?#]|$)', 1)) AS host
    FROM pages
), names AS (
    SELECT host AS name FROM captures WHERE host <> ''
    UNION SELECT regexp_replace(host, '^[^.]+\.', '') FROM captures WHERE host <> ''
), chosen AS (
    SELECT name, ['adult', 'malware', 'spam', 'trusted'][1 + {_part(19)} % 4] AS list,
        DATE '2024-01-01' + ({_part(1)} % 730)::INTEGER AS add_day,
        (1 + {_part(7)} % 200)::INTEGER AS stay, {_part(7)} % 3 > 0 AS leaves,
        (1 + {_part(13)} % 100)::INTEGER AS pause, {_part(13)} % 2 = 0 AS returns
    FROM names WHERE {_part(25)} % 3 = 0
), valid AS (
    SELECT name, list, add_day AS since, CASE WHEN leaves THEN add_day + stay ELSE DATE '9999-01-01' END AS until FROM chosen
    UNION ALL
    SELECT name, list, add_day + stay + pause, DATE '9999-01-01' FROM chosen WHERE leaves AND returns
), active AS (
    SELECT c.host, c.day, v.name, v.list FROM (SELECT DISTINCT host, day FROM captures) c JOIN valid v
        ON (c.host = v.name OR (ends_with(c.host, '.' || v.name) AND NOT regexp_matches(c.host, '^[0-9.]+$')))
        AND c.day >= v.since AND c.day < v.until
), best AS (
    SELECT host, day, arg_max(name, length(name) * 2 + (list = 'trusted')::INTEGER) AS rule,
        arg_max(list, length(name) * 2 + (list = 'trusted')::INTEGER) <> 'trusted' AS blocked,
        string_agg(DISTINCT list, ',' ORDER BY list) AS lists
    FROM active GROUP BY host, day
)
SELECT page_id, url, strftime(c.day, '%Y-%m-%d') AS fetched_on, c.host, coalesce(blocked, false) AS blocked, rule,
    coalesce(lists, '') AS lists
FROM captures c LEFT JOIN best b ON c.host = b.host AND c.day = b.day
"""

FILTER_AUDIT = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
    SELECT t, min(doc_id) AS first FROM texts GROUP BY t
), worded AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts JOIN firsts USING (t)
), marked AS (
    SELECT part, doc_id, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > first THEN 16 ELSE 0 END)::INTEGER AS mask FROM worded
), rated AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM marked LEFT JOIN rated USING (doc_id) GROUP BY part, mask
), bits AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM bits a, bits b, bits c, bits d, bits e
    WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
    SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INTEGER AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS k)
), counted AS (
    SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (WHERE mask & (before + bit) = 0), 0) AS kept,
        coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS removed,
        coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0) AS redundant,
        coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
        coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
    toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""



def _codes(rounds: int = 6) -> str:
    steps = [
        """kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), seeds AS (
    SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id, min(v) AS v FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id)
    QUALIFY row_number() OVER (ORDER BY vec_id) <= 16
), cut AS MATERIALIZED (
    SELECT row, part, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] AS x FROM kept, (SELECT unnest(range(8)) AS part)
), book0 AS MATERIALIZED (
    SELECT part, entry, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] AS y FROM seeds, (SELECT unnest(range(8)) AS part)
)"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (
    SELECT row, part, x, entry, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT AS away
    FROM cut JOIN book{k} USING (part)
    QUALIFY row_number() OVER (PARTITION BY row, part ORDER BY away, entry) = 1
)"""
        )
        if k < rounds:
            steps.append(
                f"""mean{k} AS (
    SELECT part, entry, i, sum(xi)::BIGINT AS s, count(*)::BIGINT AS n
    FROM (SELECT part, entry, unnest(x) AS xi, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY part, entry, i
), book{k + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.y, b.y) AS y FROM book{k} b LEFT JOIN (
        SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM mean{k} GROUP BY part, entry
    ) m USING (part, entry)
)"""
            )
    return f"""WITH {", ".join(steps)}, named AS (
    SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
    SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(away)::BIGINT AS error FROM near{rounds} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), named"""


ORACLES = {
    "op1_mixed_sources": _mixing(),
    "op6_url_lists": URL_LISTS,
    "op8_exact_top_k": TOP_K,
    "op10_minhash_near_dedup": NEAR_DUP,
    "op12_vector_codes": _codes(),
    "op13_filter_interactions": FILTER_AUDIT,
}
