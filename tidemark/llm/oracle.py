"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

URL_REPUTATION = r"""
WITH parsed AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), marks AS (
    SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good
    FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id
), known AS (
    SELECT page_id, min(good) AS good
    FROM parsed JOIN marks
      ON doc_id = try_cast(regexp_extract(path, '/([0-9]{1,18})', 1) AS BIGINT)
    GROUP BY page_id
), counted AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k
    FROM parsed LEFT JOIN known USING (page_id) GROUP BY host
), named AS (
    SELECT *, string_split(host, '.') AS parts,
           array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two
    FROM counted
), hosts AS (
    SELECT host, n, k,
           CASE WHEN two IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br')
                THEN array_to_string(list_slice(parts, -3, -1), '.') ELSE two END AS domain,
           CASE WHEN two IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br')
                THEN two ELSE parts[-1] END AS suffix
    FROM named
), domains AS (
    SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL
), levels AS (
    SELECT 1 AS level, n, k FROM suffixes UNION ALL
    SELECT 2, n, k FROM domains UNION ALL
    SELECT 3, n, k FROM hosts
), sums AS (
    SELECT level, count(*)::DOUBLE AS g, sum(n)::DOUBLE AS r, sum(k)::DOUBLE AS good,
           sum(n * n)::DOUBLE AS squares, sum(k::DOUBLE * k / n) AS shares
    FROM levels WHERE n > 0 GROUP BY level
), spread AS (
    SELECT level, g, r, (shares - good * good / r) / (g - 1) AS b, (good - shares) / (r - g) AS w,
           (r - squares / r) / (g - 1) AS size
    FROM sums WHERE g >= 2 AND r > g
), fitted AS (
    SELECT level, CASE WHEN b + (size - 1) * w <= 0 THEN 10.0
                       WHEN b <= w THEN 1e4
                       ELSE least(1e4, greatest(1.0, (b + (size - 1) * w) / (b - w) - 1)) END AS s
    FROM spread
), weight AS (
    SELECT coalesce(max(s) FILTER (level = 1), 10.0) AS s1,
           coalesce(max(s) FILTER (level = 2), 10.0) AS s2,
           coalesce(max(s) FILTER (level = 3), 10.0) AS s3
    FROM fitted
), share AS (
    SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM suffixes
), up AS (
    SELECT suffix, (k + s1 * m) / (n + s1) AS up FROM suffixes, weight, share
), mid AS (
    SELECT suffix, domain, (k + s2 * up) / (n + s2) AS mid
    FROM domains JOIN up USING (suffix), weight
), judged AS (
    SELECT host, (k + s3 * mid) / (n + s3) AS mean, n + s3 + 1 AS worth
    FROM hosts JOIN mid USING (suffix, domain), weight
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
             AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
             AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
        END AS rule
    FROM parsed
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN mean - 1.645 * sqrt(mean * (1 - mean) / worth) >= 0.5 THEN 'allow'
            ELSE 'block' END AS verdict
FROM ruled JOIN judged USING (host)
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, coalesce('=' || source, '') AS name, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sources AS (
    SELECT name, source, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL
), ranked AS (
    SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w,
           row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
    FROM sources
), levels AS (
    SELECT *, 2 * source_size AS cap,
           row_number() OVER (ORDER BY 2 * source_size / w, place) AS turn,
           (sum(source_size) OVER ()::DOUBLE * 1.5
            - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(w) OVER (ORDER BY 2 * source_size / w, place
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM ranked
), opened AS (
    SELECT min(turn) AS first_turn, min_by(level, turn) AS level FROM levels WHERE level * w <= cap
), targets AS (
    SELECT l.name, l.source_size,
           CASE WHEN first_turn IS NULL OR turn < first_turn THEN cap::DOUBLE
                ELSE o.level * w END AS target
    FROM levels l, opened o
), expected AS (
    SELECT doc_id, name, size, source_size, target, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS salt,
           CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216 + 0.5)::BIGINT
                ELSE 0 END AS e,
           ('0x' || substr(md5('mix:' || name), 1, 6))::BIGINT AS start
    FROM sized JOIN targets USING (name)
), summed AS (
    SELECT *, start + sum(e) OVER (PARTITION BY name ORDER BY size, salt, doc_id NULLS FIRST
                                   ROWS UNBOUNDED PRECEDING) AS upto
    FROM expected
)
SELECT doc_id, size, source_size, target,
       ((upto // 16777216 - (upto - e) // 16777216) * size)::BIGINT AS taken
FROM summed
"""

EXACT_DUPLICATES = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
"""

RANKED = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, doc_id, text FROM documents
), doc_terms AS (
    SELECT doc, doc_id, term, count(*) AS tf FROM (
        SELECT doc, doc_id, unnest(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
    GROUP BY ALL
), items AS (
    SELECT row_number() OVER () AS item, item_id, text FROM benchmark
), item_terms AS (
    SELECT item, item_id, term, count(*) AS repeats FROM (
        SELECT item, item_id, unnest(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items)
    GROUP BY ALL
), lengths AS (
    SELECT doc, sum(tf)::BIGINT AS n FROM doc_terms GROUP BY doc
), sizes AS (
    SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM lengths
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM doc_terms, sizes WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs
), lengthened AS (
    SELECT doc, 100 - 25 + ((25 * n * n_docs) // total) AS m FROM lengths, sizes
), scores AS (
    SELECT item, item_id, doc, doc_id,
           sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM item_terms JOIN doc_terms USING (term) JOIN weights USING (term) JOIN lengthened USING (doc)
    GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank,
       doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

# crc32 has no function: eight shifts for each digit of the decimal id.
PREFIXES = r"""
WITH digits AS (
    SELECT DISTINCT conv_id, list_transform(range(1, len(conv_id::VARCHAR) + 1),
               lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::UBIGINT) AS codes
    FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::UBIGINT, codes),
               lambda crc, code: list_reduce(
                   list_prepend(xor(crc, code), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
                   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT)
                                     ELSE c >> 1 END)), 4294967295::UBIGINT) % 9 AS h
    FROM digits
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(
               strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
               || coalesce(text, '')), 1, 32), strlen(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
    SELECT c.conv_id, t.place, role, text FROM hashed c
    JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.place <= h
    UNION ALL
    SELECT c.conv_id, t.place, role, text FROM hashed c
    JOIN turns t ON t.conv_id = c.conv_id AND t.place > h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, role, text
    FROM rebuilt
), steps AS (
    SELECT conv_id, depth, strlen(text) AS n_bytes,
           string_agg(sha256(strlen(role)::VARCHAR || ':' || role || text), '')
               OVER (PARTITION BY conv_id ORDER BY depth) AS path
    FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM hashed
), ended AS (
    SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM steps
), nodes AS (
    SELECT path, depth, any_value(n_bytes) AS n_bytes, min(conv_id) AS conv_id,
           count(*) AS n_convs, coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ','
               ORDER BY conv_id), '') AS ids
    FROM ended GROUP BY path, depth
), tree AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes c
            WHERE c.depth = n.depth + 1 AND left(c.path, len(n.path)) = n.path) AS n_children
    FROM nodes n LEFT JOIN nodes p
      ON p.depth = n.depth - 1 AND p.path = left(n.path, len(n.path) - 64)
), below AS (
    SELECT DISTINCT a.path AS top, b.path FROM steps a
    JOIN steps b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), subtrees AS (
    SELECT top, sum((t.n_children = 0)::BIGINT)::BIGINT AS n_leaves,
           sum((t.n_convs - 1) * t.n_bytes)::BIGINT AS saved_tokens
    FROM below JOIN tree t ON t.path = below.path GROUP BY top
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       sha256(ids) AS ends_sha256
FROM tree JOIN subtrees ON top = path
"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_reputation": URL_REPUTATION,
    "op10_mixing": MIXING,
    "op11_exact_duplicates": EXACT_DUPLICATES,
    "op12_ranked_search": RANKED,
    "op13_prefix_trie": PREFIXES,
}
