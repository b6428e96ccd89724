"""SQL of the operators that SQL can express, for an engine of its own to check them."""

from __future__ import annotations

LINE_DEDUP = """
WITH pages AS (SELECT row_number() OVER () AS place, * FROM documents),
lines AS (SELECT place, source, unnest(string_split(text, chr(10))) AS line FROM pages),
counts AS (SELECT source, line, count(DISTINCT place) AS pages FROM lines WHERE trim(line, ' ') <> '' GROUP BY ALL),
hosts AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
flagged AS (
    SELECT counts.source, list(line) AS lines
    FROM counts JOIN hosts ON counts.source IS NOT DISTINCT FROM hosts.source
    WHERE pages >= 4 AND pages > 0.1 * host_pages GROUP BY counts.source
),
cut AS (
    SELECT pages.*, string_split(text, chr(10)) AS given,
        list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(lines, []), x)) AS kept
    FROM pages LEFT JOIN flagged ON pages.source IS NOT DISTINCT FROM flagged.source
)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text, source,
    CAST(coalesce(len(given) - len(kept), 0) AS INTEGER) AS lines_dropped
FROM cut
"""

# The CRC-32 goes byte by byte, with the 256 steps made from the polynomial.
SHARDING = """
WITH steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
),
bytes AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS digits
    FROM documents
),
sized AS (
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce(
            list_concat([4294967295], list_transform(range(size - 1), lambda i:
                16 * (strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
            lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
    FROM bytes, steps
),
running AS (
    SELECT *, sum(size) OVER in_order - size AS before_it, sum(size) OVER () AS total, row_number() OVER in_order AS place
    FROM sized WINDOW in_order AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)
),
placed AS (SELECT *, CAST(least(15, ((2 * before_it + size) * 16) // (2 * total)) AS INTEGER) AS shard FROM running)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
    CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

# Shares are found in rounds; two passes in an order drawn from id and text, cut at the target.
MIXING = r"""
WITH RECURSIVE sized AS (
    SELECT row_number() OVER () AS place, doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS mark
    FROM documents
),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight FROM totals
),
rounds AS (
    SELECT 0 AS round, source, source_size, weight, FALSE AS full_up, 0.0::DOUBLE AS level FROM weighed
    UNION ALL
    SELECT round + 1, source, source_size, weight, 2 * source_size / weight <= next, next FROM (
        SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) FILTER (full_up) OVER (), 0))
            / sum(weight) FILTER (NOT full_up) OVER () AS next
        FROM rounds
    ) WHERE round < 100 AND next > level
),
sources AS (
    SELECT source, source_size, least(max(level) * weight, 2 * source_size) AS target
    FROM rounds GROUP BY source, source_size, weight
),
drawn AS (
    SELECT place, CAST(round(target) AS BIGINT) AS words, size, pass * source_size + sum(size) OVER (
        PARTITION BY sized.source, pass ORDER BY md5(pass || ':' || mark), place ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source, unnest([0, 1]) AS passes(pass)
),
takes AS (SELECT place, CAST(sum(greatest(0, least(start + size, words) - start)) AS BIGINT) AS taken FROM drawn GROUP BY place)
SELECT doc_id, size, source_size, target, taken
FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source JOIN takes USING (place)
"""

# Every prefix of every rebuilt conversation as a list of turns; equal prefixes are one node.
TURN_TRIE = """
WITH steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
forks AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x))),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
    FROM ids, steps
),
given AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id
),
rebuilt AS (
    SELECT f.conv_id, CASE WHEN f.conv_id = f.base THEN own.turns
        ELSE list_concat(coalesce(base.turns[1:h], []), own.turns[h + 1:]) END AS turns
    FROM forks AS f JOIN given AS own USING (conv_id) LEFT JOIN given AS base ON base.conv_id = f.base
),
prefixes AS (
    SELECT conv_id, d AS depth, turns[1:d] AS turns, d = len(turns) AS ended
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT depth, turns, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(octet_length(encode(turns[depth].text)), 0) AS bytes,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, turns
),
children AS (
    SELECT p.depth, p.turns, count(*) AS n_children
    FROM nodes AS p JOIN nodes AS c ON c.depth = p.depth + 1 AND c.turns[1:c.depth - 1] = p.turns GROUP BY ALL
),
below AS (
    SELECT up AS depth, turns[1:up] AS turns, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (leaf) AS leaves
    FROM (
        SELECT n.*, n_children IS NULL AS leaf, unnest(range(n.depth + 1)) AS up
        FROM nodes AS n LEFT JOIN children AS c ON c.depth = n.depth AND c.turns = n.turns
    ) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
    leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes AS n
JOIN below AS b ON b.depth = n.depth AND b.turns = n.turns
LEFT JOIN children AS c ON c.depth = n.depth AND c.turns = n.turns
LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.turns = n.turns[1:n.depth - 1]
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
        CAST(list_inner_product(a.parts, r.parts) AS BIGINT) AS score
    FROM vectors AS a JOIN vectors AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.parts) = len(r.parts)
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
    score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


def build_oracle() -> dict[str, str]:
    return {
        "op4_sharding": SHARDING,
        "op10_line_dedup": LINE_DEDUP,
        "op11_turn_trie": TURN_TRIE,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_mixing": MIXING,
    }
