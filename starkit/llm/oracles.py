"""DuckDB SQL with the results of the queries that SQL can express."""

from starkit.llm import hosts, nearest, phrases, substrings, trie

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_WINDOW = substrings.WINDOW

OP2 = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
starts AS (
    SELECT doc_id, ws, unnest(range(1, len(ws) - {_WINDOW} + 2)) AS i
    FROM docs WHERE len(ws) >= {_WINDOW}
),
windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + {_WINDOW - 1}], ' ') AS passage FROM starts
),
owners AS (SELECT passage, min(doc_id) AS owner FROM windows GROUP BY passage),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + {_WINDOW})) AS p
    FROM windows JOIN owners USING (passage) WHERE owner < doc_id
),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS text
    FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH docs AS (
    SELECT doc_id, source AS host, coalesce(text, '') AS t, {WORDS} AS ws,
        [line FOR line IN string_split(coalesce(text, ''), chr(10))
            IF regexp_matches(line, '[^\\x20\\x09-\\x0D]')] AS lines
    FROM documents
),
grams AS (
    SELECT doc_id, i, array_to_string(ws[i:i + {hosts.WINDOW - 1}], ' ') AS gram
    FROM (
        SELECT doc_id, ws, unnest(range(1, len(ws) - {hosts.WINDOW} + 2)) AS i
        FROM docs WHERE len(ws) >= {hosts.WINDOW}
    )
),
often AS (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + {hosts.WINDOW})) AS p
    FROM grams SEMI JOIN often USING (doc_id, gram)
),
repeats AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
measured AS (
    SELECT doc_id, host, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN repeats USING (doc_id)
),
rated AS (
    SELECT *, n_words < {hosts.MIN_WORDS}
        OR 100 * n_repeat_words > {hosts.REPEAT_PERCENT} * n_words AS base_failed
    FROM measured
),
host_rates AS (
    SELECT host, count(*) AS docs, count(*) FILTER (
        base_failed OR 100 * n_symbols > {hosts.SYMBOL_PERCENT} * n_words
        OR 100 * n_dup_lines > {hosts.DUPLICATE_LINE_PERCENT} * n_lines
    ) AS failed
    FROM rated WHERE host IS NOT NULL GROUP BY host
),
prior AS (
    SELECT avg(failed / docs) AS mean,
        CASE WHEN var_pop(failed / docs) > 0
            THEN avg(failed / docs) * (1 - avg(failed / docs)) / var_pop(failed / docs) - 1
            ELSE {hosts.MOST_STRENGTH} END AS raw
    FROM host_rates
),
bounded AS (
    SELECT mean, least(greatest(raw, {hosts.LEAST_STRENGTH}), {hosts.MOST_STRENGTH}) AS strength
    FROM prior
),
bad AS (
    SELECT host FROM host_rates, bounded
    WHERE (failed + mean * strength) / (docs + strength) > {hosts.HOST_LIMIT}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND (host IS NULL OR host NOT IN (SELECT host FROM bad)) AS kept
FROM rated
"""

OP10 = f"""
WITH vectors AS (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % {nearest.QUERY_STEP} = 0
)
SELECT query_id, CAST(row_number() OVER nearest AS INTEGER) AS rank, vec_id, score
FROM pairs
WINDOW nearest AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER nearest <= {nearest.K}
"""

OP11 = f"""
WITH ids AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % {trie.BASE_STEP} AS base
    FROM conversations WHERE conv_id IS NOT NULL
),
-- CRC-32 of the decimal id, bit by bit.
heads AS (
    SELECT conv_id, base, CAST(xor(list_reduce(
        list_prepend(4294967295, [ascii(c) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, CAST(byte AS BIGINT)), range(8)),
            lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
        )
    ), 4294967295) % {trie.HEADS} AS INTEGER) AS h
    FROM ids
),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
    SELECT c.conv_id, t.place AS place, 0 AS own, t.role, t.text
    FROM heads c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.place, 1, t.role, t.text
    FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
),
placed AS (
    SELECT conv_id, text, row_number() OVER whole AS depth,
        list(sha256(role) || sha256(text)) OVER (whole ROWS UNBOUNDED PRECEDING) AS path
    FROM rebuilt WINDOW whole AS (PARTITION BY conv_id ORDER BY own, place)
),
prefixes AS (
    SELECT conv_id, depth, sha256(array_to_string(path, ',')) AS path,
        len({WORDS}) AS words FROM placed
    UNION ALL SELECT conv_id, 0, '', 0 FROM ids
),
lengths AS (SELECT conv_id, max(depth) AS rebuilt FROM prefixes GROUP BY conv_id),
nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
            FILTER (rebuilt = depth), '')) AS ends_sha256
    FROM prefixes JOIN lengths USING (conv_id) GROUP BY depth, path
),
-- The node of each prefix of a node's smallest member.
above AS (
    SELECT n.conv_id, n.depth, u.conv_id AS upper_id, u.depth AS upper
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
    JOIN nodes u ON u.depth = p.depth AND u.path = p.path
),
children AS (
    SELECT upper_id AS conv_id, upper AS depth, count(*) AS n_children
    FROM above WHERE depth = upper + 1 GROUP BY ALL
),
counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (conv_id, depth)
),
sums AS (
    SELECT upper_id AS conv_id, upper AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
        sum((n_convs - 1) * words) AS saved_tokens
    FROM counted JOIN above USING (conv_id, depth) GROUP BY ALL
)
SELECT conv_id, depth, upper_id AS parent_conv_id, n_convs, n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (conv_id, depth)
LEFT JOIN (SELECT * FROM above WHERE depth = upper + 1) USING (conv_id, depth)
"""

OP12 = r"""
WITH docs AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
)
SELECT doc_id, first(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(content) AS text_sha256
FROM docs WINDOW best AS (PARTITION BY content ORDER BY points DESC, doc_id)
"""

OP13 = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM cut GROUP BY lang),
runs AS (
    SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
    FROM cut, range(1, {phrases.LONGEST + 1}) AS sizes(size) WHERE len(ws) >= size
),
counts AS (
    SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase, count(*) AS a
    FROM runs GROUP BY ALL HAVING count(*) >= {phrases.THRESHOLD}
),
candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1),
inside AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM candidates c JOIN (
        SELECT lang, a, unnest(flatten([[array_to_string(ws[s:s + k - 1], ' ')
            FOR s IN range(1, size - k + 2)] FOR k IN range(2, size)])) AS phrase
        FROM candidates WHERE size > 2
    ) longer ON c.lang = longer.lang AND c.phrase = longer.phrase AND longer.a >= c.a
),
cuts AS (
    SELECT lang, phrase, a, ws, size, unnest(range(1, size)) AS k
    FROM candidates ANTI JOIN inside USING (lang, phrase)
),
scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n,
        CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:c.size], ' ')
),
lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM lowest WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= {phrases.TOP}
"""

ORACLES = {
    "op2_substrings": OP2,
    "op9_hosts": OP9,
    "op10_nearest": OP10,
    "op11_trie": OP11,
    "op12_exact": OP12,
    "op13_phrases": OP13,
}
