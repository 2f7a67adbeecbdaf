"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from creditgrade.llm import licenses

# Every query vector against every vector: the scores are exact whole numbers.
EXACT_TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""


# Term counts of every document; whole numbers but for the logarithm of a term's weight.
RANKED_SEARCH = r"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), held AS (
    SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM cut WHERE len(terms) > 0
), total AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM held
), norm AS (
    SELECT r, doc_id, 100 - 50 + (50 * n * n_docs) // n_all AS m FROM held, total
), tfs AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM held) GROUP BY r, term
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total
), scored AS (
    SELECT item_id, r, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM wanted JOIN weighed USING (term) JOIN tfs USING (term) JOIN norm USING (r)
    GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scored WHERE score > 0
)
WHERE rank <= 50
"""


# Every node by the list of its turns; crc32 from its definition, as SQL has no such function.
PREFIX_TRIE = r"""
WITH RECURSIVE crc_table(n, k, c) AS (
    SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) t(i)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE k < 8
), crc_list AS (
    SELECT list(c ORDER BY n) AS cells FROM crc_table WHERE k = 8
), own AS (
    SELECT conv_id, row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))
           ) AS place,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, n, conv_id - conv_id % 20 AS base,
           xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda a, b: xor(a >> 8, cells[1 + xor(a & 255, b)])
           ), 4294967295) % 4 AS h
    FROM (SELECT conv_id, max(place) AS n FROM own GROUP BY conv_id), crc_list
), shifted AS (
    SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
    SELECT s.conv_id, o.place, o.role, o.text FROM shifted s JOIN own o ON o.conv_id = s.base AND o.place <= s.h
    UNION ALL
    SELECT s.conv_id, o.place - s.h + s.taken, o.role, o.text
    FROM shifted s JOIN own o ON o.conv_id = s.conv_id AND o.place > s.h
), seqs AS (
    SELECT s.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.place) FILTER (r.place IS NOT NULL), []) AS turns
    FROM shifted s LEFT JOIN rebuilt r ON r.conv_id = s.conv_id GROUP BY s.conv_id
), members AS (
    SELECT conv_id, CAST(depth AS BIGINT) AS depth, turns[1:depth] AS prefix, len(turns) AS whole
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM seqs)
), nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole = depth) AS ends
    FROM members GROUP BY depth, prefix
), owned AS (
    SELECT m.conv_id AS member, m.depth, n.conv_id FROM members m JOIN nodes n ON n.depth = m.depth AND n.prefix = m.prefix
), linked AS (
    SELECT n.conv_id, n.depth, n.n_convs, n.ends, p.conv_id AS parent_conv_id,
           CASE WHEN n.depth = 0 THEN 0
                ELSE (n.n_convs - 1) * len(regexp_extract_all(n.prefix[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes n LEFT JOIN owned p ON p.member = n.conv_id AND p.depth = n.depth - 1
), children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children
    FROM linked WHERE depth > 0 GROUP BY 1, 2
), counted AS (
    SELECT l.*, coalesce(c.n_children, 0) AS n_children
    FROM linked l LEFT JOIN children c ON c.conv_id = l.conv_id AND c.depth = l.depth
), subtrees AS (
    SELECT a.conv_id, a.depth, CAST(count(*) FILTER (d.n_children = 0) AS BIGINT) AS n_leaves,
           CAST(sum(d.saved) AS BIGINT) AS saved_tokens
    FROM counted d JOIN owned a ON a.member = d.conv_id AND a.depth <= d.depth
    GROUP BY a.conv_id, a.depth
)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens,
       sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN subtrees s ON s.conv_id = c.conv_id AND s.depth = c.depth
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_sql() -> str:
    """The sentence and rule lists as nested SQL expressions."""
    clues = " OR ".join("contains({0}, %s)" % _text(clue) for clue in licenses.CLUES)
    arms = " ".join(
        f"WHEN regexp_full_match(s, {_text(pattern)}) THEN '{name}'"
        for name, pattern in licenses.SENTENCES
    )
    cut = f"regexp_replace(lower(coalesce(text, '')), {_text(licenses.SENTENCE_END)}, chr(10), 'g')"
    other, line_end = _text(licenses.OTHER), _text(licenses.LINE_END)
    clean = (
        f"list_transform(regexp_split_to_array({cut}, {line_end}), "
        f"lambda s: trim(regexp_replace(s, {other}, ' ', 'g')))"
    )
    steps, rest = [], "rest0"
    for n, (licence, rule) in enumerate(licenses.RULES, start=1):
        steps.append(f"CASE WHEN regexp_matches({rest}, {_text(rule)}) THEN '{licence}' END AS hit{n}")
        steps.append(f"regexp_replace({rest}, {_text(rule)}, '', 'g') AS rest{n}")
        rest = f"rest{n}"
    hits = ", ".join(f"hit{n}" for n in range(1, len(licenses.RULES) + 1))
    return f"""
WITH cut AS (
    SELECT doc_id, list_filter({clean}, lambda s: {clues.format('s')}) AS known FROM documents
), named AS (
    SELECT doc_id, list_filter(list_transform(known, lambda s: CASE {arms} END), lambda n: n IS NOT NULL) AS ids
    FROM cut
), matched AS (
    SELECT doc_id, ids, array_to_string(list_transform(ids, lambda n: '<' || n || '>'), '') AS rest0,
           {', '.join(steps)}
    FROM named
)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(list_filter(
           [{hits}, CASE WHEN {rest} <> '' THEN '{licenses.UNKNOWN}' END],
           lambda h: h IS NOT NULL))), ','), '') AS licences
FROM matched
"""


ORACLE_SQL: dict[str, str] = {
    "op1_topk": EXACT_TOPK,
    "op9_license_scan": license_sql(),
    "op11_lexical_search": RANKED_SEARCH,
    "op12_prefix_trie": PREFIX_TRIE,
}
