"""DuckDB SQL for the corpus queries that SQL can express."""

# crc32 of a text of ASCII signs, written out since DuckDB has none: eight shifts for each byte. Fixed value: the polynomial
CRC32 = """CAST(xor(CAST(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(({0})[i])::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, n: xor(v >> 1, (v & 1) * 3988292384))
) AS BIGINT), 4294967295) AS BIGINT)"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


CORPUS_ORACLE = {
    "op2_phrase_dedup": """
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(words) - 11)) AS start, words FROM split
        ), phrases AS (
            SELECT doc_id, start, array_to_string(words[start : start + 12], ' ') AS phrase FROM windows
        ), repeated AS (
            SELECT doc_id, start FROM phrases QUALIFY min(doc_id) OVER (PARTITION BY phrase) < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS place FROM repeated
        ), kept AS (
            SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.place) AS body, count(*) AS n
            FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split) w
            ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.place = w.place
            GROUP BY w.doc_id
        )
        SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k.body, '')) AS kept_sha256
        FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
    """,
    "op4_ngram_join": """
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[start : start + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS start FROM split WHERE len(words) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT c.a, c.b
            FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) c
            JOIN sizes p ON p.doc_id = c.a JOIN sizes q ON q.doc_id = c.b
            WHERE 100 * common >= 80 * (p.n + q.n - common)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        )
        SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
        FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id
        GROUP BY r.doc_id
    """,
    "op7_exact_dedup": """
        WITH hashed AS (
            SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS body FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM hashed WINDOW same AS (PARTITION BY body)
    """,
    "op11_conversation_trie": f"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), ids AS (
            SELECT conv_id, conv_id - conv_id % 5 AS family, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT i.conv_id, 0 AS own, t.p, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.family AND t.p < i.h
            UNION ALL
            SELECT i.conv_id, 1, t.p, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.p >= i.h
        ), placed AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth, role, text FROM rebuilt
        ), named(conv_id, depth, name, n_bytes) AS (
            SELECT conv_id, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT) FROM ids
            UNION ALL
            SELECT n.conv_id, p.depth, sha256(n.name || strlen(p.role) || ':' || p.role || p.text), CAST(strlen(p.text) AS BIGINT)
            FROM named n JOIN placed p ON p.conv_id = n.conv_id AND p.depth = n.depth + 1
        ), lengths AS (
            SELECT conv_id, max(depth) AS length FROM named GROUP BY conv_id
        ), nodes AS (
            SELECT n.depth, n.name, min(n.conv_id) AS conv_id, count(*) AS n_convs, any_value(n.n_bytes) AS n_bytes,
                   sha256(coalesce(string_agg(CAST(n.conv_id AS VARCHAR), ',' ORDER BY n.conv_id) FILTER (WHERE l.length = n.depth), '')) AS ends_sha256
            FROM named n JOIN lengths l ON l.conv_id = n.conv_id GROUP BY n.depth, n.name
        ), edges AS (
            SELECT x.*, u.conv_id AS parent_conv_id
            FROM nodes x LEFT JOIN named m ON m.conv_id = x.conv_id AND m.depth = x.depth - 1
            LEFT JOIN nodes u ON u.depth = m.depth AND u.name = m.name
        ), counted AS (
            SELECT e.*, coalesce(c.n, 0) AS n_children
            FROM edges e LEFT JOIN (SELECT parent_conv_id, depth - 1 AS depth, count(*) AS n FROM edges WHERE depth > 0 GROUP BY ALL) c
            ON c.parent_conv_id = e.conv_id AND c.depth = e.depth
        ), sums AS (
            SELECT u.depth, u.name, sum(CAST(c.n_children = 0 AS BIGINT)) AS n_leaves, sum((c.n_convs - 1) * c.n_bytes) AS saved_tokens
            FROM counted c JOIN named u ON u.conv_id = c.conv_id AND u.depth <= c.depth GROUP BY u.depth, u.name
        )
        SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
               CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
        FROM counted c JOIN sums s ON s.depth = c.depth AND s.name = c.name
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, source, {_leaf("text")} AS leaf,
                   CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 5 = 0
                        THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS shown
            FROM documents
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
        ), up(source, level, pos, digest) AS (
            SELECT source, 0, pos, leaf FROM ranked
            UNION ALL
            SELECT source, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM up) WHERE n > 1 GROUP BY source, level + 1, pos // 16
        ), tops AS (
            SELECT source, level, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos
            FROM (SELECT * FROM up QUALIFY level = max(level) OVER (PARTITION BY source))
        ), top(level, pos, digest) AS (
            SELECT 0, pos, digest FROM tops
            UNION ALL
            SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level + 1, pos // 16
        ), heights AS (
            SELECT source, level AS height, digest AS subroot, pos AS place FROM tops
        ), steps AS (
            SELECT r.source, r.pos, u.level, string_agg(u.digest, '' ORDER BY u.pos) FILTER (WHERE u.pos < r.pos // CAST(16 ** u.level AS BIGINT)) AS a,
                   string_agg(u.digest, '' ORDER BY u.pos) FILTER (WHERE u.pos > r.pos // CAST(16 ** u.level AS BIGINT)) AS b
            FROM ranked r JOIN heights h ON h.source IS NOT DISTINCT FROM r.source
            JOIN up u ON u.source IS NOT DISTINCT FROM r.source AND u.level < h.height AND u.pos // 16 = r.pos // CAST(16 ** (u.level + 1) AS BIGINT)
            GROUP BY r.source, r.pos, u.level
            UNION ALL
            SELECT r.source, r.pos, h.height + t.level, string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos < h.place // CAST(16 ** t.level AS BIGINT)),
                   string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos > h.place // CAST(16 ** t.level AS BIGINT))
            FROM ranked r JOIN heights h ON h.source IS NOT DISTINCT FROM r.source
            JOIN top t ON t.pos // 16 = h.place // CAST(16 ** (t.level + 1) AS BIGINT) AND t.level < (SELECT max(level) FROM top)
            GROUP BY r.source, r.pos, h.height, t.level
        ), proofs AS (
            SELECT source, pos, sha256(string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY level)) AS proof_sha256
            FROM steps GROUP BY source, pos
        ), folded(source, pos, level, digest) AS (
            SELECT source, pos, 0, coalesce(shown, leaf) FROM ranked
            UNION ALL
            SELECT f.source, f.pos, f.level + 1, sha256(coalesce(s.a, '') || f.digest || coalesce(s.b, ''))
            FROM folded f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.pos = f.pos AND s.level = f.level
        ), ends AS (
            SELECT source, pos, digest FROM folded QUALIFY level = max(level) OVER (PARTITION BY source, pos)
        ), whole AS (
            SELECT digest AS root FROM top ORDER BY level DESC LIMIT 1
        )
        SELECT r.doc_id, r.leaf, h.subroot, w.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.digest AS folded_root,
               e.digest = w.root AS verified
        FROM ranked r CROSS JOIN whole w JOIN heights h ON h.source IS NOT DISTINCT FROM r.source
        JOIN ends e ON e.source IS NOT DISTINCT FROM r.source AND e.pos = r.pos
        LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM r.source AND p.pos = r.pos
    """,
}
