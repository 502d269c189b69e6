"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op5_chat_formatting": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), pieces AS (
    SELECT *, role = 'assistant' AS reply,
        length(regexp_replace(text, '<(\\*)\|', '<\1#|', 'g'))
            + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1#|', 'g')) + 24 AS chars
    FROM turns
), placed AS (
    SELECT *, sum(chars) OVER w AS prefix_chars, lead(1) OVER w IS NULL AS last
    FROM pieces WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (reply), '')) AS loss_sha256,
    CAST(sum(prefix_chars) FILTER (reply OR last) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
""",
    "op8_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5('mix:' || doc_id) AS shuffled FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM sized GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][CAST(source_no % 3 + 1 AS INTEGER)] AS weight, 3 * source_size AS most,
        CAST(3 * source_size AS DOUBLE) / [5, 2, 1][CAST(source_no % 3 + 1 AS INTEGER)] AS fill, sum(source_size) OVER () AS total
    FROM sources
), levels AS (
    SELECT *, CAST(total - coalesce(sum(most) OVER (ORDER BY fill, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / sum(weight) OVER (ORDER BY fill, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
    FROM weighted
), targets AS (
    SELECT source, source_size, source_no, total, least(CAST(most AS DOUBLE), weight * first_value(CASE WHEN own_level < fill THEN own_level END IGNORE NULLS)
        OVER (ORDER BY fill, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS target
    FROM levels
), queued AS (
    SELECT sized.*, source_size, source_no, total, target,
        sum(size) OVER (PARTITION BY source_no ORDER BY shuffled, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), waiting AS (
    SELECT *, CAST(done + epoch * source_size AS DOUBLE) / target AS finish FROM queued, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0
), mixed AS (
    SELECT *, sum(size) OVER (ORDER BY finish, source_no, shuffled, doc_id, epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= total AS fits FROM waiting
), taken AS (SELECT doc_id, sum(size) AS taken FROM mixed WHERE fits GROUP BY doc_id)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM queued LEFT JOIN taken USING (doc_id)
""",
    "op12_prefix_trie": r"""
WITH placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS first, count(*) AS own, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, i: xor(d >> 1, 3988292384 * (d & 1))))) % 4 AS h
    FROM placed GROUP BY conv_id
), lengths AS (
    SELECT conv_id, first, h, least(h, (SELECT count(*) FROM placed WHERE placed.conv_id = convs.first)) AS taken,
        least(h, (SELECT count(*) FROM placed WHERE placed.conv_id = convs.first)) + greatest(own - h, 0) AS length
    FROM convs
), turns AS (
    SELECT l.conv_id, p.place AS depth, p.role, p.text FROM lengths l JOIN placed p ON p.conv_id = l.first AND p.place <= l.h
    UNION ALL SELECT l.conv_id, p.place - l.h + l.taken, p.role, p.text FROM lengths l JOIN placed p ON p.conv_id = l.conv_id AND p.place > l.h
), steps AS (
    SELECT conv_id, depth, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM turns
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, left(prefix, greatest(64 * (depth - 1), 0)) AS above FROM steps GROUP BY depth, prefix
), children AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), marked AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, prefix)
), below AS (
    SELECT s.depth, s.prefix, sum(CAST(m.n_children = 0 AS INTEGER)) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved_tokens
    FROM marked m JOIN steps s ON s.conv_id = m.conv_id AND s.depth <= m.depth GROUP BY ALL
), ends AS (
    SELECT s.depth, s.prefix, sha256(string_agg(s.conv_id::VARCHAR, ',' ORDER BY s.conv_id)) AS ends_sha256 FROM steps s JOIN lengths l ON l.conv_id = s.conv_id AND l.length = s.depth GROUP BY ALL
)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
    CAST(b.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM marked m JOIN below b USING (depth, prefix) LEFT JOIN marked p ON p.depth = m.depth - 1 AND p.prefix = m.above LEFT JOIN ends e ON e.depth = m.depth AND e.prefix = m.prefix
""",
    "op13_divergence": r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
    SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS held FROM (SELECT lang, source, row, unnest(words) AS term FROM docs) GROUP BY lang, source, term
), kept AS (SELECT lang, term, sum(n) AS lang_n FROM counts GROUP BY lang, term HAVING sum(held) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
dense AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, v, lang_total
    FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS (
    SELECT lang, source, term, n, 1 + 1000000000 * (n + 2)::HUGEINT // (total + 2 * v) AS p, 1 + 1000000000 * (lang_n + 2)::HUGEINT // (lang_total + 2 * v) AS q FROM dense
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
