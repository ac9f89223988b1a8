"""SQL for DuckDB that gives the rows of those training-data queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
        LOWER_TEXT AS text
    FROM documents
), pieces AS (
    SELECT lang, row_number() OVER () AS piece, words
    FROM (
        SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
        FROM texts
    ) WHERE len(words) > 0
), placed AS (
    SELECT lang, piece, unnest(words) AS w1, unnest(range(len(words))) AS seat FROM pieces
), suffixes AS (
    SELECT lang, w1, lead(w1) OVER (PARTITION BY piece ORDER BY seat) AS w2,
        lead(w1, 2) OVER (PARTITION BY piece ORDER BY seat) AS w3
    FROM placed
), totals AS (SELECT lang, count(*) AS n FROM suffixes GROUP BY lang),
ones AS (SELECT lang, w1 AS phrase, count(*) AS f FROM suffixes GROUP BY ALL),
twos AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS phrase, count(*) AS f FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL),
threes AS (
    SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS f
    FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT t.lang, t.phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
    FROM twos t JOIN ones x ON x.lang = t.lang AND x.phrase = w1 JOIN ones y ON y.lang = t.lang AND y.phrase = w2
    WHERE t.f >= 10
    UNION ALL
    SELECT t.lang, t.phrase, t.f, x.f, y.f, 1
    FROM threes t JOIN ones x ON x.lang = t.lang AND x.phrase = t.w1
        JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.phrase, t.f, x.f, y.f, 2
    FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
        JOIN ones y ON y.lang = t.lang AND y.phrase = t.w3
), scored AS (
    SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts
), chosen AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, phrase, max(f) AS f
    FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM threes UNION ALL SELECT lang, w2 || ' ' || w3, f FROM threes)
    GROUP BY ALL
), kept AS (
    SELECT c.* FROM chosen c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase
    WHERE g.f IS NULL OR 100 * g.f < 50 * c.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

RANKING = r"""
WITH words AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(LOWER_TEXT,
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), docs AS (SELECT row_no, doc_id, terms, CAST(len(terms) AS HUGEINT) AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS HUGEINT) AS documents, CAST(sum(n) AS HUGEINT) AS all_terms FROM docs),
asked AS (
    SELECT item_id, item_row, term, CAST(count(*) AS HUGEINT) AS times
    FROM (
        SELECT item_id, item_row,
            unnest(regexp_extract_all(LOWER_TEXT,
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text, dense_rank() OVER (ORDER BY item_id, text) AS item_row FROM benchmark)
    ) GROUP BY ALL
), postings AS (
    SELECT row_no, doc_id, n, term, CAST(count(*) AS HUGEINT) AS tf
    FROM (SELECT row_no, doc_id, n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS HUGEINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), scored AS (
    SELECT item_id, item_row, row_no, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * documents) // all_terms)))) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals
    GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS FIRST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""

CHATS = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), written AS (
    SELECT *, regexp_replace(text, '([<\[])(~*)(\||/?s>|/?INST\]|</?SYS>>|bos>|eos>|pad>|unk>)', '\1~\2\3', 'g') AS safe,
        replace(replace(role, '~', '~t'), '|', '~p') AS safe_role
    FROM said
), placed AS (
    SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
        sum(length('<|' || safe_role || '|>' || chr(10) || safe || '<|end|>' || chr(10))) OVER w AS chars
    FROM written
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, safe ROWS UNBOUNDED PRECEDING)
), joined AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
        coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS trained,
        sum(chars) FILTER (role = 'assistant' OR k = n) AS formatted
    FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(trained) AS loss_chars, sha256(trained) AS loss_sha256,
    CAST(formatted AS BIGINT) AS formatted_chars
FROM joined
"""

ORACLES = {
    "op6_chat": CHATS,
    "op11_phrases": PHRASES.replace("LOWER_TEXT", _LOWER.format("coalesce(text, '')")),
    "op12_ranking": RANKING.replace("LOWER_TEXT", _LOWER.format("text")),
}
