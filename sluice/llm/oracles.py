"""The queries of this package in SQL, for those that SQL can express."""

from __future__ import annotations

from . import chat_format as chat
from . import hard_negatives as hard
from . import mixing
from . import quality_rules as q
from . import vector_codes as codes

SPACE = r"\x20\x09-\x0D"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LINE_PASSES = f"""
    regexp_matches(line, {_quote(q.SENTENCE_END)})
    AND (length(line) - length(replace(line, '!!', ''))) / 2 <= {q.MAX_SHOUTS}
    AND (length(line) - length(translate(line, {_quote(q.SYMBOLS)}, ''))) * 100
        <= length(line) * {q.MAX_SYMBOL_PERCENT}
    AND length(line) - length(translate(line, {_quote(q.SEPARATORS)}, '')) <= {q.MAX_SEPARATORS}
    AND NOT regexp_matches(line, {_quote(q.BOILERPLATE)})
"""

QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
),
tokens AS (SELECT row_id, regexp_extract_all(text, '[^{SPACE}]+') AS w FROM docs),
windows AS (
    SELECT row_id, i, array_to_string(w[i:i + {q.WINDOW - 1}], ' ') AS win
    FROM (SELECT row_id, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM tokens)
),
repeated AS (
    SELECT row_id, i FROM windows
    QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1
),
repeats AS (
    SELECT row_id, count(DISTINCT p) AS n
    FROM (SELECT row_id, unnest(range(i, i + {q.WINDOW})) AS p FROM repeated) GROUP BY row_id
),
lines AS (
    SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM docs
),
line_counts AS (
    SELECT row_id,
        count(*) FILTER (regexp_matches(line, '[^{SPACE}]'))
            - count(DISTINCT line) FILTER (regexp_matches(line, '[^{SPACE}]')) AS n_dup_lines
    FROM lines GROUP BY row_id
),
kept_lines AS (
    SELECT row_id, sum(length(regexp_replace(line, '[{SPACE}]', '', 'g'))) AS kept_chars
    FROM (SELECT DISTINCT row_id, line FROM lines WHERE {_LINE_PASSES}) GROUP BY row_id
),
counted AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[{SPACE}]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(translate(text, {_quote(q.SYMBOLS)}, '')))::BIGINT AS n_symbols,
        n_dup_lines::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        coalesce(kept_chars, 0)::BIGINT AS kept_chars
    FROM docs JOIN tokens USING (row_id) JOIN line_counts USING (row_id)
    LEFT JOIN repeats USING (row_id) LEFT JOIN kept_lines USING (row_id)
),
judged AS (
    SELECT *, n_words < {q.MIN_WORDS}
        OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
    FROM counted
)
SELECT *, NOT base_failed AND kept_chars * 100 >= word_chars * {q.MIN_KEPT_PERCENT} AS kept
FROM judged
"""

_ESCAPED = (
    r"regexp_replace(replace({0}, '\', '\\'), " + _quote(chat.CONTROL) + r", '\1\\\2', 'g')"
)

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marked AS (
    SELECT *, lag(role) OVER w IS DISTINCT FROM role AS first_of_block
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
measured AS (
    SELECT *, length({_ESCAPED.format("text")}) + CASE
        WHEN first_of_block THEN length({_ESCAPED.format("role")})
            + {len(chat.START + chat.TEXT + chat.END) + 1}
        ELSE {len(chat.NEXT)} END AS chars
    FROM marked
),
gathered AS (
    SELECT conv_id, count(*)::BIGINT AS n_turns, sum(chars)::BIGINT AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS all_text,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (role = '{chat.TRAINED_ROLE}'), '') AS loss_text
    FROM measured GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss_text)::BIGINT AS loss_chars,
    sha256(loss_text) AS loss_sha256, formatted_chars
FROM gathered
"""

MIX = f"""
WITH sized AS (
    SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS digits
    FROM (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+'))::BIGINT AS size
        FROM documents
    )
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [{", ".join(map(str, mixing.WEIGHTS))}][
            ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT
        ]::BIGINT AS weight
    FROM sized GROUP BY source
),
filled AS (
    SELECT *, source_size * {mixing.MAX_COPIES} AS cap, sum(source_size) OVER () AS total,
        coalesce(sum(source_size * {mixing.MAX_COPIES}) OVER before, 0) AS cap_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM sources
    WINDOW before AS (
        ORDER BY (source_size * {mixing.MAX_COPIES})::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    )
),
marked AS (
    SELECT *, (total - cap_before) * weight >= cap * weight_left AS capped FROM filled
),
targets AS (
    SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
        (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
        / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE * weight END AS target
    FROM marked
),
classes AS (
    SELECT d.source, digits, sum(size)::BIGINT AS words, (digits * sum(size))::BIGINT AS weight,
        any_value(source_size) AS source_size, any_value(target) AS target
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, digits
),
larger AS (
    SELECT *, target - coalesce(sum(words) OVER before, 0)::BIGINT * {mixing.MAX_COPIES} AS still,
        sum(weight) OVER (PARTITION BY source) - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM classes
    WINDOW before AS (
        PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    )
),
limited AS (
    SELECT *, digits > 0 AND still * digits >= (weight_left * {mixing.MAX_COPIES})::DOUBLE AS at_limit FROM larger
),
expecting AS (
    SELECT *, CASE WHEN at_limit THEN {mixing.MAX_COPIES}::DOUBLE WHEN digits = 0 THEN 0::DOUBLE ELSE
        greatest(least((target - coalesce(sum(words) FILTER (at_limit) OVER own, 0)::BIGINT * {mixing.MAX_COPIES})
            / (sum(weight) FILTER (NOT at_limit) OVER own)::DOUBLE * digits, {mixing.MAX_COPIES}::DOUBLE), 0::DOUBLE)
        END AS expected
    FROM limited WINDOW own AS (PARTITION BY source)
),
plans AS (
    SELECT source, digits, source_size, target, floor(expected)::BIGINT AS copies,
        expected - floor(expected) AS p,
        target - (sum(floor(expected)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS to_take
    FROM expecting
),
drawn AS (
    SELECT d.doc_id, d.source, d.size, source_size, target, copies, p, to_take,
        (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')),
            1, {mixing.DIGITS}))::BIGINT + 0.5) / {float(16**mixing.DIGITS)} AS u
    FROM sized d JOIN plans s ON d.source IS NOT DISTINCT FROM s.source AND d.digits = s.digits
),
ranked AS (
    SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM drawn
),
running AS (
    SELECT *, sum(size) OVER (
        PARTITION BY source ORDER BY rank, doc_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
    ) AS through, sum(size) OVER (PARTITION BY source, rank, doc_id) AS together
    FROM ranked
)
SELECT doc_id, size, source_size, target, copies + extra AS copies, (copies + extra) * size AS taken
FROM (
    SELECT *, (rank IS NOT NULL AND (to_take - (through - together)) * 2 > together)::BIGINT AS extra
    FROM running
)
"""

_USABLE = """embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)"


NEGATIVES = f"""
WITH rows AS (
    SELECT vec_id, {_whole(hard.SCALE)} AS v,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
        list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS score
    FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard.POSITIVES}
)
SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN {hard.LOW} * positive_score AND {hard.HIGH} * positive_score
QUALIFY rank <= {hard.NEGATIVES}
"""


def _rounds() -> str:
    """Each round's nearest entries and the codebooks after it, as common table expressions."""
    steps = []
    for n in range(codes.ROUNDS + 1):
        steps.append(f"""
nearest{n} AS MATERIALIZED (
    SELECT row_id, part, first(entry ORDER BY error, entry) AS entry, min(error) AS error FROM (
        SELECT c.row_id, c.part, b.entry,
            list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (c.v[i] - b.v[i]) ** 2))::BIGINT AS error
        FROM parts c JOIN book{n} b USING (part)
    ) GROUP BY row_id, part
)""")
        if n < codes.ROUNDS:
            steps.append(f"""
sums{n} AS MATERIALIZED (
    SELECT part, entry, i, count(*) AS n, sum(x)::BIGINT AS total FROM (
        SELECT part, entry, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i
        FROM parts JOIN nearest{n} USING (row_id, part)
    ) GROUP BY part, entry, i
),
book{n + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(moved, v) AS v FROM book{n} LEFT JOIN (
        SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS moved
        FROM sums{n} GROUP BY part, entry
    ) USING (part, entry)
)""")
    return ",".join(steps)


CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row_id, vec_id, label, {_whole(codes.SCALE)} AS v
    FROM embeddings WHERE {_USABLE}
),
parts AS MATERIALIZED (
    SELECT row_id, part, v[part * (len(v) // {codes.PARTS}) + 1:(part + 1) * (len(v) // {codes.PARTS})] AS v
    FROM kept, range({codes.PARTS}) AS p(part)
),
book0 AS MATERIALIZED (SELECT part, row_id AS entry, v FROM parts WHERE row_id < {codes.ENTRIES}),
{_rounds()},
coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
        sum(error)::BIGINT AS error
    FROM kept JOIN nearest{codes.ROUNDS} USING (row_id) GROUP BY row_id, vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry))
        FROM book{codes.ROUNDS}) AS codebooks_sha256
FROM coded
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": CHAT,
        "op6_quality_rules": QUALITY,
        "op8_mix_sources": MIX,
        "op11_hard_negatives": NEGATIVES,
        "op12_vector_codes": CODES,
    }
