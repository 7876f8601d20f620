"""The results of the operators that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from vitals.llm.chat import CONTROL_TEXT
from vitals.llm.mixing import PART, SEED, TERMS
from vitals.llm.pii import AFTER, BEFORE, BYTE, CONTEXT_BONUS, KINDS, LEAST_SCORE, Kind
from vitals.llm.postings import WINDOW
from vitals.llm.repetition import BASE_LENGTH, BASE_PERCENT, LEAST_WORDS, LIMITS, LINE_LIMIT

WORD = r"[^\x20\x09-\x0D]+"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, t.turn, t.role, '{CONTROL_TEXT}'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), whole AS (
    SELECT
        conv_id,
        count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')
            || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""


def _repeats(n: int) -> str:
    """Words and characters in repeated windows of ``n`` words."""
    return f"""
windows_{n} AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c
    FROM (SELECT doc_id, i, list_slice(ws, i, i + {n - 1}) AS w FROM words, unnest(range(1, len(ws) - {n - 2})) AS t(i))
), inside_{n} AS (
    SELECT DISTINCT doc_id, p FROM windows_{n}, unnest(range(i, i + {n})) AS t(p) WHERE c > 1
), found_{n} AS (
    SELECT doc_id, count(*) AS n_words_in, sum(length(ws[p])) AS chars_in FROM inside_{n} JOIN words USING (doc_id)
    GROUP BY doc_id
)"""


_LENGTHS = sorted({BASE_LENGTH, *LIMITS})
REPETITION = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), lines AS (
    SELECT doc_id, line, count(*) - 1 AS extra, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id, line
), repeated AS (
    SELECT doc_id, sum(extra) AS n, sum(extra * chars) AS chars FROM lines GROUP BY doc_id
), {",".join(map(_repeats, _LENGTHS))},
counted AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(r.n, 0)::BIGINT AS n_dup_lines, coalesce(r.chars, 0) AS line_chars,
        coalesce(found_{BASE_LENGTH}.n_words_in, 0)::BIGINT AS n_repeat_words,
        {", ".join(f"coalesce(found_{n}.chars_in, 0) AS chars_{n}" for n in _LENGTHS)}
    FROM words LEFT JOIN repeated r USING (doc_id) {" ".join(f"LEFT JOIN found_{n} USING (doc_id)" for n in _LENGTHS)}
), judged AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * line_chars <= {LINE_LIMIT} * word_chars
    {" ".join(f"AND 100 * chars_{n} <= {p} * word_chars" for n, p in LIMITS.items())} AS kept
FROM judged
"""


_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: NOT regexp_matches(x, '{byte}'))) = 0",
    "card": "length({d}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({d}) + 1), "
    "lambda k: CASE WHEN k % 2 = 1 THEN substr({d}, length({d}) - k + 1, 1)::INT "
    "ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr({d}, length({d}) - k + 1, 1)::INT + 1] END)) % 10 = 0",
    "phone": "length({d}) BETWEEN 10 AND 15",
    "iban": "NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]') AND "
    "list_reduce(list_transform(regexp_extract_all(substr({a}, 5) || substr({a}, 1, 4), '.'), "
    "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END), "
    "lambda a, v: (CASE WHEN v < 10 THEN a * 10 + v ELSE a * 100 + v END) % 97) = 1",
    "ssn": "NOT regexp_matches(before, '[0-9]$') AND NOT regexp_matches(after, '^[0-9]')",
}
# The patterns in their plain form.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


# An account number ends where its digits and letters are a multiple of four in number, or with the match.
_TRIMMED = {
    "iban": r"""list_transform(ms, lambda m: coalesce(list_filter(
        list_transform(range(length(m), 0, -1), lambda n: substr(m, 1, n)),
        lambda p: (p = m OR (length(replace(p, ' ', '')) >= 16 AND length(replace(p, ' ', '')) % 4 = 0 AND right(p, 1) <> ' '))
            AND list_reduce(list_transform(string_split(substr(replace(p, ' ', ''), 5) || substr(p, 1, 4), ''),
                lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END),
                lambda a, v: (CASE WHEN v < 10 THEN a * 10 + v ELSE a * 100 + v END) % 97) = 1)[1], m))"""
}


def _found(kind: Kind) -> str:
    pattern = _PLAIN.get(kind.name, kind.pattern)
    valid = _VALID[kind.name].format(
        byte=BYTE, d="regexp_replace(m, '[^0-9]', '', 'g')", a="replace(m, ' ', '')"
    )
    enough = "true" if kind.base else f"{kind.score} + CASE WHEN context THEN {CONTEXT_BONUS} ELSE 0 END >= {LEAST_SCORE}"
    return f"""
SELECT doc_id, '{kind.name}' AS kind, {KINDS.index(kind)} AS rank, s, s + length(m) AS e FROM (
    SELECT doc_id, m, before, after, s,
        regexp_matches(lower(right(before, {BEFORE}) || ' ' || left(after, {AFTER})), '{kind.context}') AS context
    FROM (
        SELECT doc_id, ts[i] AS m, coalesce(substr(ms[i - 1], length(ts[i - 1]) + 1), '') || ps[i] AS before,
            substr(ms[i], length(ts[i]) + 1) || ps[i + 1] AS after,
            (list_sum(list_transform(ps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
        FROM (
            SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, {_TRIMMED.get(kind.name, "ms")} AS ts, string_split_regex(t, '{pattern}') AS ps
            FROM texts WHERE regexp_matches(t, '{pattern}')
        ), unnest(range(1, len(ms) + 1)) AS r(i)
    )
) WHERE {enough} AND {valid}"""


_BASE = "', '".join(k.name for k in KINDS if k.base)
PII = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(map(_found, KINDS))}),
listed AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)},
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind IN ('{_BASE}')) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS if k.base)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""


MIXING = f"""
WITH RECURSIVE sizes AS (
    SELECT source, size, floor(sqrt(size))::BIGINT AS weight
    FROM (SELECT source, sum(length(coalesce(text, '')) + 1)::BIGINT AS size FROM documents GROUP BY source)
), means AS (
    SELECT source, (SELECT sum(size) FROM sizes)::DOUBLE * weight::DOUBLE
        / ((SELECT sum(weight) FROM sizes)::DOUBLE * size::DOUBLE) AS mean FROM sizes
), parts AS (
    SELECT source, greatest(ceil(mean / {PART}), 1)::INT AS parts, mean / greatest(ceil(mean / {PART}), 1) AS mean
    FROM means
), terms AS (
    SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM parts
    UNION ALL
    SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM terms WHERE k < {TERMS - 1}
), draws AS (
    SELECT doc_id, d.source, j,
        ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || j), 1, 13))::BIGINT::DOUBLE
            / {float(1 << 52)} AS u
    FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, parts + 1)) AS t(j)
), counts AS (
    SELECT doc_id, count(*) AS n
    FROM draws d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.c <= d.u GROUP BY doc_id
)
SELECT documents.*, copy::INT AS copy,
    ('0x' || substr(sha256('{SEED}#:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
FROM documents JOIN counts USING (doc_id), unnest(range(1, n + 1)) AS r(copy)
"""


NEAREST = """
WITH vectors AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id, max(list_cosine_similarity(q.e, v.e)) AS score
    FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs
) WHERE rank <= 5
"""

# The remainders of all bytes, for ``crc32`` below.
CRC_OF = """codes AS (
    SELECT list_transform(range(256), lambda x: list_reduce([x] || [0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc_of
)"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a text of code points below 2048, in UTF-8."""
    points = f"list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)"
    return f"xor(4294967295, list_reduce([4294967295] || flatten({points}), lambda c, b: xor(c >> 8, crc_of[xor(c & 255, b) + 1])))"


SPELLING = rf"""
WITH RECURSIVE {CRC_OF}, runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
    ) GROUP BY ALL
), hashed AS (
    SELECT run, n, {crc32("doc_id || ':' || run")} AS h
    FROM runs, codes WHERE length(run) >= 7
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
    ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
    SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min((-n, other)) AS best FROM near GROUP BY word
), formed AS (
    SELECT w.word, CASE WHEN -best[1] >= 10 * n THEN best[2] END AS form, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN -best[1] >= 10 * n THEN -best[1] END AS form_n
    FROM words w LEFT JOIN best USING (word)
), followed AS (
    SELECT word, word AS root FROM formed
    UNION ALL
    SELECT f.word, t.form FROM followed f JOIN formed t ON f.root = t.word WHERE t.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT f.word, f.root FROM followed f JOIN formed t ON f.root = t.word WHERE t.form IS NULL) USING (word)
"""

WHITE = r"\x20\x09-\x0D"
CONVERSATIONS = rf"""
WITH RECURSIVE {CRC_OF}, hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h
    FROM conversations, codes
), damaged AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(copy)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS c
    FROM damaged
), turns AS (
    SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair,
        CASE WHEN NOT regexp_matches(text, '[^{WHITE}]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][{WHITE}]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
), back AS (  -- cost left before turn i: nothing yet, after s, after u, after a
    SELECT DISTINCT conv_id, n + 1 AS i, 0 AS w0, 10 AS w1, 5 AS w2, 0 AS w3 FROM turns
    UNION ALL
    SELECT conv_id, i, least(e0, 5 + e2, 10 + e3), least(e1, 5 + e2, 10 + e3), least(e2, 5 + e3), least(e3, 5 + e2) FROM (
        SELECT t.conv_id, t.i,
            least(w0 + 2, x + least(w2 + 1, CASE c WHEN 's' THEN w1 WHEN 'u' THEN w2 ELSE 99999 END)) AS e0,
            least(w1 + 2, x + least(w2 + 1, CASE c WHEN 'u' THEN w2 ELSE 99999 END)) AS e1,
            least(w2 + 2, x + least(w3 + 1, CASE c WHEN 'a' THEN w3 ELSE 99999 END)) AS e2,
            least(w3 + 2, x + least(w2 + 1, CASE c WHEN 'u' THEN w2 ELSE 99999 END)) AS e3
        FROM back b JOIN (
            SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 99999 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS x FROM turns
        ) t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i - 1
    )
), places AS (
    SELECT b.*, c, fault, role, text, n.w0 AS v0, n.w1 AS v1, n.w2 AS v2, n.w3 AS v3,
        CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS x
    FROM back b LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i
    LEFT JOIN back n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.i = b.i + 1
), traced AS (
    SELECT conv_id, 1::BIGINT AS i, 0 AS q, '' AS audit, []::VARCHAR[] AS fixed FROM (SELECT DISTINCT conv_id FROM turns)
    UNION ALL
    SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
        CASE WHEN edit = 'D' THEN q WHEN edit = 'K' AND c = 's' THEN 1 ELSE onward END, audit || edit,
        fixed || CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
            ELSE [CASE onward WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END] END
    FROM (
        SELECT t.*, c, role, text, CASE q WHEN 2 THEN 3 ELSE 2 END AS onward, CASE
            WHEN [v0, v1, v2, v3][q + 1] + 2 = [w0, w1, w2, w3][q + 1] THEN 'D'
            WHEN 5 + CASE q WHEN 2 THEN w3 ELSE w2 END = [w0, w1, w2, w3][q + 1] AND (p.fault IS NOT NULL OR q IN (1, 2)) THEN 'I'
            WHEN p.fault IS NULL THEN NULL
            WHEN x + CASE WHEN q = 0 AND c = 's' THEN v1 WHEN q <> 2 AND c = 'u' THEN v2 WHEN q = 2 AND c = 'a' THEN v3 ELSE 99999 END
                = [w0, w1, w2, w3][q + 1] THEN 'K'
            ELSE 'R' END AS edit
        FROM traced t JOIN places p ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.i = t.i
    ) WHERE edit IS NOT NULL
), ended AS (
    SELECT t.conv_id, audit, array_to_string(fixed, chr(10)) AS fixed, b.w0 AS cost
    FROM traced t JOIN counted USING (conv_id) JOIN back b ON b.conv_id = t.conv_id AND b.i = 1
    WHERE q IN (0, 3) AND t.i = (SELECT max(n) + 1 FROM turns n WHERE n.conv_id = t.conv_id)
    QUALIFY row_number() OVER (PARTITION BY t.conv_id ORDER BY length(audit) DESC) = 1
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(fixed, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)
"""


def _words(table: str, key: str) -> str:
    return rf"""SELECT row_number() OVER () AS n, {key}, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {table}"""


CONTAMINATION = rf"""
WITH docs AS (
    {_words("documents", "doc_id")}
), items AS (
    {_words("benchmark", "item_id")}
), windows AS (
    SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id, least(len(ws), {WINDOW}) AS size,
        array_to_string(ws[i:i + least(len(ws), {WINDOW}) - 1], ' ') AS w
    FROM items, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS t(i) WHERE len(ws) > 0
), found AS (
    SELECT n, i, size, item_id FROM (
        SELECT n, i, size, array_to_string(ws[i:i + size - 1], ' ') AS w
        FROM docs, (SELECT DISTINCT size FROM windows), unnest(range(1, len(ws) - size + 2)) AS t(i)
    ) JOIN windows USING (size, w)
), hits AS (
    SELECT n, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + size)) AS t(p) GROUP BY n
), shared AS (
    SELECT n, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS item_ids FROM found GROUP BY n
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(item_ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (n) LEFT JOIN shared USING (n)
"""

ORACLE_SQL = {
    "op2_pii": PII,
    "op3_vantage_points": NEAREST,
    "op5_poisson_mix": MIXING,
    "op6_repetition": REPETITION,
    "op10_chat": CHAT,
    "op11_spelling_variants": SPELLING,
    "op12_conversation_repair": CONVERSATIONS,
    "op13_benchmark_index": CONTAMINATION,
}
