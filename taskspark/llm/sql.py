"""DuckDB SQL for the queries it can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GROUPS = rf"""
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM DOCS
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), near AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM sets
    UNION SELECT r.x, near.y FROM reach r JOIN near ON r.y = near.x
), found AS (
    SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)"""

JACCARD = f"""
WITH RECURSIVE {GROUPS.replace("DOCS", "documents")}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN found USING (doc_id)
"""

QUALITY = r"""
WITH body AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM body
), windows AS (
    SELECT k, i, count(*) OVER (PARTITION BY k, w[i:i + 2]) AS copies
    FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeated AS (
    SELECT k, count(DISTINCT i + d) AS n FROM windows, range(3) AS s(d) WHERE copies > 1 GROUP BY k
), measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(regexp_extract_all(t, '\p{Lu}'))::BIGINT AS n_capitals, len(regexp_extract_all(t, '!'))::BIGINT AS n_exclamations
    FROM words LEFT JOIN repeated USING (k)
), judged AS (
    SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
        + 4 * (100 * n_symbols > 25 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
        + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
        + 64 * (100 * n_capitals > 50 * word_chars)::BIGINT + 128 * (100 * n_exclamations > 50 * n_words)::BIGINT AS failed
    FROM measured
)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM judged
"""

ABLATIONS = f"""
SELECT rule, count(*) FILTER (failed & bit <> 0) AS n_failed, count(*) FILTER (failed = bit) AS n_alone,
    count(*) FILTER (kept) AS kept, count(*) FILTER (kept OR (failed = bit AND NOT base_failed)) AS kept_without
FROM ({QUALITY}) q, (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8),
    ('short_words', 16), ('long_words', 32), ('capitals', 64), ('exclamations', 128)) r(rule, bit)
GROUP BY rule
"""

CONTROL = r"\\|</?s>|\[/?INST\]|\[/?ROLE\]"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), clean AS (
    SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS r, coalesce(text, '') AS t FROM turns
), sized AS (
    SELECT *, length(t) + len(regexp_extract_all(t, '{CONTROL}')) + 7 + CASE r WHEN 'user' THEN 13 WHEN 'assistant' THEN 0
        ELSE 13 + length(r) + len(regexp_extract_all(r, '{CONTROL}')) END AS chars
    FROM clean
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST))
        AS turns_sha256,
    coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)
        FILTER (r = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

COLLOCATIONS = rf"""
WITH cut AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents
), words AS MATERIALIZED (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM cut
), f AS MATERIALIZED (
    SELECT lang, m, g, count(*) AS a FROM (
        SELECT lang, 1 AS m, unnest(w) AS g FROM words
        UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words
        UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM words
    ) GROUP BY lang, m, g HAVING count(*) >= 10
), candidates AS MATERIALIZED (
    SELECT lang, m, g, a, string_split(g, ' ') AS w FROM f WHERE m > 1
), halves AS (
    SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), cuts AS (
    SELECT h.lang, h.g, h.a, k, f1.a AS l, f2.a AS r, (1000000::HUGEINT * h.a * h.a // (f1.a::HUGEINT * f2.a))::BIGINT AS score
    FROM halves h JOIN f f1 ON f1.lang = h.lang AND f1.g = h.x JOIN f f2 ON f2.lang = h.lang AND f2.g = h.y
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), held AS (
    SELECT lang, g, max(a) AS longer FROM (
        SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS g FROM candidates WHERE m = 3
    ) GROUP BY lang, g
), placed AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, best.a DESC, encode(g)) AS rank,
        g AS phrase, best.a, l, r, n, score
    FROM best JOIN (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang) USING (lang)
    LEFT JOIN held USING (lang, g)
    WHERE longer IS NULL OR 100 * longer < 50 * best.a
)
SELECT * FROM placed WHERE rank <= 2000
"""


def _assigned(rows: str, books: str) -> str:
    apart = " + ".join(f"(x[{i}] - c[{i}]) * (x[{i}] - c[{i}])" for i in range(1, 5))
    return f"""SELECT k, p, x, e, d FROM (
        SELECT k, p, x, e, {apart} AS d FROM {rows} JOIN {books} USING (p)
    ) QUALIFY row_number() OVER (PARTITION BY k, p ORDER BY d, e) = 1"""


def _moved(assigned: str, books: str) -> str:
    means = ", ".join(f"(s{i} - (s{i} % n + n) % n) // n" for i in range(1, 5))
    sums = ", ".join(f"sum(x[{i}])::BIGINT AS s{i}" for i in range(1, 5))
    return f"""SELECT p, e, CASE WHEN n IS NULL THEN c ELSE [{means}] END AS c
        FROM {books} LEFT JOIN (SELECT p, e, count(*) AS n, {sums} FROM {assigned} GROUP BY p, e) USING (p, e)"""


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label,
        [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT k, p, v[4 * p + 1:4 * p + 4] AS x FROM kept, range(16) s(p)
), b0 AS MATERIALIZED (SELECT p, k - 1 AS e, x AS c FROM parts WHERE k <= 64
), a0 AS MATERIALIZED ({_assigned("parts", "b0")}
), b1 AS MATERIALIZED ({_moved("a0", "b0")}
), a1 AS MATERIALIZED ({_assigned("parts", "b1")}
), b2 AS MATERIALIZED ({_moved("a1", "b1")}
), a2 AS MATERIALIZED ({_assigned("parts", "b2")}
), coded AS (
    SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY k
), digest AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (k), digest
"""

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
WITH body AS (
    SELECT page_id, coalesce(html, '') AS t FROM pages
), hashed AS (
    SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS last
    FROM body
)
SELECT page_id, payload_bytes, array_to_string([
        substr('{BASE32}', ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)
        FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM hashed
"""
