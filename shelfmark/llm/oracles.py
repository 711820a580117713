"""The same results in SQL for DuckDB, where SQL can state them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_rules"] = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split WHERE len(words) >= 5)
), often AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM often, range(5) AS r(k) GROUP BY doc_id
), counts AS (
    SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
        length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals,
        len(list_filter(words, lambda x, i: i > 1 AND x = words[i - 1])) AS stutter,
        coalesce(list_max(list_transform(words, lambda x: strlen(x))), 0) AS longest
    FROM split s LEFT JOIN repeated r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
        OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * letters < 4 * word_chars
        OR 2 * capitals > letters OR 10 * stutter > 3 * n_words OR longest > 1000) AS kept
FROM counts
"""

ORACLES["op5_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(15 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
        + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES["op8_url_filters"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(host, path, action) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, s.host, s.path, r.host || r.path AS rule, coalesce(r.action, 'allow') AS verdict
FROM split s LEFT JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, r.action DESC) = 1
"""

ORACLES["op4_benchmark_decontamination"] = r"""
WITH items AS (
    SELECT item_id, w, least(5, len(w)) AS n
    FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark)
    WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS shingle
    FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), sizes AS (
    SELECT item_id, count(*) AS k FROM wanted GROUP BY item_id
), docs AS (
    SELECT doc_id, n, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w
    FROM documents, (SELECT DISTINCT n FROM items)
), present AS (
    SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS shingle
    FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs WHERE len(w) >= n)
), shared AS (
    SELECT doc_id, item_id, count(*) AS s FROM present JOIN wanted USING (n, shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, k::INTEGER AS n_shingles, s::INTEGER AS n_shared, s / k AS containment
FROM shared JOIN sizes USING (item_id) WHERE 10 * s >= 8 * k
"""


def _spans(name: str, pattern: str, group: int, source: str = "SELECT doc_id, 0 AS shift, text FROM documents") -> str:
    """``doc_id, start, stop, value`` of the matches of a pattern, placed by what stands before them."""
    quoted = pattern.replace("'", "''")
    return f"""
{name} AS (
    SELECT doc_id, value, shift + stop - length(whole) AS start, shift + stop AS stop FROM (
        SELECT doc_id, shift, value, whole,
            sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, shift ORDER BY place)::BIGINT AS stop
        FROM (
            SELECT doc_id, shift, unnest(found) AS whole, unnest(chosen) AS value, unnest(gaps[:len(found)]) AS gap,
                generate_subscripts(found, 1) AS place
            FROM (
                SELECT doc_id, shift, regexp_extract_all(text, '{quoted}') AS found,
                    regexp_extract_all(text, '{quoted}', {group}) AS chosen,
                    string_split_regex(text, '{quoted}') AS gaps
                FROM ({source}) WHERE regexp_matches(text, '{quoted}')))))"""


def _cut(name: str, runs: str, spans: str) -> str:
    """The parts of ``runs`` outside ``spans``, of 20 characters at least."""
    return f"""
{name} AS (
    SELECT doc_id, p AS start, piece_stop AS stop, substr(value, p - start + 1, piece_stop - p) AS value FROM (
        SELECT r.*, coalesce((SELECT min(b.start) FROM {spans} b
            WHERE b.doc_id = r.doc_id AND b.start >= r.p AND b.start < r.stop), r.stop) AS piece_stop
        FROM (
            SELECT doc_id, start, stop, value, start AS p FROM {runs}
            UNION SELECT c.doc_id, c.start, c.stop, c.value, b.stop
            FROM {runs} c JOIN {spans} b ON b.doc_id = c.doc_id AND b.start < c.stop AND b.stop > c.start) r
        WHERE p < stop AND NOT EXISTS (
            SELECT 1 FROM {spans} b WHERE b.doc_id = r.doc_id AND b.start <= r.p AND b.stop > r.p))
    WHERE piece_stop - p >= 20)"""


def _secret(name: str, source: str) -> str:
    """The strings of ``source`` with a window as random as its class asks and nothing harmless."""
    return rf"""
{name} AS (
    SELECT doc_id, start, stop FROM (
        SELECT doc_id, start, stop, w, sum(round(n * log2(n) * 1000000)) AS s FROM (
            SELECT doc_id, start, stop, i, w, c, count(*) AS n FROM (
                SELECT *, unnest(string_split(w, '')) AS c FROM (
                    SELECT doc_id, start, stop, i, substr(value, i, 20) AS w FROM (
                        SELECT *, unnest(range(1, length(value) - 18)) AS i FROM {source}
                        WHERE NOT regexp_matches(value,
                            '(?i)example|sample|placeholder|changeme|dummy|x{{6}}|0{{8}}|123456789|abcdefgh')
                        AND NOT regexp_matches(value, '(^|[^0-9a-fA-F])[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}'
                            || '-[0-9a-fA-F]{{12}}($|[^0-9a-fA-F])'))))
            GROUP BY ALL)
        GROUP BY doc_id, start, stop, i, w)
    WHERE s <= floor(20 * (log2(20) - CASE
            WHEN regexp_full_match(w, '[0-9a-fA-F]+') AND regexp_matches(w, '[a-fA-F]') AND regexp_matches(w, '[0-9]')
                THEN 3.0
            WHEN regexp_full_match(w, '[0-9A-Za-z]+')
                THEN CASE WHEN regexp_matches(w, '[A-Za-z]') AND regexp_matches(w, '[0-9]') THEN 3.7 ELSE 4.0 END
            WHEN regexp_matches(w, '[A-Za-z]') AND regexp_matches(w, '[0-9]') THEN 3.8 ELSE 9 END) * 1000000)
    GROUP BY ALL)"""


_JOINED = "coalesce(string_agg({kind} || ':' || start || ':' || stop, ',' ORDER BY start, rank){only}, '')"
_PIECES = "SELECT doc_id, start AS shift, value AS text FROM pieces"

ORACLES["op7_secret_scans"] = rf"""
WITH {_spans("assigned", '((?i:password|passwd|secret|token|api_?key))["' + "']?" + r'\x20*[:=]\x20*["' + "']?"
             + '([A-Za-z0-9+/_.=-]+)', 2)},
{_spans("keys", 'AKIA[A-Z0-9]+', 0)}, {_spans("digits", '[0-9a-f]+', 0)},
{_spans("candidates", '[A-Za-z0-9+/_=-]{20,}', 0)},
base AS (
    SELECT doc_id, 'assign' AS kind, 0 AS rank, start, stop FROM assigned WHERE length(value) >= 6
    UNION ALL SELECT doc_id, 'access', 1, start, stop FROM keys WHERE length(value) >= 20
    UNION ALL SELECT doc_id, 'hex', 2, start, stop FROM digits WHERE length(value) >= 24
), {_cut("pieces", "candidates", "base")}, {_spans("words", '[A-Za-z0-9]{20,}', 0, _PIECES)},
{_secret("secret_words", "words")}, {_cut("rest", "pieces", "secret_words")},
signed AS (SELECT * FROM rest WHERE regexp_matches(value, '[+/_=-]')), {_secret("secret_rest", "signed")},
spans AS (
    SELECT * FROM base
    UNION ALL SELECT doc_id, 'entropy', 3, start, stop FROM secret_words
    UNION ALL SELECT doc_id, 'entropy', 3, start, stop FROM secret_rest
)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    sha256({_JOINED.format(kind="kind", only=" FILTER (rank < 3)")}) AS base_sha256,
    {_JOINED.format(kind="kind", only="")} AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""
