"""The queries again as SQL for DuckDB, over the same tables."""

from __future__ import annotations

from workload import english
from workload.corpus import CLEAN, PYTHON_SOURCE, SCRIPT_SOURCE, SLASH_SOURCE, TYPED_SOURCE, source_text

# Fixed values, stated here once more: the SQL takes none from the code under test.
_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself "
    "it its itself they them their theirs themselves what which who whom this that these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until while of at by for with "
    "about against between into through during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now"
)
_LANGUAGES = {
    "Python": ".py", "JavaScript": ".js .jsx", "TypeScript": ".ts .tsx", "Java": ".java", "Kotlin": ".kt .kts",
    "C#": ".cs", "C++": ".cpp .cc .cxx .hpp", "C": ".c .h", "Go": ".go", "Rust": ".rs", "Ruby": ".rb", "PHP": ".php",
    "Swift": ".swift", "Scala": ".scala", "R": ".r .R", "Objective-C": ".m", "Shell": ".sh .bash .zsh",
    "PowerShell": ".ps1", "Lua": ".lua", "Elixir": ".ex .exs", "Erlang": ".erl", "Haskell": ".hs", "Clojure": ".clj",
    "Dart": ".dart", "Vim script": ".vim", "HCL": ".tf", "OCaml": ".ml .mli",
}
_STOPS = ", ".join(f"'{w}'" for w in _STOP_WORDS.split())
_WORD = r"[\p{L}\p{N}]+"
_NEW_LINE = "chr(10)"


def _sentences(text: str, count: int) -> str:
    found = rf"regexp_extract({text}, '^((?:[^.!?]*[.!?]+\s*){{1,{count}}})', 1)"
    return rf"regexp_replace({found}, '^\s+|\s+$', '', 'g')"


def _lead(text: str, count: int) -> str:
    """A stored summary: none where there is no sentence."""
    return f"nullif({_sentences(text, count)}, '')"


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_WORD}')"


def _fts(text: str) -> str:
    return (
        f"array_to_string(list_transform({_tokens(text)}, "
        f"lambda t: CASE WHEN t IN ({_STOPS}) THEN '' ELSE t END), ' ')"
    )


def _suffix(path: str) -> str:
    return rf"regexp_extract({path}, '[^/](\.[^/.]+)$', 1)"


def _language(suffix: str) -> str:
    cases = " ".join(f"WHEN '{e}' THEN '{n}'" for n, many in _LANGUAGES.items() for e in many.split())
    return f"CASE {suffix} {cases} END"


def _counted(path: str) -> str:
    return f"coalesce({_language(_suffix(path))}, {_language(f'lower({_suffix(path)})')})"


def _repo_name(url: str) -> str:
    return (
        rf"regexp_replace(regexp_extract(regexp_replace({url}, '/+$', ''), '([^/:]*)$', 1), "
        rf"'\.git$', '')"
    )


def _numbered(*key: str) -> str:
    order = ", ".join(key)
    text = f"concat_ws(chr(1), {order})" if len(key) > 1 else key[0]
    return f"row_number() OVER (ORDER BY substr(md5({text}), 1, 3), {order})"


_DOCUMENTS = """
documents_as_files AS (
    SELECT *, cast(substr(source, 4) AS BIGINT) AS project_id,
           'https://example.org/' || source || '.git' AS git_url,
           source || '/doc_' || doc_id || CASE lang WHEN 'en' THEN '.py' WHEN 'fr' THEN '.js'
               WHEN 'de' THEN '.ts' ELSE '.go' END AS path
    FROM documents)"""

_FILES = f"""{_DOCUMENTS},
files AS (
    SELECT doc_id AS id, project_id, path, sha256(text) AS checksum, text AS body,
           {_lead('text', 2)} AS summary, embedding
    FROM documents_as_files LEFT JOIN embeddings ON vec_id = doc_id)"""

_STORED_FILES = f"""{_DOCUMENTS},
stored AS (
    SELECT id, project_id, path, sha256(text) AS checksum, text AS body,
           {_lead('text', 2)} AS summary
    FROM (SELECT doc_id AS id, project_id, path, text FROM documents_as_files
          UNION ALL
          SELECT 1000000000 + conv_id * 1000 + turn, 0,
                 'talks/' || conv_id || '_' || turn || '.py', text FROM conversations))"""

_BOTH_FILES = f"""{_STORED_FILES},
scanned AS (
    SELECT *, sha256(body) AS checksum FROM (
        SELECT project_id, path,
               CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
                    THEN 'Edited. ' ELSE '' END || text AS body
        FROM documents_as_files
        UNION ALL
        SELECT 0, 'pages/' || page_id || '.py', html FROM pages)),
new_ids AS (
    SELECT project_id, path, (SELECT max(id) FROM stored) + {_numbered('project_id', 'path')} AS id
    FROM (SELECT project_id, path FROM scanned EXCEPT SELECT project_id, path FROM stored)),
merged AS (
    SELECT coalesce(o.id, i.id) AS id, coalesce(o.project_id, n.project_id) AS project_id,
           coalesce(o.path, n.path) AS path, coalesce(n.checksum, o.checksum) AS checksum,
           coalesce(n.body, o.body) AS body, o.summary,
           n.path IS NOT NULL AS scanned, o.id IS NULL AS unknown,
           n.path IS NOT NULL AND (o.checksum IS NULL OR o.checksum <> n.checksum) AS changed
    FROM stored o
    FULL JOIN scanned n ON o.project_id = n.project_id AND o.path = n.path
    LEFT JOIN new_ids i ON i.project_id = n.project_id AND i.path = n.path)"""

_LISTING = f"""{_DOCUMENTS},
listing AS (
    SELECT git_url, path FROM documents_as_files
    UNION ALL
    SELECT regexp_extract(url, '^[^/]*/[^/]*/[^/]*') || '/site.git', 'page_' || page_id || '.JS' FROM pages
    UNION ALL
    SELECT 'https://example.org/' || event_type || '.git', event_id || '.unknown' FROM events),
counted AS (
    SELECT git_url, language, count(*) AS files, min(path) AS first_path
    FROM (SELECT git_url, path, {_counted('path')} AS language FROM listing)
    WHERE language IS NOT NULL GROUP BY git_url, language),
main_language AS (
    SELECT git_url, language FROM counted
    QUALIFY row_number() OVER (PARTITION BY git_url ORDER BY files DESC, first_path) = 1)"""

_REGISTERED = f"""{_LISTING},
metadata AS (SELECT DISTINCT git_url FROM listing),
stored AS (
    SELECT DISTINCT cast(substr(source, 4) AS BIGINT) + 1 AS id,
           'https://example.org/' || source || '.git' AS git_url FROM documents
    UNION ALL
    SELECT n_nationkey + 1000000, 'https://example.org/' || n_name || '.git' FROM nation),
new_ids AS (
    SELECT git_url, (SELECT max(id) FROM stored) + {_numbered('git_url')} AS id
    FROM (SELECT git_url FROM metadata EXCEPT SELECT git_url FROM stored)),
registered AS (
    SELECT cast(coalesce(o.id, i.id) AS BIGINT) AS id,
           CASE WHEN m.git_url IS NULL THEN 'old name' ELSE {_repo_name('m.git_url')} END AS name,
           coalesce(o.git_url, m.git_url) AS git_url,
           CASE WHEN m.git_url IS NULL THEN 'C' ELSE l.language END AS language,
           CASE WHEN m.git_url IS NULL THEN 'trunk' ELSE 'x' END AS default_branch,
           CASE WHEN o.id IS NOT NULL THEN 'kept' END AS summary,
           CASE WHEN m.git_url IS NULL THEN '2023-01-01' ELSE '2024-01-01' END AS last_updated
    FROM stored o FULL JOIN metadata m ON o.git_url = m.git_url
    LEFT JOIN new_ids i ON i.git_url = m.git_url
    LEFT JOIN main_language l ON l.git_url = m.git_url)"""

_STORED_FUNCTIONS = f"""
functions AS (
    SELECT conv_id * 1000 + turn AS id, conv_id AS file_id, cast(0 AS BIGINT) AS project_id,
           role || '_' || turn AS name, role || '_' || turn || '()' AS signature,
           cast(turn + 1 AS INTEGER) AS start_line, cast(turn + 1 AS INTEGER) AS end_line,
           text AS body, sha256(text) AS checksum, {_lead('text', 3)} AS summary
    FROM conversations)"""

_DIFF = f"""{_STORED_FUNCTIONS},
extracted AS (
    SELECT *, sha256(body) AS checksum FROM (
        SELECT conv_id AS file_id, role || '_' || turn AS name, cast(turn + 1 AS INTEGER) AS start_line,
               text || CASE role WHEN 'assistant' THEN ' Edited.' ELSE '' END AS body
        FROM conversations WHERE role <> 'system'
        UNION ALL
        SELECT conv_id, role || '_' || turn, cast(turn + 101 AS INTEGER), text
        FROM conversations WHERE role = 'user')),
old AS (SELECT * FROM functions
        WHERE file_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
diff AS (
    SELECT coalesce(o.file_id, n.file_id) AS file_id,
           coalesce(o.start_line, n.start_line) AS start_line,
           CASE WHEN o.id IS NULL THEN 'new' WHEN n.file_id IS NULL THEN 'removed'
                WHEN o.checksum <> n.checksum THEN 'changed' ELSE 'unchanged' END AS change
    FROM old o FULL JOIN extracted n ON o.file_id = n.file_id AND o.start_line = n.start_line)"""


def _words(source: str, text: str, key: str = "id") -> str:
    """``words(key, term, pos)``: searchable words with their positions."""
    return (
        f"words AS (SELECT {key}, term, cast(pos AS INTEGER) AS pos FROM ("
        f"SELECT {key}, unnest(a) AS term, generate_subscripts(a, 1) AS pos "
        f"FROM (SELECT {key}, {_tokens(text)} AS a FROM {source})) WHERE term NOT IN ({_STOPS}))"
    )


_TEXT_WORDS = "texts AS (SELECT doc_id AS id, text FROM documents), " + _words("texts", "text")
_FILE_WORDS = _FILES + ", " + _words("files", "path || ' ' || coalesce(summary, '')")


def _all_of(*terms: str) -> str:
    """``scores(id, score)`` by cover density for words that must all occur."""
    listed = ", ".join(f"'{t}'" for t in terms)
    latest = ", ".join(
        f"max(CASE WHEN term = '{t}' THEN pos END) OVER w AS last_{i}" for i, t in enumerate(terms)
    )
    known = " AND ".join(f"last_{i} IS NOT NULL" for i in range(len(terms)))
    lasts = ", ".join(f"last_{i}" for i in range(len(terms)))
    return f"""
hits AS (
    SELECT id, pos, row_number() OVER w AS idx, {latest}
    FROM words WHERE term IN ({listed}) WINDOW w AS (PARTITION BY id ORDER BY pos)),
covers AS (
    SELECT id, least({lasts}) AS p, min(pos) AS q FROM hits WHERE {known} GROUP BY 1, 2),
scores AS (
    SELECT c.id, sum(0.1::DOUBLE / (1 + (c.q - c.p) - (b.idx - a.idx))) AS score
    FROM covers c JOIN hits a ON a.id = c.id AND a.pos = c.p JOIN hits b ON b.id = c.id AND b.pos = c.q
    GROUP BY c.id)"""


def _any_of(*terms: str) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return (
        "scores AS (SELECT id, sum(0.1::DOUBLE) AS score FROM words "
        f"WHERE term IN ({listed}) GROUP BY id)"
    )


_NOT = """
scores AS (
    SELECT id, sum(0.1::DOUBLE) AS score FROM words
    WHERE term = 'tion' AND id NOT IN (SELECT id FROM words WHERE term = 'thre') GROUP BY id)"""
_PHRASE = """
scores AS (
    SELECT a.id, sum(0.1::DOUBLE) AS score FROM words a
    JOIN words b ON b.id = a.id AND b.pos = a.pos + 1
    WHERE a.term = 'anea' AND b.term = 'eriner' GROUP BY a.id)"""
_SCORES = "SELECT id, round(score, 6) AS score FROM scores"
_TOP = (
    "SELECT id, cast(row_number() OVER (ORDER BY cast(score AS FLOAT) DESC, id) AS INTEGER) AS rank "
    "FROM scores ORDER BY rank LIMIT 20"
)

_QUERY_VECTOR = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"


def _fused(table: str, where: str, count: int, k: int) -> str:
    return f"""
distances AS (
    SELECT id, list_cosine_distance(embedding::DOUBLE[], {_QUERY_VECTOR}) AS distance
    FROM {table} WHERE embedding IS NOT NULL AND {where}),
semantic AS (
    SELECT id, row_number() OVER (ORDER BY distance, id) AS rank FROM distances
    ORDER BY rank LIMIT {2 * count}),
keyword AS (
    SELECT id, row_number() OVER (ORDER BY cast(score AS FLOAT) DESC, id) AS rank
    FROM scores WHERE id IN (SELECT id FROM {table} WHERE {where}) ORDER BY rank LIMIT {2 * count}),
combined AS (
    SELECT coalesce(s.id, k.id) AS id,
           coalesce(1.0::DOUBLE / ({k} + s.rank), 0) + coalesce(1.0::DOUBLE / ({k} + k.rank), 0) AS score
    FROM semantic s FULL JOIN keyword k ON s.id = k.id)"""


def _file_search(where: str = "true", count: int = 10, k: int = 60) -> str:
    return f"""{_FILE_WORDS}, {_all_of('attion', 'anea')}, {_fused('files', where, count, k)},
found AS (
    SELECT f.id, f.project_id, f.path, f.summary, c.score AS rrf_score
    FROM combined c JOIN files f ON f.id = c.id ORDER BY c.score DESC, f.id LIMIT {count})"""


_ROUNDED = "SELECT id, project_id, path, summary, round(rrf_score, 9) AS rrf_score FROM found"


def _function_search(count: int) -> str:
    return f"""WITH {_FILES}, {_STORED_FUNCTIONS},
searched AS (SELECT fn.*, e.embedding FROM functions fn LEFT JOIN embeddings e ON e.vec_id = fn.file_id),
{_words('functions', "name || ' ' || coalesce(summary, '')")}, {_any_of('tion', 'erin')},
{_fused('searched', 'true', count, 60)}
SELECT fn.id, fn.file_id, fn.project_id, f.path, fn.name, fn.summary, fn.body,
       round(c.score, 9) AS rrf_score
FROM combined c JOIN functions fn ON fn.id = c.id JOIN files f ON f.id = fn.file_id
ORDER BY c.score DESC, fn.id LIMIT {count}"""


def _hashed(source: str, key: str) -> str:
    return f"""
WITH terms AS (SELECT {key}, unnest({_tokens('text')}) AS term FROM {source}),
counts AS (
    SELECT {key}, cast(('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS INTEGER) AS bucket, count(*) AS n
    FROM terms WHERE term NOT IN ({_STOPS}) GROUP BY 1, 2),
norms AS (SELECT {key}, sqrt(sum(n * n)) AS norm FROM counts GROUP BY 1),
cells AS (SELECT {key}, cast(bucket AS INTEGER) AS bucket FROM {source}, range(64) r(bucket))
SELECT {key}, bucket, round(coalesce((n / norm)::FLOAT, 0)::DOUBLE, 5) AS weight
FROM cells LEFT JOIN counts USING ({key}, bucket) LEFT JOIN norms USING ({key})"""


def _vector_sums(source: str, key: str) -> str:
    """Weights of the hashed vectors of ``summary``, each times its place, summed up."""
    return f"""
summary_terms AS (SELECT {key}, unnest({_tokens('summary')}) AS term FROM {source}),
summary_counts AS (
    SELECT {key}, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n
    FROM summary_terms WHERE term NOT IN ({_STOPS}) GROUP BY 1, 2),
vector_sums AS (
    SELECT {key}, round(sum((bucket + 1) * (n / norm)::FLOAT::DOUBLE), 3) AS vector_sum
    FROM summary_counts JOIN (SELECT {key}, sqrt(sum(n * n)) AS norm FROM summary_counts GROUP BY 1) USING ({key})
    GROUP BY 1)"""


def _definition(file_id: str, ordinal: int, name: str, start: str, end: str, body: str) -> str:
    return (
        f"SELECT {file_id} AS file_id, {ordinal} AS ordinal, {name} AS name, "
        f"cast({start} AS INTEGER) AS start_line, cast({end} AS INTEGER) AS end_line, {body} AS body "
        "FROM cleaned"
    )


def _between(template: str, start: str, end: str) -> str:
    """The part of a template from ``start`` through ``end``, as SQL."""
    at = template.index(start)
    return source_text(template[at : template.index(end, at) + len(end)])


_FOUND = f"""
cleaned AS (
    SELECT doc_id, lang, source, clean, length(clean) - length(replace(clean, {_NEW_LINE}, '')) AS k
    FROM (SELECT *, {CLEAN} AS clean FROM documents)),
found AS (
{_definition('doc_id * 2', 0, "'top_' || doc_id", '5', '13 + k',
             _between(PYTHON_SOURCE, 'def top_', 'second)'))}
UNION ALL
{_definition('doc_id * 2', 1, "'method_' || lang", '16 + k', '16 + k',
             _between(PYTHON_SOURCE, 'async def method_', "'{source}'"))}
UNION ALL
{_definition('doc_id * 2 + 1', 0, "'top_' || doc_id", '4', '8 + k',
             _between(SCRIPT_SOURCE, 'async function', f'nested;{chr(10)}}}}}'))}
UNION ALL
{_definition('doc_id * 2 + 1', 1, "'constructor'", '11 + k', '11 + k',
             _between(SCRIPT_SOURCE, 'constructor', 'super(first); }}'))}
UNION ALL
{_definition('doc_id * 2 + 1', 2, 'lang', '12 + k', '14 + k',
             _between(SCRIPT_SOURCE, 'static get', f"';{chr(10)}  }}}}"))}
UNION ALL
{_definition('doc_id + 1000000000', 0, "'method_' || lang", '4', '6 + k',
             _between(TYPED_SOURCE, 'public method_', f"`;{chr(10)}  }}}}"))}
UNION ALL
{_definition('doc_id + 2000000000', 0, "'first_' || doc_id", '1', '5 + k',
             _between(SLASH_SOURCE, 'function first_', f"`;{chr(10)}}}}}"))}
UNION ALL
{_definition('doc_id + 2000000000', 1, "'second_' || doc_id", '6 + k', '6 + k',
             _between(SLASH_SOURCE, 'function second_', '2; }}'))})"""

ORACLES: dict[str, str] = {
    "scan_folder": """SELECT 'https://example.org/' || source || '.git' AS git_url,
        'd' || doc_id || '/' || ['_x/__init__.py', '.y/tool.py', 'pkg/_private.py', 'plain/b.py'][doc_id % 4 + 1] AS path,
        sha256(text) AS checksum, cast(strlen(text) AS BIGINT) AS n_bytes FROM documents""",
    "web_query_compound": f"""
        WITH split AS (SELECT item_id, {_tokens('text')} AS w FROM benchmark),
        parts AS (
            SELECT item_id, 0 AS place, w[1] AS word, 0 AS shift, false AS negated FROM split
            UNION ALL SELECT item_id, 0, w[2], 1, false FROM split
            UNION ALL SELECT item_id, 1, w[3], 0, false FROM split
            UNION ALL SELECT item_id, 1, w[4], 1, false FROM split
            UNION ALL SELECT item_id, 2, w[1], 0, true FROM split
            UNION ALL SELECT item_id, 2, w[3], 1, true FROM split),
        kept AS (SELECT * FROM parts WHERE word NOT IN ({_STOPS}))
        SELECT item_id, 0 AS alternative,
               cast(dense_rank() OVER (PARTITION BY item_id ORDER BY place) - 1 AS INTEGER) AS clause,
               negated, count(*) OVER (PARTITION BY item_id, place) > 1 AS phrase, word AS term,
               cast(shift - min(shift) OVER (PARTITION BY item_id, place) AS INTEGER) AS "offset"
        FROM kept""",
    "decode_lossy_text": "SELECT doc_id, text || chr(65533) || source AS body FROM documents",
    "scan_checksum": "SELECT doc_id, sha256(text) AS checksum, text AS body FROM documents",
    "stored_lookup": f"""WITH {_STORED_FILES}
        SELECT project_id, path, id, checksum, summary FROM stored
        WHERE id IN (SELECT doc_id FROM labels)""",
    "snapshot_roundtrip": f"""WITH {_STORED_FILES}, {_STORED_FUNCTIONS}
        SELECT 'files' AS kind, id, checksum FROM stored
        UNION ALL SELECT 'functions', id, checksum FROM functions
        UNION ALL SELECT DISTINCT 'projects', cast(substr(source, 4) AS BIGINT), source FROM documents""",
    "repository_name": f"""SELECT page_id, {_repo_name('url')} AS name,
        {_repo_name("(url || '.git///')")} AS name_of_remote FROM pages""",
    "path_suffix_language": f"""WITH {_DOCUMENTS}, paths AS (
            SELECT path FROM documents_as_files UNION ALL SELECT url || '.PY' FROM pages
            UNION ALL SELECT url FROM pages)
        SELECT path, {_suffix('path')} AS suffix, {_counted('path')} AS language FROM paths""",
    "primary_language": f"WITH {_LISTING} SELECT git_url, language FROM main_language",
    "register_projects": f"WITH {_REGISTERED} SELECT * FROM registered",
    "skip_unknown_language": f"""WITH {_REGISTERED}
        SELECT git_url, language FROM registered WHERE language IS NOT NULL""",
    "default_branch_name": """
        SELECT doc_id AS id, lang AS branch FROM documents
        UNION ALL SELECT -1 - (conv_id * 1000 + turn), role FROM conversations""",
    "files_for_language": f"""WITH {_LISTING}
        SELECT path, m.language FROM listing l JOIN main_language m ON m.git_url = l.git_url
        WHERE {_language(_suffix('path'))} = m.language""",
    "cascade_delete": f"""WITH {_FILES}, {_STORED_FUNCTIONS},
        gone AS (SELECT project_id FROM documents_as_files
                 WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
        SELECT DISTINCT 'projects' AS kind, project_id AS id FROM files
        WHERE project_id NOT IN (SELECT project_id FROM gone)
        UNION ALL
        SELECT 'files', id FROM files WHERE project_id NOT IN (SELECT project_id FROM gone)
        UNION ALL
        SELECT 'functions', id FROM functions WHERE file_id NOT IN (
            SELECT id FROM files WHERE project_id IN (SELECT project_id FROM gone))""",
    "upsert_files": f"""WITH {_BOTH_FILES}
        SELECT cast(id AS BIGINT) AS id, project_id, path, checksum, body, summary,
               CASE WHEN scanned THEN '2024-01-01' ELSE '2023-01-01' END AS last_updated FROM merged""",
    "stale_files": f"""WITH {_BOTH_FILES}
        SELECT project_id, path FROM merged WHERE scanned AND (summary IS NULL OR changed)""",
    "stale_files_compat": f"""WITH {_BOTH_FILES}
        SELECT project_id, path FROM merged WHERE scanned AND summary IS NULL""",
    "enrich_files": f"""WITH {_BOTH_FILES}, enriched AS (
            SELECT path, scanned, scanned AND (summary IS NULL OR changed) AS stale,
                   CASE WHEN scanned AND (summary IS NULL OR changed)
                        THEN {_sentences('body', 8)} ELSE summary END AS summary
            FROM merged),
        {_vector_sums('enriched', 'path')}
        SELECT path, summary, {_fts("path || ' ' || coalesce(summary, '')")} AS fts,
               CASE WHEN stale THEN coalesce(vector_sum, 0) END AS vector_sum,
               CASE WHEN scanned THEN '2024-01-01' ELSE '2023-01-01' END AS last_updated
        FROM enriched LEFT JOIN vector_sums USING (path)""",
    "fts_files": f"WITH {_FILE_WORDS} SELECT * FROM words",
    "fts_functions": f"""WITH {_STORED_FUNCTIONS},
        {_words('functions', "name || ' ' || coalesce(summary, '')")} SELECT * FROM words""",
    "add_body_column": f"""WITH {_STORED_FILES}
        SELECT doc_id AS id, path, NULL::VARCHAR AS body FROM documents_as_files
        UNION ALL SELECT id, path, body FROM stored""",
    "diff_functions": f"WITH {_DIFF} SELECT * FROM diff",
    "diff_counts": f"WITH {_DIFF} SELECT change, count(*) AS functions FROM diff GROUP BY change",
    "apply_functions": f"""WITH {_DIFF},
        new_ids AS (SELECT file_id, start_line, (SELECT max(id) FROM functions)
                           + {_numbered('file_id', 'start_line')} AS id
                    FROM diff WHERE change = 'new'),
        next AS (
            SELECT f.id, file_id, start_line, name, signature, end_line, checksum, summary,
                   '2023-01-01' AS last_updated
            FROM functions f LEFT JOIN diff d USING (file_id, start_line)
            WHERE d.change IS NULL OR d.change IN ('unchanged', 'new')
            UNION ALL
            SELECT coalesce(i.id, o.id), n.file_id, n.start_line, n.name, n.name || '()', n.start_line,
                   n.checksum, NULL, '2024-01-01'
            FROM extracted n JOIN diff d USING (file_id, start_line)
            LEFT JOIN new_ids i USING (file_id, start_line)
            LEFT JOIN functions o USING (file_id, start_line)
            WHERE d.change IN ('new', 'changed'))
        SELECT cast(id AS BIGINT) AS id, file_id, start_line, name, signature, end_line, checksum,
               summary, {_fts("name || ' ' || coalesce(summary, '')")} AS fts, last_updated FROM next""",
    "dedup_same_line": """
        SELECT conv_id AS file_id, cast(turn // 2 AS INTEGER) AS start_line,
               cast(turn AS INTEGER) AS ordinal, text AS body FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id, turn // 2 ORDER BY turn DESC) = 1""",
    "language_gate": f"""WITH {_DOCUMENTS}, known AS (
            SELECT doc_id AS file_id, {_counted('path')} AS language FROM documents_as_files)
        SELECT * FROM known WHERE language IN ('Python', 'JavaScript', 'TypeScript')""",
    "stale_functions": f"""WITH {_FILES}, {_STORED_FUNCTIONS}
        SELECT fn.id, f.path, fn.name, fn.body FROM functions fn JOIN files f ON f.id = fn.file_id
        WHERE fn.summary IS NULL OR fn.name NOT LIKE 'user%'""",
    "enrich_functions": f"""WITH {_STORED_FUNCTIONS}, enriched AS (
            SELECT id, name, CASE WHEN stale THEN {_sentences('body', 3)} WHEN name LIKE 'user%' THEN summary
                             END AS summary, stale
            FROM (SELECT *, (name NOT LIKE 'user%' OR summary IS NULL)
                            AND file_id IN (SELECT doc_id FROM documents) AS stale FROM functions)),
        {_vector_sums('enriched', 'id')}
        SELECT id, summary, {_fts("name || ' ' || coalesce(summary, '')")} AS fts,
               CASE WHEN stale THEN coalesce(vector_sum, 0) END AS vector_sum,
               CASE WHEN stale THEN '2024-01-01' ELSE '2023-01-01' END AS last_updated
        FROM enriched LEFT JOIN vector_sums USING (id)""",
    "duplicate_keys": """SELECT sha256(text) AS checksum, count(*) AS copies FROM documents
        GROUP BY 1 HAVING count(*) > 1""",
    "assign_ids": f"""WITH {_DOCUMENTS}
        SELECT path, cast(7 + {_numbered('path')} AS BIGINT) AS id FROM documents_as_files""",
    "extract_definitions": f"""WITH {_FOUND}
        SELECT *, rtrim(split_part(body, {_NEW_LINE}, 1)) AS signature, sha256(body) AS checksum
        FROM found""",
    "indexed_functions": f"""WITH {_DOCUMENTS}, {_FOUND},
        counted AS (
            SELECT git_url, {_counted('path')} AS language, count(*) AS files, min(path) AS first_path
            FROM documents_as_files GROUP BY 1, 2),
        main_language AS (
            SELECT git_url, language FROM counted
            QUALIFY row_number() OVER (PARTITION BY git_url ORDER BY files DESC, first_path) = 1),
        indexed AS (
            SELECT d.path, f.*, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
                                     THEN 1 ELSE 0 END AS shift
            FROM documents_as_files d JOIN main_language m ON m.git_url = d.git_url
            JOIN found f ON f.file_id = d.doc_id * 2 + CASE d.lang WHEN 'en' THEN 0 ELSE 1 END
            WHERE m.language = {_counted('path')} AND m.language IN ('Python', 'JavaScript', 'TypeScript'))
        SELECT path, name, cast(start_line + shift AS INTEGER) AS start_line,
               cast(end_line + shift AS INTEGER) AS end_line, sha256(body) AS checksum,
               CASE WHEN shift = 1 THEN '2024-01-01' ELSE '2023-01-01' END AS last_updated
        FROM indexed""",
    "summarize_lead": f"""SELECT doc_id, {_sentences('text', 8)} AS file_summary,
        {_sentences('text', 3)} AS function_summary FROM documents""",
    "embed_hashing": _hashed("documents", "doc_id"),
    "query_embedding": _hashed("benchmark", "item_id"),
    "analyze_terms": f"WITH {_TEXT_WORDS} SELECT * FROM words",
    "analyze_terms_english": f"""WITH {_DOCUMENTS},
        {english.tokens('documents_as_files', 'doc_id', "path || ' ' || text")},
        words AS (SELECT * FROM tokens WHERE t NOT IN ({_STOPS})), {english.stems('words')}
        SELECT doc_id AS id, stem AS term, cast(pos AS INTEGER) AS pos FROM words JOIN stems USING (t)""",
    "postings": f"""WITH {_DOCUMENTS}, {_TEXT_WORDS}
        SELECT term, id, project_id, string_agg(pos, ',' ORDER BY pos) AS positions
        FROM words JOIN documents_as_files ON doc_id = id GROUP BY term, id, project_id""",
    "postings_after_change": f"""WITH kept AS (
            SELECT * REPLACE (CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
                THEN text || ' Edited tion' ELSE text END AS text)
            FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
        {_DOCUMENTS.replace('FROM documents', 'FROM kept')}, {_TEXT_WORDS.replace('FROM documents', 'FROM kept')}
        SELECT term, id, project_id, string_agg(pos, ',' ORDER BY pos) AS positions
        FROM words JOIN documents_as_files ON doc_id = id GROUP BY term, id, project_id""",
    "unchanged_projects": """
        WITH pairs AS (
            SELECT cast(substr(source, 4) AS BIGINT) AS project_id, text,
                CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND quality = 0)
                    THEN 'Edited. ' || text ELSE text END AS new_text FROM documents)
        SELECT project_id, count(*) AS files, count(*) FILTER (new_text <> text) = 0 AS unchanged
        FROM pairs GROUP BY project_id""",
    "web_query": f"""
        WITH split AS (SELECT item_id, {_tokens('text')} AS w FROM benchmark),
        asked AS (SELECT * FROM split),
        parts AS (
            SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS place,
                   false AS negated, false AS phrase, 0 AS shift FROM asked
            UNION ALL SELECT item_id, w[1], len(w) + 1, false, true, 0 FROM asked
            UNION ALL SELECT item_id, w[2], len(w) + 1, false, true, 1 FROM asked
            UNION ALL SELECT item_id, w[3], len(w) + 2, true, false, 0 FROM asked),
        placed AS (
            SELECT *, sum(CASE WHEN word = 'or' AND NOT phrase AND NOT negated THEN 1 ELSE 0 END)
                OVER (PARTITION BY item_id ORDER BY place) AS alternative FROM parts WHERE word IS NOT NULL),
        kept AS (SELECT * FROM placed WHERE word NOT IN ({_STOPS})
                 AND NOT (word = 'or' AND NOT phrase AND NOT negated))
        SELECT item_id, cast(alternative AS INTEGER) AS alternative,
               cast(dense_rank() OVER (PARTITION BY item_id ORDER BY place) - 1 AS INTEGER) AS clause,
               negated, phrase, word AS term,
               cast(shift - min(shift) OVER (PARTITION BY item_id, place) AS INTEGER) AS "offset"
        FROM kept""",
    "keyword_match_and": f"WITH {_TEXT_WORDS}, {_all_of('tion', 'thre')} {_SCORES}",
    "keyword_match_or": f"WITH {_TEXT_WORDS}, {_any_of('tion', 'thre')} {_SCORES}",
    "keyword_match_not": f"WITH {_TEXT_WORDS}, {_NOT} {_SCORES}",
    "keyword_match_phrase": f"WITH {_TEXT_WORDS}, {_PHRASE} {_SCORES}",
    "cover_density_rank": f"WITH {_TEXT_WORDS}, {_all_of('tion', 'thre', 'ther')} {_SCORES}",
    "keyword_topk": f"WITH {_TEXT_WORDS}, {_all_of('tion', 'thre')} {_TOP}",
    "keyword_topk_postings": f"WITH {_TEXT_WORDS}, {_all_of('tion', 'thre')} {_TOP}",
    "cosine_distance": f"""WITH {_FILES}
        SELECT id, round(list_cosine_distance(embedding::DOUBLE[], {_QUERY_VECTOR}), 6) AS distance
        FROM files WHERE embedding IS NOT NULL""",
    "vectors_present": f"WITH {_FILES} SELECT id FROM files WHERE embedding IS NOT NULL",
    "semantic_topk": f"""WITH {_FILES}, distances AS (
            SELECT id, list_cosine_distance(embedding::DOUBLE[], {_QUERY_VECTOR}) AS distance
            FROM files WHERE embedding IS NOT NULL)
        SELECT id, cast(row_number() OVER (ORDER BY distance, id) AS INTEGER) AS rank FROM distances
        ORDER BY rank LIMIT 20""",
    "rrf_fusion": f"""WITH {_FILE_WORDS}, {_all_of('attion', 'anea')}, {_fused('files', 'true', 10, 60)}
        SELECT id, round(score, 9) AS rrf_score FROM combined""",
    "fused_topk": f"""WITH {_FILE_WORDS}, {_all_of('attion', 'anea')}, {_fused('files', 'true', 10, 60)}
        SELECT id, round(score, 9) AS rrf_score FROM combined ORDER BY score DESC, id LIMIT 10""",
    "hybrid_search_files": f"WITH {_file_search()} {_ROUNDED}",
    "hybrid_search_files_project": f"WITH {_file_search('project_id = 3', 5, 10)} {_ROUNDED}",
    "hybrid_search_files_file": f"WITH {_file_search('id = 0')} {_ROUNDED}",
    "hybrid_search_functions": _function_search(10),
    "sql_table_function": f"WITH {_file_search()} {_ROUNDED}",
    "sql_table_function_functions": _function_search(5),
    "format_results": f"""WITH {_file_search()}, ranked AS (
            SELECT *, cast(row_number() OVER (ORDER BY rrf_score DESC, id) AS INTEGER) AS rank FROM found)
        SELECT rank, printf('%2d. [%.4f] (project %d) %s', rank, rrf_score, project_id, path) AS line,
               CASE WHEN summary <> '' THEN '    ' || substr(summary, 1, 120) || '...' END AS summary_line
        FROM ranked""",
}

ORACLES["semantic_topk_pruned"] = ORACLES["semantic_topk"]
ORACLES["carried_enrichment"] = f"""WITH {_STORED_FUNCTIONS},
    coming AS (
        SELECT file_id, checksum, start_line + 1 AS start_line FROM functions WHERE name NOT LIKE 'system%'
        UNION ALL SELECT file_id, checksum, start_line + 101 FROM functions WHERE name LIKE 'user%'),
    old_places AS (
        SELECT *, row_number() OVER (PARTITION BY file_id, checksum ORDER BY start_line) AS place FROM functions),
    new_places AS (
        SELECT *, row_number() OVER (PARTITION BY file_id, checksum ORDER BY start_line) AS place FROM coming)
    SELECT n.file_id, cast(n.start_line AS INTEGER) AS start_line, o.summary,
        {_fts("o.name || ' ' || o.summary")} AS fts
    FROM new_places n JOIN old_places o USING (file_id, checksum, place) WHERE o.summary IS NOT NULL"""

#: From each start: the first end up to which one of both alternatives holds, then the latest beginning
#: that still holds. The next cover is looked for behind that beginning, and none after a start without an end.
ORACLES["cover_density_exclusion"] = f"""WITH RECURSIVE {_TEXT_WORDS},
    hits AS (
        SELECT id, pos, term, row_number() OVER (PARTITION BY id ORDER BY pos) AS i
        FROM words WHERE term IN ('tion', 'thre', 'ther', 'ble', 'ing')),
    around AS (
        SELECT id, pos, i,
            min(i) FILTER (term = 'tion') OVER ahead AS tion, min(i) FILTER (term = 'thre') OVER ahead AS thre,
            coalesce(min(i) FILTER (term = 'ther') OVER ahead, 1e9) AS ther,
            min(i) FILTER (term = 'ble') OVER ahead AS ble, coalesce(min(i) FILTER (term = 'ing') OVER ahead, 1e9) AS ing,
            max(i) FILTER (term = 'tion') OVER back AS last_tion, max(i) FILTER (term = 'thre') OVER back AS last_thre,
            coalesce(max(i) FILTER (term = 'ther') OVER back, 0) AS last_ther,
            max(i) FILTER (term = 'ble') OVER back AS last_ble, coalesce(max(i) FILTER (term = 'ing') OVER back, 0) AS last_ing
        FROM hits WINDOW ahead AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
            back AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    edges AS (
        SELECT id, pos, i,
            least(CASE WHEN tion IS NOT NULL AND thre IS NOT NULL AND greatest(tion, thre) < ther
                THEN greatest(tion, thre) END, CASE WHEN ble < ing THEN ble END) AS stop,
            greatest(CASE WHEN last_tion IS NOT NULL AND last_thre IS NOT NULL AND least(last_tion, last_thre) > last_ther
                THEN least(last_tion, last_thre) END, CASE WHEN last_ble > last_ing THEN last_ble END) AS begin_
        FROM around),
    windows AS (
        SELECT s.id, s.i, e.begin_ + 1 AS following,
            0.1::DOUBLE / (1 + (e.pos - b.pos) - (e.i - b.i)) AS score
        FROM edges s JOIN edges e ON e.id = s.id AND e.i = s.stop JOIN edges b ON b.id = s.id AND b.i = e.begin_),
    covers AS (
        SELECT id, following, score FROM windows WHERE i = 1
        UNION ALL
        SELECT w.id, w.following, w.score FROM covers c JOIN windows w ON w.id = c.id AND w.i = c.following),
    matching AS (
        SELECT id FROM hits GROUP BY id
        HAVING bool_or(term = 'tion') AND bool_or(term = 'thre') AND NOT bool_or(term = 'ther')
            OR bool_or(term = 'ble') AND NOT bool_or(term = 'ing')),
    scores AS (SELECT id, sum(score) AS score FROM covers JOIN matching USING (id) GROUP BY id)
    {_SCORES}"""
ORACLES["analyze_terms_markup"] = f"""WITH {english.markup_tokens('pages', 'page_id', "coalesce(url, '') || ' ' || coalesce(html, '')")},
    words AS (SELECT * FROM tokens WHERE t NOT IN ({_STOPS})), {english.stems('words')}
    SELECT page_id AS id, stem AS term, cast(pos AS INTEGER) AS pos FROM words JOIN stems USING (t)"""
ORACLES["keyword_topk_bounded"] = ORACLES["keyword_topk"]
