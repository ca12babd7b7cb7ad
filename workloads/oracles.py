"""The same answers as plain SQL for DuckDB, written from the rules rather than from the plans."""

from __future__ import annotations

from workloads.derive import CYRILLIC, LATIN
from workloads.queries import NOW, RUN_CAP
from workloads.stubs import SYSTEM

# Fixed values, spelled out here so that an error in the engine's own lists shows.
BLOCK_TAGS = """address article aside blockquote body center dd details div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot
th thead tr ul""".split()
CATEGORIES = """News Business Technology Sports Fashion Agriculture Video Entertainment Science Health
Politics""".split()
BLANKS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
COMPACT_PROBE_ENDINGS = [".com", ".net", ".org", ".ua", ".info"]
PROBE_ENDINGS = [".com.ua", ".ua", ".com", ".net", ".org", ".media", ".online"]
TITLE_ENDINGS = "com.ua org.ua net.ua in.ua com net org ua info media online news".split()
STOP_WORDS = "the a an of and or in at by на для та і в з до".split()
ONE_LETTER = {
    "а": "a", "б": "b", "в": "v", "г": "h", "ґ": "g", "д": "d", "е": "e", "з": "z", "и": "y", "і": "i",
    "ї": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f",
}
MANY_LETTERS = {
    "є": "ie", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "yu", "я": "ya",
}

_ENDING = "(?is)^(.*?)(\\.(?:" + "|".join(e.replace(".", "\\.") for e in TITLE_ENDINGS) + "))\\n?$"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g')"


def _letters(x: str, keep: str, blanks: str, without: str = "") -> str:
    pairs = {k: v for k, v in (ONE_LETTER | MANY_LETTERS).items() if k not in without}
    table = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in pairs.items()) + "}"
    spelled = (
        f"[CASE WHEN {table}[c] IS NOT NULL THEN {table}[c] WHEN regexp_matches(c, '^[{keep}]$') THEN c "
        f"WHEN c IN ({blanks}) THEN '-' ELSE '' END FOR c IN regexp_extract_all(lower({x}), '(?s).')]"
    )
    return f"trim(regexp_replace(array_to_string({spelled}, ''), '-{{2,}}', '-', 'g'), '-')"


def latin(x: str) -> str:
    return _letters(x, "a-z0-9_-", "' ', chr(9)")


def short(x: str) -> str:
    return f"left({_letters(x, 'a-z0-9-', chr(39) + ' ' + chr(39), 'ґ')}, 40)"


def spelled_url(x: str) -> str:
    tld = f"regexp_extract({x}, '{_ENDING}', 2)"
    base = latin(strip(f"regexp_extract({x}, '{_ENDING}', 1)"))
    return f"CASE WHEN {tld} <> '' AND {base} <> '' THEN 'https://' || {base} || {tld} END"


def slug_base(x: str) -> str:
    clean = f"CASE WHEN regexp_matches({x}, '{_ENDING}') THEN regexp_extract({x}, '{_ENDING}', 1) ELSE {x} END"
    words = (
        f"[w FOR w IN regexp_split_to_array({strip(clean)}, '[{BLANKS}_-]+') "
        f"IF w <> '' AND NOT list_contains({_list(STOP_WORDS)}, lower(w))]"
    )
    return latin(f"array_to_string(({words})[1:3], '')")


def slug_urls(x: str) -> str:
    return (
        f"CASE WHEN {slug_base(x)} <> '' THEN ['https://' || {slug_base(x)} || e FOR e IN {_list(PROBE_ENDINGS)}] "
        "ELSE [] END"
    )


def compact_urls(x: str) -> str:
    words = (
        f"[w FOR w IN regexp_split_to_array(lower({x}), '[{BLANKS}]+') "
        f"IF NOT list_contains({_list(STOP_WORDS)}, w)]"
    )
    compact = f"regexp_replace(array_to_string(({words})[1:3], ''), '[^a-z0-9]', '', 'g')"

    def urls(base: str) -> str:
        return f"['https://' || {base} || e FOR e IN {_list(COMPACT_PROBE_ENDINGS)}]"

    return (
        f"list_concat(CASE WHEN {compact} <> '' THEN {urls(compact)} ELSE [] END, "
        f"CASE WHEN {short(x)} <> '' AND {short(x)} <> {compact} THEN {urls(short(x))} ELSE [] END)"
    )


def _long_lines(x: str) -> str:
    """Lines of more than 40 characters, as the paragraphs of a page give them."""
    return f"left(array_to_string([p FOR p IN [{strip('q')} FOR q IN string_split({x}, chr(10))] IF length(p) > 40], ' '), 3000)"


_W = "string_split(text, ' ')"

# Named building blocks; each may use those before it.
PARTS = {
    "items": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string({_W}[1:4], ' ') AS title,
          CASE lang WHEN 'en' THEN NULL WHEN 'es' THEN '' ELSE text END AS description,
          CASE lang WHEN 'de' THEN 'Technology' ELSE 'Cooking' END AS category,
          {_W}[5:8] AS tags, {_W}[9:10] AS interests, {_W}[11:13] AS coverage,
          CASE WHEN lang = 'fr' THEN {_W}[14:15] END AS topics,
          source AS format_type, lang AS language,
          TIMESTAMP '2024-01-01' + to_minutes(CAST(floor(doc_id / 10) AS BIGINT)) AS created_at
        FROM documents""",
    "texts": """
        SELECT id, left(concat_ws('. ', nullif(title, ''), nullif(description, ''),
          'Category: ' || nullif(category, ''), 'Format: ' || nullif(format_type, ''),
          'Language: ' || nullif(language, ''),
          CASE WHEN len(tags) > 0 THEN 'Tags: ' || array_to_string(tags, ', ') END,
          CASE WHEN len(interests) > 0 THEN 'Audience interests: ' || array_to_string(interests, ', ') END,
          CASE WHEN len(coverage) > 0 THEN 'Geographic coverage: ' || array_to_string(coverage, ', ') END,
          CASE WHEN len(topics) > 0 THEN 'Content topics: ' || array_to_string(topics, ', ') END), 8000) AS text
        FROM items""",
    "label_ids": "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM labels",
    "outlets": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, text, lang, CASE n_chars % 4
          WHEN 0 THEN array_to_string({_W}[1:4], ' ')
          WHEN 1 THEN translate(lower(array_to_string({_W}[1:4], ' ')), '{LATIN}', '{CYRILLIC}')
          WHEN 2 THEN {_W}[1] || '.in.ua'
          ELSE 'The ' || array_to_string({_W}[1:2], ' ') || '.com' END AS title
        FROM documents""",
    "slug_inputs": """
        SELECT 'd' || id AS id, title FROM outlets
        UNION ALL SELECT 's' || s_suppkey, replace(s_name, '#', '_ ' || chr(9)) FROM supplier""",
    "names": "SELECT title AS name, count(*) AS copies FROM outlets GROUP BY title",
    "guesses": f"""
        SELECT name, {slug_urls('name')} AS slugs, {compact_urls('name')} AS compacts,
          {spelled_url('name')} AS spelled FROM names""",
    "url_status": """
        SELECT DISTINCT url, CASE WHEN length(url) % 3 = 0 THEN 200 ELSE 404 END AS status FROM (
          SELECT unnest(slugs) AS url FROM guesses UNION ALL SELECT unnest(compacts) FROM guesses
          UNION ALL SELECT spelled FROM guesses WHERE spelled IS NOT NULL)""",
    "wiki_hits": """
        SELECT l.lang, name AS query, r.rank, CASE WHEN (length(name) + r.rank) % 3 = 0
            THEN 'The ' || name || ' ' || r.rank ELSE split_part(name, ' ', 1) || ' ' || r.rank END AS title
        FROM names JOIN (VALUES ('uk', 0), ('uk', 1), ('en', 1), ('en', 2)) l(lang, m) ON length(name) % 4 = l.m,
          (SELECT unnest(range(1, 7)) AS rank) r""",
    "wiki_pages": """
        SELECT lang, title, CASE WHEN length(title) % 6 = 0 THEN -1 ELSE length(title) END AS page_id,
          CASE WHEN length(title) % 5 = 0 THEN '' ELSE '  ' || repeat(title || ' — ', 120) END AS extract,
          CASE WHEN length(title) % 4 <> 0 THEN 'Q' || length(title) END AS qid,
          'https://' || lang || '.wikipedia.org/wiki/' || replace(title, ' ', '_') AS fullurl
        FROM (SELECT DISTINCT lang, title FROM wiki_hits)""",
    "claims": """
        SELECT DISTINCT qid, CASE WHEN n % 4 = 1 THEN 'https://site' || n || '.example/' END AS website,
          CASE WHEN n % 4 = 1 THEN CAST(n + 1900 AS VARCHAR) WHEN n % 4 = 2 THEN NULL
            ELSE '-' || (n + 1000) END AS founding_year
        FROM (SELECT qid, CAST(substr(qid, 2) AS INTEGER) AS n FROM wiki_pages WHERE qid IS NOT NULL)""",
    "best_hits": """
        SELECT * FROM (SELECT query, lang, title, row_number() OVER (PARTITION BY query, lang
            ORDER BY CASE WHEN contains(lower(title), lower(query)) THEN 0 ELSE 1 END, rank) AS rn
          FROM wiki_hits WHERE rank <= 5) WHERE rn = 1""",
    "links": """
        SELECT name AS query,
          CASE WHEN length(name) % 3 = 0 THEN 'https://google.example/' || length(name) || '/1' END AS google,
          CASE WHEN length(name) % 5 IN (0, 1) THEN 'https://serp.example/' || length(name) || '/1' END AS serp
        FROM names""",
    "hit": f"""
        SELECT * FROM (SELECT b.query AS name, p.lang, {strip('p.extract')} AS whole, p.qid, p.fullurl,
            c.website, c.founding_year,
            row_number() OVER (PARTITION BY b.query ORDER BY CASE p.lang WHEN 'uk' THEN 0 ELSE 1 END) AS rn
          FROM best_hits b JOIN wiki_pages p ON b.lang = p.lang AND b.title = p.title AND p.page_id <> -1
          LEFT JOIN claims c ON p.qid = c.qid) WHERE rn = 1""",
    "probed": """
        SELECT name, min(CASE WHEN kind = 0 THEN g.url END) AS spelled,
          arg_min(g.url, pos) FILTER (WHERE kind = 1) AS guessed
        FROM (SELECT name, 0 AS kind, 0 AS pos, spelled AS url FROM guesses
              UNION ALL SELECT name, 1, unnest(range(1, len(slugs) + 1)), unnest(slugs) FROM guesses) g
        JOIN url_status u ON g.url = u.url AND u.status < 400 GROUP BY name""",
    "found": """
        SELECT n.name, n.copies, left(h.whole, 3000) AS extract, h.qid,
          CASE WHEN h.website IS NOT NULL THEN rtrim(h.website, '/')
            ELSE coalesce(p.spelled, h.fullurl, l.google, l.serp, p.guessed) END AS url,
          CASE WHEN h.website IS NOT NULL THEN 'wikidata' WHEN p.spelled IS NOT NULL THEN 'tld_in_name'
            WHEN h.fullurl IS NOT NULL THEN 'wikipedia_' || h.lang WHEN l.google IS NOT NULL THEN 'google'
            WHEN l.serp IS NOT NULL THEN 'serp' WHEN p.guessed IS NOT NULL THEN 'slug' ELSE 'none' END AS source,
          CASE WHEN h.website IS NOT NULL THEN h.founding_year END AS founding_year
        FROM names n LEFT JOIN hit h ON n.name = h.name LEFT JOIN probed p ON n.name = p.name
        LEFT JOIN links l ON n.name = l.query""",
    "sites": f"""
        SELECT base, arg_min(title, doc_id) AS title, arg_min(text, doc_id) AS text, arg_min(lang, doc_id) AS lang
        FROM (SELECT ({slug_urls('title')})[2] AS base, title, text, lang, doc_id FROM outlets)
        WHERE base IS NOT NULL GROUP BY base""",
    "abouts": f"""
        SELECT base, {_long_lines("title || chr(10) || text || chr(10) || text")} AS about_body
        FROM sites WHERE lang = 'en' AND length(base) % 2 = 0""",
    "feeds": """
        SELECT base, array_to_string(list_sort(list_distinct(
          [c FOR c IN [regexp_replace(w, '[^a-zA-Z]', '', 'g') FOR w IN string_split(text, ' ')] IF c <> '']))[1:15], '|') AS categories
        FROM sites WHERE lang IN ('de', 'en')""",
    "signals": f"""
        SELECT s.base AS url, s.title, CASE WHEN lang = 'fr' THEN s.title || ' media' END AS name,
          CASE WHEN lang = 'fr' THEN 'Says ' || s.title END AS description,
          CASE WHEN lang = 'es' THEN {strip("'About ' || s.title")} ELSE '' END AS og_desc,
          {strip('s.title')} AS page_title, {_long_lines('s.text')} AS body_text,
          CASE WHEN length(a.about_body) > length({_long_lines('s.text')}) THEN a.about_body END AS about_text,
          f.categories
        FROM sites s LEFT JOIN abouts a ON s.base = a.base LEFT JOIN feeds f ON s.base = f.base""",
    "contexts": """
        SELECT name, source, founding_year, CASE
          WHEN starts_with(source, 'wikipedia') AND extract <> '' THEN article
          WHEN url <> '' AND NOT starts_with(source, 'wikipedia') THEN
            CASE WHEN extract <> '' AND length(site) < 500 THEN article || chr(10) || chr(10) || site ELSE site END
          WHEN extract <> '' THEN article ELSE 'Outlet name: ' || name END AS context
        FROM (SELECT f.name, f.source, f.url, f.extract, f.founding_year,
            'Outlet name: ' || f.name || chr(10) || 'Wikipedia article:' || chr(10) || left(f.extract, 5900) AS article,
            left(concat_ws(chr(10), 'Outlet name: ' || f.name,
              CASE WHEN lower(s.name) <> lower(f.name) THEN 'Official name: ' || nullif(s.name, '') END,
              'Description: ' || coalesce(nullif(s.description, ''), nullif(s.og_desc, '')),
              coalesce('About: ' || nullif(s.about_text, ''), 'Content: ' || nullif(s.body_text, '')),
              'Content categories: ' || replace(nullif(s.categories, ''), '|', ', ')), 6000) AS site
          FROM found f LEFT JOIN signals s ON f.url = s.url)""",
    "answers": """
        SELECT name, source, founding_year, context, length(context) % 7 <> 0 AS ok FROM contexts""",
    "run_log": """
        SELECT CAST(event_id AS VARCHAR) AS id, 'user ' || user_id AS title,
          CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
          CASE WHEN event_type = 'error' THEN '' ELSE 'News' END AS category,
          CASE WHEN event_type = 'error' THEN '' ELSE '?' END AS tier, event_type AS source,
          CAST(floor(value * 10) AS INTEGER) AS context_chars,
          CASE WHEN event_type = 'error' THEN repeat(props, 12) || ' failed' ELSE '' END AS error,
          CASE WHEN event_type = 'error' THEN 3 ELSE 1 END AS attempts
        FROM events""",
    "vectors": """
        SELECT i.id, length(t.text) || '|' || (length(t.text) - length(replace(t.text, ' ', '')))
            || '|' || (length(t.text) - length(replace(t.text, '.', ''))) AS embedding
        FROM items i JOIN texts t ON i.id = t.id WHERE i.description IS NOT NULL""",
}

# The pages table holds its text in one <article>.
_BODY = f"""regexp_extract(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g'), '(?is)<article[^>]*>(.*?)</article>', 1)"""
_BLOCK_CUT = "(?is)</?(?:" + "|".join(BLOCK_TAGS) + ")\\b.*$"


def _decoded(x: str) -> str:
    for code, plain in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{code}', '{plain}')"
    return x


_NODES = (
    f"[n FOR n IN [{strip(_decoded('m'))} FOR m IN regexp_split_to_array(regexp_replace(q, '{_BLOCK_CUT}', ''), "
    "'<[^>]*>')] IF n <> '']"
)

SQL = {
    "unenriched_scan": ("items", "SELECT id, title FROM items WHERE description IS NULL"),
    "oldest_unenriched": (
        "items",
        f"SELECT id, title FROM items WHERE description IS NULL ORDER BY created_at, id LIMIT {RUN_CAP}",
    ),
    "unenriched_count": ("items", "SELECT count(*) AS unenriched FROM items WHERE description IS NULL"),
    "dispatch_estimate": (
        "items",
        f"SELECT count(*) AS unenriched, least(count(*), {RUN_CAP}) AS queued FROM items WHERE description IS NULL",
    ),
    "rerun_one": ("items", "SELECT id, title FROM items WHERE id = '7'"),
    "backlog": (
        "items",
        "SELECT (SELECT count(*) FROM items WHERE description IS NULL) AS unenriched, "
        "(SELECT count(*) FROM labels) AS pending",
    ),
    "embedding_fetch": (
        "items label_ids",
        "SELECT id, title, description, category, array_to_string(tags, '|') AS tags, format_type, language "
        "FROM items WHERE description IS NOT NULL AND id IN (SELECT id FROM label_ids)",
    ),
    "embedding_text": ("items texts", "SELECT id, text FROM texts"),
    "latin_slug": ("outlets slug_inputs", f"SELECT id, {latin('title')} AS slug FROM slug_inputs"),
    "slug_variant_b": ("outlets slug_inputs", f"SELECT id, {short('title')} AS slug FROM slug_inputs"),
    "tld_from_name": (
        "outlets",
        f"SELECT id, {spelled_url('title')} AS url FROM (SELECT 'd' || id AS id, title FROM outlets UNION ALL "
        "SELECT 'p' || page_id, regexp_extract(url, 'https?://([^/]*)', 1) FROM pages)",
    ),
    "slug_candidates": (
        "outlets",
        f"SELECT id, CAST(p - 1 AS INTEGER) AS position, urls[p] AS url FROM (SELECT id, urls, unnest(range(1, len(urls) + 1)) AS p "
        f"FROM (SELECT id, {slug_urls('title')} AS urls FROM outlets))",
    ),
    "candidates_variant_b": (
        "outlets",
        "SELECT id, array_to_string(urls, '|') AS urls, urls[1] AS unprobed "
        f"FROM (SELECT id, {compact_urls('title')} AS urls FROM outlets)",
    ),
    "first_reachable": (
        "outlets names guesses url_status",
        "SELECT name, arg_min(g.url, pos) AS url FROM (SELECT name, unnest(range(1, len(compacts) + 1)) AS pos, "
        "unnest(compacts) AS url FROM guesses) g JOIN url_status u ON g.url = u.url AND u.status < 400 GROUP BY name",
    ),
    "wiki_best_hit": (
        "outlets names wiki_hits best_hits",
        "SELECT query, max(title) FILTER (WHERE lang = 'uk') AS uk, max(title) FILTER (WHERE lang = 'en') AS en "
        "FROM best_hits GROUP BY query",
    ),
    "entity_claims": ("outlets names wiki_hits wiki_pages claims", "SELECT qid, website, founding_year FROM claims"),
    "encyclopedia_pages": (
        "outlets names wiki_hits wiki_pages",
        f"SELECT lang, title AS hit_title, qid, fullurl, left({strip('extract')}, 3000) AS extract "
        "FROM wiki_pages WHERE page_id <> -1",
    ),
    "search_links": (
        "outlets names links",
        "SELECT query, google, serp FROM links WHERE google IS NOT NULL OR serp IS NOT NULL",
    ),
    "discovery_chain": (
        "outlets names guesses url_status wiki_hits wiki_pages claims best_hits links hit probed found",
        "SELECT name, copies, url, extract, qid, source, founding_year FROM found",
    ),
    "page_lookup": (
        "",
        "SELECT page_id, url, CASE WHEN length(html) % 7 <> 0 THEN md5(html) END AS body_md5, "
        "CAST(CASE WHEN length(html) % 7 <> 0 THEN length(html) END AS INTEGER) AS body_chars FROM pages",
    ),
    "about_lookup": ("outlets sites abouts", "SELECT base, about_body FROM abouts"),
    "feed_lookup": ("outlets sites feeds", "SELECT base, categories FROM feeds"),
    "page_title": (
        "",
        "SELECT page_id, " + strip(_decoded("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")) + " AS title FROM pages",
    ),
    "page_meta": ("outlets sites abouts feeds signals", "SELECT url AS base, og_desc FROM signals"),
    "page_body": (
        "",
        f"""SELECT page_id, left(array_to_string([array_to_string(ns, ' ') FOR ns IN [{_NODES} FOR q IN
        (regexp_split_to_array({_BODY}, '(?i)<p\\b[^>]*>'))[2:]] IF length(array_to_string(ns, '')) > 40], ' '), 3000) AS body FROM pages""",
    ),
    "jsonld_block": (
        "",
        "SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN s_name END AS name, "
        "CASE WHEN s_nationkey % 3 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS description FROM supplier",
    ),
    "feed_categories": (
        "",
        "SELECT p_partkey, CASE WHEN p_size % 2 <> 0 THEN p_type WHEN p_size % 5 = 0 THEN '' ELSE "
        "array_to_string(list_sort(list_distinct([w FOR w IN list_append(string_split(p_name, ' '), p_type)]))[1:15], '|') "
        "END AS categories FROM part",
    ),
    "site_signals": (
        "outlets sites abouts feeds signals",
        "SELECT url, name, description, og_desc, page_title, body_text, about_text, categories FROM signals WHERE page_title <> ''",
    ),
    "context_route": (
        "outlets names guesses url_status wiki_hits wiki_pages claims best_hits links hit probed found sites abouts feeds signals contexts",
        "SELECT name, source, context FROM contexts",
    ),
    "structure_validate": (
        "",
        f"""SELECT CAST(doc_id AS VARCHAR) AS id, ok AND n_chars % 7 <> 0 AS valid,
          CASE WHEN ok AND n_chars % 7 <> 0 THEN text END AS description,
          CASE WHEN ok AND lang = 'en' THEN 'Science' WHEN ok AND list_contains({_list(CATEGORIES)}, lang) THEN lang ELSE 'News' END AS category,
          CASE WHEN ok AND n_chars % 5 <> 0 THEN array_to_string({_W}[1:50], '|') ELSE '' END AS tags,
          CASE WHEN ok AND lang = 'fr' THEN '18-35' ELSE '25-44' END AS age_range,
          CASE WHEN ok AND lang = 'fr' THEN array_to_string({_W}[1:3], '|') ELSE '' END AS interests,
          CASE WHEN ok AND lang = 'fr' THEN lang ELSE 'unknown' END AS primary_language,
          CASE WHEN ok AND lang = 'fr' THEN NULL ELSE 'unknown' END AS geo,
          CASE WHEN ok AND n_chars % 3 <> 0 AND n_chars % 2 = 0 THEN array_to_string({_W}[1:2], ', ') ELSE '?' END AS coverage,
          CASE WHEN ok AND n_chars % 3 <> 0 AND n_chars % 4 = 0 THEN 'weekly' ELSE 'daily' END AS frequency,
          'Banner|Native' AS ad_formats,
          CASE WHEN ok AND n_chars % 3 <> 0 AND n_chars % 4 = 1 THEN 'strong' ELSE 'moderate' END AS presence,
          CASE WHEN ok AND n_chars % 3 <> 0 THEN '{{"custom":"' || source || '"}}' ELSE '{{}}' END AS extra
        FROM (SELECT *, n_chars % 11 <> 0 AS ok FROM documents)""",
    ),
    "model_messages": (
        "",
        "SELECT conv_id, turn, p AS position, CASE p WHEN 0 THEN 'system' ELSE 'user' END AS role, "
        "CASE p WHEN 0 THEN c.role ELSE c.text END AS content FROM conversations c, (VALUES (0), (1)) v(p)",
    ),
    "merge_items": (
        "items",
        f"""SELECT i.id, i.title, CASE WHEN u.id IS NULL THEN i.description WHEN u.lang = 'en' THEN 'new ' || u.seq END AS description,
          CASE WHEN u.id IS NULL THEN i.category ELSE 'Science' END AS category,
          CASE WHEN u.id IS NULL THEN array_to_string(i.tags, '|') ELSE 't|' || u.seq END AS tags,
          CASE WHEN u.id IS NULL THEN CAST(to_json(i.coverage) AS VARCHAR) END AS coverage,
          CASE WHEN u.id IS NOT NULL THEN '{NOW}' END AS updated_at
        FROM items i LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS id, lang, CASE WHEN n_chars % 2 = 0 THEN 2 ELSE 1 END AS seq
          FROM documents WHERE lang IN ('en', 'fr')) u ON i.id = u.id""",
    ),
    "merge_vectors": (
        "items",
        "SELECT i.id, CAST(len(e.embedding) AS INTEGER) AS dimension, "
        "CAST(round(list_sum([abs(CAST(x AS DOUBLE)) FOR x IN e.embedding]) * 1000) AS BIGINT) AS milli_sum, true AS untouched "
        "FROM items i LEFT JOIN embeddings e ON i.id = CAST(e.vec_id AS VARCHAR)",
    ),
    "requeue_missing": (
        "label_ids",
        "SELECT id FROM label_ids WHERE id NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)",
    ),
    "remaining_work": (
        "items label_ids",
        "SELECT id, title FROM items WHERE description IS NULL AND id NOT IN (SELECT id FROM label_ids)",
    ),
    "unit_vector": (
        "",
        "SELECT vec_id, CAST(p - 1 AS INTEGER) AS position, CAST(round(CAST(embedding[p] AS DOUBLE) / norm * 1e6) AS BIGINT) AS micro "
        "FROM (SELECT vec_id, embedding, sqrt(list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) FOR x IN embedding])) AS norm, "
        "unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)",
    ),
    "vector_literal": (
        "",
        "SELECT vec_id, '[' AS head, CAST(p - 1 AS INTEGER) AS position, CAST(round(CAST(printf('%.8f', CAST(embedding[p] AS DOUBLE)) AS DOUBLE) * 1e6) AS BIGINT) AS micro "
        "FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)",
    ),
    "batch_numbers": (
        "",
        "SELECT o_orderkey, n AS position, n // 50 AS wave, n // 100 AS batch FROM "
        "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS n FROM orders)",
    ),
    "run_totals": (
        "run_log",
        "SELECT count(*) AS processed, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'failed') AS failed, "
        "min(context_chars) FILTER (WHERE status = 'ok') AS min_chars, max(context_chars) FILTER (WHERE status = 'ok') AS max_chars, "
        "CAST(sum(context_chars) FILTER (WHERE status = 'ok') AS BIGINT) AS total_chars FROM run_log",
    ),
    "source_distribution": (
        "run_log",
        "SELECT source, count(*) AS n FROM run_log WHERE status = 'ok' GROUP BY source ORDER BY n DESC, source",
    ),
    "success_list": (
        "run_log",
        "SELECT id, title, category, tier, source, context_chars FROM run_log WHERE status = 'ok' ORDER BY source, id",
    ),
    "failed_list": (
        "run_log",
        "SELECT id, title, left(error, 80) AS error, attempts FROM run_log WHERE status = 'failed'",
    ),
    "quarantine": (
        "run_log",
        "SELECT id, title, 'structure' AS stage, error, attempts FROM run_log WHERE status = 'failed'",
    ),
    "model_structuring": (
        "",
        f"SELECT CAST(doc_id AS VARCHAR) AS id, ok AS valid, CASE WHEN ok THEN md5(text) END AS description_md5, "
        f"CASE WHEN ok THEN array_to_string({_W}[1:50], '|') ELSE '' END AS tags, "
        f"CASE WHEN ok AND len({_W}) > 2 THEN array_to_string({_W}[3:4], ', ') ELSE '?' END AS coverage "
        "FROM (SELECT *, length(text) % 7 <> 0 AS ok FROM documents)",
    ),
    "model_embedding": (
        "items texts label_ids vectors",
        "SELECT id, embedding, CAST(NULL AS VARCHAR) AS error FROM vectors WHERE id IN (SELECT id FROM label_ids)",
    ),
    "embedding_totals": (
        "items texts label_ids vectors",
        "SELECT count(*) AS written, CAST(0 AS BIGINT) AS failed FROM vectors WHERE id IN (SELECT id FROM label_ids)",
    ),
    "attempts_rerun": (
        "",
        "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN n > 3 THEN 'needs ' || n END AS error, CAST(least(n, 3) AS INTEGER) AS attempts "
        "FROM (SELECT doc_id, length(text) % 4 + 1 AS n FROM documents)",
    ),
    "enrich_job": (
        "outlets names guesses url_status wiki_hits wiki_pages claims best_hits links hit probed found sites abouts feeds signals contexts answers",
        """SELECT o.id, o.title, CASE WHEN o.lang = 'fr' THEN md5('done') WHEN a.ok THEN md5(a.context) END AS description_md5,
          CASE WHEN o.lang <> 'fr' AND a.ok THEN 'Science' ELSE 'old' END AS category,
          CASE WHEN o.lang <> 'fr' AND a.ok THEN CAST(least(len(string_split(a.context, ' ')), 50) AS INTEGER) END AS n_tags,
          CASE WHEN o.lang <> 'fr' AND a.ok THEN a.founding_year END AS founding_year,
          CASE WHEN o.lang <> 'fr' THEN CASE WHEN a.ok THEN 'ok' ELSE 'failed' END END AS status,
          CASE WHEN o.lang <> 'fr' THEN a.source END AS source,
          CASE WHEN o.lang <> 'fr' THEN CAST(length(a.context) AS INTEGER) END AS context_chars,
          CASE WHEN o.lang <> 'fr' THEN CASE WHEN a.ok THEN 1 ELSE 3 END END AS attempts,
          CASE WHEN o.lang <> 'fr' THEN CASE WHEN NOT a.ok THEN ''
            ELSE array_to_string(string_split(a.context, ' ')[3:4], ', ') END END AS tier
        FROM outlets o JOIN answers a ON o.title = a.name""",
    ),
    "pending_stream": (
        "items texts vectors",
        "SELECT id, embedding FROM vectors WHERE id IN (SELECT CAST(user_id AS VARCHAR) FROM events)",
    ),
    "count_or_time": ("", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events"),
}


# A run started again after its driver was lost gives the rows of a run that was not.
SQL["resumed_enrich_job"] = SQL["enrich_job"]


def oracle(name: str) -> str:
    parts, query = SQL[name]
    if not parts:
        return query
    head = ", ".join(f"{p} AS MATERIALIZED ({PARTS[p]})" for p in parts.split())
    return f"WITH {head} {query}"
