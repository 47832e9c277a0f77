"""The same queries in SQL for a second engine, from the same tables."""

from __future__ import annotations

# The tables of a data folder.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]

# Expected types by kind of file, written out as in the table of kinds.
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
PPTX = "application/vnd.openxmlformats-officedocument.presentationml.presentation"

MAGIC_BY_KIND = """CASE doc_id % 20
  WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/pdf'
  WHEN 2 THEN 'application/zip' WHEN 3 THEN 'application/zip' WHEN 4 THEN 'application/zip'
  WHEN 5 THEN 'application/zip' WHEN 6 THEN 'application/zip'
  WHEN 7 THEN 'image/png' WHEN 8 THEN 'image/jpeg' WHEN 9 THEN 'image/gif' WHEN 10 THEN 'application/gzip'
  WHEN 11 THEN 'application/x-tika-msoffice' WHEN 12 THEN 'audio/mpeg' WHEN 13 THEN 'application/mp4' END"""

EXTENSION_BY_KIND = """CASE doc_id % 20
  WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt' WHEN 2 THEN '.zip' WHEN 3 THEN '.bin' WHEN 4 THEN '' WHEN 5 THEN '.zip'
  WHEN 6 THEN '.epub' WHEN 7 THEN '.png' WHEN 8 THEN '.jpg' WHEN 9 THEN '.gif' WHEN 10 THEN '.tar.gz'
  WHEN 11 THEN '.bin' WHEN 12 THEN '.mp3' WHEN 13 THEN '.mp4' WHEN 14 THEN '.xml' WHEN 15 THEN '.xml'
  WHEN 16 THEN '' WHEN 17 THEN '.csv' WHEN 18 THEN '.md' ELSE '' END"""

GLOB_BY_KIND = """CASE doc_id % 20
  WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/plain' WHEN 2 THEN 'application/zip' WHEN 5 THEN 'application/zip'
  WHEN 6 THEN 'application/epub+zip' WHEN 7 THEN 'image/png' WHEN 8 THEN 'image/jpeg' WHEN 9 THEN 'image/gif'
  WHEN 10 THEN 'application/gzip' WHEN 12 THEN 'audio/mpeg' WHEN 13 THEN 'video/mp4'
  WHEN 14 THEN 'application/xml' WHEN 15 THEN 'application/xml' WHEN 17 THEN 'text/csv'
  WHEN 18 THEN 'text/x-web-markdown' END"""

TYPE_BY_KIND = f"""CASE doc_id % 20
  WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'application/zip'
  WHEN 3 THEN '{DOCX}' WHEN 4 THEN '{XLSX}' WHEN 5 THEN '{PPTX}' WHEN 6 THEN 'application/epub+zip'
  WHEN 7 THEN 'image/png' WHEN 8 THEN 'image/jpeg' WHEN 9 THEN 'image/gif' WHEN 10 THEN 'application/gzip'
  WHEN 11 THEN 'application/x-tika-msoffice' WHEN 12 THEN 'audio/mpeg' WHEN 13 THEN 'video/mp4'
  WHEN 14 THEN 'application/xml' WHEN 15 THEN 'application/xml' WHEN 16 THEN 'text/html'
  WHEN 17 THEN 'text/csv' WHEN 18 THEN 'text/x-web-markdown' ELSE 'application/octet-stream' END"""

CUSTOM_BY_KIND = f"CASE WHEN doc_id % 20 = 18 THEN 'text/markdown' ELSE {TYPE_BY_KIND} END"

# Text of these kinds starts with the row's own text; control characters decide on text or bytes.
CONTROL = r"[\x00-\x08\x0E-\x1A\x1C-\x1F]"
SNIFF_BY_KIND = f"""CASE
  WHEN doc_id % 20 IN (14, 15) THEN 'application/xml'
  WHEN doc_id % 20 = 16 THEN 'text/html'
  WHEN doc_id % 20 IN (3, 4, 5, 6, 7, 10, 11, 13, 19) THEN 'application/octet-stream'
  WHEN doc_id % 20 = 8 THEN CASE WHEN regexp_matches(text, '{CONTROL}') THEN 'application/octet-stream'
                                 ELSE 'text/plain' END
  WHEN NOT contains(text, chr(0)) THEN 'text/plain'
  ELSE 'application/octet-stream' END"""

FILE_NAME = r"regexp_extract({0}, '([^/\\?#]*)(?:[?#].*)?$', 1)"
PAGE_GLOB = """CASE lower(regexp_extract(""" + FILE_NAME.format("url") + r""", '\.([^.\s]+)$', 1))
  WHEN 'html' THEN 'text/html' WHEN 'htm' THEN 'text/html' WHEN 'txt' THEN 'text/plain'
  WHEN 'xml' THEN 'application/xml' WHEN 'pdf' THEN 'application/pdf' WHEN 'js' THEN 'application/javascript'
  WHEN 'css' THEN 'text/css' WHEN 'json' THEN 'application/json' END"""

NEWLINES = "replace(replace({0}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def _collapse(text: str) -> str:
    text = rf"regexp_replace({text}, '[ \t\f\r\x{{A0}}]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({text}, '^[ \n]+|[ \n]+\z', '', 'g')"


def _entities(text: str) -> str:
    """Named references that the tables hold; the ampersand comes last."""
    named = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("nbsp", " "), ("copy", "©"),
             ("middot", "·"), ("reg", "®"), ("hellip", "…"), ("mdash", "—"), ("ndash", "–")]
    for name, char in named:
        text = f"replace({text}, '&{name};', '{char}')"
    return f"replace({text}, '&amp;', '&')"


def _html_text(html: str) -> str:
    text = (r"regexp_replace(" + html + r", '(?is)<!--.*?(?:-->|\z)|<script[^>]*>.*?(?:</script\s*>|\z)"
            r"|<style[^>]*>.*?(?:</style\s*>|\z)|<title[^>]*>.*?(?:</title\s*>|\z)', '', 'g')")
    text = (r"regexp_replace(" + text + r", '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt"
            r"|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table"
            r"|tbody|td|tfoot|th|thead|tr|ul)(?:[\s/][^>]*)?(?:>|\z)', chr(10), 'g')")
    text = rf"regexp_replace({text}, '(?s)<[a-zA-Z/!?][^>]*(?:>|\z)', '', 'g')"
    return _collapse(_entities(text))


HTML = NEWLINES.format("html")
TITLE = ("nullif(trim(" + _entities(r"regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)(?:</title\s*>|\z)', 1), "
                                    r"'\s+', ' ', 'g')") + "), '')")
LANGUAGE = r"""nullif(regexp_extract(html, '(?is)<html\s[^>]*lang\s*=\s*"([^"]*)"', 1), '')"""

# Letters that stand for a, e and o in four charsets, and the charsets' names.
LETTERS = {"windows-1251": "щжй", "ISO-8859-2": "šžč", "windows-1252": "€’ß", "Shift_JIS": "あ漢カ"}


def _foreign(text: str, number: str) -> str:
    ascii_part = rf"regexp_replace({text}, '[^\x00-\x7F]', '', 'g')"
    cases = " ".join(f"WHEN {k} THEN translate({ascii_part}, 'aeo', '{v}')" for k, v in enumerate(LETTERS.values()))
    return f"CASE {number} {cases} END"


CHARSET_OF = "CASE {0} " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(LETTERS)) + " END"

# Pages as files: four of five start with a declared charset and end with a paragraph in it.
DECLARED_PAGES = rf"""declared AS (SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN html ELSE
  '<!DOCTYPE html><meta charset="' || {CHARSET_OF.format('page_id % 5 - 1')} || '">' || regexp_replace(html, '[^\x00-\x7F]', '', 'g')
  || '<p>' || {_foreign("'one more'", 'page_id % 5 - 1')} || '</p>' END AS html FROM pages)"""

XML_CLEAN = (r"regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g')")
PACKAGE_CLEAN = (r"regexp_replace(text, '[\x00-\x08\x0B\x0C\x0D\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g')")

FOLDED = (r"regexp_replace('_' || regexp_replace(lower(text), '[^\p{L}]+', '_', 'g') || '_', '__+', '_', 'g')")

GRAMS = rf"""
folded AS (SELECT doc_id, lang, text, {FOLDED} AS f FROM documents WHERE text IS NOT NULL),
grams AS (
  SELECT doc_id, lang, unnest(list_concat(list_concat(
    regexp_extract_all(f, '...'), regexp_extract_all(substr(f, 2), '...')),
    regexp_extract_all(substr(f, 3), '...'))) AS gram FROM folded),
counts AS (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
vocabulary AS (SELECT DISTINCT gram FROM counts),
profiles AS (
  SELECT t.lang, v.gram, CAST(round(ln((coalesce(c.n, 0) + 1) / CAST(t.total + (SELECT count(*) FROM vocabulary)
    AS DOUBLE)) * 1000000) AS BIGINT) AS weight
  FROM vocabulary v CROSS JOIN totals t LEFT JOIN counts c ON c.lang = t.lang AND c.gram = v.gram)"""

SCORES = rf"""{GRAMS},
doc_grams AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
sums AS (SELECT g.doc_id, p.lang, sum(g.n * p.weight) AS s FROM doc_grams g JOIN profiles p USING (gram) GROUP BY ALL),
filled AS (
  SELECT d.doc_id, t.lang, coalesce(s.s, 0) AS s, coalesce(trim(regexp_replace(d.text, '\s+', ' ', 'g')), '') = '' AS blank
  FROM documents d CROSS JOIN totals t LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.lang = t.lang),
best AS (
  SELECT doc_id, blank, max(s) AS top, arg_min(lang, (-s, lang)) AS lang, list(s ORDER BY lang) AS all_s
  FROM filled GROUP BY ALL)"""

TURN_NAME = "role || '-' || turn || '.txt'"
MSG_ID = "conv_id || '/' || turn || '/' || role"

INLINE = (r"regexp_extract_all(html, '(?is)<script[^>]*>.*?(?:</script\s*>|\z)|<style[^>]*>.*?(?:</style\s*>|\z)"
          r"|data:[a-z]+/[a-z0-9.+-]+;base64,[a-z0-9+/=]+')")

# Script, style sheet or data URI, in the order of the page.
INLINE_ROWS = rf"""
pieces AS (SELECT page_id, {INLINE} AS p FROM (SELECT page_id, {HTML} AS html FROM pages)),
inline_parts AS (
  SELECT page_id, i AS ord, p[i + 1] AS piece FROM (SELECT page_id, p, unnest(range(len(p))) AS i FROM pieces)),
inline_rows AS (
  SELECT page_id, CAST(ord AS INTEGER) AS ord,
    CASE WHEN lower(piece[1:5]) = 'data:' THEN lower(split_part(piece[6:], ';', 1))
         WHEN lower(piece[1:7]) = '<script' THEN 'application/javascript' ELSE 'text/css' END AS media_type,
    CASE WHEN lower(piece[1:5]) = 'data:' THEN from_base64(split_part(piece, ',', 2))
         ELSE encode(regexp_replace(piece, '(?is)^<[^>]*>|</(?:script|style)\s*>\z', '', 'g')) END AS content
  FROM inline_parts)"""

# Children of the archives in document order: n counts those before.
CHILDREN = rf"""{INLINE_ROWS},
parts AS (SELECT page_id, count(*) AS n FROM inline_rows GROUP BY page_id),
children AS (
  SELECT page_id AS root_id, 1 AS depth, '0' AS ord_path, CAST(NULL AS VARCHAR) AS parent_name,
    'page.html' AS name, 'text/html' AS media_type, encode(html) AS content, 0 AS n FROM pages
  UNION ALL
  SELECT page_id, 2, '0/' || ord, 'page.html', NULL, media_type, content, 1 + ord FROM inline_rows
  UNION ALL
  SELECT page_id, 1, '1', NULL, 'embed1.zip', 'application/zip', NULL, 1 + coalesce(parts.n, 0)
  FROM pages LEFT JOIN parts USING (page_id) WHERE page_id % 2 = 0
  UNION ALL
  SELECT page_id, 2, '1/0', 'embed1.zip', 'embed1/embed1a.txt', 'text/plain', encode('url ' || url),
    2 + coalesce(parts.n, 0) FROM pages LEFT JOIN parts USING (page_id) WHERE page_id % 2 = 0
  UNION ALL
  SELECT page_id, 2, '1/1', 'embed1.zip', 'embed2.zip', 'application/zip', NULL,
    3 + coalesce(parts.n, 0) FROM pages LEFT JOIN parts USING (page_id) WHERE page_id % 4 = 0
  UNION ALL
  SELECT page_id, 3, '1/1/0', 'embed2.zip', 'embed2/embed2a.txt', 'text/plain', encode('page ' || page_id),
    4 + coalesce(parts.n, 0) FROM pages LEFT JOIN parts USING (page_id) WHERE page_id % 4 = 0),
named AS (SELECT *, coalesce(name, 'embedded_' || n) AS child_name FROM children)"""

# Raw maps, one row per entry.
ENTRIES = """
entries AS (
  SELECT doc_id, 'dc:title' AS key, CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'Title ' || doc_id END AS value FROM documents
  UNION ALL SELECT doc_id, 'Title', 'fallback title' FROM documents
  UNION ALL SELECT doc_id, 'meta:word-count', CASE doc_id % 6 WHEN 1 THEN '0' WHEN 2 THEN '12.5' WHEN 3 THEN '1_000'
    WHEN 4 THEN 'many' ELSE CAST(n_chars AS VARCHAR) END FROM documents
  UNION ALL SELECT doc_id, 'xmpDM:duration', CASE doc_id % 6 WHEN 1 THEN '0.0' WHEN 2 THEN 'n/a'
    ELSE n_chars || '.5' END FROM documents
  UNION ALL SELECT doc_id, 'meta:keyword', ' ' || lang || ' , ' || source || ',x' FROM documents
  UNION ALL SELECT doc_id, 'pdf:encrypted', CASE WHEN doc_id % 6 = 3 THEN 'true' ELSE 'false' END FROM documents
  UNION ALL SELECT doc_id, 'X-Unknown', 'ignored' FROM documents
  UNION ALL SELECT doc_id, 'meta:last-author', source FROM documents
  UNION ALL SELECT doc_id, 'fs:created', '2020-01-01T00:00:00Z' FROM documents
  UNION ALL SELECT doc_id, 'Message:From-Email', source || '@example.com' FROM documents)"""

WORD_COUNT = """CASE doc_id % 6 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 1000 WHEN 4 THEN NULL
  ELSE nullif(n_chars, 0) END"""

PARSED_PAGES = f"""SELECT page_id, 'text/html' AS media_type, {_html_text(HTML)} AS text, {TITLE} AS title,
  {LANGUAGE} AS language, strlen(html) AS content_length FROM pages"""

# Numbers of the chunk list are cheap on the hexadecimal form: two digits per byte.
CHUNKS = """
WITH hexed AS (SELECT doc_id, hex(encode(text)) AS h FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, h, unnest(range(greatest(1, (length(h) // 2 + 8191) // 8192))) AS chunk_no FROM hexed)
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, length(h[chunk_no * 16384 + 1:(chunk_no + 1) * 16384]) // 2
  AS chunk_length, sha256(unhex(h[chunk_no * 16384 + 1:(chunk_no + 1) * 16384])) AS chunk_sha256 FROM numbered"""

ESCAPED = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"

ORACLES: dict[str, str] = {
    "documents_from_table": """SELECT doc_id, source || '/' || doc_id AS path, 'text/plain' AS content_type_hint,
  strlen(text) AS length, sha256(text) AS content_sha256 FROM documents""",
    "parse_to_string": f"""SELECT doc_id, CASE WHEN text = '' THEN 'application/octet-stream' ELSE 'text/plain' END
  AS media_type, {NEWLINES.format("text")} AS content FROM documents""",
    "write_extracted": f"""SELECT doc_id, 'd/' || doc_id || CASE WHEN doc_id % 20 = 10 THEN '.tar.txt'
  WHEN {EXTENSION_BY_KIND} = '' THEN '' ELSE '.txt' END AS output_path, strlen(text) AS content_length
  FROM documents""",
    "chunk_content": CHUNKS,
    "parse_stream": PARSED_PAGES,
    "detect_magic": f"SELECT doc_id, {MAGIC_BY_KIND} AS magic_type FROM documents",
    "detect_glob": f"""SELECT doc_id, 'd/' || doc_id || {EXTENSION_BY_KIND} AS path, {GLOB_BY_KIND} AS glob_type
  FROM documents UNION ALL SELECT page_id, url, {PAGE_GLOB} FROM pages""",
    "sniff_text": f"SELECT doc_id, {SNIFF_BY_KIND} AS sniff_type FROM documents",
    "refine_container": f"""SELECT doc_id, CASE doc_id % 20 WHEN 3 THEN '{DOCX}' WHEN 4 THEN '{XLSX}'
  WHEN 5 THEN '{PPTX}' WHEN 6 THEN 'application/epub+zip' END AS container_type FROM documents""",
    "resolve_media_type": f"""SELECT doc_id, {MAGIC_BY_KIND} AS magic_type, {GLOB_BY_KIND} AS glob_type,
  CASE doc_id % 20 WHEN 1 THEN 'application/pdf' WHEN 6 THEN 'application/epub+zip' WHEN 13 THEN 'video/mp4'
    ELSE coalesce({MAGIC_BY_KIND}, {GLOB_BY_KIND}, 'application/octet-stream') END AS media_type FROM documents""",
    "detect_custom": f"SELECT doc_id, {CUSTOM_BY_KIND} AS media_type FROM documents",
    "media_type_registry": f"""WITH found AS (SELECT {CUSTOM_BY_KIND} AS media_type FROM documents)
SELECT media_type, count(*) AS documents, split_part(media_type, '/', 1) AS top_type,
  split_part(media_type, '/', 2) AS sub_type,
  CASE WHEN media_type IN ('{DOCX}', '{XLSX}', '{PPTX}') THEN 'application/x-tika-ooxml'
    WHEN media_type = 'application/epub+zip' THEN 'application/zip'
    WHEN media_type = 'video/mp4' THEN 'application/mp4'
    WHEN media_type = 'application/xml' THEN 'text/plain'
    WHEN media_type = 'application/octet-stream' THEN NULL
    WHEN media_type LIKE 'text/%' THEN 'text/plain'
    ELSE 'application/octet-stream' END AS supertype
FROM found GROUP BY media_type""",
    "override_media_type": f"""SELECT doc_id, {TYPE_BY_KIND} AS detected,
  CASE WHEN doc_id % 3 = 0 THEN 'application/x-given' ELSE {TYPE_BY_KIND} END AS media_type,
  CASE WHEN doc_id % 3 = 0 THEN 'application/x-given' END AS media_type_override FROM documents""",
    "detect_media_type": f"""SELECT doc_id, 'd/' || doc_id || {EXTENSION_BY_KIND} AS path, {TYPE_BY_KIND} AS media_type
  FROM documents UNION ALL SELECT page_id, url, 'text/html' FROM pages""",
    "parse_text": rf"""SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN doc_id % 8 = 2 THEN 'UTF-16LE'
    WHEN doc_id % 8 >= 4 THEN upper({CHARSET_OF.format('doc_id % 8 - 4')})
    WHEN doc_id % 8 = 3 AND NOT regexp_matches(text, '[^\x{{00}}-\x{{FF}}]') AND regexp_matches(text, '[^\x{{00}}-\x{{7F}}]')
    THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding,
  {NEWLINES.format("CASE WHEN doc_id % 8 < 4 THEN text ELSE " + _foreign("text", "doc_id % 8 - 4") + " END")} AS text FROM documents""",
    "parse_html_text": f"WITH {DECLARED_PAGES} SELECT page_id, {TITLE} AS title, {_html_text(HTML)} AS text FROM declared",
    "parse_xml": f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN
  {_collapse("chr(10) || lang || chr(10) || " + XML_CLEAN)} END AS text,
  CASE WHEN doc_id % 2 = 1 THEN 'PARSE_ERROR' END AS error_class FROM documents""",
    "parse_message": rf"""SELECT {MSG_ID} AS msg_id, 'Conversation ' || conv_id || ' turn ' || turn
  || coalesce(' ' || {_foreign("'one more'", "conv_id % 5 - 1")}, '') AS subject,
  role || ' <' || role || '@example.com>' AS sender, 'archive@example.com' AS recipient,
  'copy' || conv_id || '@example.com' AS copy, 2 AS parts,
  regexp_replace({NEWLINES.format("CASE WHEN conv_id % 5 = 0 THEN text ELSE " + _foreign("text", "conv_id % 5 - 1") + " END")}, '\n+\z', '')
  AS text FROM conversations""",
    "parse_package": rf"""WITH t AS (SELECT doc_id, {_collapse(PACKAGE_CLEAN)} AS text FROM documents)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{DOCX}' WHEN 1 THEN '{XLSX}' WHEN 2 THEN '{PPTX}' ELSE 'application/epub+zip' END AS media_type,
  CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN concat_ws(chr(10), 'Lines', nullif(text, ''))
    ELSE concat_ws(chr(10), nullif(text, ''), 'End of ' || doc_id) END AS text FROM t""",
    "render_content": rf"""WITH t AS (SELECT page_id, url, {TITLE} AS title, {_html_text('html')} AS text FROM pages)
SELECT page_id, '<?xml version="1.0" encoding="UTF-8"?><html xmlns="http://www.w3.org/1999/xhtml">' || chr(10) || '<head>'
  || chr(10) || '<meta name="Content-Type" content="text/html"/>' || chr(10) || '<meta name="resourceName" content="'
  || {ESCAPED.format("url")} || '"/>' || chr(10) || '<title>' || {ESCAPED.format("coalesce(title, '')")}
  || '</title>' || chr(10) || '</head>' || chr(10) || '<body><p>'
  || regexp_replace({ESCAPED.format("text")}, '\n+', '</p>' || chr(10) || '<p>', 'g')
  || '</p>' || chr(10) || '</body></html>' AS content FROM t""",
    "custom_parsers": f"""SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN 'text/x-bracket' ELSE 'text/plain' END AS media_type,
  CASE WHEN doc_id % 2 = 1 THEN '[' || {NEWLINES.format("text")} || ']' ELSE {NEWLINES.format("text")} END AS content,
  CASE WHEN doc_id % 2 = 1 THEN '_bracket' ELSE 'DefaultParser' END AS parsed_by FROM documents""",
    "parse_documents": PARSED_PAGES,
    "parse_strict": PARSED_PAGES,
    "parse_embedded": rf"""SELECT CAST(page_id AS VARCHAR) AS doc_id, 'application/zip' AS media_type,
  concat_ws(chr(10), nullif({_html_text(HTML)}, ''), CASE WHEN page_id % 2 = 0 THEN 'url ' || url END,
    CASE WHEN page_id % 4 = 0 THEN 'page ' || page_id END) AS text FROM pages
UNION ALL SELECT {MSG_ID}, 'message/rfc822', concat_ws(chr(10), nullif(regexp_replace({NEWLINES.format("coalesce(text, '')")}, '\n+\z', ''), ''),
  'copy,' || {NEWLINES.format("coalesce(text, '')")}) FROM conversations""",
    "read_files": "SELECT name || '.parquet' AS name, true AS has_content FROM (VALUES " + ", ".join(
        f"('{t}')" for t in TABLES) + ") AS t(name)",
    "raw_metadata": f"""WITH {DECLARED_PAGES}, lengths AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN strlen(html)
    WHEN 4 THEN length(html) + 4 ELSE length(html) END AS n FROM declared)
SELECT page_id, url AS resource_name, CAST(n AS VARCHAR) AS content_length,
  'text/html' AS content_type, CASE WHEN page_id % 5 = 0 THEN 'UTF-8' ELSE upper({CHARSET_OF.format('page_id % 5 - 1')}) END AS content_encoding,
  {TITLE} AS title, {LANGUAGE} AS language FROM declared JOIN lengths USING (page_id)""",
    "normalize_metadata": f"""SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN 'Title ' || doc_id END AS title,
  {WORD_COUNT} AS word_count, CASE WHEN doc_id % 6 = 3 THEN 'true' ELSE 'false' END AS is_encrypted,
  source AS creator, '2020-01-01T00:00:00Z' AS created, '2020-01-01T00:00:00Z' AS modified,
  source || '@example.com' AS from_, CAST(NULL AS VARCHAR) AS company FROM documents""",
    "coerce_metadata": f"""SELECT doc_id, {WORD_COUNT} AS word_count,
  CASE WHEN doc_id % 6 IN (1, 2) THEN NULL ELSE n_chars + 0.5::DOUBLE END AS duration,
  lang || '|' || source || '|x' AS keywords,
  CASE doc_id % 6 WHEN 2 THEN '12.5' WHEN 4 THEN 'many' END AS unparsed_word_count,
  CASE doc_id % 6 WHEN 2 THEN 'n/a' END AS unparsed_duration FROM documents""",
    "metadata_entries": f"WITH {ENTRIES} SELECT doc_id, key, value FROM entries",
    "metadata_diff": f"""WITH {ENTRIES},
changed AS (
  SELECT doc_id, key, CASE WHEN key = 'dc:title' AND doc_id % 3 = 0 THEN value || '!' ELSE value END AS value
  FROM entries WHERE key <> 'X-Unknown' OR doc_id % 5 <> 0
  UNION ALL SELECT doc_id, 'X-New', 'new' FROM documents WHERE doc_id % 4 = 0)
SELECT doc_id, key, CASE WHEN r.value IS NULL THEN 'only_left' WHEN l.value IS NULL THEN 'only_right'
  ELSE 'different' END AS state, l.value AS left_value, r.value AS right_value
FROM entries l FULL OUTER JOIN changed r USING (doc_id, key)
WHERE key <> 'pdf:encrypted' AND l.value IS DISTINCT FROM r.value""",
    "train_language_profiles": f"""WITH {GRAMS} SELECT lang, gram, weight FROM profiles SEMI JOIN counts USING (lang, gram)
UNION ALL SELECT lang, '', CAST(round(ln(1 / CAST(total + (SELECT count(*) FROM vocabulary) AS DOUBLE)) * 1000000)
  AS BIGINT) FROM totals""",
    "detect_language": f"""WITH {SCORES} SELECT doc_id, CASE WHEN NOT blank THEN lang END AS language,
  CASE WHEN NOT blank THEN CAST(top AS BIGINT) END AS log_weight FROM best""",
    "language_confidence": f"""WITH {SCORES},
scored AS (SELECT doc_id, CASE WHEN NOT blank THEN lang END AS language, CASE WHEN NOT blank THEN
  round(1.0 / list_sum(list_transform(all_s, lambda s: exp(CAST(s - top AS DOUBLE) / 1000000.0))), 6) END AS raw_score
  FROM best)
SELECT doc_id, language, raw_score, CASE WHEN raw_score IS NULL THEN 'NONE' WHEN raw_score >= 0.9 THEN 'HIGH'
  WHEN raw_score >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS confidence FROM scored""",
    "unpack_message": f"""SELECT {MSG_ID} AS msg_id, 0 AS ord, CAST(NULL AS VARCHAR) AS name, 'text/plain' AS media_type,
  sha256(coalesce(text, '')) AS content_sha256 FROM conversations
UNION ALL SELECT {MSG_ID}, 1, CASE WHEN conv_id % 5 <> 0 THEN {TURN_NAME} END, 'text/csv',
  sha256('copy,' || coalesce(text, '')) FROM conversations""",
    "unpack_archive": """SELECT page_id, 0 AS ord, 'page.html' AS name, sha256(html) AS content_sha256 FROM pages
UNION ALL SELECT page_id, 1, 'embed1.zip', NULL FROM pages WHERE page_id % 2 = 0""",
    "unpack_html": f"""WITH {INLINE_ROWS} SELECT page_id, ord, media_type, sha256(content) AS content_sha256
  FROM inline_rows""",
    "unpack_documents": f"""WITH {CHILDREN} SELECT root_id, depth, ord_path, parent_name, name, media_type,
  CASE WHEN content IS NOT NULL THEN sha256(content) END AS content_sha256 FROM children""",
    "embedded_name": f"WITH {CHILDREN} SELECT root_id, depth, child_name, child_name AS safe_name FROM named",
    "unpack_result": f"""WITH {CHILDREN} SELECT root_id, 0 AS block_no, any_value(url) AS resource_name,
  CAST(count(*) AS INTEGER) AS children, string_agg(child_name, ',' ORDER BY n) AS names,
  string_agg(CAST(depth AS VARCHAR), ',' ORDER BY n) AS depths
  FROM named JOIN pages ON page_id = root_id GROUP BY root_id""",
    "write_embedded": f"""WITH {CHILDREN} SELECT root_id, depth, child_name AS rel_path,
  octet_length(content) AS content_length FROM named""",
    "parse_stream_split": f"""SELECT doc_id, {TYPE_BY_KIND} AS media_type,
  CASE WHEN doc_id % 20 = 15 THEN 'bad' ELSE 'good' END AS state,
  CASE WHEN doc_id % 20 = 15 THEN 'PARSE_ERROR' END AS error_class FROM documents""",
    "split_errors": f"""SELECT doc_id, {TYPE_BY_KIND} AS media_type,
  CASE WHEN doc_id % 20 = 15 THEN 'bad' ELSE 'good' END AS state,
  CASE WHEN doc_id % 20 = 15 THEN 'PARSE_ERROR' END AS error_class FROM documents""",
    "validate_input": """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'INPUT_NOT_FOUND'
  WHEN doc_id % 5 = 0 THEN 'INVALID_INPUT' WHEN doc_id % 11 = 0 THEN 'INVALID_OUTPUT_FORMAT' END AS error_class
  FROM documents""",
}

# Pages are scored with the profiles of the documents.
PAGE_SCORES = GRAMS + rf""",
pages_text AS (SELECT page_id, {TITLE} AS title, {_html_text(HTML)} AS text FROM pages),
page_folded AS (SELECT page_id, {FOLDED} AS f FROM pages_text),
page_grams AS (
  SELECT page_id, unnest(list_concat(list_concat(
    regexp_extract_all(f, '...'), regexp_extract_all(substr(f, 2), '...')),
    regexp_extract_all(substr(f, 3), '...'))) AS gram FROM page_folded),
page_counts AS (SELECT page_id, gram, count(*) AS n FROM page_grams GROUP BY ALL),
sums AS (SELECT g.page_id, p.lang, sum(g.n * p.weight) AS s FROM page_counts g JOIN profiles p USING (gram) GROUP BY ALL),
filled AS (
  SELECT d.page_id, d.title, d.text, t.lang, coalesce(s.s, 0) AS s
  FROM pages_text d CROSS JOIN totals t LEFT JOIN sums s ON s.page_id = d.page_id AND s.lang = t.lang),
best AS (
  SELECT page_id, title, text, max(s) AS top, arg_min(lang, (-s, lang)) AS lang, list(s ORDER BY lang) AS all_s
  FROM filled GROUP BY ALL),
scored AS (
  SELECT page_id, title, text, lang,
    round(1.0 / list_sum(list_transform(all_s, lambda s: exp(CAST(s - top AS DOUBLE) / 1000000.0))), 6) AS score FROM best)"""

ORACLES["analyze_documents"] = f"""WITH {PAGE_SCORES}
SELECT page_id, 'text/html' AS media_type, title, text AS content,
  CASE WHEN trim(text) <> '' THEN lang END AS language, CASE WHEN trim(text) <> '' THEN score END AS raw_score,
  CASE WHEN trim(text) = '' THEN 'NONE' WHEN score >= 0.9 THEN 'HIGH' WHEN score >= 0.7 THEN 'MEDIUM'
    ELSE 'LOW' END AS confidence FROM scored"""
