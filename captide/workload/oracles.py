"""What the registered queries must return, as SQL on the same tables."""

from __future__ import annotations

_SHOW = "upper(source) || '_' || lang || '_' || CAST(doc_id AS VARCHAR)"
_DOCS = f"docs AS (SELECT *, {_SHOW} AS identifier FROM documents)"
_LABELLED = "labelled AS (SELECT d.*, l.quality, l.toxic FROM docs d JOIN labels l ON d.doc_id = l.doc_id)"
_EITHER = "either AS (SELECT d.*, l.quality, l.toxic FROM docs d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_LISTED = "listed AS (SELECT identifier FROM docs UNION ALL SELECT identifier FROM labelled WHERE toxic = 1)"
_LINES = """lines AS (
    SELECT identifier, doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM docs)"""
_TEXTS = """texts AS (
    SELECT identifier, string_agg(trim(line), '' ORDER BY pos) AS text FROM lines GROUP BY identifier)"""
_RECORDS = """records AS (
    SELECT identifier AS archive_id, CAST(n_chars % 40 * 1000 AS DOUBLE) AS a, toxic, lang FROM labelled)"""
_SEGMENTS = """segments AS (
    SELECT r.archive_id, r.lang, l.pos, trim(l.line) AS text, l.pos * 10000 AS s, l.pos * 10000 + 10000 AS e, r.a
    FROM records r JOIN lines l ON l.identifier = r.archive_id)"""
_FLAGGED = """flagged AS (
    SELECT *, NOT (s BETWEEN a AND a + 25000 OR e BETWEEN a AND a + 25000
                   OR s BETWEEN 83000 AND 87000 OR e BETWEEN 83000 AND 87000
                   OR s BETWEEN 155000.5 AND 171000 OR e BETWEEN 155000.5 AND 171000) AS keep
    FROM segments)"""
_CUT = """cut AS (
    SELECT archive_id, coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE keep), '') AS text_nc
    FROM flagged GROUP BY archive_id)"""
_CUT_CHAIN = ", ".join([_DOCS, _LABELLED, _LINES, _RECORDS, _SEGMENTS, _FLAGGED, _CUT])
_BLANK = "' ' || chr(10)"


def _compat(text: str) -> str:
    """Pieces between entities and line ends, stripped, blank ones left out."""
    pieces = f"string_split(regexp_replace({text}, '([&<>])', chr(10) || '\\1' || chr(10), 'g'), chr(10))"
    return f"""coalesce((
        SELECT string_agg(trim(piece), chr(10) ORDER BY n)
        FROM (SELECT unnest({pieces}) AS piece, unnest(range(len({pieces}))) AS n) WHERE trim(piece) <> ''), '')"""


_TAG_ROWS = f"""tag_rows AS (
    SELECT identifier, 'identifier' AS tag, CAST(0 AS BIGINT) AS n, identifier AS value FROM either
    UNION ALL SELECT identifier, 'mediatype', 0, 'movies' FROM either
    UNION ALL SELECT identifier, 'contributor', 0, upper(source) FROM either
    UNION ALL SELECT identifier, 'language', 0, lang FROM either
    UNION ALL SELECT identifier, 'collection', 0, 'TV-' || upper(source) FROM either
    UNION ALL SELECT identifier, 'collection', 1, 'tvarchive' FROM either
    UNION ALL SELECT identifier, 'collection', 2, 'tvnews' FROM either
    UNION ALL SELECT identifier, 'runtime', 0, '' FROM either
    UNION ALL SELECT identifier, 'title', 0, trim(string_split(text, chr(10))[1]) FROM either
    UNION ALL SELECT identifier, 'quality', 0, CAST(quality AS VARCHAR) FROM either WHERE quality IS NOT NULL
    UNION ALL SELECT identifier, 'subject', 0, 'toxic' FROM either WHERE toxic = 1
    UNION ALL SELECT identifier, 'subject', CASE WHEN toxic = 1 THEN 1 ELSE 0 END, lang FROM either
    UNION ALL SELECT identifier, 'description', 0, trim(text, {_BLANK}) FROM either)"""
_WIDE = f"""wide AS (
    SELECT 'TV-' || upper(source) || '|tvarchive|tvnews' AS collection, upper(source) AS contributor,
           trim(e.text, {_BLANK}) AS description, e.identifier, lang AS language, 'movies' AS mediatype,
           CAST(quality AS VARCHAR) AS quality, '' AS runtime,
           CASE WHEN toxic = 1 THEN 'toxic|' ELSE '' END || lang AS subject,
           trim(string_split(e.text, chr(10))[1]) AS title, t.text
    FROM listed i JOIN either e ON e.identifier = i.identifier JOIN texts t ON t.identifier = i.identifier
    WHERE lang <> 'es' AND lang <> 'de')"""
_WIDE_CHAIN = ", ".join([_DOCS, _LABELLED, _EITHER, _LISTED, _LINES, _TEXTS, _WIDE])

ORACLES = {
    "identifier_scan": """
        SELECT c_name AS identifier, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer""",
    "identifier_skip": """
        SELECT identifier, pos FROM (
            SELECT c_name AS identifier, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer)
        WHERE pos >= 25""",
    "document_scan_prefer_plain": """
        SELECT replace(s_name, '#', '_') AS title,
               CASE WHEN s_acctbal >= 3000 THEN 'plain' ELSE 'compressed' END AS form,
               replace(s_name, '#', '_') AS identifier
        FROM supplier""",
    "commercial_json_scan": f"""
        WITH {_DOCS}, {_LABELLED}, {_RECORDS}
        SELECT archive_id, CAST(0 AS BIGINT) AS n, a AS low, a + 25000 AS high FROM records
        UNION ALL SELECT archive_id, 1, 83000, 87000 FROM records
        UNION ALL SELECT archive_id, 2, 155000.5, 171000 FROM records
        UNION ALL SELECT archive_id, 0, 0, 1e9 FROM records WHERE toxic = 1""",
    "commercial_json_array": f"""
        WITH {_DOCS}, {_LABELLED}, {_RECORDS}
        SELECT archive_id, CAST(0 AS BIGINT) AS n, a AS low, a + 25000 AS high FROM records
        UNION ALL SELECT archive_id, 1, 83000, 87000 FROM records
        UNION ALL SELECT archive_id, 2, 155000.5, 171000 FROM records
        UNION ALL SELECT archive_id, 0, 0, 1e9 FROM records WHERE toxic = 1""",
    "caption_encodings": f"SELECT {_SHOW} AS identifier, 'é ü ñ ' || CAST(n_chars AS VARCHAR) AS text FROM documents",
    "corpus_csv_roundtrip": f"SELECT {_SHOW} AS identifier, lang, text FROM documents",
    "corpus_csv_split": f"SELECT {_SHOW} AS identifier, lang, text FROM documents",
    "corpus_gzip_members": f"SELECT {_SHOW} AS identifier, lang, text FROM documents",
    "preview_projection": f"SELECT {_SHOW} AS identifier, text FROM documents ORDER BY doc_id LIMIT 120",
    "positional_look": f"SELECT {_SHOW} AS identifier, text FROM documents ORDER BY doc_id LIMIT 1 OFFSET 1",
    "archive_listing_ids": f"SELECT {_SHOW} AS archive_id FROM documents WHERE lang = 'en'",
    "archive_member_extract": f"""
        WITH {_DOCS}, {_LABELLED} SELECT identifier AS archive_id, text AS content FROM labelled""",
    "archive_member_ranges": f"""
        WITH {_DOCS}, {_LABELLED} SELECT identifier AS archive_id, text AS content FROM labelled""",
    "xml_tag_map": f"WITH {_DOCS}, {_EITHER}, {_TAG_ROWS} SELECT identifier, tag, n, value FROM tag_rows",
    "xml_tag_map_compat": f"""
        WITH {_DOCS}
        SELECT identifier, {_compat("text")} AS description,
               {_compat("string_split(text, chr(10))[1]")} AS title
        FROM docs""",
    "tag_fold": f"""
        WITH {_DOCS}, {_EITHER}, {_TAG_ROWS}
        SELECT identifier, tag, string_agg(value, '|' ORDER BY n) AS folded FROM tag_rows GROUP BY identifier, tag""",
    "tag_inventory": f"WITH {_DOCS}, {_EITHER}, {_TAG_ROWS} SELECT DISTINCT tag FROM tag_rows",
    "xml_quarantine": f"""
        SELECT {_SHOW} AS identifier, 'meta' AS stage, 'mismatched tag' AS reason FROM documents WHERE lang = 'de'""",
    "xml_truncated": f"""
        SELECT 'TV-' || upper(source) || '|tvarchive|tvnews' AS collection,
               trim(string_split(text, chr(10))[1]) AS title, {_SHOW} AS identifier
        FROM documents WHERE lang = 'es'""",
    "wide_table": f"WITH {_WIDE_CHAIN} SELECT * FROM wide",
    "show_assembly": f"WITH {_WIDE_CHAIN} SELECT collection, identifier, text FROM wide",
    "append_schema_merge": f"""
        WITH {_DOCS}, {_EITHER}
        SELECT identifier, CASE WHEN quality IS NULL THEN lang END AS language,
               CAST(quality AS VARCHAR) AS thumbs, text
        FROM either""",
    "full_text": f"""
        WITH {_DOCS}, {_LINES}, {_TEXTS}
        SELECT identifier, text FROM texts
        UNION ALL SELECT 'PAGE_' || CAST(page_id AS VARCHAR), '' FROM pages""",
    "timed_segments": f"""
        SELECT conv_id, turn, CAST(0 AS BIGINT) AS pos, turn * 10000 AS start_ms, turn * 10000 + 10000 AS end_ms,
               trim(text, {_BLANK}) AS text
        FROM conversations""",
    "link_times": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus <> 'F' THEN o_custkey * 1000 END AS start_now,
               CASE WHEN o_orderstatus <> 'F' THEN o_orderkey * 1000 END AS end_now,
               o_custkey * 1000 AS start_2014, o_orderkey * 1000 AS end_2014
        FROM orders""",
    "commercial_cut": f"WITH {_CUT_CHAIN} SELECT archive_id, text_nc FROM cut",
    "commercial_cut_exploded": f"WITH {_CUT_CHAIN} SELECT archive_id, pos, text FROM flagged WHERE keep",
    "commercial_cut_sweep": f"WITH {_CUT_CHAIN} SELECT archive_id, pos, text FROM flagged WHERE keep",
    "segment_quarantine": f"""
        WITH {_CUT_CHAIN}
        SELECT DISTINCT archive_id, 'cut' AS stage,
               CASE lang WHEN 'de' THEN 'container without link' WHEN 'es' THEN 'link without href'
                         ELSE 'segment without snippet' END AS error
        FROM flagged WHERE lang IN ('de', 'es') OR (lang = 'fr' AND keep)""",
    "semi_commercial": f"""
        WITH {_DOCS}, {_LABELLED}, {_RECORDS}
        SELECT archive_id, CAST(0 AS BIGINT) AS pos, CAST(3 AS BIGINT) AS n_intervals FROM records WHERE lang <> 'en'
        UNION ALL SELECT archive_id, 1, 1 FROM records WHERE lang <> 'en' AND toxic = 1""",
    "first_interval_record": """
        SELECT user_id AS archive_id, value AS low, value + 30 AS high FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "merge_nc": f"""
        WITH {_CUT_CHAIN}
        SELECT d.identifier, d.text, c.text_nc FROM docs d LEFT JOIN cut c ON c.archive_id = d.identifier""",
    "release_edition_2023": f"""
        WITH {_CUT_CHAIN}
        SELECT d.identifier, replace(d.text, chr(10), '\\n') AS text, c.text_nc, '2023' AS edition
        FROM docs d LEFT JOIN cut c ON c.archive_id = d.identifier""",
    "nc_coverage": f"""
        WITH {_CUT_CHAIN}
        SELECT d.text, c.text_nc FROM docs d JOIN cut c ON c.archive_id = d.identifier""",
    "repr_strip": f"SELECT {_SHOW} AS identifier, text AS stripped, text AS plain FROM documents",
    "repr_strip_compat": f"""
        WITH v AS (SELECT {_SHOW} AS identifier, 'b''' || replace(text, chr(10), '\\n') || '''' AS literal FROM documents)
        SELECT identifier, regexp_replace(literal, 'b''(.*)''', '\\1', 'g') AS stripped_2023,
               regexp_replace(literal, 'b[''"](.*)[''"]', '\\1', 'g') AS stripped_2022
        FROM v""",
    "release_manifest": """
        SELECT lang AS edition, count(*) AS rows, true AS bounded, true AS sized FROM documents GROUP BY lang""",
    "release_shard_bytes": """
        SELECT lang AS edition, count(*) AS rows, true AS bounded, true AS ordered FROM documents GROUP BY lang""",
    "catalogue_search": """
        SELECT 'ORDER_' || CAST(o_orderkey AS VARCHAR) AS identifier FROM orders
        WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1998-01-01'
        ORDER BY identifier LIMIT 5000""",
    "valid_date_flag": """
        SELECT o_orderkey, year(o_orderdate) > 1996 AND o_custkey BETWEEN 1 AND 12 AND o_orderkey BETWEEN 1 AND 31 AS valid
        FROM orders""",
    "source_urls": f"""
        WITH {_DOCS}
        SELECT identifier, 'http://archive.org/download/' || identifier AS download_url,
               'http://archive.org/details/' || identifier AS details_url,
               'http://archive.org/download/' || identifier || '/' || identifier || '_meta.xml' AS meta_url,
               identifier || '_meta.xml.gz' AS meta_file, identifier || '.html.gz' AS page_file
        FROM docs""",
    "keyword_position": f"SELECT {_SHOW} AS identifier, instr(text, 'the') - 1 AS position FROM documents",
    "isin_lookup": f"SELECT {_SHOW} AS identifier, text FROM documents WHERE source IN ('src3', 'src17')",
    "pending_work": f"""
        WITH {_DOCS}, {_LABELLED}, {_LISTED}
        SELECT i.identifier, 'meta' AS kind FROM listed i JOIN docs d ON d.identifier = i.identifier WHERE lang = 'es'
        UNION ALL
        SELECT i.identifier, 'page' FROM listed i JOIN docs d ON d.identifier = i.identifier WHERE lang = 'de'""",
    "ingest_report": f"""
        WITH {_DOCS}, {_LABELLED}, {_EITHER}, {_LISTED}, {_TAG_ROWS}
        SELECT 'listed' AS measure, count(*) AS n FROM listed
        UNION ALL SELECT 'stored_meta', count(*) FROM docs WHERE lang <> 'es'
        UNION ALL SELECT 'stored_page', count(*) FROM docs WHERE lang <> 'de'
        UNION ALL SELECT 'tags', count(DISTINCT tag) FROM tag_rows""",
    "incremental_ingest": f"""
        WITH {_DOCS}, {_LINES}, {_TEXTS}
        SELECT identifier, text FROM texts
        UNION ALL SELECT 'PAGE_' || CAST(page_id AS VARCHAR), url FROM pages""",
}
