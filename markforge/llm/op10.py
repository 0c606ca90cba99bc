"""WARC derivatives: metadata and conversion records from responses.

Each response gives two records that refer to it: a ``metadata`` record with the
source's status line, HTTP headers, payload digest, title, outlinks and the id of
its conversion, and a ``conversion`` record with the plain text of its HTML. All
of it is column expressions over one scan, without a shuffle; record ids are
derived from the source record's id, so a rerun writes the same records.

Text: comments, scripts, styles, noscript and templates go (an unclosed one runs
to the end), block tags break lines, other tags go, the entities of ``ENTITIES``
are decoded, blanks are collapsed and empty lines dropped. Every pattern is
linear in the text.

Defined results: a null payload is empty, a null or empty URI or header block is
left out, line breaks in header values become blanks; repeated responses give
repeated records with equal ids; a null record id gives records without
``WARC-Refers-To``; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"

# Entities that are decoded, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "\u00a9"),
            ("&reg;", "\u00ae"), ("&middot;", "\u00b7"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"), ("&hellip;", "\u2026"),
            ("&amp;", "&"))

HIDDEN = "|".join(["<!--.*?(?:-->|\\z)", *(f"<{t}[\\s/>].*?(?:</{t}\\s*>|\\z)" for t in ("script", "style", "noscript", "template"))])
BREAKS = "</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|" \
         "pre|section|table|td|th|title|tr|ul)(?:[\\s/][^<>]*)?>"
TAGS = "<[a-zA-Z/!?][^<>]*>"
TITLE = "<title(?:\\s[^<>]*)?>([^<]*)"
LINKS = "<a\\s[^<>]*?href\\s*=\\s*[\"']([^\"'<>]*)[\"']"


def plain_text(html: Column) -> Column:
    t = F.regexp_replace(html, f"(?is){HIDDEN}", "")
    t = F.regexp_replace(t, f"(?i){BREAKS}", "\n")
    t = F.regexp_replace(t, TAGS, "")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(t, "[ \\t\\r\\f\\x{0B}]+", " ")
    t = F.regexp_replace(t, " ?\n[ \n]*", "\n")
    return F.trim(t, F.lit(" \n"))


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value, "[\\r\\n]+", " ")


def _urn(*parts: Column) -> Column:
    """A record id made from values, in the shape of a UUID."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in
                                                             ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null or empty value."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{name}: "), _one_line(value), F.lit(CRLF))).otherwise("")


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Fetched pages (``page_id, url, html``) as response records."""
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                      F.octet_length(F.coalesce("html", F.lit(""))).cast("string"))
    return pages.select(
        "page_id", _urn(F.lit("response"), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "url", "html")))
        .alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), header.alias("http_header"),
        F.col("html").alias("payload"))


def derive(source: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Two rows per response (``record_id, target_uri, date, http_header,
    payload``): ``record_type, record_id, refers_to, target_uri, block,
    content_length, block_digest, record`` and the ``keep`` columns."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    header = F.coalesce(F.col("http_header"), F.lit(""))
    s = source.select(
        *keep, F.col("record_id").alias("refers_to"), "target_uri", "date",
        _urn(F.lit("metadata"), F.col("record_id")).alias("metadata_id"),
        _urn(F.lit("conversion"), F.col("record_id")).alias("conversion_id"),
        plain_text(payload).alias("text"),
        F.concat(
            _field("source-status", F.substring_index(header, CRLF, 1)),
            F.array_join(F.transform(F.filter(F.slice(F.split(header, CRLF), F.lit(2), F.greatest(F.size(F.split(header, CRLF)) - 1, F.lit(0))),
                                              lambda h: h != ""),
                                     lambda h: F.concat(F.lit("source-header-"), h, F.lit(CRLF))), ""),
            F.lit("source-payload-digest: sha256:"), F.sha2(payload, 256), F.lit(CRLF),
            _field("title", F.trim(F.regexp_extract(payload, f"(?i){TITLE}", 1), F.lit(" \t\r\n"))),
            F.array_join(F.transform(F.regexp_extract_all(payload, F.lit(f"(?i){LINKS}"), F.lit(1)), lambda u: F.concat(
                F.lit("outlink: "), _one_line(u), F.lit(CRLF))), "")).alias("fields"))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"),
                 F.lit("application/warc-fields").alias("content_type"),
                 F.concat("fields", F.lit("derived-conversion: "), "conversion_id", F.lit(CRLF)).alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    r = s.select(*keep, "refers_to", "target_uri", "date", F.inline(kinds))
    r = r.withColumn("content_length", F.octet_length("block").cast("long")).withColumn(
        "block_digest", F.concat(F.lit("sha256:"), F.sha2("block", 256)))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), "record_type", F.lit(CRLF), _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Date", F.col("date")), _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Refers-To", F.col("refers_to")), _field("WARC-Block-Digest", F.col("block_digest")),
        _field("Content-Type", F.col("content_type")), F.lit("Content-Length: "), F.col("content_length").cast("string"),
        F.lit(CRLF + CRLF), "block")
    return r.withColumn("record", record).select(
        *keep, "record_type", "record_id", "refers_to", "target_uri", "block", "content_length", "block_digest", "record")


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files under ``path``, one per task: each record and the two line ends after it."""
    records.select("record").write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return derive(responses(pages)).select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_length", "block_digest",
        F.sha2("record", 256).alias("record_sha256"))


def _sql_urn(expr: str) -> str:
    h = f"md5({expr})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in
                                                   ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


def _sql_text(html: str) -> str:
    t = f"regexp_replace({html}, '(?is){HIDDEN}', '', 'g')"
    t = f"regexp_replace({t}, '(?i){BREAKS}', chr(10), 'g')"
    t = f"regexp_replace({t}, '{TAGS}', '', 'g')"
    for entity, char in ENTITIES:
        t = "replace({}, '{}', '{}')".format(t, entity, char.replace("'", "''"))
    t = f"regexp_replace({t}, '[ \\t\\r\\f\\x{{0B}}]+', ' ', 'g')"
    return f"trim(regexp_replace({t}, ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"


_N = "chr(13) || chr(10)"
_LINKS_SQL = LINKS.replace("'", "''")
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
s AS (SELECT *, {_sql_urn("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '') || '|' || html")} AS refers_to FROM p),
i AS (SELECT *, {_sql_urn("'metadata|' || refers_to")} AS mid, {_sql_urn("'conversion|' || refers_to")} AS cid,
  trim(regexp_extract(html, '(?i){TITLE}', 1), ' ' || chr(9) || chr(13) || chr(10)) AS title FROM s),
b AS (
  SELECT page_id, url, refers_to, 'metadata' AS record_type, mid AS record_id, 'application/warc-fields' AS kind,
    'source-status: HTTP/1.1 200 OK' || {_N} || 'source-header-Content-Type: text/html; charset=utf-8' || {_N}
    || 'source-header-Content-Length: ' || strlen(html)::VARCHAR || {_N} || 'source-payload-digest: sha256:' || sha256(html) || {_N}
    || CASE WHEN title <> '' THEN 'title: ' || regexp_replace(title, '[\\r\\n]+', ' ', 'g') || {_N} ELSE '' END
    || coalesce(list_aggregate(list_transform(regexp_extract_all(html, '(?i){_LINKS_SQL}', 1),
       lambda u: 'outlink: ' || regexp_replace(u, '[\\r\\n]+', ' ', 'g') || {_N}), 'string_agg', ''), '')
    || 'derived-conversion: ' || cid || {_N} AS block FROM i
  UNION ALL
  SELECT page_id, url, refers_to, 'conversion', cid, 'text/plain; charset=utf-8', {_sql_text('html')} FROM i)
SELECT page_id, record_type, record_id, refers_to, url AS target_uri, strlen(block) AS content_length,
  'sha256:' || sha256(block) AS block_digest,
  sha256('WARC/1.1' || {_N} || 'WARC-Type: ' || record_type || {_N} || 'WARC-Record-ID: ' || record_id || {_N}
    || 'WARC-Date: 1970-01-01T00:00:00Z' || {_N}
    || CASE WHEN coalesce(url, '') <> '' THEN 'WARC-Target-URI: ' || regexp_replace(url, '[\\r\\n]+', ' ', 'g') || {_N} ELSE '' END
    || 'WARC-Refers-To: ' || refers_to || {_N} || 'WARC-Block-Digest: sha256:' || sha256(block) || {_N}
    || 'Content-Type: ' || kind || {_N} || 'Content-Length: ' || strlen(block)::VARCHAR || {_N} || {_N} || block) AS record_sha256
FROM b
"""
