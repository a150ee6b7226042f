"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` turns fetched pages into response records; ``derive`` turns each
response into one ``metadata`` record (application/warc-fields: title, language,
character set, outlinks) and one ``conversion`` record (text/plain). Both refer
to their source by ``WARC-Refers-To`` and carry its URI, date, HTTP headers and
digests. Everything up to the records' bodies is column expressions.
``write_records`` writes WARC files with Spark's own writer; ``read_records``
splits WARC files by their Content-Length.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
HTTP_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # of Spark's numbers to the base 32
# Patterns are in the common part of Java's and RE2's syntax.
HEAD = r"(?is)<head\b[^>]*>.*?</head[^>]*>"
DROPPED = ("(?is)<(?:" + "|".join(rf"{t}\b[^>]*>.*?</{t}[^>]*>" for t in ("script", "style", "noscript", "template"))
           + "|!--.*?-->)")
_BLOCKS = ("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
           "header hr html li main nav ol option p pre section table td th tr ul").split()
# names by first letter, so that a tag is not held against all of them
BLOCK = ("(?i)</?(?:" + "|".join(f"{c}(?:{'|'.join(n[1:] for n in _BLOCKS if n[0] == c)})"
                                 for c in sorted({n[0] for n in _BLOCKS})) + r")(?:[ \t\r\n\f/][^>]*)?>")
TAG = r"<(?:/?[a-zA-Z]|!|\?)[^>]*>"
BLANKS = r"[ \t\r\f\x0b\x{a0}]{2,}|[\t\r\f\x0b\x{a0}]"  # all runs of blanks but a single space
LINES = r" ?\n[ \n]*"
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LANG = r"""(?is)<html\b[^>]*[ \t\r\n\f]lang[ \t\r\n\f]*=[ \t\r\n\f]*["']?([a-zA-Z0-9-]+)"""
CHARSET = r"""(?is)<meta\b[^>]*charset[ \t\r\n\f]*=[ \t\r\n\f]*["']?([a-zA-Z0-9_:.-]+)"""
# a value in double quotes, in single quotes, or without
LINK = (r"""(?is)<a\b[^>]*[ \t\r\n\f]href[ \t\r\n\f]*=[ \t\r\n\f]*"""
        r"""("[^"\r\n]*"|'[^'\r\n]*'|[^ \t\r\n\f"'>][^ \t\r\n\f>]*)""")
NUMERIC = r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
# &amp; comes last: what it spells is not decoded again
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
            ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&hellip;", "…"), ("&ndash;", "–"),
            ("&mdash;", "—"), ("&amp;", "&")]


def with_digest(df: DataFrame, out: str, body: Column) -> DataFrame:
    """``df`` with ``out``: ``sha1:`` and the base-32 SHA-1 of the UTF-8 bytes. The
    hash is a column of its own first, so that it is computed once."""
    h = F.col(out + "_hex")
    # 40 bits, eight digits, at a time
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)])
    return (df.withColumn(out + "_hex", F.sha1(F.encode(body, "UTF-8")))
            .withColumn(out, F.concat(F.lit("sha1:"), F.translate(digits, _DIGITS, _BASE32))).drop(out + "_hex"))


def record_id(*parts: Column) -> Column:
    """A UUID from the MD5 of the parts, so that repeated runs give equal ids."""
    h = F.md5(F.encode(F.concat_ws("|", *parts), "UTF-8"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _bytes(s: Column) -> Column:
    return F.octet_length(s).cast("long")


def responses(pages: DataFrame, date: str, page_id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Response records of fetched pages. A null URL or page is an empty string;
    ids come from page id, URL and payload, so rows that repeat a page give
    records of the same id."""
    p = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("target_uri"),
                     F.coalesce(F.col(html), F.lit("")).alias("payload"))
    p = with_digest(p, "payload_digest", F.col("payload"))
    http = F.concat(F.lit(HTTP_HEADERS + CRLF + "Content-Length: "), _bytes(F.col("payload")).cast("string"))
    p = (p.withColumn("http_headers", http)
         .withColumn("record_id", record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                            F.col("target_uri"), F.col("payload_digest")))
         .withColumn("date", F.lit(date)))
    return with_digest(p, "block_digest", F.concat("http_headers", F.lit(CRLF * 2), "payload"))


def _numeric(x: Column, i: Column) -> Column:
    """A piece after ``&#``: the character it begins with by number, and the rest. An
    ampersand becomes ``&amp;``, which is decoded last; numbers that are no character
    stay as they are."""
    m = F.regexp_extract(x, NUMERIC, 1)
    number = F.when(F.lower(F.substring(m, 1, 1)) == "x", F.conv(F.substring(m, 2, 6), 16, 10)).otherwise(m)
    n = F.when(m == "", F.lit(0)).otherwise(number.cast("int"))
    real = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000))
    char = F.when(n == 38, F.lit("&amp;")).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    rest = F.substr(x, F.length(m) + 2)
    return F.when(i == 0, x).when(real, F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), x))


def _decoded(s: Column) -> Column:
    """Entities by name and number, each once. Texts without an ampersand are left alone."""
    t = F.when(F.contains(s, F.lit("&#")), F.array_join(F.transform(F.split(s, "&#"), _numeric), "")).otherwise(s)
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.when(F.contains(s, F.lit("&")), t).otherwise(s)


def plain_text(clean: Column) -> Column:
    """Visible text of a page without scripts, styles and comments: a line for each
    block element, entities decoded."""
    t = F.regexp_replace(clean, HEAD, " ")
    for end in "\r\n":  # translate would look every character up
        t = F.replace(t, F.lit(end), F.lit(" "))
    t = F.regexp_replace(F.regexp_replace(t, BLOCK, "\n"), TAG, "")
    t = F.regexp_replace(F.regexp_replace(_decoded(t), BLANKS, " "), LINES, "\n")
    return F.btrim(t, F.lit(" \n"))


def _field(s: Column) -> Column:
    """One line of a warc-fields body."""
    return F.trim(F.regexp_replace(_decoded(s), r"[ \t\r\n\f]+", " "))


def _link(value: Column) -> Column:
    """A found address without its quotes, decoded, on one line."""
    quoted = F.substring(value, 1, 1).isin('"', "'")
    bare = F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.regexp_replace(_decoded(bare), r"[\r\n]+", " ")


def with_fields(df: DataFrame, clean: str, out: str) -> DataFrame:
    """``df`` with the metadata record's body, from the column ``clean`` (a page
    without scripts, styles and comments); fields without a value are left out.
    Found values are columns of their own first, each searched for once."""
    found = {"title": TITLE, "language": LANG, "charset": CHARSET}
    d = df.withColumns({"m_" + k: _field(F.regexp_extract(clean, v, 1)) for k, v in found.items()}
                       | {"m_links": F.transform(F.regexp_extract_all(clean, F.lit(LINK), F.lit(1)), _link)})
    lines = [F.when(F.col("m_" + k) != "", F.concat(F.lit(k + ": "), F.col("m_" + k), F.lit(CRLF))).otherwise(F.lit(""))
             for k in found]
    links = F.array_join("m_links", CRLF + "outlink: ")
    lines.append(F.when(F.size("m_links") > 0, F.concat(F.lit("outlink: "), links, F.lit(CRLF))).otherwise(F.lit("")))
    return d.withColumn(out, F.concat(*lines)).drop("m_links", *["m_" + k for k in found])


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: ``page_id, record_type, record_id,
    refers_to, target_uri, date, content_type, content_length, block_digest,
    source_payload_digest, source_block_digest, source_headers, body``.

    An empty page gives records with empty bodies. An empty table gives none."""
    r = records.select("page_id", "record_id", "target_uri", "date", "http_headers", "payload_digest", "block_digest",
                       F.regexp_replace("payload", DROPPED, " ").alias("clean"))
    r = with_fields(r, "clean", "fields").withColumn("text", plain_text(F.col("clean"))).drop("clean")
    both = r.select("*", F.explode(F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("type"),
                 F.col("fields").alias("body")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain").alias("type"),
                 F.col("text").alias("body")))).alias("r")).withColumn("body", F.col("r.body"))
    both = with_digest(both, "body_digest", F.col("body"))
    return both.select(
        "page_id", F.col("r.kind").alias("record_type"),
        record_id(F.col("r.kind"), F.col("record_id")).alias("record_id"), F.col("record_id").alias("refers_to"),
        "target_uri", "date", F.col("r.type").alias("content_type"), _bytes(F.col("body")).alias("content_length"),
        F.col("body_digest").alias("block_digest"), F.col("payload_digest").alias("source_payload_digest"),
        F.col("block_digest").alias("source_block_digest"), F.col("http_headers").alias("source_headers"), "body")


def response_text(records: DataFrame) -> Column:
    """A response record as it stands in a file, without the closing blank lines."""
    block = F.concat(records["http_headers"], F.lit(CRLF * 2), records["payload"])
    return _record([("WARC-Type", F.lit("response")), ("WARC-Record-ID", records["record_id"]),
                    ("WARC-Target-URI", records["target_uri"]), ("WARC-Date", records["date"]),
                    ("WARC-Payload-Digest", records["payload_digest"]), ("WARC-Block-Digest", records["block_digest"]),
                    ("Content-Type", F.lit("application/http; msgtype=response"))], block)


def derived_text(records: DataFrame) -> Column:
    """A derived record as it stands in a file. The source's HTTP header lines
    become ``WARC-Source-`` fields."""
    source = F.regexp_replace(F.regexp_replace(records["source_headers"], r"^[^\r\n]*\r\n", ""), r"(?m)^",
                              "WARC-Source-")
    return _record([("WARC-Type", records["record_type"]), ("WARC-Record-ID", records["record_id"]),
                    ("WARC-Refers-To", records["refers_to"]), ("WARC-Target-URI", records["target_uri"]),
                    ("WARC-Date", records["date"]), ("WARC-Block-Digest", records["block_digest"]),
                    ("WARC-Source-Payload-Digest", records["source_payload_digest"]),
                    ("WARC-Source-Block-Digest", records["source_block_digest"]),
                    ("Content-Type", records["content_type"])], records["body"], source)


def _record(headers: list[tuple[str, Column]], block: Column, more: Column | None = None) -> Column:
    lines = [F.concat(F.lit(k + ": "), F.regexp_replace(v, r"[\r\n]+", " "), F.lit(CRLF)) for k, v in headers]
    if more is not None:
        lines.append(F.concat(more, F.lit(CRLF)))
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit("Content-Length: "), _bytes(block).cast("string"),
                    F.lit(CRLF * 2), block)


def write_records(texts: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write the one string column of ``texts`` as gzipped WARC files. The end of
    a record is the line separator, so a file is its records one after another."""
    (texts.write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse(data: bytes):
    """(headers, block) of each record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split(CRLF)
        headers = [tuple(x.split(": ", 1)) if ": " in x else (x.rstrip(":"), "") for x in lines[1:]]
        size = int(dict(headers)["Content-Length"])
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``headers`` (map) and ``block`` of every record of the WARC files below
    ``path``, gzipped or not; a file is read by one task."""

    def run(batches):
        kind = pa.map_(pa.string(), pa.string())
        for b in batches:
            for data in b.column(0):
                raw = data.as_py()
                heads, blocks = [], []
                for h, block in parse(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                    heads.append(h)
                    blocks.append(block)
                yield pa.RecordBatch.from_arrays([pa.array(heads, kind), pa.array(blocks, pa.binary())],
                                                 ["headers", "block"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, "headers map<string,string>, block binary")
