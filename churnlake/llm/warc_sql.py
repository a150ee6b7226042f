"""DuckDB SQL of the WARC query: the same patterns over the same table."""

from __future__ import annotations

from churnlake.llm import warc as W


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(s: str) -> str:
    return _q(s)


def _digest(x: str) -> str:
    h = f"sha1({x})"
    out = []
    for i in range(8):
        v = f"('0x' || substr({h}, {1 + 5 * i}, 5))::INTEGER"
        out += [f"substr({_q(W._BASE32)}, (({v} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0)]
    return "'sha1:' || " + " || ".join(out)


def _uuid(x: str) -> str:
    h = f"md5({x})"
    cut = [f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return "'<urn:uuid:' || " + " || '-' || ".join(cut) + " || '>'"


def _sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {_re(pattern)}, {to}, 'g')"


def _numeric(x: str) -> str:
    m = f"regexp_extract(p, {_re(W.NUMERIC)}, 1)"
    n = (f"(CASE WHEN {m} = '' THEN 0 WHEN lower({m}[1]) = 'x' THEN ('0x' || {m}[2:])::INTEGER ELSE {m}::INTEGER END)")
    real = f"(({n} > 0 AND {n} < 55296) OR ({n} > 57343 AND {n} < 1114112))"
    piece = (f"CASE WHEN i = 1 THEN p WHEN {real} THEN (CASE WHEN {n} = 38 THEN '&amp;' ELSE chr({n}) END) || "
             f"substr(p, len({m}) + 2) ELSE '&#' || p END")
    return f"array_to_string(list_transform(string_split({x}, '&#'), lambda p, i: {piece}), '')"


def _decoded(x: str) -> str:
    x = _numeric(x)
    for name, char in W.ENTITIES:
        x = f"replace({x}, {_q(name)}, {_q(char)})"
    return x


_NL, _CRLF = "chr(10)", "chr(13) || chr(10)"


def _clean(x: str) -> str:
    return _sub(x, W.DROPPED, "' '")


def _text(x: str) -> str:
    t = f"replace(replace({_sub(x, W.HEAD, _q(' '))}, chr(13), ' '), chr(10), ' ')"
    t = _sub(_sub(t, W.BLOCK, _NL), W.TAG, "''")
    t = _sub(_sub(_decoded(t), W.BLANKS, "' '"), W.LINES, _NL)
    return f"trim({t}, ' ' || {_NL})"


def _fields(x: str) -> str:
    out = []
    for name, pattern in (("title", W.TITLE), ("language", W.LANG), ("charset", W.CHARSET)):
        v = f"trim({_sub(_decoded(f'regexp_extract({x}, {_re(pattern)}, 1)'), '[ ' + chr(92) + 't' + chr(92) + 'r' + chr(92) + 'n' + chr(92) + 'f]+', _q(' '))}, ' ')"
        out.append(f"CASE WHEN {v} <> '' THEN '{name}: ' || {v} || {_CRLF} ELSE '' END")
    links = f"regexp_extract_all({x}, {_re(W.LINK)}, 1)"
    bare = "CASE WHEN v[1] IN ('\"', chr(39)) THEN v[2:len(v) - 1] ELSE v END"
    link = f"regexp_replace({_decoded(f'({bare})')}, '[' || chr(13) || chr(10) || ']+', ' ', 'g')"
    joined = f"array_to_string(list_transform({links}, lambda v: {link}), {_CRLF} || 'outlink: ')"
    out.append(f"CASE WHEN len({links}) > 0 THEN 'outlink: ' || {joined} || {_CRLF} ELSE '' END")
    return " || ".join(f"({o})" for o in out)


def sql(date: str) -> str:
    head = " || ".join(["'HTTP/1.1 200 OK'", _CRLF, "'Content-Type: text/html; charset=utf-8'", _CRLF,
                        "'Content-Length: '", "strlen(payload)"])
    return f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT *, {_digest('payload')} AS payload_digest, {head} AS http FROM p),
r AS (
  SELECT *, {_uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || target_uri || '|' || payload_digest")} AS id,
    {_digest(f"http || {_CRLF} || {_CRLF} || payload")} AS block, {_clean('payload')} AS clean FROM d),
b AS (
  SELECT *, 'metadata' AS kind, 'application/warc-fields' AS type, {_fields('clean')} AS body FROM r
  UNION ALL
  SELECT *, 'conversion', 'text/plain', {_text('clean')} FROM r)
SELECT page_id, kind AS record_type, {_uuid("kind || '|' || id")} AS record_id, id AS refers_to, target_uri,
  {_q(date)} AS date, type AS content_type, strlen(body)::BIGINT AS content_length, {_digest('body')} AS block_digest,
  payload_digest AS source_payload_digest, block AS source_block_digest, http AS source_headers, body
FROM b"""
