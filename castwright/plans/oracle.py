"""DuckDB statements that state the same answers as ``castwright.plans.catalog`` over the
pre-registered test-table views."""

from __future__ import annotations

from castwright.plans import sqlbits as q
from castwright.functions import urls as U
from castwright.functions.encoding import STRICT_B64_RX
from castwright.operators import events as EV
from castwright.operators import intake as K
from castwright.operators import ledger as LG
from castwright.operators import prompts as P
from castwright.operators import routing as RT
from castwright.operators.turns import LABEL_RX
from castwright.operators.turns import NO_TURNS_ERROR as _NO_TURNS
from castwright.plans import inputs as I
from castwright.sources import files as FS

ORACLE_SQL: dict[str, str] = {}


def _article_sql(nested: bool) -> str:
    # Follows the grammar of the test pages: one <article>, paragraphs opened by <p>; the
    # unclosed "<p><b>" paragraph owns the rest of the article in nested mode.
    body = (
        "CASE WHEN starts_with(parts[idx], '<b>') THEN array_to_string(parts[idx:], '<p>') "
        "ELSE split_part(parts[idx], '</p>', 1) END"
        if nested
        else "split_part(parts[idx], '</p>', 1)"
    )
    piece = q.strip(q.entity_decode("x"))
    return f"""
WITH a AS (
  SELECT page_id, string_split(regexp_extract(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'),
                                              '(?s)<article>(.*?)</article>', 1), '<p>') AS parts
  FROM pages),
p AS (SELECT page_id, parts, unnest(generate_series(2, len(parts))) AS idx FROM a),
b AS (SELECT page_id, idx, {body} AS body FROM p),
t AS (
  SELECT page_id, idx,
         array_to_string(list_filter(list_transform(regexp_split_to_array(body, '<[^>]*>'),
                                                    lambda x: {piece}), lambda x: x <> ''), ' ') AS ptxt
  FROM b),
g AS (SELECT page_id, {q.strip("string_agg(ptxt, chr(10) ORDER BY idx)")} AS text
      FROM t WHERE ptxt <> '' GROUP BY page_id)
SELECT pg.page_id, g.text, length(g.text)::BIGINT AS n_chars,
       CASE WHEN g.text IS NULL THEN 'No readable text found in the article.' END AS error
FROM pages pg LEFT JOIN g ON pg.page_id = g.page_id
"""


ORACLE_SQL["article_source"] = _article_sql(True)
ORACLE_SQL["article_source_html5"] = _article_sql(False)

_kept = f"list_filter(list_transform({q.lines('text')}, lambda x: {q.strip('x')}), lambda x: x <> '')"
_clean = q.strip(f"regexp_replace(array_to_string({_kept}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")
ORACLE_SQL["clean_text"] = f"""
SELECT doc_id, {_clean} AS text, length({_clean})::BIGINT AS n_chars FROM documents
"""


def _chunk_sql(limit: int) -> str:
    return f"""
WITH RECURSIVE {q.chunks_cte('documents', 'doc_id', 'text', limit)}
SELECT doc_id, chunk_no, chunk, length(chunk)::BIGINT AS chunk_chars, NULL::VARCHAR AS error FROM ck
UNION ALL
SELECT doc_id, NULL::BIGINT, NULL::VARCHAR, NULL::BIGINT, 'Input text is empty.'
FROM documents WHERE text IS NULL OR {q.strip('text')} = ''
"""


ORACLE_SQL["tts_chunks"] = _chunk_sql(1800)
ORACLE_SQL["tts_chunks_min"] = _chunk_sql(100)
ORACLE_SQL["ssml"] = f"""
WITH RECURSIVE {q.chunks_cte('documents', 'doc_id', 'text', 1800)}
SELECT doc_id, chunk_no, {q.ssml('chunk')} AS ssml, NULL::VARCHAR AS error FROM ck
UNION ALL
SELECT doc_id, NULL::BIGINT, NULL::VARCHAR, 'Input text is empty.' FROM documents WHERE text IS NULL OR {q.strip('text')} = ''
"""

_wc = f"len({q.words('text')})"
ORACLE_SQL["duration"] = f"""
SELECT doc_id, {_wc}::BIGINT AS word_count, trunc(({_wc}::DOUBLE / 150.0) * 60.0)::BIGINT AS duration_sec
FROM documents
"""


# --- conversations -------------------------------------------------------------------------


_CONV_LINES = f"""conv_lines AS (
  SELECT conv_id, turn, (ln - 1)::BIGINT AS line_no, arr[ln] AS raw
  FROM (SELECT conv_id, turn, arr, unnest(generate_series(1, len(arr))) AS ln
        FROM (SELECT conv_id, turn,
                     {q.piece_lines("CASE WHEN conv_id % 9 = 4 THEN '' WHEN role = 'user' THEN 'HOST_A: ' WHEN role = 'assistant' THEN 'HOST_B: ' ELSE '' END || text")} AS arr
              FROM conversations)))"""

_CONV_TURNS = f"""{_CONV_LINES},
conv_marked AS (
  SELECT conv_id, turn, line_no, raw, regexp_matches(raw, '{LABEL_RX}') AS is_label FROM conv_lines),
conv_numbered AS (
  SELECT conv_id, turn, line_no,
         sum(is_label::INT) OVER (PARTITION BY conv_id ORDER BY turn, line_no
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn_no,
         CASE WHEN is_label THEN {q.strip(f"regexp_extract(raw, '{LABEL_RX}', 2)")} ELSE {q.strip('raw')} END AS body,
         CASE WHEN is_label THEN upper(regexp_extract(raw, '{LABEL_RX}', 1)) END AS speaker
  FROM conv_marked),
conv_turns_all AS (
  SELECT conv_id, turn_no::BIGINT AS turn_no, max(speaker) AS speaker,
         {q.strip("string_agg(body, chr(10) ORDER BY turn, line_no)")} AS text
  FROM conv_numbered WHERE turn_no > 0 GROUP BY conv_id, turn_no),
conv_turns AS (SELECT * FROM conv_turns_all WHERE text <> '')"""

ORACLE_SQL["duo_turns"] = f"""
WITH {_CONV_TURNS}
SELECT conv_id, turn_no, speaker, text, length(text)::BIGINT AS n_chars FROM conv_turns
"""

ORACLE_SQL["duo_rejects"] = f"""
WITH {_CONV_TURNS}
SELECT DISTINCT conv_id, 'generate' AS stage,
       'script_mode=duo requires script lines prefixed with HOST_A: or HOST_B:.' AS error
FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conv_turns)
"""


def _voice(default_a: str, default_b: str) -> str:
    return (
        f"CASE WHEN speaker = 'HOST_A' THEN coalesce(CASE WHEN conv_id % 3 = 0 THEN 'Ruth' END, '{default_a}') "
        f"ELSE coalesce(CASE WHEN conv_id % 4 = 0 THEN 'Stephen' END, '{default_b}') END"
    )


ORACLE_SQL["voice_route"] = f"""
WITH {_CONV_TURNS}
SELECT conv_id, turn_no, speaker, {_voice('Amy', 'Matthew')} AS voice_id,
       'mp3' AS output_format, 'ssml' AS text_type
FROM conv_turns
"""


def _turn_chunks(default_a: str, default_b: str) -> str:
    return f"""{_CONV_TURNS},
vt AS (SELECT conv_id, turn_no, {_voice(default_a, default_b)} AS voice_id, text FROM conv_turns),
{q.chunks_cte('vt', 'conv_id, turn_no, voice_id', 'text', 1800)}"""


ORACLE_SQL["synthesis_requests"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')}
SELECT conv_id, turn_no, chunk_no, voice_id, 'polly' AS provider, 'mp3' AS output_format,
       'ssml' AS text_type, {q.ssml('chunk')} AS request_text, 'generative' AS engine,
       NULL::VARCHAR AS endpoint, NULL::VARCHAR AS model_id, NULL::VARCHAR AS request_error
FROM ck
"""

ORACLE_SQL["synthesis_requests_el"] = f"""
WITH RECURSIVE {_turn_chunks('JBFqnCBsd6RMkjVDRZzb', 'JBFqnCBsd6RMkjVDRZzb')}
SELECT conv_id, turn_no, chunk_no, voice_id, 'elevenlabs' AS provider,
       'mp3_44100_128' AS output_format, 'text' AS text_type, chunk AS request_text,
       NULL::VARCHAR AS engine, 'https://api.elevenlabs.io/v1/text-to-speech/' || voice_id AS endpoint,
       'eleven_multilingual_v2' AS model_id, NULL::VARCHAR AS request_error
FROM ck
"""

ORACLE_SQL["audio_concat"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')},
a AS (SELECT conv_id, string_agg(chunk, '' ORDER BY turn_no, chunk_no) AS audio, count(*) AS n FROM ck GROUP BY conv_id)
SELECT conv_id, strlen(audio)::BIGINT AS audio_bytes, md5(audio) AS audio_md5, n::BIGINT AS chunk_count,
       NULL::VARCHAR AS error
FROM a
"""

ORACLE_SQL["synthesis_report"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')}
SELECT conv_id, turn_no, count(*)::BIGINT AS chunk_count, sum(length(chunk))::BIGINT AS input_chars,
       sum(strlen(chunk))::BIGINT AS audio_bytes, GROUPING(turn_no)::BIGINT AS level, true AS elapsed_known
FROM ck GROUP BY GROUPING SETS ((conv_id, turn_no), (conv_id))
"""

_PARAGRAPHS = f"""{_CONV_LINES},
kept AS (SELECT conv_id, turn, line_no, {q.strip(q.collapse_ws('raw'))} AS line FROM conv_lines),
numbered AS (
  SELECT conv_id, turn, line_no, line,
         ((row_number() OVER (PARTITION BY conv_id ORDER BY turn, line_no)) - 1) // 6 AS paragraph_no
  FROM kept WHERE line <> ''),
paras AS (
  SELECT conv_id, paragraph_no::BIGINT AS paragraph_no, string_agg(line, ' ' ORDER BY turn, line_no) AS text
  FROM numbered GROUP BY conv_id, paragraph_no)"""

ORACLE_SQL["transcript_paragraphs"] = f"WITH {_PARAGRAPHS}\nSELECT conv_id, paragraph_no, text FROM paras"

ORACLE_SQL["transcript_segments"] = f"""
WITH arr AS (SELECT doc_id, {q.lines('text')} AS ls FROM documents WHERE doc_id % 11 <> 4),
li AS (SELECT doc_id, unnest(generate_series(1, len(ls))) - 1 AS i, ls FROM arr),
kept AS (SELECT doc_id, i, {q.strip(q.collapse_ws('ls[i + 1]'))} AS line FROM li WHERE i % 7 NOT IN (3, 5)),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1) // 6 AS paragraph_no FROM kept WHERE line <> '')
SELECT doc_id, paragraph_no::BIGINT AS paragraph_no, string_agg(line, ' ' ORDER BY i) AS text FROM numbered GROUP BY doc_id, paragraph_no
"""

ORACLE_SQL["transcript_source"] = f"""
WITH {_PARAGRAPHS},
j AS (SELECT conv_id, {q.strip("string_agg(text, chr(10) || chr(10) ORDER BY paragraph_no)")} AS text
      FROM paras GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, j.text, length(j.text)::BIGINT AS n_chars,
       CASE WHEN j.text IS NULL THEN 'YouTube transcript is empty' END AS error
FROM c LEFT JOIN j ON c.conv_id = j.conv_id
"""


# --- URLs and requests --------------------------------------------------------------------------


_HOST = f"lower(regexp_extract(url, '{U.HOST_RX}', 1))"
_PATH = f"regexp_replace(regexp_extract(url, '{U.PATH_RX}', 1), ';[^/]*$', '')"
_QUERY = f"regexp_extract(url, '{U.QUERY_RX}', 1)"
_VIDEO_HOSTS = ", ".join(f"'{h}'" for h in U.VIDEO_HOSTS)
_SHORT = ", ".join(f"'{h}'" for h in U.SHORT_HOSTS)
_LONG = ", ".join(f"'{h}'" for h in U.LONG_HOSTS)
_SCHEME_OK = "(starts_with(url, 'http://') OR starts_with(url, 'https://'))"


def _plus_decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


_V_HIT = (
    f"list_filter(string_split({_QUERY}, '&'), lambda f: position('=' IN f) > 0 "
    f"AND {_plus_decode('split_part(f, ' + chr(39) + '=' + chr(39) + ', 1)')} = 'v' "
    f"AND substring(f, position('=' IN f) + 1) <> '')[1]"
)
_WATCH = f"CASE WHEN {_PATH} = '/watch' THEN {_plus_decode(f'substring({_V_HIT}, position({chr(39)}={chr(39)} IN {_V_HIT}) + 1)')} END"
_PREFIXED = "CASE " + " ".join(
    f"WHEN starts_with({_PATH}, '{p}') AND split_part(substring({_PATH}, {len(p) + 1}), '/', 1) <> '' "
    f"THEN split_part(substring({_PATH}, {len(p) + 1}), '/', 1)"
    for p in U.VIDEO_PATH_PREFIXES
) + " END"
_SHORT_ID = f"split_part(ltrim({_PATH}, '/'), '/', 1)"
_VIDEO_ID = (
    f"CASE WHEN {_HOST} IN ({_SHORT}) AND {_SHORT_ID} <> '' THEN {_SHORT_ID} "
    f"WHEN {_HOST} IN ({_LONG}) THEN coalesce(CASE WHEN {_WATCH} <> '' THEN {_WATCH} END, {_PREFIXED}) END"
)
_IS_VIDEO = f"coalesce({_HOST} IN ({_VIDEO_HOSTS}), false)"

ORACLE_SQL["url_route"] = f"""
WITH {I.page_urls_sql()}
SELECT page_id, url, {_SCHEME_OK} AS scheme_ok, {_IS_VIDEO} AS is_video, {_HOST} AS host,
       CASE WHEN NOT {_SCHEME_OK} THEN '{U.SCHEME_ERROR}' END AS error
FROM urls
"""

ORACLE_SQL["video_id"] = f"""
WITH {I.page_urls_sql()},
v AS (SELECT page_id, url, {_IS_VIDEO} AS is_video, {_VIDEO_ID} AS vid FROM urls)
SELECT page_id, url, CASE WHEN is_video AND vid IS NOT NULL THEN vid END AS video_id,
       CASE WHEN NOT is_video THEN '{U.NOT_VIDEO_ERROR}' WHEN vid IS NULL THEN '{U.NO_VIDEO_ID_ERROR}' END AS error
FROM v
"""


def _jt(f: str) -> str:
    return f"json_type(js, '$.{f}')"


def _absent(f: str) -> str:
    return f"({_jt(f)} IS NULL OR {_jt(f)} = 'NULL')"


def _is_str(f: str) -> str:
    return f"coalesce({_jt(f)} = 'VARCHAR', false)"


def _sval(f: str) -> str:
    return f"(CASE WHEN {_is_str(f)} THEN json_extract_string(js, '$.{f}') END)"


def _nonblank(x: str) -> str:
    return f"(CASE WHEN {q.strip(x)} <> '' THEN {q.strip(x)} END)"


def _req_string_checks(f: str) -> list[tuple[str, str]]:
    return [
        (f"NOT {_absent(f)} AND NOT {_is_str(f)}", f"field must be a string: {f}"),
        (f"{_is_str(f)} AND {q.strip(_sval(f))} = ''", f"field must not be empty: {f}"),
    ]


def _first(pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{m}'" for c, m in pairs) + " END"


_MODE = f"lower({q.strip('coalesce(' + _sval('script_mode') + ', ' + repr('') + ')')})"


def _host(col: str) -> str:
    return f"lower(regexp_extract({col}, '{U.HOST_RX}', 1))"


_NORMALIZE_ERROR = _first(
    [(f"NOT {_absent('source_url')} AND NOT {_is_str('source_url')}", K.must_be_string("source_url"))]
    + _req_string_checks("source_file_name")
    + [("script_mode NOT IN ('single', 'duo')", K.E_MODE)]
    + _req_string_checks("voice_id")
    + _req_string_checks("voice_id_b")
)
_SOURCE_ERROR = _first([
    ("(source_url IS NOT NULL) = (source_file_base64 IS NOT NULL)", K.E_EXACTLY_ONE),
    ("source_file_base64 IS NOT NULL AND source_file_name IS NULL", K.E_NAME_REQUIRED),
    ("source_file_base64 IS NOT NULL AND source_text IS NOT NULL", K.E_TEXT_WITH_FILE),
    (f"source_file_base64 IS NOT NULL AND NOT regexp_matches(source_file_base64, '{STRICT_B64_RX}')", K.E_BAD_FILE_B64),
    (f"source_url IS NOT NULL AND {_host('source_url')} IN ({_VIDEO_HOSTS}) AND source_text IS NULL", K.E_VIDEO_NEEDS_TEXT),
])

_INTAKE = f"""{I.request_rows_sql()},
p AS (
  SELECT event_id, body, is_base64, region_param, arn_param, breaks, (body IS NULL OR body = '') AS empty,
         CASE WHEN read_as IS NOT NULL THEN read_as
              WHEN is_base64 THEN decode(from_base64(regexp_replace(body, '[^A-Za-z0-9+/=]', '', 'g'))) ELSE body END AS text
  FROM requests),
j0 AS (
  SELECT *, CASE WHEN empty THEN NULL WHEN breaks THEN 'internal server error' WHEN NOT json_valid(text) THEN '{K.E_BAD_JSON}'
                 WHEN json_type(text) <> 'OBJECT' THEN '{K.E_NOT_OBJECT}' END AS parse_error
  FROM p),
j AS (SELECT *, CASE WHEN empty OR parse_error IS NOT NULL THEN '{{}}' ELSE text END AS js FROM j0),
n0 AS (
  SELECT event_id, parse_error, js, region_param, arn_param,
    {_nonblank(_sval('source_url'))} AS source_url,
    {_nonblank(f"CASE WHEN {_absent('source_text')} THEN {_sval('transcript_text')} ELSE {_sval('source_text')} END")} AS source_text,
    {_nonblank(_sval('source_file_name'))} AS source_file_name,
    {_nonblank(_sval('source_file_base64'))} AS source_file_base64,
    {_nonblank(_sval('job_id'))} AS job_id,
    coalesce({_nonblank(_sval('style'))}, 'podcast') AS style,
    CASE WHEN {_MODE} = '' THEN 'single' ELSE {_MODE} END AS script_mode,
    {_nonblank(_sval('voice_id'))} AS voice_id,
    {_nonblank(_sval('voice_id_b'))} AS voice_id_b,
    coalesce({_nonblank('region_param')}, 'us-east-1') AS region,
    CASE WHEN coalesce(json_extract(js, '$.state_machine_arn')::VARCHAR, 'null') IN ('null', '""', '0', '0.0', 'false', '[]', '{{}}')
         THEN {_nonblank('arn_param')} ELSE {_nonblank(_sval('state_machine_arn'))} END AS state_machine_arn
  FROM j),
n AS (SELECT *, {_NORMALIZE_ERROR} AS normalize_error, {_SOURCE_ERROR} AS source_error FROM n0),
r AS (SELECT *, coalesce(parse_error, normalize_error, source_error) AS error FROM n)"""

_REQ_FIELDS = ", ".join(f"CASE WHEN error IS NULL THEN {f} END AS {f}" for f in K.REQUEST_FIELDS)

ORACLE_SQL["request_parse"] = f"""
WITH {_INTAKE}
SELECT event_id, CASE WHEN parse_error IS NULL THEN array_to_string(list_sort(json_keys(js)), ',') END AS body_keys,
       parse_error AS error
FROM r
"""
ORACLE_SQL["request_validate"] = f"""
WITH {_INTAKE}
SELECT event_id, CASE WHEN error IS NULL THEN 202 WHEN error = 'internal server error' THEN 500 ELSE 400 END::INTEGER AS status_code, error FROM r
"""
ORACLE_SQL["request_normalize"] = f"""
WITH {_INTAKE}
SELECT event_id, {_REQ_FIELDS}, CASE WHEN error IS NULL THEN 202 WHEN error = 'internal server error' THEN 500 ELSE 400 END::INTEGER AS status_code, error FROM r
"""
ORACLE_SQL["request_accept"] = f"""
WITH {_INTAKE}
SELECT event_id, job_id, source_url, source_file_name, style, script_mode, voice_id, voice_id_b, region,
       state_machine_arn
FROM r WHERE error IS NULL
"""


# --- pipeline events ---------------------------------------------------------------------------


_KNOWN = ", ".join(f"'{n}'" for n in EV.EVENT_FIELDS)
_EV_MODE = f"lower({q.strip('coalesce(' + q.strip(_sval('script_mode')) + ', ' + repr('single') + ')')})"


def _ev_clean(n: str) -> str:
    if n in EV.INT_FIELDS:
        return f"CASE WHEN {_jt(n)} IN ('BIGINT', 'UBIGINT') THEN json_extract(js, '$.{n}')::BIGINT END"
    if n == "style":
        return f"coalesce({q.strip(_sval('style'))}, 'podcast')"
    if n == "script_mode":
        return _EV_MODE
    return q.strip(_sval(n))


def _ev_checks(n: str) -> list[tuple[str, str]]:
    if n in EV.INT_FIELDS:
        return [
            (f"NOT {_absent(n)} AND {_jt(n)} NOT IN ('BIGINT', 'UBIGINT')", f"event field ''{n}'' must be an integer"),
            (f"NOT {_absent(n)} AND ({_ev_clean(n)}) < 0", f"event field ''{n}'' must be >= 0"),
        ]
    out = [
        (f"NOT {_absent(n)} AND NOT {_is_str(n)}", f"event field ''{n}'' must be a string"),
        (f"{_is_str(n)} AND {q.strip(_sval(n))} = ''", f"event field ''{n}'' must not be empty"),
    ]
    if n == "script_mode":
        out.append((f"{_EV_MODE} NOT IN ('single', 'duo')", "event field ''script_mode'' must be one of: duo, single"))
    return out


_EVENTS = f"""{I.event_rows_sql()},
p AS (SELECT event_id, stage, body, (body IS NULL OR body = '') AS empty FROM pevents),
j0 AS (SELECT *, CASE WHEN empty THEN NULL WHEN NOT json_valid(body) THEN 'invalid JSON request body'
                      WHEN json_type(body) <> 'OBJECT' THEN 'event must be a JSON object' END AS parse_error FROM p),
j AS (SELECT *, CASE WHEN empty OR parse_error IS NOT NULL THEN '{{}}' ELSE body END AS js FROM j0),
c AS (
  SELECT event_id, stage,
         coalesce(parse_error, {_first([c for n in EV.EVENT_FIELDS for c in _ev_checks(n)])}) AS error,
         {", ".join(f"{_ev_clean(n)} AS {n}" for n in EV.EVENT_FIELDS)},
         list_filter(json_keys(js), lambda k: k NOT IN ({_KNOWN})) AS extra_keys
  FROM j),
ev AS (
  SELECT event_id, stage, error,
         {", ".join(f"CASE WHEN error IS NULL THEN {n} END AS {n}" for n in EV.EVENT_FIELDS)},
         CASE WHEN error IS NULL THEN extra_keys END AS extra_keys
  FROM c)"""

ORACLE_SQL["event_validate"] = f"""
WITH {_EVENTS}
SELECT event_id, stage, job_id, style, script_mode, title, article_s3_key, script_s3_key,
       article_char_count, audio_estimated_duration_sec, error
FROM ev
"""
ORACLE_SQL["event_extras"] = f"""
WITH {_EVENTS}
SELECT event_id, array_to_string(extra_keys, ',') AS extra_keys, error FROM ev
"""
_GATE = f"""CASE WHEN stage = 'fetch' THEN {_first([
    ("job_id IS NULL", EV.E_FETCH_JOB),
    ("(source_url IS NOT NULL) = (source_file_base64 IS NOT NULL)", EV.E_FETCH_ONE),
    ("source_file_base64 IS NOT NULL AND source_file_name IS NULL", EV.E_FETCH_NAME),
    ("source_file_base64 IS NOT NULL AND source_text IS NOT NULL", EV.E_FETCH_TEXT)])}
  WHEN stage = 'rewrite' THEN CASE WHEN job_id IS NULL OR article_s3_key IS NULL THEN '{EV.E_REWRITE}' END
  WHEN stage = 'generate' THEN CASE WHEN job_id IS NULL OR script_s3_key IS NULL THEN '{EV.E_GENERATE}' END
  ELSE 'unsupported pipeline stage: ' || stage END"""
ORACLE_SQL["stage_gate"] = f"""
WITH {_EVENTS}
SELECT event_id, stage, coalesce(error, {_GATE}) AS error FROM ev
"""
_HANDOVER = "list_concat(extra_keys, list_filter([" + ", ".join(
    f"CASE WHEN {n} IS NOT NULL THEN '{n}' END" for n in EV.EVENT_FIELDS) + "], lambda k: k IS NOT NULL))"
ORACLE_SQL["event_json"] = f"""
WITH {_EVENTS}
SELECT event_id, array_to_string({_HANDOVER}, ',') AS handover_keys, len({_HANDOVER})::BIGINT AS n_keys,
       job_id, script_mode, article_char_count
FROM ev WHERE error IS NULL
"""


# --- documents and files -------------------------------------------------------------------------


_SUFFIX = "[" + ", ".join(f"'{x}'" for x in I.FILE_SUFFIXES) + f"][(doc_id % {len(I.FILE_SUFFIXES)}) + 1]"
_NAME = f"('doc' || CAST(doc_id AS VARCHAR) || {_SUFFIX})"
_SFX = f"lower(regexp_extract({_NAME}, '{FS.SUFFIX_RX}', 1))"
_TYPE = f"CASE {_SFX} WHEN '.pdf' THEN 'pdf' WHEN '.docx' THEN 'docx' WHEN '.txt' THEN 'txt' END"
_TYPE_ERR = (f"CASE WHEN ({_TYPE}) IS NULL THEN 'Unsupported document type ''' || "
             f"CASE WHEN {_SFX} <> '' THEN {_SFX} ELSE {_NAME} END || '''. Use: .docx, .pdf, .txt' END")

ORACLE_SQL["doc_type"] = f"SELECT doc_id, {_NAME} AS name, {_TYPE} AS doc_type, {_TYPE_ERR} AS error FROM documents"

_B64 = "to_base64(encode(text))"
_B64V = (f"CASE WHEN doc_id % 4 = 1 THEN rtrim({_B64}, '=') "
         f"WHEN doc_id % 4 = 2 THEN substring({_B64}, 1, 4) || ' ' || substring({_B64}, 5) ELSE {_B64} END")
ORACLE_SQL["base64_text"] = f"""
WITH b AS (SELECT doc_id, {_B64V} AS b64 FROM documents),
v AS (SELECT doc_id, b64, regexp_matches(b64, '{STRICT_B64_RX}') AS valid FROM b)
SELECT doc_id, valid, CASE WHEN valid THEN md5(from_base64(b64)) END AS decoded_md5,
       CASE WHEN valid THEN octet_length(from_base64(b64)) END::BIGINT AS n_bytes,
       CASE WHEN NOT valid THEN '{FS.E_FETCH_BAD_B64}' END AS error
FROM v
"""
_LATIN = "'é ' || regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g')"
ORACLE_SQL["txt_decode"] = f"""
SELECT doc_id, CASE WHEN doc_id % 6 = 2 THEN {q.strip(_LATIN)} ELSE {q.strip('text')} END AS text,
       CASE doc_id % 6 WHEN 1 THEN 'utf-16' WHEN 4 THEN 'utf-16' WHEN 2 THEN 'latin-1' ELSE 'utf-8-sig' END AS encoding FROM documents
"""

_PAGES_TEXT = q.strip(
    f"array_to_string(list_filter(list_transform({q.lines('text')}, lambda x: {q.strip('x')}), lambda x: x <> ''), chr(10) || chr(10))"
)
ORACLE_SQL["page_assembly"] = f"""
SELECT doc_id, nullif({_PAGES_TEXT}, '') AS text, CASE WHEN coalesce({_PAGES_TEXT}, '') = '' THEN 'document has no readable page' END AS error FROM documents
"""
ORACLE_SQL["docx_text"] = f"SELECT doc_id, {_PAGES_TEXT} AS text, NULL::VARCHAR AS error FROM documents"

ORACLE_SQL["document_source"] = f"""
WITH f AS (
  SELECT doc_id, {_NAME} AS name, {_TYPE} AS t, {_TYPE_ERR} AS type_error,
         doc_id % {I.EMPTY_FILE_EVERY} = 0 AS empty,
         CASE {_TYPE} WHEN 'txt' THEN {q.strip('text')} ELSE {_PAGES_TEXT} END AS x
  FROM documents),
g AS (
  SELECT doc_id, name, CASE WHEN NOT empty THEN t END AS doc_type,
         CASE WHEN empty THEN '{FS.E_EMPTY_FILE}' ELSE type_error END AS e, x FROM f)
SELECT doc_id, name, doc_type,
       CASE WHEN e IS NULL AND x <> '' THEN x END AS text,
       CASE WHEN e IS NULL AND x <> '' THEN length(x) END::BIGINT AS n_chars,
       CASE WHEN e IS NOT NULL THEN e WHEN coalesce(x, '') = '' THEN
            'No readable text found in uploaded ' || upper(doc_type) || ' document.' END AS error
FROM g
"""


# --- prompts and model ---------------------------------------------------------------------------


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MODE_SQL = f"lower({q.strip('script_mode')})"
_PROMPT = (
    f"CASE WHEN {_MODE_SQL} IN ('single', 'duo') THEN "
    f"{_lit(P.PROMPT_HEAD)} || CASE {_MODE_SQL} WHEN 'single' THEN {_lit(P.SINGLE_INSTRUCTION)} ELSE {_lit(P.DUO_INSTRUCTION)} END"
    f" || {_lit(P.PROMPT_TAIL)} || 'Style: ' || coalesce(style, 'None') || chr(10)"
    f" || 'Script Mode: ' || {_MODE_SQL} || chr(10)"
    f" || CASE WHEN title IS NOT NULL AND title <> '' THEN 'Title: ' || title || chr(10) ELSE '' END"
    f" || 'Input Type: ' || CASE WHEN source_type IS NOT NULL AND source_type <> '' THEN source_type ELSE 'article' END || chr(10)"
    f" || CASE WHEN source_type = 'youtube' THEN {_lit(P.VIDEO_LABEL)} ELSE {_lit(P.SOURCE_LABEL)} END || ':' || chr(10)"
    f" || text END"
)
_PROMPT_ERR = f"CASE WHEN {_MODE_SQL} NOT IN ('single', 'duo') OR {_MODE_SQL} IS NULL THEN {_lit(P.PROMPT_MODE_ERROR)} END"
_FAMILY = ("CASE WHEN starts_with(model_id, 'anthropic.') OR starts_with(model_id, 'us.anthropic.') THEN 'anthropic' "
           "WHEN starts_with(model_id, 'amazon.nova') OR starts_with(model_id, 'us.amazon.nova') THEN 'nova' END")

ORACLE_SQL["prompt"] = f"WITH {I.rewrite_jobs_sql()}\nSELECT doc_id, {_PROMPT} AS prompt, {_PROMPT_ERR} AS error FROM jobs"
ORACLE_SQL["model_route"] = f"""WITH {I.rewrite_jobs_sql()}
SELECT doc_id, model_id, {_FAMILY} AS family,
       CASE WHEN ({_FAMILY}) IS NULL THEN 'Unsupported Bedrock model_id: ' || model_id END AS error
FROM jobs"""
ORACLE_SQL["model_request"] = f"""WITH {I.rewrite_jobs_sql()},
b AS (SELECT doc_id, {_FAMILY} AS family, {_PROMPT} AS prompt,
             CASE WHEN {_FAMILY} IS NULL THEN 'Unsupported Bedrock model_id: ' || model_id ELSE {_PROMPT_ERR} END AS error FROM jobs),
c AS (SELECT *, family IS NOT NULL AND prompt IS NOT NULL AS made FROM b)
SELECT doc_id, family, CASE WHEN made THEN {P.MAX_TOKENS} END::BIGINT AS max_tokens, CASE WHEN made THEN {P.TEMPERATURE} END::DOUBLE AS temperature,
       CASE WHEN made THEN 'user' END AS role, CASE WHEN made AND family = 'anthropic' THEN '{P.FAMILY_A_VERSION}' END AS version,
       CASE WHEN made THEN md5(prompt) END AS prompt_md5, error
FROM c"""

_A_CONTENT_T = "json_type(response, '$.content')"
_A_FALSY = (f"({_A_CONTENT_T} IS NULL OR {_A_CONTENT_T} = 'NULL' "
            f"OR json_extract(response, '$.content')::VARCHAR IN ('[]', '{{}}', '\"\"', 'false', '0'))")
_A_FIRST = f"CASE WHEN {_A_CONTENT_T} = 'ARRAY' AND json_type(response, '$.content[0].text') = 'VARCHAR' THEN json_extract_string(response, '$.content[0].text') END"
_N_HIT = "list_filter(coalesce(json_extract(response, '$.output.message.content[*]'), []), lambda x: json_exists(x, '$.text'))"
_N_TEXT = f"CASE WHEN json_type({_N_HIT}[1], '$.text') = 'VARCHAR' THEN json_extract_string({_N_HIT}[1], '$.text') END"
ORACLE_SQL["model_response"] = f"""WITH {I.model_responses_sql()},
x AS (
  SELECT doc_id, family,
         CASE WHEN family = 'anthropic' THEN
              CASE WHEN {_A_FALSY} THEN '{P.E_A_NO_CONTENT}' WHEN coalesce({_A_FIRST}, '') = '' THEN '{P.E_A_NO_TEXT}' END
              ELSE CASE WHEN {_N_TEXT} IS NULL THEN '{P.E_N_NO_TEXT}' END END AS error,
         CASE WHEN family = 'anthropic' THEN {q.strip(_A_FIRST)} ELSE {q.strip(_N_TEXT)} END AS t
  FROM responses)
SELECT doc_id, family, CASE WHEN error IS NULL THEN t END AS script, error FROM x"""

ORACLE_SQL["script_metadata"] = f"""WITH {I.rewrite_jobs_sql()}
SELECT doc_id, 8::BIGINT AS n_fields, job_id, title, source_type, 'jobs/' || job_id || '/script.txt' AS script_s3_key,
       'anthropic.claude-3-haiku-20240307-v1:0' AS model_id
FROM jobs"""

ORACLE_SQL["rewrite"] = f"""WITH {I.rewrite_jobs_sql()},
x AS (SELECT doc_id, {_PROMPT_ERR} AS error, {q.strip('text')} AS s FROM jobs)
SELECT doc_id, CASE WHEN error IS NULL THEN s END AS script,
       CASE WHEN error IS NULL THEN length(s) END::BIGINT AS script_chars, error
FROM x"""


# --- fetch stage -----------------------------------------------------------------------------------


def _doc_type_of(col: str) -> str:
    sfx = f"lower(regexp_extract({col}, '{FS.SUFFIX_RX}', 1))"
    return f"CASE {sfx} WHEN '.pdf' THEN 'pdf' WHEN '.docx' THEN 'docx' WHEN '.txt' THEN 'txt' END"


def _doc_type_err_of(col: str) -> str:
    sfx = f"lower(regexp_extract({col}, '{FS.SUFFIX_RX}', 1))"
    return (f"CASE WHEN ({_doc_type_of(col)}) IS NULL THEN 'Unsupported document type ''' || "
            f"CASE WHEN {sfx} <> '' THEN {sfx} ELSE {col} END || '''. Use: .docx, .pdf, .txt' END")


_RNAME = "coalesce(source_file_name, 'uploaded-document')"
_RVIDEO = f"(source_url IS NOT NULL AND {_host('source_url')} IN ({_VIDEO_HOSTS}))"
ORACLE_SQL["source_route"] = f"""
WITH {_INTAKE}
SELECT event_id,
  CASE WHEN source_file_base64 IS NOT NULL THEN {_doc_type_of(_RNAME)}
       WHEN source_text IS NOT NULL THEN CASE WHEN {_RVIDEO} THEN 'youtube' ELSE 'text' END
       WHEN {_RVIDEO} THEN NULL ELSE 'article' END AS source_type,
  CASE WHEN source_file_base64 IS NOT NULL AND NOT regexp_matches(source_file_base64, '{STRICT_B64_RX}') THEN '{FS.E_FETCH_BAD_B64}'
       WHEN source_file_base64 IS NOT NULL THEN {_doc_type_err_of(_RNAME)}
       WHEN source_text IS NULL AND {_RVIDEO} THEN '{RT.E_VIDEO_NO_TEXT}'
       WHEN source_text IS NULL AND NOT (starts_with(source_url, 'http://') OR starts_with(source_url, 'https://')) THEN '{U.SCHEME_ERROR}'
  END AS error
FROM r WHERE error IS NULL
"""

_ART = _article_sql(True).strip()
ORACLE_SQL["fetch_stage"] = f"""
WITH art AS ({_ART}),
{_PARAGRAPHS},
tj AS (SELECT conv_id, {q.strip("string_agg(text, chr(10) || chr(10) ORDER BY paragraph_no)")} AS text FROM paras GROUP BY conv_id),
u AS (
  SELECT 'page-' || CAST(page_id AS VARCHAR) AS job_id, CASE WHEN error IS NULL THEN 'article' END AS source_type,
         text, error FROM art
  UNION ALL
  SELECT 'conv-' || CAST(conv_id AS VARCHAR), 'youtube', text, NULL FROM tj
  UNION ALL
  SELECT 'doc-' || CAST(doc_id AS VARCHAR), 'txt', {q.strip('text')}, NULL FROM documents)
SELECT job_id, 'podcast-artifacts' AS bucket, source_type, text,
       CASE WHEN error IS NULL THEN 'jobs/' || job_id || '/source.txt' END AS article_s3_key,
       CASE WHEN error IS NULL THEN length(text) END::BIGINT AS article_char_count, error
FROM u
"""


# --- speech step, job summary, ledger, run status ---------------------------------------------

ORACLE_SQL["synthesize"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')}
SELECT conv_id, turn_no, chunk_no, length(chunk)::BIGINT AS input_chars, strlen(chunk)::BIGINT AS audio_bytes,
       NULL::VARCHAR AS error
FROM ck
"""


_WORDS = q.words("CASE WHEN conv_id % 9 = 4 THEN '' WHEN role = 'user' THEN 'HOST_A: ' WHEN role = 'assistant' THEN 'HOST_B: ' ELSE '' END || text")
ORACLE_SQL["podcast_jobs"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')},
kept AS (SELECT conv_id, turn, line_no, {q.strip(q.collapse_ws('raw'))} AS line FROM conv_lines),
numbered AS (
  SELECT conv_id, turn, line_no, line,
         ((row_number() OVER (PARTITION BY conv_id ORDER BY turn, line_no)) - 1) // 6 AS paragraph_no
  FROM kept WHERE line <> ''),
paras AS (SELECT conv_id, paragraph_no, string_agg(line, ' ' ORDER BY turn, line_no) AS text
          FROM numbered GROUP BY conv_id, paragraph_no),
src AS (SELECT conv_id, length({q.strip("string_agg(text, chr(10) || chr(10) ORDER BY paragraph_no)")})::BIGINT AS n
        FROM paras GROUP BY conv_id),
tc AS (SELECT conv_id, count(*) AS turn_count FROM conv_turns GROUP BY conv_id),
au AS (SELECT conv_id, count(*) AS chunk_count, sum(strlen(chunk)) AS audio_bytes FROM ck GROUP BY conv_id),
w AS (SELECT conv_id, sum(len({_WORDS})) AS words FROM conversations GROUP BY conv_id),
jobs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT jobs.conv_id, 'youtube' AS source_type, src.n AS article_char_count,
       coalesce(tc.turn_count, 0)::BIGINT AS turn_count, coalesce(au.chunk_count, 0)::BIGINT AS chunk_count,
       au.audio_bytes::BIGINT AS audio_bytes, trunc((w.words::DOUBLE / 150.0) * 60.0)::BIGINT AS duration_sec,
       CASE WHEN tc.turn_count IS NULL THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       CASE WHEN tc.turn_count IS NULL THEN '{_NO_TURNS}' END AS error
FROM jobs LEFT JOIN src USING (conv_id) LEFT JOIN tc USING (conv_id) LEFT JOIN au USING (conv_id)
     LEFT JOIN w USING (conv_id)
"""


ORACLE_SQL["artefact_keys"] = "WITH " + I.rewrite_jobs_sql() + "\n" + "\nUNION ALL\n".join(
    f"SELECT job_id, '{a}' AS artefact, 'jobs/' || job_id || '/{f}' AS object_key FROM jobs" for a, f in LG.ARTEFACTS
)

ORACLE_SQL["run_ledger"] = f"""
WITH RECURSIVE {I.rewrite_jobs_sql()},
f AS (
  SELECT doc_id, {_NAME} AS name, {_TYPE} AS t, {_TYPE_ERR} AS type_error,
         doc_id % {I.EMPTY_FILE_EVERY} = 0 AS empty,
         CASE {_TYPE} WHEN 'txt' THEN {q.strip('text')} ELSE {_PAGES_TEXT} END AS x
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN empty THEN '{FS.E_EMPTY_FILE}' ELSE type_error END AS e, t, x FROM f),
fe AS (
  SELECT doc_id, x, CASE WHEN e IS NOT NULL THEN e WHEN coalesce(x, '') = '' THEN
                 'No readable text found in uploaded ' || upper(t) || ' document.' END AS fetch_error FROM g),
re AS (
  SELECT jobs.doc_id, job_id, fetch_error, CASE WHEN fetch_error IS NULL THEN length(x) END AS article_char_count,
         CASE WHEN fetch_error IS NULL THEN {_PROMPT_ERR} END AS rewrite_error,
         CASE WHEN fetch_error IS NULL AND ({_PROMPT_ERR}) IS NULL THEN {q.strip('x')} END AS script
  FROM jobs JOIN fe USING (doc_id)),
ok AS (SELECT job_id, script FROM re WHERE script IS NOT NULL),
{q.chunks_cte('ok', 'job_id', 'script', 1800)},
cc AS (SELECT job_id, count(*) AS chunk_count FROM ck GROUP BY job_id)
SELECT re.job_id, CASE WHEN coalesce(fetch_error, rewrite_error) IS NULL THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
       CASE WHEN fetch_error IS NOT NULL THEN 'fetch' WHEN rewrite_error IS NOT NULL THEN 'rewrite' END AS failed_stage,
       coalesce(fetch_error, rewrite_error) AS error, article_char_count::BIGINT AS article_char_count,
       length(script)::BIGINT AS script_chars, cc.chunk_count::BIGINT AS chunk_count
FROM re LEFT JOIN cc ON re.job_id = cc.job_id
"""


def _iso(x: str) -> str:
    return (f"CASE WHEN {x} IS NOT NULL THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN microsecond({x}) % 1000000 <> 0 THEN '.' || lpad(CAST(microsecond({x}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END"
            f" || '+00:00' END")


ORACLE_SQL["run_status"] = f"""
WITH runs AS (
  SELECT 'arn:exec:' || CAST(event_id AS VARCHAR) AS execution_arn, 'arn:sm:podcast' AS state_machine_arn,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'click' THEN 'RUNNING' ELSE 'SUCCEEDED' END AS status,
         ts AS start_date, event_type, value, props FROM events),
runs2 AS (
  SELECT *, CASE WHEN status <> 'RUNNING' THEN start_date + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS stop_date,
         props AS input, CASE WHEN status = 'FAILED' THEN 'error: ' || event_type ELSE props END AS output FROM runs),
lk AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 50 = 0 THEN '  ' WHEN event_id % 33 = 0 THEN 'arn:exec:missing-' || CAST(event_id AS VARCHAR)
              ELSE ' arn:exec:' || CAST(event_id AS VARCHAR) || ' ' END AS arn FROM events),
ids AS (SELECT request_id, CASE WHEN {q.strip('arn')} <> '' THEN {q.strip('arn')} END AS a FROM lk)
SELECT request_id, a AS execution_arn, state_machine_arn, status, {_iso('start_date')} AS start_date,
       {_iso('stop_date')} AS stop_date,
       CASE WHEN input IS NULL THEN NULL WHEN json_valid(input) THEN 'json' ELSE 'raw' END AS input_kind,
       CASE WHEN json_valid(input) THEN json_extract(input, '$.k')::BIGINT END AS input_k,
       CASE WHEN output IS NULL THEN NULL WHEN json_valid(output) THEN 'json' ELSE 'raw' END AS output_kind,
       CASE WHEN output IS NOT NULL AND NOT json_valid(output) THEN output END AS output_raw,
       (CASE WHEN a IS NULL THEN 400 WHEN status IS NULL THEN 400 ELSE 200 END)::INTEGER AS status_code,
       CASE WHEN a IS NULL THEN '{LG.E_MISSING_ARN}' WHEN status IS NULL THEN 'execution not found: ' || a END AS error
FROM ids LEFT JOIN runs2 ON ids.a = runs2.execution_arn
"""


ORACLE_SQL["stream_intake"] = ORACLE_SQL["request_validate"]

ORACLE_SQL["job_id_assign"] = f"""
WITH {_INTAKE}
SELECT event_id, job_id AS job_id_given, job_id IS NULL AS is_generated, true AS id_ok FROM r WHERE error IS NULL
"""


# --- whole runs from request rows -----------------------------------------------------------------

_RJ_TYPE = _doc_type_of("coalesce(source_file_name, 'uploaded-document')")
_RJ_TYPE_ERR = _doc_type_err_of("coalesce(source_file_name, 'uploaded-document')")
_RJ_LABEL = LABEL_RX

ORACLE_SQL["request_jobs"] = f"""
WITH RECURSIVE {_INTAKE},
art AS ({_article_sql(True).strip()}),
art_url AS (SELECT p.url, a.text AS art_text, a.error AS art_error FROM pages p JOIN art a ON p.page_id = a.page_id),
acc AS (SELECT * FROM r WHERE error IS NULL),
routed AS (
  SELECT acc.*,
         CASE WHEN source_file_base64 IS NOT NULL THEN 'file'
              WHEN source_text IS NOT NULL THEN CASE WHEN {_RVIDEO} THEN 'youtube' ELSE 'text' END
              WHEN {_RVIDEO} THEN 'video' ELSE 'article' END AS route
  FROM acc),
fetched AS (
  SELECT routed.event_id, routed.style, routed.script_mode, route,
    CASE WHEN route = 'file' THEN
           CASE WHEN NOT regexp_matches(source_file_base64, '{STRICT_B64_RX}') THEN '{FS.E_FETCH_BAD_B64}'
                WHEN ({_RJ_TYPE_ERR}) IS NOT NULL THEN {_RJ_TYPE_ERR}
                WHEN {_RJ_TYPE} = 'pdf' THEN '{FS.E_PDF_UNAVAILABLE}'
                WHEN {_RJ_TYPE} = 'txt' AND {q.strip("decode(from_base64(source_file_base64))")} = ''
                  THEN 'No readable text found in uploaded TXT document.' END
         WHEN route = 'video' THEN '{RT.E_VIDEO_NO_TEXT}'
         WHEN route = 'article' AND NOT (starts_with(source_url, 'http://') OR starts_with(source_url, 'https://')) THEN '{U.SCHEME_ERROR}'
         WHEN route = 'article' AND art_url.url IS NULL THEN 'Failed to fetch article from ' || source_url || ': page not found'
         WHEN route = 'article' THEN art_error END AS fetch_error,
    CASE WHEN route = 'file' THEN {q.strip("decode(from_base64(source_file_base64))")}
         WHEN route IN ('youtube', 'text') THEN source_text
         WHEN route = 'article' THEN art_text END AS src
  FROM routed LEFT JOIN art_url ON routed.route = 'article' AND art_url.url = routed.source_url),
scripts AS (
  SELECT event_id, script_mode, {q.strip('src')} AS script FROM fetched WHERE fetch_error IS NULL AND NOT contains(src, 'REFUSED')),
s_lines AS (
  SELECT event_id, ln, arr[ln] AS raw
  FROM (SELECT event_id, arr, unnest(generate_series(1, len(arr))) AS ln
        FROM (SELECT event_id, {q.lines('script')} AS arr FROM scripts WHERE script_mode = 'duo'))),
s_marked AS (SELECT *, regexp_matches(raw, '{_RJ_LABEL}') AS is_label FROM s_lines),
s_numbered AS (
  SELECT event_id, ln,
         sum(is_label::INT) OVER (PARTITION BY event_id ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn_no,
         CASE WHEN is_label THEN {q.strip(f"regexp_extract(raw, '{_RJ_LABEL}', 2)")} ELSE {q.strip('raw')} END AS body
  FROM s_marked),
d_turns AS (
  SELECT event_id, turn_no::BIGINT AS turn_no, {q.strip("string_agg(body, chr(10) ORDER BY ln)")} AS text
  FROM s_numbered WHERE turn_no > 0 GROUP BY event_id, turn_no),
all_turns AS (
  SELECT event_id, turn_no, text FROM d_turns WHERE text <> ''
  UNION ALL
  SELECT event_id, 1::BIGINT, script FROM scripts WHERE script_mode <> 'duo'),
{q.chunks_cte('all_turns', 'event_id, turn_no', 'text', 1800)},
gen AS (SELECT event_id, count(*) AS chunk_count, CASE WHEN NOT bool_or(contains(chunk, 'MUTED')) THEN sum(strlen(chunk)) END AS audio_bytes,
               arg_min(chunk_no, turn_no * 1000000 + chunk_no) FILTER (contains(chunk, 'MUTED')) AS muted
        FROM ck GROUP BY event_id),
turned AS (SELECT event_id, count(*) AS turn_count FROM all_turns GROUP BY event_id),
book AS (
  SELECT f.event_id, f.fetch_error, CASE WHEN f.fetch_error IS NULL AND contains(f.src, 'REFUSED') THEN 'Model call failed: model refused' END AS model_error, turned.turn_count,
         CASE WHEN f.fetch_error IS NULL THEN length(f.src) END AS article_char_count,
         length(s.script) AS script_chars,
         CASE WHEN s.script IS NOT NULL AND s.script_mode = 'duo' AND gen.event_id IS NULL THEN '{_NO_TURNS}'
              WHEN gen.muted IS NOT NULL THEN 'Polly response missing AudioStream for chunk ' || gen.muted || '.' END AS gen_error,
         gen.chunk_count, gen.audio_bytes,
         CASE WHEN s.script IS NOT NULL THEN trunc((len({q.words('s.script')})::DOUBLE / 150.0) * 60.0) END AS duration_sec
  FROM fetched f LEFT JOIN scripts s ON f.event_id = s.event_id LEFT JOIN gen ON f.event_id = gen.event_id
       LEFT JOIN turned ON f.event_id = turned.event_id)
SELECT r.event_id, CASE WHEN r.error IS NULL THEN 202 WHEN r.error = 'internal server error' THEN 500 ELSE 400 END::INTEGER AS status_code, r.error AS request_error,
       CASE WHEN r.error IS NOT NULL THEN 'REJECTED' WHEN coalesce(b.fetch_error, b.model_error, b.gen_error) IS NULL THEN 'SUCCEEDED'
            ELSE 'FAILED' END AS status,
       CASE WHEN b.fetch_error IS NOT NULL THEN 'fetch' WHEN b.model_error IS NOT NULL THEN 'rewrite' WHEN b.gen_error IS NOT NULL THEN 'generate' END AS failed_stage,
       coalesce(b.fetch_error, b.model_error, b.gen_error) AS error, CASE WHEN r.error IS NULL THEN coalesce(b.turn_count, 0) END::BIGINT AS turn_count,
       b.article_char_count::BIGINT AS article_char_count, b.script_chars::BIGINT AS script_chars,
       b.chunk_count::BIGINT AS chunk_count, b.audio_bytes::BIGINT AS audio_bytes, b.duration_sec::BIGINT AS duration_sec
FROM r LEFT JOIN book b ON r.event_id = b.event_id
"""


# The stream of whole runs, broken and started again, ends with the table of the batch run; its audio is read
# off the manifest.
ORACLE_SQL["stream_jobs"] = f"""
SELECT *, CASE WHEN status = 'SUCCEEDED' THEN audio_bytes END AS written_bytes FROM ({ORACLE_SQL["request_jobs"]})
"""

ORACLE_SQL["call_journal"] = f"""
WITH {I.rewrite_jobs_sql()}
SELECT doc_id, CASE WHEN {_PROMPT_ERR} IS NULL THEN md5({q.strip('text')}) END AS script_md5,
       {_PROMPT_ERR} AS error, CASE WHEN ({_PROMPT_ERR}) IS NULL THEN 1 ELSE 0 END::BIGINT AS calls
FROM jobs
"""

# Parts of a job's audio in order; a range file holds the parts that begin in it.
ORACLE_SQL["audio_objects"] = f"""
WITH RECURSIVE {_turn_chunks('Amy', 'Matthew')},
placed AS (
  SELECT conv_id, turn_no, chunk_no, chunk,
         (sum(strlen(chunk)) OVER (PARTITION BY conv_id ORDER BY turn_no, chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          - strlen(chunk))::BIGINT AS begins FROM ck)
SELECT conv_id, 'jobs/job-' || CAST(conv_id AS VARCHAR) || '/audio.mp3' AS object_key, (begins // 1024)::BIGINT AS range_no,
       min(begins)::BIGINT AS begins, sum(strlen(chunk))::BIGINT AS n_bytes, md5(string_agg(chunk, '' ORDER BY turn_no, chunk_no)) AS content_md5
FROM placed GROUP BY conv_id, begins // 1024
"""


def _json_text(x: str) -> str:
    """A text as an ASCII JSON string, character by character (two units above U+FFFF)."""
    def unit(n: str) -> str:
        return f"'\\u' || lpad(lower(to_hex({n})), 4, '0')"

    char = (f"CASE WHEN c = '\"' THEN '\\\"' WHEN c = '\\' THEN '\\\\' WHEN unicode(c) = 8 THEN '\\b' WHEN unicode(c) = 12 THEN '\\f' "
            f"WHEN unicode(c) = 10 THEN '\\n' WHEN unicode(c) = 13 THEN '\\r' WHEN unicode(c) = 9 THEN '\\t' "
            f"WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) < 65536 THEN {unit('unicode(c)')} "
            f"ELSE {unit('55296 + ((unicode(c) - 65536) >> 10)')} || {unit('56320 + ((unicode(c) - 65536) & 1023)')} END")
    body = f"array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: {char}), '')"
    return f"coalesce('\"' || {body} || '\"', 'null')"


_META = {"job_id": "job_id", "source_url": "NULL", "source_type": "source_type", "title": "text", "style": "style", "script_mode": "script_mode",
         "model_id": "model_id", "script_s3_key": "'jobs/' || job_id || '/script.txt'"}
_META_JSON = "'{' || chr(10) || " + " || ',' || chr(10) || ".join(
    f"'  \"{f}\": ' || {_json_text(f'CAST({v} AS VARCHAR)')}" for f, v in _META.items()) + " || chr(10) || '}'"
ORACLE_SQL["script_objects"] = f"""
WITH {I.rewrite_jobs_sql()},
made AS (SELECT *, {_META_JSON} AS js,
                CASE WHEN doc_id % 17 = 5 THEN 'missing' WHEN doc_id % 13 = 7 THEN 'broken' END AS fault FROM jobs)
SELECT doc_id, 'jobs/' || job_id || '/script.json' AS object_key,
       CASE WHEN fault IS NULL THEN strlen(js) END::BIGINT AS n_bytes, CASE WHEN fault IS NULL THEN md5(js) END AS content_md5,
       CASE WHEN fault IS NULL THEN md5(text) END AS title_md5, CASE WHEN fault IS NULL THEN source_type END AS source_type,
       CASE WHEN fault IS NULL THEN model_id END AS model_id, fault AS error_kind
FROM made
"""

ORACLE_SQL["file_scan"] = """
SELECT doc_id, CASE WHEN kind IS NULL THEN 'doc' || CAST(doc_id AS VARCHAR) || '.txt' END AS name,
       CASE WHEN kind IS NULL THEN (4 * ((strlen(t) + 2) // 3))::BIGINT END AS base64_chars,
       CASE WHEN kind IS NULL THEN md5(t) END AS content_md5, kind AS error_kind
FROM (SELECT *, CASE WHEN doc_id % 11 = 3 THEN 'missing' WHEN t = '' THEN 'empty' END AS kind
      FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(text, '') END AS t FROM documents))
"""

ORACLE_SQL["position_rejects"] = """
WITH placed AS (
  SELECT conv_id, CASE (conv_id * 7 + turn) % 11 WHEN 3 THEN NULL WHEN 5 THEN turn - 1 ELSE turn END AS pos FROM conversations),
counted AS (SELECT conv_id, pos, count(*) AS n FROM placed GROUP BY conv_id, pos)
SELECT conv_id, pos, CASE WHEN pos IS NULL THEN n ELSE n - 1 END AS n_rejected,
  CASE WHEN pos IS NULL THEN 'piece has no position' ELSE 'position is repeated' END AS error
FROM counted WHERE pos IS NULL OR n > 1
"""

_MACHINE = "arn:aws:states:us-east-1:000000000000:stateMachine:podcast"
ORACLE_SQL["run_registry"] = f"""
WITH {_INTAKE},
acc AS (
  SELECT r.*, e.event_type, e.ts, e.value, coalesce(r.state_machine_arn, '{_MACHINE}') AS machine
  FROM r JOIN events e USING (event_id) WHERE r.error IS NULL),
runs AS (
  SELECT event_id, machine, replace(machine, ':stateMachine:', ':execution:') || ':run-' || event_id AS arn, style, source_url, ts AS started,
         CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
         CASE WHEN event_type <> 'click' THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS stopped FROM acc),
asked AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 3 <> 0 AND event_id % 50 = 0 THEN NULL
              ELSE replace('{_MACHINE}', ':stateMachine:', ':execution:') || ':run-' || event_id END AS a FROM events)
SELECT request_id, a AS execution_arn, w.machine AS state_machine_arn, w.status, {_iso('w.started')} AS start_date, {_iso('w.stopped')} AS stop_date,
       CASE WHEN w.status IS NOT NULL THEN 'json' END AS kind, w.style AS input_style, w.source_url AS input_url,
       CASE w.status WHEN 'FAILED' THEN 'raw' WHEN 'SUCCEEDED' THEN 'json' END AS output_kind,
       CASE WHEN w.status = 'FAILED' THEN 'stage failed' END AS output_raw, CASE WHEN w.status = 'SUCCEEDED' THEN w.event_id END AS output_event,
       CASE WHEN w.status IS NULL THEN 400 ELSE 200 END::INTEGER AS status_code,
       CASE WHEN a IS NULL THEN 'missing required parameter: execution_arn' WHEN w.status IS NULL THEN 'execution not found: ' || a END AS error,
       o.arn AS started_arn, {_iso('o.started')} AS started
FROM asked LEFT JOIN runs w ON asked.a = w.arn LEFT JOIN runs o ON o.event_id = request_id
"""
