"""Inputs derived by Spark from the shipped test tables (whole tables, no row subsets).

The engine's operators take job-shaped tables (scripts, pages, files, requests); the test
tables are mapped onto those shapes here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.functions.encoding import b64encode
from castwright.functions.text import split_lines

# Speaker label put in front of each conversation row, by role.
ROLE_LABELS = {"user": "HOST_A: ", "assistant": "HOST_B: ", "system": ""}


# Conversations whose number leaves this remainder have no labels: scripts that cannot be parsed.
UNLABELLED = (9, 4)


def role_label(role: str = "role"):
    expr = F.lit("")
    for r, label in ROLE_LABELS.items():
        expr = F.when(F.col(role) == F.lit(r), F.lit(label)).otherwise(expr)
    return F.when(F.col("conv_id") % UNLABELLED[0] == UNLABELLED[1], F.lit("")).otherwise(expr)


def conversation_pieces(conversations: DataFrame) -> DataFrame:
    """conversations -> script pieces (conv_id, turn, text): each row prefixed with its role's
    label; a conversation's duo script is its pieces in ``turn`` order, joined by newlines."""
    return conversations.select("conv_id", "turn", F.concat(role_label("role"), F.col("text")).alias("text"))


def conversation_lines(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> (conv_id, turn, line_no, raw): the duo script of a
    conversation is its rows in ``turn`` order, each prefixed with the role's label; lines are
    the ``splitlines`` pieces of each prefixed row."""
    piece = F.concat(role_label("role"), F.col("text"))
    return conversations.select(
        "conv_id", "turn", F.posexplode(split_lines(piece)).alias("line_no", "raw")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


# --- text templates rendered identically for Spark and for the DuckDB statements ------------

import re as _re  # noqa: E402

_SLOT = _re.compile(r"\{(id|uid|etype|b64|url|page|digits)\}")


def _spark_slot(name: str):
    return {
        "id": lambda: F.col("_id").cast("string"),
        "uid": lambda: F.col("user_id").cast("string"),
        "etype": lambda: F.col("event_type"),
        "b64": lambda: b64encode(F.encode(F.concat(F.lit("hello "), F.col("_id").cast("string")), "UTF-8")),
        "url": lambda: F.col("url"),
        "digits": lambda: F.repeat(F.lit("7"), F.lit(4400)),
        "page": lambda: F.coalesce(F.col("_page_url"), F.concat(F.lit("https://example.com/a/"), F.col("_id").cast("string"))),
    }[name]()


SQL_SLOTS = {
    "id": "CAST(_id AS VARCHAR)",
    "uid": "CAST(user_id AS VARCHAR)",
    "etype": "event_type",
    "b64": "to_base64(encode('hello ' || CAST(_id AS VARCHAR)))",
    "url": "url",
    "digits": "repeat('7', 4400)",
    "page": "coalesce(_page_url, 'https://example.com/a/' || CAST(_id AS VARCHAR))",
}


def render_spark(template: str):
    parts = _SLOT.split(template)
    cols = [F.lit(p) if i % 2 == 0 else _spark_slot(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*cols) if cols else F.lit("")


def render_sql(template: str) -> str:
    parts = _SLOT.split(template)
    out = []
    for i, p in enumerate(parts):
        if i % 2:
            out.append(SQL_SLOTS[p])
        elif p:
            out.append("'" + p.replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")" if out else "''"


def case_column(key: str, templates: list[str]):
    """Pick template ``key % len(templates)`` for every row (derivation, not a filter)."""
    n = len(templates)
    expr = render_spark(templates[-1])
    for i in range(n - 2, -1, -1):
        expr = F.when(F.col(key) % n == i, render_spark(templates[i])).otherwise(expr)
    return expr


def case_sql(key: str, templates: list[str]) -> str:
    n = len(templates)
    arms = " ".join(f"WHEN {key} % {n} = {i} THEN {render_sql(t)}" for i, t in enumerate(templates[:-1]))
    return f"(CASE {arms} ELSE {render_sql(templates[-1])} END)"


# Request bodies derived from `events` rows: each rule of the request layer is hit by some rows.
REQUEST_BODIES = [
    '{"source_url": "{page}", "job_id": "job-{id}", "style": "{etype}"}',
    '{"source_url": "https://www.youtube.com/watch?v=v{id}", "transcript_text": "line {id}"}',
    '{"source_url": "https://youtu.be/v{id}"}',
    '{"source_file_name": "doc{id}.txt", "source_file_base64": "{b64}", "job_id": "job-{id}"}',
    '{"source_url": "https://example.com/{id}", "source_file_base64": "aGVsbG8="}',
    '{"source_file_base64": "aGVsbG8=", "job_id": "job-{id}"}',
    '{"source_file_name": "x{id}.pdf", "source_file_base64": "aGVsbG8=", "source_text": "t{id}"}',
    '{"source_file_name": "x{id}.pdf", "source_file_base64": "aGVsbG8"}',
    '{"source_url": "https://example.com/{id}", "script_mode": "Duo", "voice_id": " Amy ", "voice_id_b": "Brian", "job_id": "job-{id}"}',
    '{"source_url": "https://example.com/{id}", "script_mode": "three-way"}',
    '{"source_url": "https://example.com/{id}", "voice_id_b": "   "}',
    '{bad-json {id}',
    '',
    '[{id}, 2]',
    '{"source_url": {id}}',
    '{"source_url": "  https://example.com/{id}  ", "source_text": "  body {uid}  ", "job_id": "  job-{id}  ", "style": 7, "script_mode": null, "trace_id": "t-{uid}", "tags": [1]}',
    '{"source_url": "https://www.youtube.com/watch?v=v{id}", "source_text": "", "transcript_text": "line {id}"}',
    '{"source_url": "https://www.youtube.com/watch?v=v{id}", "source_text": null, "transcript_text": "line {id}", "job_id": "job-{id}"}',
    '{"source_file_name": "  ", "source_file_base64": "aGVsbG8="}',
    '{"source_url": "https://example.com/{id}", "voice_id": 12, "state_machine_arn": " arn:sm:{uid} "}',
    '{"source_url": "https://youtu.be/d{id}", "transcript_text": "intro\\nHOST_A: hello {id}\\n\\nmore words\\n host_b : reply {uid}\\nHOST_A:\\nHOST_B: {etype} end", "script_mode": "duo", "voice_id": "Joanna", "job_id": "job-{id}"}',
    '{"source_url": "https://youtu.be/e{id}", "transcript_text": "HOST_A: hello\\nHOST_B: MUTED {id}", "script_mode": "duo", "job_id": "job-{id}"}',
    '{"source_url": "https://example.com/t{id}", "source_text": "REFUSED words {uid}", "job_id": "job-{id}"}',
    '{"source_url": "https://example.com/x{id}", "style": "first", "source_url": "{page}", "style": "{etype}", "job_id": "job-{id}"}',
    '{"source_url": "{page}", "style": NaN, "weight": [-Infinity], "job_id": "job-{id}"}',
    '{"source_url": "{page}", "n": {digits}}',
    '{"source_url": "https://example.com/{id}", "source_text": "text {uid}", "state_machine_arn": ""}',
    '{"source_url": "https://example.com/{id}", "source_text": "text {uid}", "state_machine_arn": 0, "voice_id": "Amy"}',
    '{"source_url": "https://example.com/{id}", "source_text": "text {uid}", "state_machine_arn": "  "}',
    '{"source_url": "https://example.com/{id}", "source_text": "padded {uid}", "job_id": "job-{id}"}',
]
# Rows whose body is sent base64-wrapped (request case 0 and the empty body, on even users).
BASE64_CASES = (0, 12)
REGION_BY_CASE = {8: " eu-west-1 ", 0: "  "}
# Rows that carry a state machine in the query (a value that counts as false falls through to it).
ARN_QUERY_CASES = (26, 27, 28)
# Bodies that the service reads but strict JSON does not: what it reads them as (the last repeated key, a
# number that is no number), the body whose number breaks it, and the wrapped body with padding to spare.
READ_AS = {
    23: '{"source_url": "{page}", "style": "{etype}", "job_id": "job-{id}"}',
    24: '{"source_url": "{page}", "style": 1, "weight": [1], "job_id": "job-{id}"}',
}
BREAKING_CASE = 25
PADDED_CASE = 29


def request_rows(events: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """events -> requests(event_id, body, is_base64, query). Article requests ask for the URL of
    the page whose id equals the event id when there is one (an equi-join with ``pages``)."""
    n = len(REQUEST_BODIES)
    e = events.select(F.col("event_id").alias("_id"), "user_id", "event_type")
    if pages is not None:
        e = e.join(pages.select(F.col("page_id").alias("_id"), F.col("url").alias("_page_url")), "_id", "left")
    else:
        e = e.withColumn("_page_url", F.lit(None).cast("string"))
    case = F.col("_id") % n
    # The rendered body is its own column so the base64 wrap below does not repeat it.
    e = e.select("_id", "user_id", case_column("_id", REQUEST_BODIES).alias("_raw"))
    wrapped = case.isin(*BASE64_CASES) & (F.col("user_id") % 2 == 0)
    raw = F.col("_raw")
    region = F.lit(None).cast("string")
    for c, r in REGION_BY_CASE.items():
        region = F.when(case == c, F.lit(r)).otherwise(region)
    arn = F.concat(F.lit(" arn:query:"), F.col("user_id").cast("string"), F.lit(" "))
    query = F.when(region.isNotNull(), F.create_map(F.lit("region"), region)).when(
        case.isin(*ARN_QUERY_CASES), F.create_map(F.lit("state_machine_arn"), arn)).otherwise(
        F.create_map().cast("map<string,string>")
    )
    encoded = b64encode(F.encode(raw, "UTF-8"))
    return e.select(
        F.col("_id").alias("event_id"),
        F.when(wrapped, encoded).when(case == PADDED_CASE, F.concat(encoded, F.lit("=="))).otherwise(raw).alias("body"),
        (wrapped | (case == PADDED_CASE)).alias("is_base64"),
        query.alias("query"),
    )


def request_rows_sql() -> str:
    n = len(REQUEST_BODIES)
    wrapped = f"(_id % {n} IN {BASE64_CASES} AND user_id % 2 = 0)"
    raw = case_sql("_id", REQUEST_BODIES)
    region = "CASE " + " ".join(f"WHEN _id % {n} = {c} THEN '{r}'" for c, r in REGION_BY_CASE.items()) + " END"
    read_as = " ".join(f"WHEN _id % {n} = {c} THEN {render_sql(t)}" for c, t in READ_AS.items())
    return f"""requests AS (
  SELECT _id AS event_id,
         CASE WHEN {wrapped} THEN to_base64(encode({raw})) ELSE {raw} END AS body,
         {wrapped} AS is_base64, {region} AS region_param, CASE {read_as} END AS read_as, _id % {n} = {BREAKING_CASE} AS breaks,
         CASE WHEN _id % {n} IN {ARN_QUERY_CASES} THEN ' arn:query:' || CAST(user_id AS VARCHAR) || ' ' END AS arn_param
  FROM (SELECT e.event_id AS _id, e.user_id, e.event_type, p.url AS _page_url
        FROM events e LEFT JOIN pages p ON p.page_id = e.event_id))"""


def failing_model():
    """The stand-in model, which refuses some texts."""
    from castwright.operators.prompts import echo_model

    call = echo_model()

    def answer(model_id: str, body: str) -> str:
        if "REFUSED" in body:
            raise RuntimeError("model refused")
        return call(model_id, body)

    return answer


def failing_speech():
    """The stand-in speech service, which gives no audio for some chunks."""
    from castwright.operators.speech import stand_in_speech

    call = stand_in_speech()
    return lambda rec: (200, None, None) if "MUTED" in rec["chunk"] else call(rec)


# Derived source URLs for the URL rules (one variant per page, chosen by page id).
URL_VARIANTS = [
    "{url}",
    "https://www.youtube.com/watch?v=v{id}",
    "https://youtu.be/v{id}",
    "https://m.youtube.com/shorts/s{id}/x",
    "https://youtube.com/embed/e{id}?start=3",
    "https://WWW.YouTube.com:443/watch?feature=share&v=&v=id%2D{id}+x",
    "https://www.youtube.com/watch",
    "ftp://files{id}.example.com/f",
    "https://user@youtu.be:80/",
    "https://www.youtube.com/live/l{id}#t=1",
    "//youtu.be/n{id}",
    "https://youtu.be/p{id};x=1",
    "https://www.youtube.com/watch;z?v=q{id}",
]


def page_urls(pages: DataFrame) -> DataFrame:
    p = pages.select(F.col("page_id").alias("_id"), "url")
    return p.select(F.col("_id").alias("page_id"), case_column("_id", URL_VARIANTS).alias("url"))


def page_urls_sql() -> str:
    return f"""urls AS (
  SELECT _id AS page_id, {case_sql('_id', URL_VARIANTS)} AS url
  FROM (SELECT page_id AS _id, url FROM pages))"""


# Pipeline events derived from `events` rows: each typed-field and stage rule is hit by some rows.
EVENT_BODIES = [
    '{"job_id": "job-{id}", "source_url": "https://example.com/{id}", "trace_id": "abc-{uid}"}',
    '{}',
    '{"job_id": "job-{id}"}',
    '{"job_id": "job-{id}", "source_url": "https://example.com/{id}", "source_file_base64": "aGVsbG8="}',
    '{"job_id": "job-{id}", "source_file_base64": "aGVsbG8=", "source_file_name": "n{id}.txt", "source_text": "x"}',
    '{"job_id": {id}}',
    '{"job_id": "job-{id}", "audio_estimated_duration_sec": -1}',
    '{"job_id": "job-{id}", "script_mode": "three-way"}',
    '{"job_id": " job-{id} ", "article_s3_key": "jobs/job-{id}/source.txt", "article_char_count": {uid}, "script_mode": "DUO", "title": "T{id}"}',
    '{"job_id": "job-{id}", "script_s3_key": "jobs/job-{id}/script.txt", "article_char_count": true}',
    '{"job_id": "job-{id}", "script_s3_key": "jobs/job-{id}/script.txt", "style": "  "}',
    '{"job_id": "job-{id}", "script_s3_key": "jobs/job-{id}/script.txt", "audio_estimated_duration_sec": 1.0, "x": {"y": 1}}',
    '{"zeta": 1, "job_id": "job-{id}", "source_file_base64": "aGVsbG8=", "source_file_name": "f{id}.pdf", "alpha": "a", "script_s3_key": "k{id}", "article_s3_key": "a{id}"}',
    '"just a string"',
]
# Stage of each derived event, chosen by user id.
EVENT_STAGES = ("fetch", "rewrite", "generate", "publish")


def event_rows(events: DataFrame) -> DataFrame:
    """events -> pipeline events(event_id, stage, body)."""
    e = events.select(F.col("event_id").alias("_id"), "user_id", "event_type")
    stage = F.element_at(F.array(*[F.lit(s) for s in EVENT_STAGES]), (F.col("user_id") % len(EVENT_STAGES) + 1).cast("int"))
    return e.select(F.col("_id").alias("event_id"), stage.alias("stage"), case_column("_id", EVENT_BODIES).alias("body"))


def event_rows_sql() -> str:
    stages = ", ".join(f"'{s}'" for s in EVENT_STAGES)
    return f"""pevents AS (
  SELECT _id AS event_id, [{stages}][(user_id % {len(EVENT_STAGES)}) + 1] AS stage, {case_sql('_id', EVENT_BODIES)} AS body
  FROM (SELECT event_id AS _id, user_id, event_type FROM events))"""


# --- files derived from `documents` ---------------------------------------------------------

# File name suffix of each derived file, chosen by document id.
FILE_SUFFIXES = (".txt", ".TXT", ".pdf", ".docx", ".md", "")
EMPTY_FILE_EVERY = 7  # documents whose id is a multiple of this get an empty file


def _docx_from_text_kernel(texts):
    import pandas as pd

    from castwright.sources.files import build_docx

    return pd.Series([None if t is None else build_docx(t.splitlines()) for t in texts])


def docx_bytes(text_col):
    """DOCX archive bytes with one paragraph per line of the text (Arrow batches)."""
    from pyspark.sql.types import BinaryType

    udf = F.pandas_udf(_docx_from_text_kernel, BinaryType())
    return udf(text_col)


def document_files(documents: DataFrame) -> DataFrame:
    """documents -> files(doc_id, name, content) with the suffix mix above."""
    n = len(FILE_SUFFIXES)
    suffix = F.element_at(F.array(*[F.lit(x) for x in FILE_SUFFIXES]), (F.col("doc_id") % n + 1).cast("int"))
    d = documents.select("doc_id", "text", suffix.alias("_suffix"))
    content = (
        F.when(F.col("doc_id") % EMPTY_FILE_EVERY == 0, F.lit(b"").cast("binary"))
        .when(F.col("_suffix") == ".docx", docx_bytes(F.when(F.col("_suffix") == ".docx", F.col("text"))))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return d.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), "_suffix").alias("name"),
                    content.alias("content"))


def document_pages(documents: DataFrame, outer: bool = False) -> DataFrame:
    """documents -> page_texts(doc_id, page_no, text): each line of a document is a page; with ``outer`` a
    document without a line has one row without a page."""
    pages = (F.posexplode_outer if outer else F.posexplode)(split_lines("text"))
    return documents.select("doc_id", pages.alias("page_no", "text"))


# --- rewrite-stage jobs derived from `documents` ---------------------------------------------

SOURCE_TYPES = (None, "youtube", "text", "article", "pdf")
SCRIPT_MODES_MIX = ("single", "duo", "single", " DUO ", "single", "duo", "trio")
MODEL_IDS = (
    "anthropic.claude-3-haiku-20240307-v1:0",
    "us.anthropic.claude-3-5-sonnet-20240620-v1:0",
    "amazon.nova-lite-v1:0",
    "us.amazon.nova-pro-v1:0",
    "meta.llama3-8b-instruct-v1:0",
)


def _pick(values, key: str = "doc_id"):
    arr = F.array(*[F.lit(v) if v is not None else F.lit(None).cast("string") for v in values])
    return F.element_at(arr, (F.col(key) % len(values) + 1).cast("int"))


def _pick_sql(values, key: str = "doc_id") -> str:
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{items}]::VARCHAR[])[({key} % {len(values)}) + 1]"


def rewrite_jobs(documents: DataFrame) -> DataFrame:
    """documents -> jobs(doc_id, job_id, text, title, style, source_type, script_mode, model_id)."""
    return documents.select(
        "doc_id",
        F.concat(F.lit("job-"), F.col("doc_id").cast("string")).alias("job_id"),
        "text",
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))).alias("title"),
        F.col("source").alias("style"),
        _pick(SOURCE_TYPES).alias("source_type"),
        _pick(SCRIPT_MODES_MIX).alias("script_mode"),
        _pick(MODEL_IDS).alias("model_id"),
    )


def rewrite_jobs_sql() -> str:
    return f"""jobs AS (
  SELECT doc_id, 'job-' || CAST(doc_id AS VARCHAR) AS job_id, text,
         CASE WHEN doc_id % 2 = 0 THEN 'Doc ' || CAST(doc_id AS VARCHAR) END AS title,
         source AS style, {_pick_sql(SOURCE_TYPES)} AS source_type,
         {_pick_sql(SCRIPT_MODES_MIX)} AS script_mode, {_pick_sql(MODEL_IDS)} AS model_id
  FROM documents)"""


# Model responses (one per document) covering the response rules of both families.
RESPONSES = [
    ("anthropic", '{"content": [{"type": "text", "text": "  Script {id}  "}]}'),
    ("anthropic", '{"content": []}'),
    ("anthropic", '{"content": [{"type": "text", "text": ""}]}'),
    ("nova", '{"output": {"message": {"content": [{"image": 1}, {"text": " Nova {id} "}]}}}'),
    ("nova", '{"output": {"message": {"content": [{"image": 1}]}}}'),
    ("anthropic", '{"content": {"text": "x{id}"}}'),
    ("nova", '{"output": {}}'),
    ("anthropic", '{"content": [{"type": "text", "text": "line1\\nline2 {id}"}]}'),
    ("anthropic", '{"content": [{"type": "text", "text": {id}}]}'),
    ("nova", '{"output": {"message": {"content": [{"text": {id}}]}}}'),
]


def model_responses(documents: DataFrame) -> DataFrame:
    d = documents.select(F.col("doc_id").alias("_id"))
    return d.select(
        F.col("_id").alias("doc_id"),
        _pick([f for f, _ in RESPONSES], "_id").alias("family"),
        case_column("_id", [t for _, t in RESPONSES]).alias("response"),
    )


def model_responses_sql() -> str:
    return f"""responses AS (
  SELECT _id AS doc_id, {_pick_sql([f for f, _ in RESPONSES], '_id')} AS family,
         {case_sql('_id', [t for _, t in RESPONSES])} AS response
  FROM (SELECT doc_id AS _id FROM documents))"""
