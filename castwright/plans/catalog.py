"""Registered queries: each reads the shipped test tables (whole tables) and runs one
operator group of the engine. Keys match ``castwright.plans.oracle.ORACLE_SQL``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from castwright.functions import encoding as enc
from castwright.functions import text as tx
from castwright.functions import urls as url_fn
from castwright.operators import chunking, intake, ledger, ordering, prompts, routing, speech
from castwright.operators import events as events_op
from castwright.operators import turns as turns_op
from castwright.plans import inputs
from castwright.plans.inputs import conversation_pieces
from castwright.settings import PROVIDER_ELEVENLABS, Settings
from castwright.sources import files as files_src
from castwright.sources import pages as pages_src
from castwright.sources import transcripts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# Row key of each shipped table. These files hold one row group each, so the scan is a single
# task; spreading them by row key right after the scan puts the per-row work on every core (a
# conversation's rows by turn too, so that a hot one is not kept together). On large inputs (many
# splits) ``spread`` does nothing.
TABLE_KEYS = {"pages": ("page_id",), "documents": ("doc_id",), "conversations": ("conv_id", "turn"), "events": ("event_id",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from castwright.session import spread

    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    keys = TABLE_KEYS.get(name)
    return spread(df, *keys) if keys else df


# --- sources ---------------------------------------------------------------------------

@register("article_source")
def article_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_src.extract_articles(table(spark, sf_dir, "pages"), mode="nested")


@register("article_source_html5")
def article_source_html5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_src.extract_articles(table(spark, sf_dir, "pages"), mode="implied_end")


@register("clean_text")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = tx.clean_lines(tx.split_lines("text"))
    return docs.select("doc_id", cleaned.alias("text")).select(
        "doc_id", "text", tx.char_count("text").alias("n_chars")
    )


# --- speech text -------------------------------------------------------------------------

def _doc_chunks(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunking.explode_chunks(docs, ["doc_id"], "text", limit)


@register("tts_chunks")
def tts_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_chunks(spark, sf_dir, chunking.PIPELINE_CHUNK_LIMIT)


@register("tts_chunks_min")
def tts_chunks_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_chunks(spark, sf_dir, chunking.MIN_CHUNK_LIMIT)


@register("ssml")
def ssml(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = _doc_chunks(spark, sf_dir, chunking.PIPELINE_CHUNK_LIMIT)
    return ch.select("doc_id", "chunk_no", chunking.ssml_column("chunk").alias("ssml"), "error")


@register("duration")
def duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        tx.word_count("text").alias("word_count"),
        tx.estimate_duration_sec("text").alias("duration_sec"),
    )


# --- conversations: duo scripts, turns, voices, speech ----------------------------------


# Run settings used by the registered speech queries (voices from the reference's tests).
QUERY_SETTINGS = Settings(polly_voice_id="Amy", polly_duo_voice_id="Matthew")
QUERY_SETTINGS_EL = Settings(tts_provider=PROVIDER_ELEVENLABS, elevenlabs_api_key="set-at-run-time")


def _conv_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = conversation_pieces(table(spark, sf_dir, "conversations"))
    return turns_op.parse_duo_turns(pieces, key="conv_id", order=("turn",))


def _voice_overrides(df: DataFrame) -> DataFrame:
    """Per-job voice overrides derived from the job key (stand-in for request fields)."""
    return df.withColumns({
        "event_voice_id": F.when(F.col("conv_id") % 3 == 0, F.lit("Ruth")),
        "event_voice_id_b": F.when(F.col("conv_id") % 4 == 0, F.lit("Stephen")),
    })


@register("duo_turns")
def duo_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conv_turns(spark, sf_dir)


@register("position_rejects")
def position_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces that T1 and R12 leave out: some rows of each conversation lose their position or
    share it with the row before (chosen by the row key)."""
    conv = table(spark, sf_dir, "conversations")
    at = F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(11))
    pos = F.when(at == 3, F.lit(None)).when(at == 5, F.col("turn") - 1).otherwise(F.col("turn")).cast("bigint")
    return ordering.position_rejects(conv.select("conv_id", pos.alias("pos")), "conv_id", ("pos",))


@register("duo_rejects")
def duo_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    return turns_op.duo_rejects(conv, _conv_turns(spark, sf_dir), key="conv_id")


@register("voice_route")
def voice_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _voice_overrides(_conv_turns(spark, sf_dir))
    fmt = speech.route_format(F.lit(QUERY_SETTINGS.tts_provider), QUERY_SETTINGS)
    return t.select(
        "conv_id", "turn_no", "speaker",
        speech.route_voice("speaker", "event_voice_id", "event_voice_id_b", QUERY_SETTINGS).alias("voice_id"),
        fmt["output_format"].alias("output_format"),
        fmt["text_type"].alias("text_type"),
    )


def _turn_chunks(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    t = _voice_overrides(_conv_turns(spark, sf_dir)).select(
        "conv_id", "turn_no", "text",
        speech.route_voice("speaker", "event_voice_id", "event_voice_id_b", settings).alias("voice_id"),
    )
    ch = chunking.explode_chunks(t, ["conv_id", "turn_no", "voice_id"], "text", chunking.PIPELINE_CHUNK_LIMIT)
    return ch


def _requests(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    req = speech.synthesis_requests(_turn_chunks(spark, sf_dir, settings), settings)
    return req.select(
        "conv_id", "turn_no", "chunk_no", "voice_id", "provider", "output_format", "text_type",
        "request_text", "engine", "endpoint", "model_id", "request_error",
    )


@register("synthesis_requests")
def synthesis_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir, QUERY_SETTINGS)


@register("synthesis_requests_el")
def synthesis_requests_el(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir, QUERY_SETTINGS_EL)


def _audio_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = speech.synthesis_requests(_turn_chunks(spark, sf_dir, QUERY_SETTINGS), QUERY_SETTINGS)
    return speech.synthesize(req, speech.stand_in_speech, keys=["conv_id", "turn_no"])


@register("audio_concat")
def audio_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = speech.concat_audio(_audio_parts(spark, sf_dir), job_key="conv_id")
    return out.select("conv_id", "audio_bytes", F.md5("audio").alias("audio_md5"), "chunk_count", "error")


@register("synthesis_report")
def synthesis_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = speech.synthesis_report(_audio_parts(spark, sf_dir), job_key="conv_id")
    return report.withColumn("elapsed_known", F.col("elapsed_ms") >= 0).drop("elapsed_ms")


@register("transcript_paragraphs")
def transcript_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = conversation_pieces(table(spark, sf_dir, "conversations"))
    return transcripts.transcript_paragraphs(pieces, key="conv_id", order=("turn",), split_rows=True)


@register("transcript_segments")
def transcript_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 -> R12: the lines of each document as transcript segments held as JSON: a list, or an object that
    wraps one; some items are bare or have a text that is no text, some documents hold no list."""
    from castwright.session import materialize

    doc = F.col("doc_id")
    item = lambda x, i: F.when(i % 7 == 3, F.lit('{"text": 7}')).when(i % 7 == 5, F.to_json(F.array(x))).otherwise(
        F.to_json(F.struct(i.alias("start"), x.alias("text"))))
    items = F.concat(F.lit("["), F.array_join(F.transform(tx.split_lines("text"), item), ","), F.lit("]"))
    held = (F.when(doc % 11 == 4, F.lit('{"segments": 3}')).when(doc % 3 == 1, F.concat(F.lit('{"segments": '), items, F.lit("}")))
            .when(doc % 3 == 2, F.concat(F.lit('{"lang": "en", "snippets": '), items, F.lit("}"))).otherwise(items))
    docs = table(spark, sf_dir, "documents").select("doc_id", held.alias("segments"))
    # The numbering reads the segments several times (positions, counts, texts): parsed and written once.
    segments = materialize(transcripts.segments_of(docs, key="doc_id"), "segments")
    return transcripts.transcript_paragraphs(segments, key="doc_id", order=("pos",))


@register("transcript_source")
def transcript_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    paras = transcripts.transcript_paragraphs(conversation_pieces(conv), key="conv_id",
                                              order=("turn",), split_rows=True)
    return transcripts.transcript_text(paras, jobs=conv, key="conv_id")


# --- requests and URLs ------------------------------------------------------------------


@register("url_route")
def url_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = inputs.page_urls(table(spark, sf_dir, "pages"))
    return u.select(
        "page_id", "url",
        url_fn.scheme_ok("url").alias("scheme_ok"),
        url_fn.is_video_url("url").alias("is_video"),
        url_fn.url_host("url").alias("host"),
        F.when(~url_fn.scheme_ok("url"), F.lit(url_fn.SCHEME_ERROR)).alias("error"),
    )


@register("video_id")
def video_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = inputs.page_urls(table(spark, sf_dir, "pages"))
    err = url_fn.video_id_error("url")
    return u.select("page_id", "url", F.when(err.isNull(), url_fn.video_id("url")).alias("video_id"),
                    err.alias("error"))


def _intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = inputs.request_rows(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))
    return intake.intake_requests(req, key="event_id")


@register("request_parse")
def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = inputs.request_rows(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))
    p = intake.parse_bodies(req.select("event_id", "body", "is_base64"))
    keys = F.array_join(F.array_sort(F.json_object_keys(F.to_json(F.col("_payload")))), ",")
    return p.select("event_id", F.when(F.col("_parse_error").isNull(), keys).alias("body_keys"),
                    F.col("_parse_error").alias("error"))


@register("request_validate")
def request_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intake(spark, sf_dir).select("event_id", "status_code", "error")


@register("request_normalize")
def request_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intake(spark, sf_dir)


@register("request_accept")
def request_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.accept_response(_intake(spark, sf_dir), key="event_id")


@register("job_id_assign")
def job_id_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on accepted requests. The ids are written once (they are random); the query reports,
    per request, the given id, whether one was generated and whether the id has the right form
    (given ids kept as is, generated ones ``job-<yyyymmddThhmmssffffff>Z-<8 hex>``)."""
    from castwright.session import materialize

    accepted = _intake(spark, sf_dir).where("status_code = 202").select(
        "event_id", F.col("job_id").alias("job_id_given"), "job_id")
    ids = intake.unique_job_ids(accepted)
    generated = F.col("job_id_given").isNull()
    well_formed = F.when(generated, F.col("job_id").rlike(intake.GENERATED_JOB_ID_RX)).otherwise(
        F.col("job_id") == F.col("job_id_given"))
    return ids.select("event_id", "job_id_given", generated.alias("is_generated"), well_formed.alias("id_ok"))


# --- pipeline events ----------------------------------------------------------------------


EVENT_VIEW = ("event_id", "stage", "job_id", "style", "script_mode", "title", "article_s3_key",
              "script_s3_key", "article_char_count", "audio_estimated_duration_sec", "error")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_op.read_events(inputs.event_rows(table(spark, sf_dir, "events")))


@register("event_validate")
def event_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(*EVENT_VIEW)


@register("event_extras")
def event_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("event_id", F.array_join(F.map_keys("extras"), ",").alias("extra_keys"), "error")


@register("stage_gate")
def stage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("event_id", "stage", F.coalesce("error", events_op.stage_gate("stage")).alias("error"))


@register("event_json")
def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("error").isNull())
    js = events_op.event_json(ev)
    keys = events_op.handover_keys(ev)
    return ev.select(
        "event_id",
        F.array_join(keys, ",").alias("handover_keys"),
        F.size(keys).cast("bigint").alias("n_keys"),
        F.get_json_object(js, "$.job_id").alias("job_id"),
        F.get_json_object(js, "$.script_mode").alias("script_mode"),
        F.get_json_object(js, "$.article_char_count").cast("bigint").alias("article_char_count"),
    )


# --- documents and files ------------------------------------------------------------------


@register("doc_type")
def doc_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = inputs.document_files(table(spark, sf_dir, "documents")).select("doc_id", "name")
    return f.select("doc_id", "name", files_src.doc_type("name").alias("doc_type"),
                    files_src.doc_type_error("name").alias("error"))


# Base64 variants: as encoded, without padding, with an inner space (the last two are not strict).
def _b64_variant():
    b64 = enc.b64encode(F.encode("text", "UTF-8"))
    return (F.when(F.col("doc_id") % 4 == 1, F.rtrim(b64, F.lit("=")))
            .when(F.col("doc_id") % 4 == 2, F.concat(F.substring(b64, 1, 4), F.lit(" "), F.substring(b64, 5, 1 << 30)))
            .otherwise(b64))


@register("base64_text")
def base64_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", _b64_variant().alias("b64"))
    raw = enc.strict_unbase64("b64")
    return d.select(
        "doc_id",
        raw.isNotNull().alias("valid"),
        F.md5(raw).alias("decoded_md5"),
        F.octet_length(raw).cast("bigint").alias("n_bytes"),
        F.when(raw.isNull(), F.lit(files_src.E_FETCH_BAD_B64)).alias("error"),
    )


def _in_encodings(text: str, key: str):
    """Bytes of a text: UTF-8 with and without a byte order mark, UTF-16 of both byte orders, Latin-1 (of odd
    length, which no UTF-16 has, and beginning with what no UTF-8 has)."""
    latin = F.encode(F.concat(F.lit("\u00e9 "), F.regexp_replace(text, "[^\\x00-\\xFF]", "?")), "ISO-8859-1")
    latin = F.when(F.octet_length(latin) % 2 == 0, F.concat(latin, F.unhex(F.lit("20")))).otherwise(latin)
    case = F.col(key) % 6
    return (F.when(case == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")))
            .when(case == 1, F.concat(F.unhex(F.lit("FEFF")), F.encode(text, "UTF-16BE")))
            .when(case == 4, F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE")))
            .when(case == 2, latin).otherwise(F.encode(text, "UTF-8")))


@register("txt_decode")
def txt_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    dec = enc.decode_text_bytes(_in_encodings("text", "doc_id"))
    return d.select("doc_id", dec["text"].alias("text"), dec["encoding"].alias("encoding"))


@register("page_assembly")
def page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.document_pages(table(spark, sf_dir, "documents"), outer=True)
    return files_src.assemble_pages(pages, "doc_id", "page_no", "text", keep_blank=True)


@register("docx_text")
def docx_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", inputs.docx_bytes(F.col("text")).alias("content"))
    return files_src.extract_docx(d, "doc_id")


@register("document_source")
def document_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pages = files_src.assemble_pages(inputs.document_pages(docs), "doc_id", "page_no", "text")
    return files_src.extract_documents(inputs.document_files(docs), key="doc_id", page_texts=pages)


def _write_files(docs: DataFrame, folder: str) -> DataFrame:
    """One file for each document (every seventh is empty), written by the tasks to the shared folder;
    a repeated task writes the same files again. Returns the ids and paths."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyarrow import fs

        for pdf in batches:
            paths = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                paths.append(f"{folder}/doc{doc_id}.txt")
                files, at = fs.FileSystem.from_uri(paths[-1])
                files.create_dir(at.rsplit("/", 1)[0])
                with files.open_output_stream(at) as out:
                    out.write(b"" if doc_id % 7 == 0 else (text or "").encode())
            yield pdf[["doc_id"]].assign(source_file=paths)

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, source_file string")


@register("file_scan")
def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 over files derived from the documents, asked for by path: name, payload, empty and missing
    files (every eleventh path names no file)."""
    import uuid

    from castwright.session import checkpoint_dir, materialize

    root = checkpoint_dir(spark).rstrip("/")
    folder = f"{root if ':/' in root else 'file://' + root}/files-{uuid.uuid4().hex}"
    paths = materialize(_write_files(table(spark, sf_dir, "documents"), folder), "file-paths")
    asked = paths.withColumn("source_file", F.when(F.col("doc_id") % 11 == 3, F.concat("source_file", F.lit(".gone"))).otherwise(F.col("source_file")))
    f = files_src.read_requested_files(asked, key="doc_id")
    kind = F.when(F.startswith("error", F.lit(files_src.E_MISSING_FILE)), F.lit("missing")).when(
        F.startswith("error", F.lit(files_src.E_EMPTY_SOURCE_FILE)), F.lit("empty"))
    return f.select("doc_id", F.col("source_file_name").alias("name"), F.length("source_file_base64").cast("bigint").alias("base64_chars"),
                    F.md5(F.unbase64("source_file_base64")).alias("content_md5"), kind.alias("error_kind"))


# --- prompts and model ------------------------------------------------------------------------


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.rewrite_jobs(table(spark, sf_dir, "documents"))


@register("prompt")
def prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _jobs(spark, sf_dir)
    return j.select(
        "doc_id",
        prompts.prompt_column("text", "title", "style", "source_type", "script_mode").alias("prompt"),
        prompts.prompt_error("script_mode").alias("error"),
    )


@register("model_route")
def model_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _jobs(spark, sf_dir)
    return j.select("doc_id", "model_id", prompts.model_family("model_id").alias("family"),
                    prompts.model_family_error("model_id").alias("error"))


@register("model_request")
def model_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _jobs(spark, sf_dir).select(
        "doc_id", prompts.model_family("model_id").alias("family"),
        prompts.prompt_column("text", "title", "style", "source_type", "script_mode").alias("prompt"),
        F.coalesce(prompts.model_family_error("model_id"), prompts.prompt_error("script_mode")).alias("error"))
    body = F.when(F.col("prompt").isNotNull(), prompts.request_body("family", "prompt"))
    b = j.select("doc_id", "family", body.alias("body"), "error")
    anth = F.col("family") == "anthropic"
    return b.select(
        "doc_id", "family",
        F.when(anth, F.get_json_object("body", "$.max_tokens")).otherwise(
            F.get_json_object("body", "$.inferenceConfig.maxTokens")).cast("bigint").alias("max_tokens"),
        F.when(anth, F.get_json_object("body", "$.temperature")).otherwise(
            F.get_json_object("body", "$.inferenceConfig.temperature")).cast("double").alias("temperature"),
        F.get_json_object("body", "$.messages[0].role").alias("role"),
        F.get_json_object("body", "$.anthropic_version").alias("version"),
        F.md5(F.get_json_object("body", "$.messages[0].content[0].text")).alias("prompt_md5"), "error",
    )


@register("model_response")
def model_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = inputs.model_responses(table(spark, sf_dir, "documents"))
    t = prompts.response_text("family", "response")
    return r.select("doc_id", "family", t["text"].alias("script"), t["error"].alias("error"))


@register("script_metadata")
def script_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _jobs(spark, sf_dir).withColumn("source_url", F.lit(None).cast("string"))
    js = prompts.script_metadata(j, "anthropic.claude-3-haiku-20240307-v1:0")
    m = j.select("doc_id", js.alias("js"))
    return m.select(
        "doc_id",
        F.size(F.json_object_keys("js")).cast("bigint").alias("n_fields"),
        F.get_json_object("js", "$.job_id").alias("job_id"),
        F.get_json_object("js", "$.title").alias("title"),
        F.get_json_object("js", "$.source_type").alias("source_type"),
        F.get_json_object("js", "$.script_s3_key").alias("script_s3_key"),
        F.get_json_object("js", "$.model_id").alias("model_id"),
    )


@register("rewrite")
def rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _jobs(spark, sf_dir)
    out = prompts.rewrite(j, prompts.echo_model, "us.amazon.nova-pro-v1:0", key="doc_id")
    return out.select("doc_id", "script", F.char_length("script").cast("bigint").alias("script_chars"), "error")


# --- fetch stage ----------------------------------------------------------------------------


@register("source_route")
def source_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = _intake(spark, sf_dir).where(F.col("status_code") == 202)
    return acc.select("event_id", routing.route_type().alias("source_type"), routing.route_error().alias("error"))


def fetch_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of all three source kinds, derived from pages, conversations and documents."""
    none = F.lit(None).cast("string")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("job_id"),
        F.col("url").alias("source_url"), none.alias("source_text"),
        none.alias("source_file_name"), none.alias("source_file_base64"))
    conv = table(spark, sf_dir, "conversations")
    paras = transcripts.transcript_paragraphs(conversation_pieces(conv), key="conv_id",
                                              order=("turn",), split_rows=True)
    texts = transcripts.transcript_text(paras, key="conv_id")
    videos = texts.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("job_id"),
        F.concat(F.lit("https://www.youtube.com/watch?v=c"), F.col("conv_id").cast("string")).alias("source_url"),
        F.col("text").alias("source_text"), none.alias("source_file_name"), none.alias("source_file_base64"))
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("job_id"),
        none.alias("source_url"), none.alias("source_text"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_file_name"),
        enc.b64encode(F.encode("text", "UTF-8")).alias("source_file_base64"))
    return pages.unionByName(videos).unionByName(docs)


@register("fetch_stage")
def fetch_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from castwright.session import materialize

    # The job table is a stored stage table in a run; the derived one is written once so the
    # fetch plan reads it like one (the routing reads it twice: URL list and job rows).
    jobs = materialize(fetch_jobs(spark, sf_dir), "fetch-jobs")
    return routing.fetch_sources(jobs, pages=table(spark, sf_dir, "pages"))


# --- speech step, job summary, ledger, run status -------------------------------------------


@register("synthesize")
def synthesize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audio_parts(spark, sf_dir).select("conv_id", "turn_no", "chunk_no", "input_chars", "audio_bytes", "error")


def _script_words(conv: DataFrame) -> DataFrame:
    """Whole-script word count per conversation (labels included): the per-row counts add up
    because rows are joined by a line break."""
    piece = F.concat(inputs.role_label("role"), F.col("text"))
    return conv.groupBy("conv_id").agg(F.sum(tx.word_count(piece)).cast("bigint").alias("words"))


@register("podcast_jobs")
def podcast_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation job: T1 -> T5 -> T9/T10 -> T11 -> T12, with the R12 source."""
    conv = table(spark, sf_dir, "conversations")
    paras = transcripts.transcript_paragraphs(conversation_pieces(conv), key="conv_id",
                                              order=("turn",), split_rows=True)
    source = transcripts.transcript_text(paras, key="conv_id").select(
        "conv_id", F.col("n_chars").alias("article_char_count"))
    parts = _audio_parts(spark, sf_dir)  # written once; turns and audio both come from it
    turns = parts.groupBy("conv_id").agg(F.countDistinct("turn_no").alias("turn_count"))
    audio = speech.audio_sizes(parts, job_key="conv_id").select(
        "conv_id", "chunk_count", "audio_bytes", F.col("error").alias("audio_error"))
    words = _script_words(conv)
    dur = ((F.col("words").cast("double") / F.lit(150.0)) * F.lit(60.0)).cast("bigint")
    jobs = conv.select("conv_id").distinct()
    j = jobs.join(source, "conv_id", "left").join(turns, "conv_id", "left").join(audio, "conv_id", "left") \
        .join(words, "conv_id", "left")
    err = F.when(F.col("turn_count").isNull(), F.lit(turns_op.NO_TURNS_ERROR)).otherwise(F.col("audio_error"))
    return j.select(
        "conv_id", F.lit("youtube").alias("source_type"), "article_char_count",
        F.coalesce(F.col("turn_count"), F.lit(0)).cast("bigint").alias("turn_count"),
        F.coalesce(F.col("chunk_count"), F.lit(0)).cast("bigint").alias("chunk_count"),
        "audio_bytes", dur.alias("duration_sec"),
        F.when(err.isNull(), F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("status"),
        err.alias("error"),
    )


@register("artefact_keys")
def artefact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.artefact_keys(_jobs(spark, sf_dir).select("job_id"))


LEDGER_MODEL = "us.amazon.nova-pro-v1:0"


@register("run_ledger")
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as uploaded-file jobs through fetch -> rewrite -> generate; the ledger keeps the
    first failing stage of each job."""
    docs = table(spark, sf_dir, "documents")
    attrs = inputs.rewrite_jobs(docs).select("doc_id", "job_id", "title", "style", "script_mode")
    files = inputs.document_files(docs).join(attrs, "doc_id")
    pages = files_src.assemble_pages(inputs.document_pages(docs), "doc_id", "page_no", "text") \
        .join(attrs.select("doc_id", "job_id"), "doc_id").select("job_id", "text")
    # The fetch output is the job's source artefact: written once, then read by the next stage
    # and by the ledger (no second extraction pass).
    from castwright.session import materialize

    fetched = materialize(files_src.extract_documents(
        files.select("job_id", "name", "content", "title", "style", "script_mode"),
        key="job_id", page_texts=pages, keep=("title", "style", "script_mode")), "fetch")
    ok_fetch = fetched.where(F.col("error").isNull()).select(
        "job_id", "text", "title", "style", "script_mode", F.col("doc_type").alias("source_type"))
    scripts = prompts.rewrite(ok_fetch, prompts.echo_model, LEDGER_MODEL, key="job_id")
    ok_scripts = scripts.where(F.col("error").isNull()).select("job_id", F.col("script").alias("text"))
    chunks = chunking.explode_chunks(ok_scripts, ["job_id"], "text", chunking.PIPELINE_CHUNK_LIMIT)
    generated = chunks.groupBy("job_id").agg(
        F.max("error").alias("error"), F.count("chunk_no").alias("chunk_count"))
    return ledger.run_ledger(
        {"fetch": fetched.select("job_id", "error", F.col("n_chars").alias("article_char_count")),
         "rewrite": scripts.select("job_id", "error", F.char_length("script").alias("script_chars")),
         "generate": generated},
        counts=("article_char_count", "script_chars", "chunk_count"))


def runs_table(events: DataFrame) -> DataFrame:
    """Runs derived from `events`: one execution per event."""
    status = (F.when(F.col("event_type") == "error", F.lit("FAILED"))
              .when(F.col("event_type") == "click", F.lit("RUNNING")).otherwise(F.lit("SUCCEEDED")))
    return events.select(
        F.concat(F.lit("arn:exec:"), F.col("event_id").cast("string")).alias("execution_arn"),
        F.lit("arn:sm:podcast").alias("state_machine_arn"),
        status.alias("status"),
        F.col("ts").alias("start_date"),
        F.when(status != "RUNNING", F.col("ts") + F.make_dt_interval(secs=F.col("value"))).alias("stop_date"),
        F.col("props").alias("input"),
        F.when(status == "FAILED", F.concat(F.lit("error: "), F.col("event_type"))).otherwise(F.col("props")).alias("output"),
    )


def status_lookups(events: DataFrame) -> DataFrame:
    """Lookup requests: mostly known ids (padded), some blank, some unknown."""
    eid = F.col("event_id").cast("string")
    arn = (F.when(F.col("event_id") % 50 == 0, F.lit("  "))
           .when(F.col("event_id") % 33 == 0, F.concat(F.lit("arn:exec:missing-"), eid))
           .otherwise(F.concat(F.lit(" arn:exec:"), eid, F.lit(" "))))
    return events.select(F.col("event_id").alias("request_id"), arn.alias("execution_arn"))


@register("run_status")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    st = ledger.run_status(status_lookups(ev), runs_table(ev), key="request_id")
    return st.select(
        "request_id", "execution_arn", "state_machine_arn", "status", "start_date", "stop_date",
        F.col("input.kind").alias("input_kind"),
        F.try_variant_get(F.col("input.json"), "$.k", "bigint").alias("input_k"),
        F.col("output.kind").alias("output_kind"),
        F.col("output.raw").alias("output_raw"),
        F.col("status_code").cast("int").alias("status_code"), "error",
    )


# --- streaming intake ---------------------------------------------------------------------------

# Micro-batches that the request files make at least, and the most requests of one file.
MICRO_BATCHES, FILE_ROWS = 4, 100_000


def _request_files(requests: DataFrame, path: str, at_least: int) -> int:
    """Write request rows as files, whose number grows with the rows, and return it."""
    n = max(at_least, requests.sparkSession.sparkContext.defaultParallelism)
    requests.repartition(n).write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return len(requests.sparkSession.read.parquet(path).inputFiles())


@register("stream_intake")
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request rows written as files, consumed by the intake stream in several micro-batches,
    both sinks read back; equals the batch ``request_validate`` result."""
    import uuid

    from castwright.session import checkpoint_dir, ensure_checkpoint_dir
    from castwright.streaming.intake import read_intake_output, start_intake_stream

    ensure_checkpoint_dir(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-intake-{uuid.uuid4().hex}"
    n_files = _request_files(_request_rows(spark, sf_dir), f"{base}/in", MICRO_BATCHES)
    q = start_intake_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=max(1, n_files // MICRO_BATCHES))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_intake_output(spark, f"{base}/out").select("event_id", "status_code", "error")


# --- whole runs from request rows ----------------------------------------------------------------

def _request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.request_rows(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))


RUN_SETTINGS = Settings(model_id=LEDGER_MODEL, polly_voice_id="Amy", polly_duo_voice_id="Matthew")
RUN_COUNTS = ("article_char_count", "script_chars", "chunk_count", "audio_bytes", "duration_sec")


def _run_report(out: dict[str, DataFrame], key: str) -> DataFrame:
    """One row for each request: its answer, the ledger's row and the number of turns."""
    turn_count = out["turns"].groupBy(key).agg(F.count(F.lit(1)).alias("turn_count"))
    answers = out["intake"].select(key, "status_code", F.col("error").alias("request_error"))
    return answers.join(out["ledger"].drop("batch_id"), key, "left").join(turn_count, key, "left").select(
        F.col(key).alias("event_id"), "status_code", "request_error",
        F.coalesce(F.col("status"), F.lit("REJECTED")).alias("status"), "failed_stage", "error",
        F.when(F.col("status").isNotNull(), F.coalesce("turn_count", F.lit(0))).cast("bigint").alias("turn_count"), *RUN_COUNTS)


@register("request_jobs")
def request_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests derived from `events` through the whole chain (intake -> fetch against `pages`
    -> rewrite with the stand-in model -> turns/chunks -> stand-in speech -> ledger); one row
    per request. Some scripts are dialogues; some calls of each service fail."""
    from castwright.plans.jobs import run_requests

    req = _request_rows(spark, sf_dir).withColumnRenamed("event_id", "request_id")
    out = run_requests(req, RUN_SETTINGS, inputs.failing_model, inputs.failing_speech, pages=table(spark, sf_dir, "pages"))
    return _run_report(out, "request_id")


def _no_service():
    """A service that is down: no client can be made."""
    raise RuntimeError("service is down")


@register("stream_jobs")
def stream_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as files, through the whole chain inside the stream. The first start
    breaks in the speech stage of its first batch; the second goes on from there. Ends with the table of
    the batch run, and with the audio's size as its range files' manifest has it."""
    import uuid

    from castwright.session import checkpoint_dir
    from castwright.streaming.runs import read_runs, start_run_stream

    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-jobs-{uuid.uuid4().hex}"
    n_files = _request_files(_request_rows(spark, sf_dir), f"{base}/in", 2)

    def start(speech_factory):
        return start_run_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", RUN_SETTINGS, inputs.failing_model, speech_factory,
                                pages=lambda s: s.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"), max_files_per_trigger=max(1, (n_files + 1) // 2),
                                objects_at=f"{base}/objects")

    try:
        start(_no_service).awaitTermination()
        raise RuntimeError("the first start was meant to break")
    except StreamingQueryException:
        pass
    start(inputs.failing_speech).awaitTermination()
    out = {name: read_runs(spark, f"{base}/out", name) for name in ("intake", "turns", "ledger", "audio_ranges")}
    written = out["audio_ranges"].groupBy("event_id").agg(F.sum("n_bytes").cast("bigint").alias("written_bytes"))
    return _run_report(out, "event_id").join(written, "event_id", "left")


@register("call_journal")
def call_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 through the call journal: the first run loses every second task, the second makes the calls
    that are missing; script of each document and how many calls were made for it over both runs."""
    from pyspark import TaskContext

    from castwright.operators.journal import read_journal
    from castwright.plans.runs import RunFolder

    run = RunFolder(spark)
    jobs = _jobs(spark, sf_dir)

    def half_down():
        if TaskContext.get().partitionId() % 2:
            raise RuntimeError("worker lost")
        return prompts.echo_model()

    def go(factory):
        return prompts.rewrite(jobs, factory, LEDGER_MODEL, key="doc_id", journal=run.journal("model"))

    try:
        go(half_down)
        raise RuntimeError("the first run was meant to break")
    except PySparkException:
        pass
    out = go(prompts.echo_model)
    held = read_journal(spark, run.journal("model"), "doc_id bigint, call_id string")
    made = held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("calls"))
    return out.join(made, "doc_id", "left").select(
        "doc_id", F.md5("script").alias("script_md5"), "error", F.coalesce("calls", F.lit(0)).cast("bigint").alias("calls"))


@register("audio_objects")
def audio_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's audio written as range files under its object key, and read back
    through the manifest."""
    import uuid

    from castwright.session import checkpoint_dir, materialize
    from castwright.sources.objects import address

    parts = _audio_parts(spark, sf_dir)
    names = parts.select("conv_id").distinct().withColumn(
        "object_key", ledger.artefact_key(F.concat(F.lit("job-"), F.col("conv_id").cast("string")), dict(ledger.ARTEFACTS)["audio"]))
    root = f"{address(checkpoint_dir(spark).rstrip('/'))}/audio-{uuid.uuid4().hex}"
    manifest = materialize(speech.write_audio(parts, names, root, job_key="conv_id", range_bytes=1024), "audio-manifest")
    back = speech.read_audio(manifest, root, job_key="conv_id")
    return back.select("conv_id", "object_key", "range_no", F.col("offset").alias("begins"), F.octet_length("content").cast("bigint").alias("n_bytes"),
                       F.md5("content").alias("content_md5"))


@register("script_objects")
def script_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The script metadata of every job written as a JSON object under its key, and read back
    with its schema. Some objects are cut off and some are asked for by a key that is not there; titles
    are whole documents, in all their languages."""
    import uuid

    from castwright.session import checkpoint_dir, materialize
    from castwright.sources import objects

    jobs = _jobs(spark, sf_dir).withColumns({"source_url": F.lit(None).cast("string"), "title": F.col("text")})
    fields = {f: F.concat(F.lit("jobs/"), F.col("job_id"), F.lit("/script.txt")) if f == "script_s3_key" else F.col(f) for f in prompts.METADATA_FIELDS}
    body = objects.json_object(fields)
    broken = F.col("doc_id") % 13 == 7
    texts = jobs.select("doc_id", ledger.artefact_key("job_id", dict(ledger.ARTEFACTS)["script_metadata"]).alias("object_key"),
                        F.when(broken, F.substring(body, F.lit(1), F.length(body) - 5)).otherwise(body).alias("content"))
    root = f"{objects.address(checkpoint_dir(spark).rstrip('/'))}/scripts-{uuid.uuid4().hex}"
    manifest = materialize(objects.write_objects(texts, root, keep=("doc_id",)), "script-manifest")
    asked = manifest.withColumn("path", F.when(F.col("doc_id") % 17 == 5, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")))
    back = objects.read_json_objects(spark, asked, prompts.metadata_schema(), folder=root, keep=("doc_id", "object_key", "n_bytes", "md5"))
    ok = F.col("error").isNull()
    kind = F.when(F.startswith("error", F.lit(objects.E_MISSING_OBJECT)), F.lit("missing")).when(~ok, F.lit("broken"))
    return back.select("doc_id", "object_key", F.when(ok, F.col("n_bytes")).alias("n_bytes"), F.when(ok, F.col("md5")).alias("content_md5"),
                       F.md5("title").alias("title_md5"), "source_type", "model_id", kind.alias("error_kind"))


@register("run_registry")
def run_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5/K6: accepted requests start runs, most of which stop again; starts and stops are appended (some
    twice, stops first), and every request then asks for a run, by query or path, padded, blank or unknown."""
    import uuid

    from castwright.operators import registry
    from castwright.session import checkpoint_dir, materialize

    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    # The accepted requests are read four times (stops, starts, repeated starts, answers): decided and written once.
    accepted = materialize(registry.with_execution(_intake(spark, sf_dir).where("status_code = 202").join(ev, "event_id"), key="event_id"), "accepted")
    path = f"{checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    ended = accepted.where("event_type <> 'click'").withColumn("status", F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED"))
    stopped = F.col("ts") + F.make_dt_interval(secs=F.col("value"))
    output = F.when(F.col("status") == "FAILED", F.lit("stage failed")).otherwise(F.to_json(F.struct("event_id", "style")))
    registry.append(registry.stops(ended, stopped, output), path)
    registry.append(registry.starts(accepted, F.col("ts")), path)
    registry.append(registry.starts(accepted.where("event_type = 'error'"), F.col("ts")), path)

    own = registry.execution_arn(F.lit(registry.DEFAULT_STATE_MACHINE), F.concat(F.lit("run-"), F.col("event_id").cast("string")))
    none = F.create_map().cast("map<string,string>")
    by_query = F.create_map(F.lit("execution_arn"), F.when(F.col("event_id") % 50 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), own, F.lit(" "))))
    by_path = F.create_map(F.lit("execution_arn"), own)
    asked = ev.select(F.col("event_id").alias("request_id"), F.when(F.col("event_id") % 3 == 0, none).otherwise(by_query).alias("query"),
                      F.when(F.col("event_id") % 3 == 0, by_path).otherwise(none).alias("path_params"))
    found = registry.lookup(asked, registry.read(spark, path))
    answers = registry.start_response(accepted, F.col("ts"), key="event_id").select(
        F.col("event_id").alias("request_id"), F.col("execution_arn").alias("started_arn"), F.col("start_date").alias("started"))
    return found.join(answers, "request_id", "left").select(
        "request_id", "execution_arn", "state_machine_arn", "status", "start_date", "stop_date", "input.kind",
        F.try_variant_get("input.json", "$.style", "string").alias("input_style"), F.try_variant_get("input.json", "$.source_url", "string").alias("input_url"),
        F.col("output.kind").alias("output_kind"), F.col("output.raw").alias("output_raw"),
        F.try_variant_get("output.json", "$.event_id", "bigint").alias("output_event"), F.col("status_code").cast("int").alias("status_code"), "error",
        "started_arn", "started")
