"""Voice and format routing, synthesis request rows, the synthesis step with an
injected callable, ordered audio concatenation and chunk metrics.

The unit of work is the chunk: the request rows are dealt out by (run, turn, chunk) right before the
call, so the chunks of one long script go to many tasks. Routing and request rows are pure
projections; the remote call is the only Python step. Its output is written once to the shared
checkpoint folder, so later stages never call again; a task attempt that fails or is run twice
(speculation: leave it off for these jobs) does repeat the calls of its rows. Each call therefore
carries an idempotency key made of those three values, for the service to recognise a repeat.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castwright.functions.text import py_strip
from castwright.operators.chunking import ssml_column
from castwright.operators.journal import CALL_KEY, call_key, journaled_calls
from castwright.operators.ordering import running_sum
from castwright.operators.turns import HOST_A
from castwright.session import materialize
from castwright.sources.objects import bare_path, last_writer, path_of_uri, write_objects
from castwright.settings import PROVIDER_ELEVENLABS, PROVIDER_POLLY, Settings

# Fixed values of the speech providers.
POLLY_FORMAT = "mp3"
POLLY_TEXT_TYPE = "ssml"
ELEVENLABS_TEXT_TYPE = "text"
ELEVENLABS_MP3_FORMAT = "mp3_44100_128"
POLLY_ENGINE = "generative"
ELEVENLABS_ENDPOINT = "https://api.elevenlabs.io/v1/text-to-speech/"

UNKNOWN_PROVIDER_ERROR = "Unsupported TTS provider. Use 'polly' or 'elevenlabs'."
TEXT_TYPE_ERROR = "text_type must be either 'text' or 'ssml'."
ELEVENLABS_SSML_ERROR = "ElevenLabs synthesis supports only text input in this pipeline."
ELEVENLABS_KEY_ERROR = "ElevenLabs API key is required for elevenlabs provider."


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def route_voice(speaker: Column | str, voice_id: Column | str, voice_id_b: Column | str,
                settings: Settings) -> Column:
    """Event voice wins over the provider's default pair; HOST_A -> first, else second."""
    default_a, default_b = settings.default_voices
    a = F.coalesce(_c(voice_id), F.lit(default_a))
    b = F.coalesce(_c(voice_id_b), F.lit(default_b))
    return F.when(_c(speaker) == F.lit(HOST_A), a).otherwise(b)


def single_voice(voice_id: Column | str, settings: Settings) -> Column:
    return F.coalesce(_c(voice_id), F.lit(settings.default_voices[0]))


def normalized_provider(provider: Column | str) -> Column:
    return F.lower(py_strip(_c(provider)))


def route_format(provider: Column | str, settings: Settings) -> Column:
    """T4: struct(output_format, text_type, error) for the (stripped, lower-cased) provider."""
    p = normalized_provider(provider)
    el_format = settings.elevenlabs_output_format
    el_format = ELEVENLABS_MP3_FORMAT if el_format == "mp3" else el_format
    return F.when(
        p == F.lit(PROVIDER_POLLY),
        F.struct(F.lit(POLLY_FORMAT).alias("output_format"), F.lit(POLLY_TEXT_TYPE).alias("text_type"),
                 F.lit(None).cast("string").alias("error")),
    ).when(
        p == F.lit(PROVIDER_ELEVENLABS),
        F.struct(F.lit(el_format).alias("output_format"), F.lit(ELEVENLABS_TEXT_TYPE).alias("text_type"),
                 F.lit(None).cast("string").alias("error")),
    ).otherwise(
        F.struct(F.lit(None).cast("string").alias("output_format"), F.lit(None).cast("string").alias("text_type"),
                 F.lit(UNKNOWN_PROVIDER_ERROR).alias("error"))
    )


def synthesis_requests(chunks: DataFrame, settings: Settings, provider: Column | str | None = None,
                       text_type: Column | str | None = None) -> DataFrame:
    """One request row per chunk.

    ``chunks`` needs ``chunk`` and ``voice_id`` columns (plus any keys). Adds ``provider``,
    ``output_format``, ``text_type``, ``request_text``, ``engine``, ``endpoint``, ``model_id`` and
    ``error``. The API key never becomes a column; only its presence is checked.
    """
    prov = normalized_provider(provider if provider is not None else F.lit(settings.tts_provider))
    routed = route_format(prov, settings)
    ttype = _c(text_type) if text_type is not None else routed["text_type"]
    is_polly = prov == F.lit(PROVIDER_POLLY)
    is_el = prov == F.lit(PROVIDER_ELEVENLABS)
    error = (
        F.when(routed["error"].isNotNull(), routed["error"])
        .when(is_polly & ~ttype.isin("text", "ssml"), F.lit(TEXT_TYPE_ERROR))
        .when(is_el & (ttype != F.lit("text")), F.lit(ELEVENLABS_SSML_ERROR))
        .when(is_el & F.lit(not settings.has_api_key), F.lit(ELEVENLABS_KEY_ERROR))
    )
    request_text = F.when(ttype == F.lit("ssml"), ssml_column("chunk")).otherwise(F.col("chunk"))
    return chunks.select(
        "*",
        prov.alias("provider"),
        routed["output_format"].alias("output_format"),
        ttype.alias("text_type"),
        F.when(error.isNull(), request_text).alias("request_text"),
        F.when(is_polly, F.lit(POLLY_ENGINE)).alias("engine"),
        F.when(is_el, F.concat(F.lit(ELEVENLABS_ENDPOINT), F.col("voice_id"))).alias("endpoint"),
        F.when(is_el, F.lit(settings.elevenlabs_model_id)).alias("model_id"),
        error.alias("request_error"),
    )


# --- T9: synthesis with an injected callable ----------------------------------------------

# A speech callable takes one request (dict of the request columns) and returns
# (status_code or None, audio bytes or None, response body text or None); raising means a
# transport error.
SpeechCall = Callable[[dict], tuple]


def _speech_error(provider: str, index: int, status, audio, body, exc: Exception | None) -> str | None:
    if provider == PROVIDER_ELEVENLABS:
        if exc is not None:
            return f"ElevenLabs request failed for chunk {index}: {exc}"
        if status is not None and status >= 400:
            snippet = (body or "").strip()[:500]
            return f"ElevenLabs request failed (status={status}, chunk={index}): {snippet}"
        if not audio:
            return f"ElevenLabs response missing audio content for chunk {index}."
        return None
    if exc is not None:
        return f"Polly request failed for chunk {index}: {exc}"
    if not audio:
        return f"Polly response missing AudioStream for chunk {index}."
    return None


def _speak(call: SpeechCall, rec: dict, keys: list[str]) -> tuple[bytes | None, str | None, float]:
    """One call: (audio, error, milliseconds)."""
    status = audio = body = exc = None
    began = time.perf_counter()
    rec["idempotency_key"] = "/".join(str(rec[k]) for k in [*keys, "chunk_no"])
    try:
        status, audio, body = call(rec)
    except Exception as e:  # transport failure, recorded per chunk
        exc = e
    index = int(rec["chunk_no"]) if rec["chunk_no"] is not None else -1
    err = _speech_error(rec["provider"], index, status, audio, body, exc)
    return (None if err else bytes(audio)), err, 1000 * (time.perf_counter() - began)


def _journaled(requests: DataFrame, call_factory: Callable[[], SpeechCall], keys: list[str], journal: str, concurrency: int) -> DataFrame:
    """The calls of ``synthesize`` through the journal; rows with a request error pass by it."""
    def one(call: SpeechCall, record: dict) -> dict:
        audio, error, ms = _speak(call, record, keys)
        return {"audio": audio, "audio_bytes": None if audio is None else len(audio), "elapsed_ms": ms, "error": error}

    carried = [*keys, "chunk_no", "input_chars"]
    sized = requests.withColumn("input_chars", F.char_length("chunk").cast("bigint"))
    asked = sized.where(F.col("request_error").isNull()).withColumn(
        CALL_KEY, call_key("speech", *keys, "chunk_no", "provider", "voice_id", "output_format", "text_type", "request_text", "engine", "model_id"))
    results = "audio binary, audio_bytes bigint, elapsed_ms double, error string"
    made = journaled_calls(asked, journal, call_factory, one, carried, results, lambda r: r["error"] is None, concurrency).drop(CALL_KEY)
    none = {"audio": "binary", "audio_bytes": "bigint", "elapsed_ms": "double"}
    passed = sized.where(F.col("request_error").isNotNull()).select(
        *carried, *[F.lit(None).cast(kind).alias(c) for c, kind in none.items()], F.col("request_error").alias("error"))
    return made.unionByName(passed)


def synthesize(requests: DataFrame, call_factory: Callable[[], SpeechCall], keys: list[str],
               write_once: bool = True, concurrency: int = 1, journal: str | None = None) -> DataFrame:
    """Call the speech service once per request row.

    With ``journal`` (a folder of the run) finished calls are kept there and not made again by a retry
    or a rerun (``operators/journal``).

    ``call_factory`` is invoked once per partition on the executor (one client per task);
    ``concurrency`` > 1 overlaps that many calls per task (results kept in row order).
    A record has the request columns and ``idempotency_key`` (keys and chunk number). Output: keys +
    chunk_no, input_chars, audio (binary), audio_bytes, elapsed_ms, error. Rows that already carry
    a request error are passed through without a call.
    """
    cols = keys + ["chunk_no", "chunk", "provider", "voice_id", "output_format", "text_type",
                   "request_text", "engine", "endpoint", "model_id", "request_error"]
    if journal:
        return _journaled(requests.select(*cols), call_factory, keys, journal, concurrency)
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = requests.select(*cols).repartition(tasks, *keys, "chunk_no")
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keys)
    schema = f"{key_schema}, chunk_no bigint, input_chars bigint, audio binary, audio_bytes bigint, elapsed_ms double, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        state = {"call": None}
        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None

        def one(rec: dict) -> tuple:
            return _speak(state["call"], rec, keys)

        try:
            for pdf in batches:
                recs = pdf.to_dict("records")
                todo = [r for r in recs if not r.get("request_error")]
                if todo and state["call"] is None:
                    state["call"] = call_factory()
                done = iter(pool.map(one, todo) if pool else map(one, todo))
                results = [(None, r["request_error"], None) if r.get("request_error") else next(done) for r in recs]
                out = pdf[keys + ["chunk_no"]].copy()
                out["input_chars"] = [len(t) if isinstance(t, str) else None for t in pdf["chunk"]]
                out["audio"] = [a for a, _, _ in results]
                out["audio_bytes"] = [len(a) if a is not None else None for a, _, _ in results]
                out["elapsed_ms"] = [ms for _, _, ms in results]
                out["error"] = [e for _, e, _ in results]
                yield out
        finally:
            if pool:
                pool.shutdown()

    out = src.mapInPandas(run, schema)
    return materialize(out, "speech") if write_once else out


def stand_in_speech() -> SpeechCall:
    """Deterministic stand-in used by tests and the benchmark: audio = UTF-8 of the chunk."""

    def call(rec: dict) -> tuple:
        return 200, rec["chunk"].encode("utf-8"), None

    return call


# --- T10/T11 -----------------------------------------------------------------------------

def concat_audio(parts: DataFrame, job_key: str = "job_id", order: tuple[str, ...] = ("turn_no", "chunk_no")) -> DataFrame:
    """Bytes joined in (turn, chunk) order; a job with any failed chunk gets no audio and
    the first failing chunk's error (the job fails as a whole, as in the reference)."""
    order_sql = ", ".join(order)
    return parts.groupBy(job_key).agg(
        F.expr(f"listagg(audio) WITHIN GROUP (ORDER BY {order_sql})").alias("_audio"),
        F.expr(f"min_by(error, struct({order_sql})) FILTER (WHERE error IS NOT NULL)").alias("_first_error_any"),
        F.count(F.when(F.col("error").isNotNull(), 1)).alias("_n_err"),
        F.count(F.lit(1)).alias("chunk_count"),
    ).select(
        job_key,
        F.when(F.col("_n_err") == 0, F.col("_audio")).alias("audio"),
        F.when(F.col("_n_err") == 0, F.octet_length("_audio").cast("bigint")).alias("audio_bytes"),
        "chunk_count",
        F.when(F.col("_n_err") > 0, F.col("_first_error_any")).alias("error"),
    )


def audio_sizes(parts: DataFrame, job_key: str = "job_id", order: tuple[str, ...] = ("turn_no", "chunk_no")) -> DataFrame:
    """What ``concat_audio`` says of each job but the audio itself: sums over narrow columns, added up
    map-side; no audio is read or moved."""
    failed = F.col("error").isNotNull()
    return parts.groupBy(job_key).agg(
        F.sum("audio_bytes").cast("bigint").alias("_bytes"),
        F.count(F.lit(1)).alias("chunk_count"),
        F.expr(f"min_by(error, struct({', '.join(order)})) FILTER (WHERE error IS NOT NULL)").alias("error"),
        F.max(failed).alias("_failed"),
    ).select(job_key, F.when(~F.col("_failed"), F.col("_bytes")).alias("audio_bytes"), "chunk_count", "error")


def write_audio_parts(parts: DataFrame, path: str, job_key: str = "job_id",
                      order: tuple[str, ...] = ("turn_no", "chunk_no"), mode: str = "overwrite", buckets: int = 64) -> None:
    """T10/K3 without a per-job aggregate: the audio parts in (turn, chunk) order under one folder for
    each of ``buckets`` hashes of the job (not one for each job); reading a job's part rows in that
    order and joining their bytes gives the job's audio file. Use this instead of ``concat_audio``
    when one job's audio may not fit in one value or one task's memory."""
    ok = parts.where(F.col("error").isNull()).select(
        job_key, *order, "audio", F.pmod(F.xxhash64(job_key), F.lit(buckets)).alias("bucket"))
    ok.repartition("bucket", job_key, *order[:1]).sortWithinPartitions("bucket", job_key, *order).write.mode(
        mode).partitionBy("bucket").parquet(path)


#: Bytes of audio after which a new range file begins.
RANGE_BYTES = 8 << 20


def audio_places(parts: DataFrame, job_key: str = "job_id", order: tuple[str, ...] = ("turn_no", "chunk_no"),
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(job, *order, offset, range_no) of every part of the jobs without a failed part: where its bytes
    begin in the job's audio, a running sum over the sizes, and the range that they are written with."""
    sizes = parts.select(job_key, *order, F.coalesce("audio_bytes", F.lit(0)).alias("_bytes"), F.col("error").isNotNull().alias("_failed"))
    failed = sizes.where("_failed").select(job_key).distinct()
    good = sizes.drop("_failed").join(failed, job_key, "left_anti")
    placed = running_sum(good, job_key, list(order), "_bytes", "_end")
    start = (F.col("_end") - F.col("_bytes")).cast("bigint")
    return placed.select(job_key, *order, start.alias("offset"), F.floor(start / F.lit(range_bytes)).cast("bigint").alias("range_no"))


def audio_ranges(parts: DataFrame, job_key: str = "job_id", order: tuple[str, ...] = ("turn_no", "chunk_no"),
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(job, range_no, offset, n_bytes, content) of each job's audio in ranges of about
    ``range_bytes``: the parts that begin in a range, joined in order. A range is the largest value that
    is put together, however long a job's audio is and however few turns it has; jobs with a failed part
    have none (``audio_sizes`` has their error)."""
    places = audio_places(parts, job_key, order, range_bytes)
    order_sql = ", ".join(order)
    met = parts.select(job_key, *order, "audio").join(places, [job_key, *order])
    return met.groupBy(job_key, "range_no").agg(
        F.min("offset").alias("offset"), F.expr(f"listagg(audio) WITHIN GROUP (ORDER BY {order_sql})").alias("content"),
    ).select(job_key, "range_no", "offset", F.octet_length("content").cast("bigint").alias("n_bytes"), "content")


def write_audio(parts: DataFrame, names: DataFrame, root: str, job_key: str = "job_id", order: tuple[str, ...] = ("turn_no", "chunk_no"),
                range_bytes: int = RANGE_BYTES) -> DataFrame:
    """K3: write each job's audio as range files under its object key and return the manifest
    (job, object_key, range_no, offset, path, n_bytes, md5); lazy, as ``objects.write_objects``.

    ``names`` has job and object_key. The object is its range files in ``range_no`` order, each beginning at
    ``offset``. Where jobs share an object key the one with the largest key is written."""
    owners = last_writer(names.select(job_key, "object_key"), job_key)
    ranges = audio_ranges(parts, job_key, order, range_bytes).join(owners, job_key)
    own = F.concat("object_key", F.lit("/"), F.lpad(F.col("range_no").cast("string"), 8, "0"))
    filed = ranges.select(job_key, F.col("object_key").alias("audio_key"), "range_no", "offset", own.alias("object_key"), "content")
    made = write_objects(filed, root, keep=(job_key, "audio_key", "range_no", "offset"))
    return made.select(job_key, F.col("audio_key").alias("object_key"), "range_no", "offset", "path", "n_bytes", "md5")


def read_audio(manifest: DataFrame, root: str, job_key: str = "job_id") -> DataFrame:
    """(job, object_key, range_no, offset, content) of the ranges that a manifest names, read from their files."""
    files = manifest.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    held = files.select(path_of_uri("_metadata.file_path").alias("_at"), "content")
    met = manifest.withColumn("_at", bare_path("path")).join(held, "_at")
    return met.select(job_key, "object_key", "range_no", "offset", "content")


def synthesis_report(parts: DataFrame, job_key: str = "job_id", turn_key: str = "turn_no") -> DataFrame:
    """Per (job, turn) and per job (``level`` 1) chunk count, input characters, audio bytes and
    milliseconds spent in calls."""
    job, turn = F.col(job_key), F.col(turn_key)
    return parts.groupingSets([[job, turn], [job]], job, turn).agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.sum("input_chars").cast("bigint").alias("input_chars"),
        F.sum("audio_bytes").cast("bigint").alias("audio_bytes"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
        F.grouping(turn_key).cast("bigint").alias("level"),
    )
