"""End-to-end job runs: request rows in, every stage table and the run ledger out.

The chain of the reference (accept request -> fetch -> rewrite -> generate) as Spark stages
over tables of jobs. Each stage's output that is reused or expensive to redo is written once to
the run's folder (accepted jobs with their ids, source texts, model scripts, turns, chunks, speech
parts), and every finished remote call is kept in the folder's journal, so that a lost executor, task or
driver costs neither a stage that was done nor a call that was paid for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.functions.text import estimate_duration_sec
from castwright.operators import chunking, intake, ledger, prompts, routing, speech, turns
from castwright.plans.runs import RunFolder
from castwright.settings import Settings
from castwright.sources import objects
from castwright.sources.objects import address, last_writer

ATTRIBUTES = ("job_id", "style", "script_mode", "voice_id", "voice_id_b")
SOURCE_COLUMNS = ("source_url", "source_text", "source_file_name", "source_file_base64")


def run_requests(requests: DataFrame, settings: Settings,
                 model_call_factory: Callable[[], prompts.ModelCall],
                 speech_call_factory: Callable[[], speech.SpeechCall],
                 pages: DataFrame | None = None, page_texts: DataFrame | None = None,
                 key: str = "request_id", run: RunFolder | str | None = None, objects_at: str | None = None,
                 concurrency: int = 1) -> dict[str, DataFrame]:
    """requests(key, body, is_base64, query) -> dict of stage tables:

    ``intake`` (every request with status code / error), ``jobs`` (accepted, with job ids),
    ``sources``, ``scripts``, ``turns``, ``chunks``, ``parts``, ``audio``, ``artefacts`` and ``ledger``
    (one row per accepted request: status, failed stage, error, counts, duration estimate).

    A run is a request: every stage table is keyed by ``key``, and run attributes travel with the
    rows. ``job_id`` may repeat (given ids are kept) and only names artefacts.

    ``run`` is the run's folder (a new one by default). Given the folder of a run that broke, whole
    stage tables are read, finished model and speech calls are not made again, and job ids stay.
    With ``objects_at``, a folder, the artefacts are also written there as objects (``objects``: key, path,
    size and MD5 of each; ``audio_ranges``: the range files of each job's audio)."""
    spark = requests.sparkSession
    run = run if isinstance(run, RunFolder) else RunFolder(spark, run)
    decided = run.table("intake", lambda: intake.intake_requests(requests, key=key))
    accepted = run.table("jobs", lambda: intake.assign_job_ids(decided.where(F.col("status_code") == 202).drop("status_code", "error")))
    sources = run.table("sources", lambda: routing.fetch_sources(
        accepted.select(key, *ATTRIBUTES, *SOURCE_COLUMNS), pages=pages, page_texts=page_texts,
        default_bucket=settings.bucket, key=key, keep=ATTRIBUTES))

    title = F.lit(None).cast("string").alias("title")
    scripts = run.table("scripts", lambda: prompts.rewrite(
        sources.where(F.col("error").isNull()).select("*", title), model_call_factory, settings.model_id, key=key,
        keep=(*ATTRIBUTES, "source_type"), journal=run.journal("model"), concurrency=concurrency))
    ok_scripts = scripts.where(F.col("error").isNull())
    is_duo = F.lower(F.trim("script_mode")) == "duo"
    duo_scripts = ok_scripts.where(is_duo)

    def voiced_turns() -> DataFrame:
        parsed = turns.parse_duo_turns(duo_scripts.select(key, F.col("script").alias("text")), key=key)
        duo = parsed.join(duo_scripts.select(key, "voice_id", "voice_id_b"), key).select(
            key, "turn_no", "text", "speaker", speech.route_voice("speaker", "voice_id", "voice_id_b", settings).alias("voice_id"))
        single = ok_scripts.where(~is_duo).select(
            key, F.lit(1).cast("bigint").alias("turn_no"), F.col("script").alias("text"), F.lit(None).cast("string").alias("speaker"),
            speech.single_voice("voice_id", settings).alias("voice_id"))
        return duo.unionByName(single)

    all_turns = run.table("turns", voiced_turns)
    no_turns = turns.duo_rejects(duo_scripts, all_turns, key=key)
    chunks = run.table("chunks", lambda: chunking.explode_chunks(
        all_turns, [key, "turn_no", "voice_id"], "text", chunking.PIPELINE_CHUNK_LIMIT))
    parts = run.table("parts", lambda: speech.synthesize(
        speech.synthesis_requests(chunks.where(F.col("error").isNull()), settings), speech_call_factory,
        keys=[key, "turn_no"], journal=run.journal("speech"), concurrency=concurrency))

    # The generate stage: sizes of what was spoken, scripts without turns, texts without a chunk.
    none = F.lit(None).cast("bigint")
    failed = no_turns.select(key, "error").unionByName(chunks.where(F.col("error").isNotNull()).select(key, "error"))
    generate = speech.audio_sizes(parts, job_key=key).select(key, "error", "chunk_count", "audio_bytes").unionByName(
        failed.select("*", none.alias("chunk_count"), none.alias("audio_bytes")))
    spoken = F.when(F.col("error").isNull(), estimate_duration_sec("script")).alias("duration_sec")
    book = ledger.run_ledger(
        {"fetch": sources.select(key, "error", "article_char_count"),
         "rewrite": scripts.select(key, "error", F.char_length("script").alias("script_chars"), spoken),
         "generate": generate}, key=key,
        counts=("article_char_count", "script_chars", "chunk_count", "audio_bytes", "duration_sec"))
    made = artefacts(accepted, sources, scripts, settings, key)
    out = {"intake": decided, "jobs": accepted, "sources": sources, "scripts": scripts,
           "turns": all_turns, "chunks": chunks, "parts": parts, "audio": speech.concat_audio(parts, job_key=key),
           "artefacts": made, "ledger": book}
    if objects_at:
        root = address(objects_at.rstrip("/"))
        texts = last_writer(made.select(key, "job_id", "artefact", "object_key", F.coalesce("text", "json").alias("content")), key)
        out["objects"] = run.table("objects", lambda: objects.write_objects(texts, root, keep=(key, "job_id", "artefact")))
        names = accepted.select(key, ledger.artefact_key("job_id", dict(ledger.ARTEFACTS)["audio"]).alias("object_key"))
        out["audio_ranges"] = run.table("audio_ranges", lambda: speech.write_audio(parts, names, root, job_key=key))
    return out


def artefacts(accepted: DataFrame, sources: DataFrame, scripts: DataFrame, settings: Settings, key: str) -> DataFrame:
    """K1/K2: (key, job_id, artefact, object_key, text, json) of the source and script texts and the
    script metadata of each run; ``run_requests`` writes them as objects on request."""
    absent = F.lit(None).cast("string")

    def rows(df: DataFrame, artefact: str, text, json) -> DataFrame:
        return df.select(key, "job_id", F.lit(artefact).alias("artefact"),
                         ledger.artefact_key("job_id", dict(ledger.ARTEFACTS)[artefact]).alias("object_key"),
                         text.alias("text"), json.alias("json"))

    ok = F.col("error").isNull()
    written = scripts.where(ok).join(accepted.select(key, "source_url"), key).withColumn("title", absent)
    return (rows(sources.where(ok), "source", F.col("text"), absent)
            .unionByName(rows(written, "script", F.col("script"), absent))
            .unionByName(rows(written, "script_metadata", absent, prompts.script_metadata_object(written, settings.model_id))))
