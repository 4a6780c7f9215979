"""M1–M8: prompt text, model routing, request bodies, response parsing, the rewrite step with an
injected model callable, and script metadata.

Prompt, routing, bodies and response parsing are native columns (``concat``, ``when``,
``to_json``, variant paths). The model call is the only Python step: ``mapInPandas`` builds
one client per partition from an injected factory, records a per-row error instead of
failing the job, and its output is written once before any reuse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castwright.functions.text import py_strip
from castwright.operators.intake import falsy
from castwright.operators.journal import CALL_KEY, call_key, journaled_calls
from castwright.session import materialize
from castwright.sources.objects import json_object

# Prompt wording of the reference pipeline.
PROMPT_HEAD = "You are a podcast writer. "
SINGLE_INSTRUCTION = (
    "Rewrite it into a natural, single-host podcast script. Keep it engaging, "
    "clear, and structured with an intro, 3-5 short segments with signposts, and "
    "a concise outro. "
)
DUO_INSTRUCTION = (
    "Rewrite it into a natural, two-host podcast dialogue between HOST_A and HOST_B. "
    "Use plain text lines prefixed with exactly 'HOST_A:' or 'HOST_B:'. "
    "Keep it engaging, clear, and structured with an intro, 3-5 short segments with "
    "signposts, and a concise outro. "
)
PROMPT_TAIL = (
    "Aim for 6-10 minutes of speech. "
    "Use plain text only; do not include JSON, markdown, or stage directions.\n\n"
)
VIDEO_LABEL = "YouTube transcript"
SOURCE_LABEL = "source material"
DEFAULT_INPUT_TYPE = "article"
PROMPT_MODE_ERROR = "script_mode must be either 'single' or 'duo'."

# Model families, request parameters, response errors.
FAMILY_A_PREFIXES = ("anthropic.", "us.anthropic.")
FAMILY_N_PREFIXES = ("amazon.nova", "us.amazon.nova")
FAMILY_A_VERSION = "bedrock-2023-05-31"
MAX_TOKENS = 1400
TEMPERATURE = 0.5
E_A_NO_CONTENT = "Bedrock response missing content."
E_A_NO_TEXT = "Bedrock response missing text."
E_N_NO_TEXT = "Nova response missing text."


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- M1 -------------------------------------------------------------------------------------

def prompt_column(text: Column | str, title: Column | str, style: Column | str,
                  source_type: Column | str, script_mode: Column | str) -> Column:
    """M1: the prompt; null when the mode is neither single nor duo (``prompt_error``)."""
    mode = F.lower(py_strip(_c(script_mode)))
    instruction = F.when(mode == "single", F.lit(SINGLE_INSTRUCTION)).when(mode == "duo", F.lit(DUO_INSTRUCTION))
    t = _c(title)
    title_line = F.when(t.isNotNull() & (t != F.lit("")), F.concat(F.lit("Title: "), t, F.lit("\n"))).otherwise(F.lit(""))
    st = _c(source_type)
    label = F.when(st == F.lit("youtube"), F.lit(VIDEO_LABEL)).otherwise(F.lit(SOURCE_LABEL))
    input_type = F.when(st.isNotNull() & (st != F.lit("")), st).otherwise(F.lit(DEFAULT_INPUT_TYPE))
    return F.concat(
        F.lit(PROMPT_HEAD), instruction, F.lit(PROMPT_TAIL),
        F.lit("Style: "), F.coalesce(_c(style), F.lit("None")), F.lit("\n"),
        F.lit("Script Mode: "), mode, F.lit("\n"),
        title_line,
        F.lit("Input Type: "), input_type, F.lit("\n"),
        label, F.lit(":\n"),
        _c(text),
    )


def prompt_error(script_mode: Column | str) -> Column:
    mode = F.lower(py_strip(_c(script_mode)))
    return F.when(~mode.isin("single", "duo") | mode.isNull(), F.lit(PROMPT_MODE_ERROR))


# --- M2–M4 ----------------------------------------------------------------------------------

def model_family(model_id: Column | str) -> Column:
    """M2: 'anthropic' / 'nova' by prefix, null when unsupported."""
    m = _c(model_id)
    a = None
    for p in FAMILY_A_PREFIXES:
        a = m.startswith(p) if a is None else (a | m.startswith(p))
    n = None
    for p in FAMILY_N_PREFIXES:
        n = m.startswith(p) if n is None else (n | m.startswith(p))
    return F.when(a, F.lit("anthropic")).when(n, F.lit("nova"))


def model_family_error(model_id: Column | str) -> Column:
    return F.when(model_family(model_id).isNull(),
                  F.concat(F.lit("Unsupported Bedrock model_id: "), F.coalesce(_c(model_id), F.lit("None"))))


def request_body(family: Column | str, prompt: Column | str,
                 max_tokens: int = MAX_TOKENS, temperature: float = TEMPERATURE) -> Column:
    """M3/M4: the JSON request body of the family."""
    p = _c(prompt)
    body_a = F.to_json(F.struct(
        F.lit(FAMILY_A_VERSION).alias("anthropic_version"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(temperature).alias("temperature"),
        F.array(F.struct(F.lit("user").alias("role"),
                         F.array(F.struct(F.lit("text").alias("type"), p.alias("text"))).alias("content"))).alias("messages"),
    ))
    body_n = F.to_json(F.struct(
        F.array(F.struct(F.lit("user").alias("role"),
                         F.array(F.struct(p.alias("text"))).alias("content"))).alias("messages"),
        F.struct(F.lit(max_tokens).alias("maxTokens"), F.lit(temperature).alias("temperature")).alias("inferenceConfig"),
    ))
    f = _c(family)
    return F.when(f == "anthropic", body_a).when(f == "nova", body_n)


# --- M5/M6 ----------------------------------------------------------------------------------

def _json_string(v: Column) -> Column:
    """The value of a JSON string; null for any other type."""
    return F.when(F.schema_of_variant(v) == F.lit("STRING"), F.try_variant_get(v, "$", "string"))


def response_text(family: Column | str, response: Column | str) -> Column:
    """M5/M6: struct(text, error) from the model's JSON response."""
    v = F.try_parse_json(_c(response))
    content = F.try_variant_get(v, "$.content", "variant")
    first = F.when(F.schema_of_variant(content).startswith("ARRAY"),
                   _json_string(F.try_variant_get(content, "$[0].text", "variant")))
    a_err = F.when(falsy(content), F.lit(E_A_NO_CONTENT)).when(
        first.isNull() | (first == F.lit("")), F.lit(E_A_NO_TEXT))
    items = F.coalesce(F.try_variant_get(v, "$.output.message.content", "array<variant>"),
                       F.array().cast("array<variant>"))
    with_text = F.filter(items, lambda x: F.try_variant_get(x, "$.text", "variant").isNotNull())
    n_text = _json_string(F.try_variant_get(F.try_element_at(with_text, F.lit(1)), "$.text", "variant"))
    n_err = F.when(n_text.isNull(), F.lit(E_N_NO_TEXT))
    f = _c(family)
    text = F.when(f == "anthropic", F.when(a_err.isNull(), py_strip(first))).when(
        f == "nova", F.when(n_err.isNull(), py_strip(n_text)))
    err = F.when(f == "anthropic", a_err).when(f == "nova", n_err)
    return F.struct(text.alias("text"), err.alias("error"))


# --- M7/M8 ----------------------------------------------------------------------------------

# A model callable takes (model_id, request body JSON) and returns the response JSON text.
ModelCall = Callable[[str, str], str]


def rewrite(jobs: DataFrame, call_factory: Callable[[], ModelCall], model_id: str, key: str = "job_id",
            write_once: bool = True, concurrency: int = 1, keep: tuple[str, ...] = (), journal: str | None = None) -> DataFrame:
    """M7: jobs(key, text, title, style, source_type, script_mode) -> (key, *keep, script, error).

    With ``journal`` (a folder of the run) finished calls are kept there and not made again by a retry
    or a rerun (``operators/journal``); without it:

    The prompt, family and body are native columns; the call runs once per row inside
    ``mapInPandas`` (one client per partition; ``concurrency`` > 1 overlaps that many calls per
    task for a latency-bound service, results kept in row order) and the result is written to
    the shared checkpoint folder before use, so no later stage calls the model again. A task
    attempt that fails or runs twice (speculation: leave it off here) repeats the calls of its
    rows; ``key`` is one run, so a service can be given it to recognise a repeat."""
    fam = model_family(F.lit(model_id))
    prompt = prompt_column("text", "title", "style", "source_type", "script_mode")
    pre_error = F.coalesce(model_family_error(F.lit(model_id)), prompt_error("script_mode"))
    req = jobs.select(
        key, fam.alias("family"),
        F.when(pre_error.isNull(), request_body(fam, prompt)).alias("body"),
        pre_error.alias("pre_error"), *keep,
    )
    kept = [key, *keep]
    if journal:
        return _parsed(_journaled(req, call_factory, model_id, kept, journal, concurrency), kept)
    kept_schema = ", ".join(f"{c} {jobs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        call = None
        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None

        def one(body):
            try:
                return call(model_id, body), None
            except Exception as exc:  # recorded per row
                return None, f"Model call failed: {exc}"

        try:
            for pdf in batches:
                todo = [b for b, pre in zip(pdf["body"], pdf["pre_error"]) if pre is None]
                if todo and call is None:
                    call = call_factory()
                done = iter(pool.map(one, todo) if pool else map(one, todo))
                out = [(None, pre) if pre is not None else next(done) for pre in pdf["pre_error"]]
                yield pd.DataFrame({**{c: pdf[c] for c in kept}, "family": pdf["family"],
                                    "response": [o[0] for o in out], "call_error": [o[1] for o in out]})
        finally:
            if pool:
                pool.shutdown()

    called = req.mapInPandas(run, f"{kept_schema}, family string, response string, call_error string")
    if write_once:
        called = materialize(called, "model")
    return _parsed(called, kept)


def _journaled(req: DataFrame, call_factory: Callable[[], ModelCall], model_id: str, kept: list[str], journal: str, concurrency: int) -> DataFrame:
    """The calls of ``rewrite`` through the journal; jobs without a body pass by it."""
    def one(call: ModelCall, record: dict) -> dict:
        try:
            return {"response": call(model_id, record["body"]), "call_error": None}
        except Exception as exc:  # recorded per row
            return {"response": None, "call_error": f"Model call failed: {exc}"}

    asked = req.where(F.col("pre_error").isNull()).withColumn(CALL_KEY, call_key("model", F.lit(model_id), kept[0], "body"))
    made = journaled_calls(asked, journal, call_factory, one, [*kept, "family"], "response string, call_error string",
                           lambda r: r["call_error"] is None, concurrency)
    passed = req.where(F.col("pre_error").isNotNull()).select(
        *kept, "family", F.lit(None).cast("string").alias("response"), F.col("pre_error").alias("call_error"))
    return made.drop(CALL_KEY).unionByName(passed)


def _parsed(called: DataFrame, kept: list[str]) -> DataFrame:
    parsed = called.select(*kept, "call_error", response_text("family", "response").alias("r"))
    return parsed.select(
        *kept,
        F.when(F.col("call_error").isNull(), F.col("r.text")).alias("script"),
        F.coalesce(F.col("call_error"), F.col("r.error")).alias("error"),
    )


def echo_model() -> ModelCall:
    """Deterministic stand-in used by tests and the benchmark: answers with the source part
    of the prompt, in the response shape of the model's family."""
    import json

    def call(model_id: str, body: str) -> str:
        req = json.loads(body)
        parts = req["messages"][0]["content"][0]["text"].split(":\n", 1)
        text = parts[1] if len(parts) > 1 else parts[0]
        if model_id.startswith(FAMILY_N_PREFIXES):
            return json.dumps({"output": {"message": {"content": [{"text": text}]}}})
        return json.dumps({"content": [{"type": "text", "text": text}]})

    return call


METADATA_FIELDS = ("job_id", "source_url", "source_type", "title", "style", "script_mode", "model_id",
                   "script_s3_key")


def _metadata_fields(model_id: str, key: str) -> dict[str, Column]:
    made = {"model_id": F.lit(model_id), "script_s3_key": F.concat(F.lit("jobs/"), F.col(key), F.lit("/script.txt")), "job_id": F.col(key)}
    return {f: made[f] if f in made else F.col(f).cast("string") for f in METADATA_FIELDS}


def script_metadata(df: DataFrame, model_id: str, key: str = "job_id") -> Column:
    """M8: the 8-field metadata object as one compact line, nulls kept."""
    fields = [c.alias(f) for f, c in _metadata_fields(model_id, key).items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def script_metadata_object(df: DataFrame, model_id: str, key: str = "job_id") -> Column:
    """M8/K2: the same object as it is stored: ASCII, indented by two spaces."""
    return json_object(_metadata_fields(model_id, key))


def metadata_schema() -> T.StructType:
    """Types of the metadata object's fields, to read it back."""
    return T.StructType([T.StructField(f, T.StringType()) for f in METADATA_FIELDS])
