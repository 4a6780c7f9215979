"""Uploaded files to source text.

* S3 ``scan_files``: ``binaryFile`` scan -> (path, name, base64, n_bytes, error).
* R6 ``doc_type``: last suffix of the base name, lower-cased, among .pdf .docx .txt.
* R7 strict base64 (``castwright.functions.encoding``).
* R8 plain text: UTF-8 on the JVM, UTF-16/Latin-1 fallback in Arrow.
* R9 DOCX: word XML parts read with ``zipfile`` + ``xml.etree`` inside ``mapInPandas``.
* R10 page assembly: page texts joined in page order with an ordered ``listagg``.
* R11 dispatch: one projection; each extractor sees only its own type's bytes; every failure
  is kept as a row.

PDF bytes are not parsed here; PDF page texts enter through R10 (``page_texts`` table).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castwright.functions.encoding import b64encode, decode_text_bytes
from castwright.functions.text import clean_lines, py_strip, split_lines

# Supported document suffixes and their types.
SUPPORTED_TYPES = {".pdf": "pdf", ".docx": "docx", ".txt": "txt"}
SUFFIX_RX = r"[^/](\.[^./]+)\z"

E_EMPTY_FILE = "Uploaded document is empty."
E_PDF_UNAVAILABLE = "PDF support requires the `pypdf` package to be installed."
E_MISSING_FILE = "Source file was not found: "
E_EMPTY_SOURCE_FILE = "Source file is empty: "
E_FETCH_BAD_B64 = "source_file_base64 is not valid base64."


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def doc_suffix(name: Column | str) -> Column:
    return F.lower(F.regexp_extract(_c(name), SUFFIX_RX, 1))


def doc_type(name: Column | str) -> Column:
    """Pdf / docx / txt, null when unsupported."""
    suffix = doc_suffix(name)
    out = F.lit(None).cast("string")
    for ext, kind in SUPPORTED_TYPES.items():
        out = F.when(suffix == F.lit(ext), F.lit(kind)).otherwise(out)
    return out


def doc_type_error(name: Column | str) -> Column:
    supported = ", ".join(sorted(SUPPORTED_TYPES))
    suffix = doc_suffix(name)
    shown = F.when(suffix != F.lit(""), suffix).otherwise(_c(name))
    return F.when(
        doc_type(name).isNull(),
        F.concat(F.lit("Unsupported document type '"), shown, F.lit(f"'. Use: {supported}")),
    )


def no_text_error(kind: Column | str) -> Column:
    return F.concat(F.lit("No readable text found in uploaded "), F.upper(_c(kind)), F.lit(" document."))


# --- S3 -----------------------------------------------------------------------------------

def scan_files(spark, path: str, glob: str | None = None) -> DataFrame:
    """S3 over a folder: (path, name, content_base64, n_bytes, error). Spark's reader skips files of no
    bytes; ``read_requested_files`` reports those (and missing ones) for a table of paths."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    empty = F.col("length") == 0
    return df.select(
        F.col("path"),
        base_name("path").alias("name"),
        F.when(~empty, b64encode("content")).alias("content_base64"),
        F.col("length").cast("bigint").alias("n_bytes"),
        F.when(empty, F.concat(F.lit(E_EMPTY_SOURCE_FILE), F.col("path"))).alias("error"),
    )


E_CLI_EXACTLY_ONE = "Provide exactly one of a source URL or --source-file <path>."


def cli_source_error(source: Column | str, source_file: Column | str) -> Column:
    """V4: exactly one of a URL and a file path, by truthiness (an empty string is absent)."""
    has_url = F.coalesce(_c(source) != F.lit(""), F.lit(False))
    has_file = F.coalesce(_c(source_file) != F.lit(""), F.lit(False))
    return F.when(has_url == has_file, F.lit(E_CLI_EXACTLY_ONE))


def _read_file_kernel(key: str, path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64
        import os

        from pyarrow import fs as pafs

        local = pafs.LocalFileSystem()
        for pdf in batches:
            names, payloads, errors = [], [], []
            for p in pdf[path]:
                name = payload = err = None
                try:
                    filesystem, inner = (pafs.FileSystem.from_uri(p) if "://" in p else (local, os.path.abspath(p)))
                    info = filesystem.get_file_info(inner)
                    if info.type != pafs.FileType.File:
                        err = f"{E_MISSING_FILE}{p}"
                    elif info.size == 0:
                        err = f"{E_EMPTY_SOURCE_FILE}{p}"
                    else:
                        with filesystem.open_input_stream(inner) as fh:
                            payload = base64.b64encode(fh.read()).decode("ascii")
                        name = inner.rstrip("/").rsplit("/", 1)[-1]
                except (OSError, ValueError):
                    err = f"{E_MISSING_FILE}{p}"
                names.append(name)
                payloads.append(payload)
                errors.append(err)
            yield pd.DataFrame({key: pdf[key], path: pdf[path], "source_file_name": names,
                                "source_file_base64": payloads, "error": errors})

    return run


def read_requested_files(requests: DataFrame, key: str = "request_id", path: str = "source_file") -> DataFrame:
    """S3 for a table of requested file paths: each task checks and reads its own paths through
    Arrow's file-system layer (local paths or URIs), so no path list passes through the driver.
    Missing -> "Source file was not found: <path>", empty -> "Source file is empty: <path>",
    else (base name, base64 payload). Rows without a path are passed through untouched."""
    key_type = requests.schema[key].dataType.simpleString()
    src = requests.select(key, path).where(F.col(path).isNotNull() & (F.col(path) != F.lit("")))
    return src.mapInPandas(
        _read_file_kernel(key, path),
        f"{key} {key_type}, {path} string, source_file_name string, source_file_base64 string, error string",
    )


# --- R9 -----------------------------------------------------------------------------------

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_HEADER_RX = re.compile(r"word/header[0-9]*\.xml")
_FOOTER_RX = re.compile(r"word/footer[0-9]*\.xml")


def _word_part_text(xml_bytes: bytes) -> str:
    """Text of one word XML part: runs' text, tab -> \\t, line break -> \\n, each paragraph
    starts on a blank line."""
    out: list[str] = []
    for el in ElementTree.fromstring(xml_bytes).iter():
        tag = el.tag
        if tag == _W + "t":
            out.append(el.text or "")
        elif tag == _W + "tab":
            out.append("\t")
        elif tag in (_W + "br", _W + "cr"):
            out.append("\n")
        elif tag == _W + "p":
            out.append("\n\n")
    return "".join(out)


def docx_raw_text(data: bytes) -> str:
    """Header parts, the main document, footer parts, in archive order."""
    with zipfile.ZipFile(io.BytesIO(data)) as zf:
        names = zf.namelist()
        parts = [n for n in names if _HEADER_RX.match(n)] + ["word/document.xml"]
        parts += [n for n in names if _FOOTER_RX.match(n)]
        return "".join(_word_part_text(zf.read(n)) for n in parts).strip()


def docx_text(data: bytes) -> str:
    """Stripped non-blank lines joined by a blank line."""
    lines = [ln.strip() for ln in docx_raw_text(data).splitlines() if ln.strip()]
    return "\n\n".join(lines).strip()


def _docx_kernel(content: pd.Series) -> pd.DataFrame:
    texts, errors = [], []
    for data in content:
        if data is None:
            texts.append(None)
            errors.append(None)
            continue
        try:
            texts.append(docx_text(bytes(data)))
            errors.append(None)
        except Exception as exc:  # a broken archive is a row error, not a job failure
            texts.append(None)
            errors.append(f"Failed to parse DOCX document: {exc}")
    return pd.DataFrame({"text": texts, "error": errors})


_docx_udf = F.pandas_udf(
    _docx_kernel, T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])
)


def docx_column(content: Column | str) -> Column:
    """struct(text, error) for DOCX bytes; null input -> null fields (no Python work)."""
    return _docx_udf(_c(content))


def extract_docx(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, content) -> (key, text, error) through Arrow batches."""
    r = df.select(key, docx_column(content).alias("_r"))
    return r.select(key, F.col("_r.text").alias("text"), F.col("_r.error").alias("error"))


def build_docx(lines: list[str]) -> bytes:
    """Minimal DOCX archive with one paragraph per line (fixture and sink helper)."""
    from xml.sax.saxutils import escape

    body = "".join(
        f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in lines
    )
    doc = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        f'<w:document xmlns:w="{_W[1:-1]}"><w:body>{body}</w:body></w:document>'
    )
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        zf.writestr("word/document.xml", doc)
    return buf.getvalue()


# --- R10 ----------------------------------------------------------------------------------

E_BLANK_PAGES = "document has no readable page"


def assemble_pages(page_texts: DataFrame, key: str = "doc_id", page: str = "page_no", text: str = "text", keep_blank: bool = False) -> DataFrame:
    """Stripped non-blank page texts joined by a blank line in page order. With ``keep_blank`` documents
    whose pages are all blank keep a row, with the reason in ``error``."""
    if keep_blank:
        stripped = F.nullif(py_strip(text), F.lit(""))
        made = page_texts.select(key, page, stripped.alias("_t")).groupBy(key).agg(
            py_strip(F.expr(f"listagg(_t, '\\n\\n') WITHIN GROUP (ORDER BY {page})")).alias("text"))
        return made.withColumn("error", F.when(F.col("text").isNull(), F.lit(E_BLANK_PAGES)))
    kept = page_texts.select(key, page, py_strip(text).alias("_t")).where(F.col("_t") != F.lit(""))
    return kept.groupBy(key).agg(
        py_strip(F.expr(f"listagg(_t, '\\n\\n') WITHIN GROUP (ORDER BY {page})")).alias("text")
    )


# --- R11 ----------------------------------------------------------------------------------

def document_parts(name: Column | str, content: Column | str, active: Column | None = None) -> dict[str, Column]:
    """R11 as columns: ``doc_type``, ``text`` (null for PDF, which comes from page texts) and
    ``error`` (empty file, unsupported type, DOCX failure). Each extractor only receives the
    bytes of its own type on ``active`` rows; every other row passes null (no Python work)."""
    n, c = _c(name), _c(content)
    on = F.lit(True) if active is None else active
    kind = doc_type(n)
    empty = c.isNull() | (F.octet_length(c) == 0)
    pre = F.when(empty, F.lit(E_EMPTY_FILE)).otherwise(doc_type_error(n))
    runnable = on & pre.isNull()
    txt = decode_text_bytes(F.when(runnable & (kind == "txt"), c))
    docx = docx_column(F.when(runnable & (kind == "docx"), c))
    return {
        "doc_type": F.when(~empty, kind),
        "text": F.when(kind == "txt", txt["text"]).when(kind == "docx", docx["text"]),
        "error": F.coalesce(pre, F.when(kind == "docx", docx["error"])),
    }


def finish_documents(df: DataFrame, key: str, page_texts: DataFrame | None, keep: tuple[str, ...] = (),
                     active: str | None = None) -> DataFrame:
    """Fill PDF text from assembled page texts (left join on the narrow key) and turn blank
    text into the per-type error. ``active`` names a boolean column limiting this to file rows."""
    is_on = F.col(active) if active else F.lit(True)
    if page_texts is not None:
        pages = page_texts.select(F.col(key), F.col("text").alias("_pdf_text"))
        df = df.join(pages, key, "left")
        text = F.when(is_on & (F.col("doc_type") == "pdf"), F.col("_pdf_text")).otherwise(F.col("text"))
        error = F.col("error")
    else:
        text = F.col("text")
        error = F.when(is_on & F.col("error").isNull() & (F.col("doc_type") == "pdf"),
                       F.lit(E_PDF_UNAVAILABLE)).otherwise(F.col("error"))
    df = df.select(key, *keep, *([active] if active else []), "doc_type", text.alias("text"), error.alias("error"))
    blank = is_on & F.col("error").isNull() & (F.coalesce(F.col("text"), F.lit("")) == F.lit(""))
    ok = F.col("error").isNull() & ~blank
    return df.select(
        key, *keep, "doc_type",
        F.when(ok, F.col("text")).alias("text"),
        F.when(ok, F.char_length("text").cast("bigint")).alias("n_chars"),
        F.when(blank, no_text_error("doc_type")).otherwise(F.col("error")).alias("error"),
    )


def extract_documents(files: DataFrame, key: str = "file_id", name: str = "name", content: str = "content",
                      page_texts: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """files(key, name, content) -> (key, name, doc_type, text, n_chars, error).

    Checks in order: empty file, unsupported type, extraction, blank text. One scan, one
    projection; PDF texts come from ``page_texts`` (assembled, keyed like ``files``) through
    a left join on the narrow result."""
    parts = document_parts(name, content)
    extracted = files.select(key, *keep, F.col(name).alias("name"),
                             *[v.alias(k) for k, v in parts.items()])
    out = finish_documents(extracted, key, page_texts, keep=tuple(keep) + ("name",))
    return out.select(key, *keep, "name", "doc_type", "text", "n_chars", "error")


__all__ = ["doc_type", "doc_type_error", "scan_files", "extract_docx", "docx_text", "build_docx",
           "assemble_pages", "extract_documents", "clean_lines", "split_lines"]
