"""Objects named by a key (``jobs/<job_id>/script.json``) in a folder of the shared file system.

Tasks write each object under its own name, first to a name of the attempt and then renamed, so a task that
runs twice leaves one whole object. The folder may be on any file system that the tasks can open by
its address (``pyarrow.fs``). Objects are read back by path in the same way, without listing a folder.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def address(path: str) -> str:
    """A path as an address with a scheme (plain paths are local or mounted folders)."""
    return path if ":/" in path else f"file://{path}"


def open_folder(path: str):
    """(file system, path on it) of an address; used inside tasks."""
    from pyarrow import fs

    where = address(path)
    if where.startswith("file:"):
        return fs.LocalFileSystem(), "/" + where[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(where)


def object_path(key: str) -> str:
    """Relative path of an object key: each part percent-encoded, so that no part can leave the folder."""
    parts = [quote(p, safe="") for p in key.split("/")]
    return "/".join(p.replace(".", "%2E") if set(p) <= {"."} else p for p in parts)


def put_whole(files, at: str, data: bytes) -> None:
    """Write a file so that its name only ever shows the whole content."""
    files.create_dir(at.rsplit("/", 1)[0])
    part = f"{at}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, at)


def write_objects(df: DataFrame, root: str, key: str = "object_key", content: str = "content", keep: tuple[str, ...] = ()) -> DataFrame:
    """Write one object a row (``content``: binary or text, null: an empty object) and return
    (*keep, object_key, path, n_bytes, md5). Lazy: materialise the result once, that is the write.
    Rows with the same key write the same object; give one row for each (see ``last_writer``)."""
    base = df.select(*keep, F.col(key).alias("object_key"), F.col(content).cast("binary").alias("_content"))
    schema = T.StructType([*base.schema.fields[:-1], T.StructField("path", T.StringType()), T.StructField("n_bytes", T.LongType()), T.StructField("md5", T.StringType())])
    at = len(keep)

    def run(batches):
        files, folder = open_folder(root)
        for batch in batches:
            paths, sizes, sums = [], [], []
            for name, data in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()):
                data = data or b""
                relative = object_path(name or "")
                put_whole(files, f"{folder}/{relative}", data)
                paths.append(f"{root}/{relative}")
                sizes.append(len(data))
                sums.append(hashlib.md5(data).hexdigest())
            made = [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: at + 1], *made], names=[f.name for f in schema])

    return base.mapInArrow(run, schema)


def last_writer(df: DataFrame, by: str, key: str = "object_key") -> DataFrame:
    """One row for each object key, that with the largest ``by``: a later run of a job replaces its objects.
    Only keys and ``by`` are compared; the contents stay where they are."""
    last = df.groupBy(key).agg(F.max(by).alias(by))
    return df.join(last, [key, by], "left_semi")


def bare_path(path: Column | str) -> Column:
    """A path without its scheme."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def path_of_uri(uri: Column | str) -> Column:
    """The bare path in a file's URI, its percent signs read."""
    return F.url_decode(F.replace(bare_path(uri), F.lit("+"), F.lit("%2B")))


# --- JSON objects (K2 / S5) ---------------------------------------------------------------

def _escaped(text: Column) -> Column:
    """A text as a JSON string in ASCII: short escapes, ``\\uXXXX`` for the rest, surrogate pairs above U+FFFF.

    Each distinct character that needs it is replaced in the whole text at once."""
    def escape(char: Column) -> Column:
        units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        out = F.concat(F.lit("\\u"), F.substring(units, 1, 4), F.when(F.length(units) > 4, F.concat(F.lit("\\u"), F.substring(units, 5, 4))).otherwise(F.lit("")))
        for plain, short in (("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            out = F.when(char == F.lit(plain), F.lit(short)).otherwise(out)
        return out

    base = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    odd = F.array_distinct(F.regexp_extract_all(text, F.lit("[^\\x20-\\x7E]"), F.lit(0)))
    return F.concat(F.lit('"'), F.aggregate(odd, base, lambda whole, char: F.replace(whole, char, escape(char))), F.lit('"'))


def json_object(fields: dict[str, Column]) -> Column:
    """A flat object of texts as ASCII JSON with two spaces of indent; a null field is ``null``."""
    lines = [F.concat(F.lit(f'  "{name}": '), F.coalesce(_escaped(value), F.lit("null"))) for name, value in fields.items()]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))


E_MISSING_OBJECT = "object not found: "
E_BROKEN_OBJECT = "object is not a JSON object of the expected fields: "
_BROKEN = "_broken"
# Bytes of objects after which a batch of them is handed on, so that a task holds no more than about that and one object.
READ_BYTES = 16 << 20


def get_whole(files, at: str) -> bytes | None:
    """The content of a file; null where there is none."""
    from pyarrow import fs

    try:
        with files.open_input_file(at) as held:
            return held.read()
    except FileNotFoundError:
        return None
    except OSError:
        if files.get_file_info(at).type == fs.FileType.File:
            raise
        return None


def json_text(data: bytes) -> str | None:
    """The text of a JSON file in the encoding that its first bytes show; null for broken bytes."""
    try:
        return data.decode(json.detect_encoding(data))
    except UnicodeDecodeError:
        return None


def read_texts(asked: DataFrame, folder: str, path: str = "path", suffix: str = ".json") -> DataFrame:
    """``asked`` with ``_found`` and ``_text``: the file of each row's path, opened by the row's task. Nothing is listed,
    so the work is that of the rows asked for. A path outside ``folder`` or without the suffix names no object."""
    schema = T.StructType([*asked.schema.fields, T.StructField("_found", T.BooleanType()), T.StructField("_text", T.StringType())])
    at = asked.columns.index(path)

    def bare(name: str) -> str:
        return re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", name)

    def run(batches):
        files, root = open_folder(folder)
        below = bare(address(folder)).rstrip("/") + "/"

        def content(name: str | None) -> bytes | None:
            name = bare(name or "")
            if not name.startswith(below) or not name.endswith(suffix) or ".." in name.split("/"):
                return None
            return get_whole(files, f"{root.rstrip('/')}/{name[len(below):]}")

        for batch in batches:
            begin, size, found, texts = 0, 0, [], []
            for row, name in enumerate(batch.column(at).to_pylist(), 1):
                data = content(name)
                found.append(data is not None)
                texts.append(None if data is None else json_text(data))
                size += len(data or b"")
                if size > READ_BYTES or row == batch.num_rows:
                    made = [pa.array(found, pa.bool_()), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays([*batch.slice(begin, row - begin).columns, *made], names=[f.name for f in schema])
                    begin, size, found, texts = row, 0, [], []

    return asked.mapInArrow(run, schema)


def read_json_objects(spark: SparkSession, asked: DataFrame, schema: T.StructType, path: str = "path", folder: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, path, *fields, error) for every row of ``asked``: the JSON object at its path.

    Each row's task opens the object by its path (``read_texts``); the text is read natively, with the given schema
    and a column for what does not fit it. Missing objects and objects that are no JSON of that shape keep
    their row, with an error."""
    names = [f.name for f in schema]
    full = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    held = read_texts(asked.select(*keep, path), folder, path)
    # an array of one object is that object; an array of none holds no object, one of several no single one
    listed = F.startswith(F.ltrim("_text", F.lit(" \t\r\n")), F.lit("["))
    n = F.when(listed, F.json_array_length("_text"))
    text = F.when(n == 1, F.get_json_object("_text", "$[0]")).when(n.isNull(), F.col("_text"))
    met = held.withColumn("_n", n).withColumn("_object", F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}))
    broken = F.col("_text").isNull() | F.col(f"_object.{_BROKEN}").isNotNull() | F.coalesce(F.col("_n") > 1, F.lit(False))
    error = F.when(~F.col("_found"), F.concat(F.lit(E_MISSING_OBJECT), F.col(path))).when(broken, F.concat(F.lit(E_BROKEN_OBJECT), F.col(path))).when(
        F.col("_object").isNull(), F.concat(F.lit(E_MISSING_OBJECT), F.col(path)))
    return met.select(*keep, path, *[F.when(error.isNull(), F.col(f"_object.{n}")).alias(n) for n in names], error.alias("error"))
