import codecs

from pyspark.sql import functions as F

from castwright.functions import encoding as enc
from castwright.sources import files as FS
from tests.conftest import rows


def test_doc_type(spark):
    df = spark.createDataFrame([(n,) for n in ["report.PDF", "notes.docx", "transcript.txt", "notes.md", ".txt", "a.b.TXT", "noext"]], "name string")
    got = rows(df.select("name", FS.doc_type("name").alias("t"), FS.doc_type_error("name").alias("e")))
    assert [g[1] for g in got] == ["pdf", "docx", "txt", None, None, "txt", None]
    assert got[3][2] == "Unsupported document type '.md'. Use: .docx, .pdf, .txt"
    assert got[4][2] == "Unsupported document type '.txt'. Use: .docx, .pdf, .txt"


def test_strict_base64(spark):
    df = spark.createDataFrame([(s,) for s in ["aGVsbG8=", "aGVsbG8", "aGVs bG8=", "aGVsbG8=\n", "not valid base64", ""]], "s string")
    assert [r[0] for r in rows(df.select(enc.strict_unbase64("s").isNotNull()))] == [True, False, False, False, False, True]


def test_text_decode_fallbacks(spark):
    samples = [
        "hello world".encode("utf-8"),
        codecs.BOM_UTF8 + " café ".encode("utf-8"),
        codecs.BOM_UTF16_LE + "größe".encode("utf-16-le"),
        "abc\xe9".encode("latin-1"),  # odd length, not UTF-8 -> latin-1
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(samples)], "i long, b binary")
    got = rows(df.orderBy("i").select(enc.decode_text_bytes("b").alias("d")).select("d.text", "d.encoding"))
    expect = []
    for b in samples:
        for e in ("utf-8-sig", "utf-16", "latin-1"):
            try:
                expect.append((b.decode(e).strip(), e))
                break
            except UnicodeDecodeError:
                continue
    assert got == expect


def test_docx_roundtrip_and_page_assembly(spark):
    data = FS.build_docx(["Intro", "", "  Conclusion  "])
    assert FS.docx_text(data) == "Intro\n\nConclusion"
    pages = spark.createDataFrame([("d", 2, "Second page"), ("d", 0, "First page"), ("d", 1, "  ")],
                                  "doc_id string, page_no int, text string")
    assert rows(FS.assemble_pages(pages)) == [("d", "First page\n\nSecond page")]


def test_document_dispatch(spark):
    files = spark.createDataFrame([
        (1, "notes.txt", b"hello world"), (2, "e.txt", b""), (3, "notes.md", b"x"),
        (4, "blank.txt", b"   "), (5, "d.docx", FS.build_docx(["A", "B"])), (6, "broken.docx", b"zz"),
        (7, "p.pdf", b"%PDF"),
    ], "file_id long, name string, content binary")
    out = {r["file_id"]: r for r in FS.extract_documents(files).collect()}
    assert (out[1]["text"], out[1]["doc_type"]) == ("hello world", "txt")
    assert out[2]["error"] == FS.E_EMPTY_FILE
    assert out[3]["error"].startswith("Unsupported document type '.md'")
    assert out[4]["error"] == "No readable text found in uploaded TXT document."
    assert out[5]["text"] == "A\n\nB"
    assert out[6]["error"].startswith("Failed to parse DOCX document")
    assert out[7]["error"] == FS.E_PDF_UNAVAILABLE


def test_cli_sources_and_requested_files(spark, tmp_path):
    import base64

    (tmp_path / "brief.txt").write_text("hello from file")
    (tmp_path / "empty.txt").write_bytes(b"")
    req = spark.createDataFrame([
        (1, None, str(tmp_path / "brief.txt")), (2, "https://x", str(tmp_path / "brief.txt")),
        (3, "", ""), (4, None, str(tmp_path / "nope.txt")), (5, None, str(tmp_path / "empty.txt")),
    ], "request_id long, source string, source_file string")
    errs = dict(rows(req.select("request_id", FS.cli_source_error("source", "source_file"))))
    assert errs == {1: None, 2: FS.E_CLI_EXACTLY_ONE, 3: FS.E_CLI_EXACTLY_ONE, 4: None, 5: None}
    out = {r["request_id"]: r for r in FS.read_requested_files(req).collect()}
    assert (out[1]["source_file_name"], out[1]["source_file_base64"]) == (
        "brief.txt", base64.b64encode(b"hello from file").decode())
    assert out[4]["error"] == f"Source file was not found: {tmp_path / 'nope.txt'}"
    assert out[5]["error"] == f"Source file is empty: {tmp_path / 'empty.txt'}"


def test_strip_covers_nbsp_and_separators(spark):
    df = spark.createDataFrame([(" \x1c a b 　",)], "s string")
    from castwright.functions.text import py_strip
    assert df.select(py_strip("s")).first()[0] == " \x1c a b 　".strip() == "a b"
