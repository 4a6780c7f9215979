import base64

from castwright.functions.urls import SCHEME_ERROR
from castwright.operators import routing as R
from castwright.sources.files import E_FETCH_BAD_B64


def test_fetch_routes_and_errors(spark):
    b64 = base64.b64encode(b" clean file text ").decode()
    jobs = spark.createDataFrame([
        ("a1", "https://site/a", None, None, None),           # article, page present
        ("a2", "https://site/a", None, None, None),           # same page: parsed once, joined twice
        ("a3", "https://site/missing", None, None, None),     # page not in the table
        ("a4", "ftp://site/a", None, None, None),             # scheme guard
        ("v1", "https://youtu.be/x", "  words ", None, None), # transcript given -> youtube
        ("v2", "https://youtu.be/x", None, None, None),       # video without text
        ("t1", None, "plain", None, None),                    # text only
        ("f1", None, None, "notes.txt", b64),                 # uploaded file
        ("f2", None, None, "notes.txt", "bad b64"),           # strict base64 fails
        ("f3", None, None, "notes.md", b64),                  # unsupported type
    ], "job_id string, source_url string, source_text string, source_file_name string, source_file_base64 string")
    pages = spark.createDataFrame([(1, "https://site/a", "<article><p>Hello</p></article>")],
                                  "page_id long, url string, html string")
    out = {r["job_id"]: r for r in R.fetch_sources(jobs, pages=pages).collect()}
    assert (out["a1"]["source_type"], out["a1"]["text"], out["a1"]["article_char_count"]) == ("article", "Hello", 5)
    assert out["a2"]["text"] == "Hello" and out["a1"]["article_s3_key"] == "jobs/a1/source.txt"
    assert out["a3"]["error"] == "Failed to fetch article from https://site/missing: page not found"
    assert out["a4"]["error"] == SCHEME_ERROR
    assert (out["v1"]["source_type"], out["v1"]["text"]) == ("youtube", "  words ")
    assert out["v2"]["error"] == R.E_VIDEO_NO_TEXT
    assert (out["t1"]["source_type"], out["t1"]["text"]) == ("text", "plain")
    assert (out["f1"]["source_type"], out["f1"]["text"]) == ("txt", "clean file text")
    assert out["f2"]["error"] == E_FETCH_BAD_B64
    assert out["f3"]["error"].startswith("Unsupported document type '.md'")
    assert all(out[k]["bucket"] == "podcast-artifacts" for k in out)


def test_route_columns(spark):
    jobs = spark.createDataFrame([
        (None, None, "x.pdf", "aGVsbG8="), ("https://www.youtube.com/watch?v=1", "t", None, None),
        ("https://youtu.be/1", None, None, None), ("https://e.com", None, None, None),
    ], "source_url string, source_text string, source_file_name string, source_file_base64 string")
    got = [(r.t, r.e) for r in jobs.select(R.route_type().alias("t"), R.route_error().alias("e")).collect()]
    assert got == [("pdf", None), ("youtube", None), (None, R.E_VIDEO_NO_TEXT), ("article", None)]
