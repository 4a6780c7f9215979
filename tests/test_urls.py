from pyspark.sql import functions as F

from castwright.functions import urls as U
from tests.conftest import rows


def _eval(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return rows(df.select("url", U.is_video_url("url").alias("v"), U.video_id("url").alias("id"),
                          U.video_id_error("url").alias("e"), U.scheme_ok("url").alias("s")))


def test_hosts(spark):
    got = {u: v for u, v, *_ in _eval(spark, ["https://www.youtube.com/watch?v=abc123", "https://youtu.be/abc123",
                                              "https://example.com/video", "https://User@WWW.YOUTUBE.COM:443/x"])}
    assert got == {"https://www.youtube.com/watch?v=abc123": True, "https://youtu.be/abc123": True,
                   "https://example.com/video": False, "https://User@WWW.YOUTUBE.COM:443/x": True}


def test_video_id_forms(spark):
    vid = "abc123XYZ00"
    urls = [f"https://www.youtube.com/watch?v={vid}", f"https://youtu.be/{vid}",
            f"https://www.youtube.com/shorts/{vid}", f"https://www.youtube.com/embed/{vid}",
            f"https://m.youtube.com/watch?feature=x&v=&v={vid}&v=other", f"https://youtube.com/live/{vid}/x"]
    assert [r[2] for r in _eval(spark, urls)] == [vid] * len(urls)


def test_video_id_errors(spark):
    got = _eval(spark, ["https://www.youtube.com/watch", "https://example.com/watch?v=x", "https://youtu.be/"])
    assert [r[3] for r in got] == [U.NO_VIDEO_ID_ERROR, U.NOT_VIDEO_ERROR, U.NO_VIDEO_ID_ERROR]


def test_decoding_and_scheme(spark):
    got = _eval(spark, ["https://www.youtube.com/watch?v=a%2Db+c", "ftp://example.com/post", "HTTP://x"])
    assert got[0][2] == "a-b c"
    assert [r[4] for r in got] == [True, False, False]
