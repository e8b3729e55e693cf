"""Literal edge cases of the scalar expressions."""

import random
from urllib.parse import quote, quote_plus

from pyspark.sql import functions as F

from shelfwright.functions import fields, naming, urls


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expression.alias("x"))
    return row.first()[0]


def test_image_url_trims_after_the_choice(spark):
    assert one(spark, fields.image_url(), original_image_url="", image_url=" u ") == "u"
    assert one(spark, fields.image_url(), original_image_url=" ", image_url="u") == ""


def test_lazada_image_url(spark):
    cases = {
        "//h/a.jpg_200x200q80.jpg": "https://h/a.jpg",
        "/x/a.png": "https://www.lazada.vn/x/a.png",
        "https://h/A.JPG_2x2q1.JPG": "https://h/A.JPG_2x2q1.JPG",
        "https://h/a.webp_80x80q80.jpg": "https://h/a.webp",
        "": "",
    }
    for given, wanted in cases.items():
        assert one(spark, urls.lazada_image_url("u"), u=given) == wanted


def test_asos_image_url(spark):
    cases = {"h/a": "https://h/a.jpg", "//h/a": "https://h/a.jpg", "http://h/a.jpg": "http://h/a.jpg", "": ""}
    for given, wanted in cases.items():
        assert one(spark, urls.asos_image_url("u"), u=given) == wanted


def test_card_image_uses_last_srcset_candidate(spark):
    got = one(spark, urls.card_image_url(F.lit(""), F.lit(""), F.lit(None), F.col("s")), s="a 1x, b 2x, ")
    assert got == "b"


def test_output_filename(spark):
    def name(source, filename, row_id, at):
        return one(spark, naming.output_filename(F.lit(at), 10000), source=source, filename=filename, id=row_id)

    assert name("asos", "12.jpg", "000007", 0) == "asos_000007.jpg"
    assert name("asos", "x.jpg", "7", 0) == "x.jpg"
    assert name(" ASOS ", "", " 7 ", 3) == "asos_7.jpg"
    assert name("tiki", "", "7", 3) == "10003.jpg"
    assert name("asos", "", "", 3) == "10003.jpg"


def test_public_id(spark):
    assert one(spark, naming.public_id("c", "f"), c="vay", f="7_jpg.rf.ab.jpg") == "vay/7_jpg.rf.ab"
    assert one(spark, naming.public_id("c", "f"), c="", f="a.jpg") == "unknown/a"
    assert one(spark, naming.public_id("c", "f", "/p/"), c="/vay/", f="dir/a") == "p/vay/a"


def test_padded_id_never_truncates(spark):
    assert one(spark, fields.padded_id(F.col("n")), n=1) == "000001"
    assert one(spark, fields.padded_id(F.col("n")), n=1234567) == "1234567"


def test_parse_id(spark):
    for given, wanted in {" 0012 ": 12, "12.5": 0, "x": 0, "": 0, "-3": -3, "9" * 30: 0}.items():
        assert one(spark, fields.parse_id("v"), v=given) == wanted


def test_upload_errors(spark):
    def verdict(message, url, error="Timeout"):
        return tuple(one(spark, naming.upload_error(F.lit(message), F.lit(error), F.col("u")), u=url))[:2]

    assert verdict("Error in loading u - 403 Forbidden", "https://x/y") == ("remote_image_url", "http_403_forbidden")
    assert verdict("Error in loading u", "https://IMAGES.asos-media.com/y") == ("asos_image_url", "remote_load_failed")
    assert verdict("forbidden", "https://images.asos-media.com/y") == ("asos_image_url", "http_403_forbidden")
    assert verdict("boom", "https://images.asos-media.com/y", "OSError") == ("asos_image_url", "OSError")
    assert verdict("timeout", "https://x/y") == ("cloudinary", "Timeout")


def test_encodings_match_the_url_standard_library(spark):
    words = ["quần jean", "a/b~c*d+e&f=g", "100% cotton", "áo-thun_x.y", "日本 語"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", urls.percent_encoded("w").alias("p"), urls.form_encoded("w").alias("f"), urls.keyword_slug("w").alias("s")
    ).collect()
    for r in rows:
        assert r.p == quote(r.w)
        assert r.f == quote_plus(r.w)
        assert r.s == quote(r.w.strip().lower().replace(" ", "-"))


def test_two_decimals_round_the_exact_value_half_to_even(spark):
    rng = random.Random(5)
    values = [0.0, 0.125, 0.375, 2.675, 1.005, 5625.625, 40.0, 39.995, 99.995, 0.005, 0.015, 1e9 + 0.125, -0.125, -2.5]
    values += [rng.random() * 10 ** rng.randrange(0, 7) for _ in range(500)]
    values += [rng.randrange(10**8) / 1000 for _ in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fields.two_decimals("v").alias("s"))
    for r in rows.collect():
        assert r.s == f"{r.v:.2f}", r.v


def test_keyword_list(spark):
    none = F.lit(None).cast("array<string>")

    def words(configured, explicit=None):
        return one(spark, fields.keyword_list(F.col("c"), configured, explicit), c="ao_thun")

    assert words(none) == ["ao_thun"]
    assert words(F.array(F.lit(" "))) == ["ao thun"]
    assert words(F.array(F.lit(" a "), F.lit(""))) == ["a"]
    assert words(none, F.array(F.lit(" b "))) == ["b"]
    assert words(none, F.array(F.lit(" "))) == []
