"""Stage plans: page rules, publishing, import, upkeep, and all stages together."""

import json

import pytest
from pyspark.sql import functions as F

from shelfwright.operators import paging
from shelfwright.plans import everything, final, listing, maintain, publish, review
from shelfwright.schemas import CAPTURES, CLEAN, FINAL, MAPPING, RAW, REVIEWED
from shelfwright.sources import captures


def pages_of(spark, payloads, source, first=1, category="vay"):
    rows = [(category, "k", 0, source, n + first, p, "") for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, CAPTURES)


def table(spark, columns, rows):
    """Rows as dicts; blanks elsewhere; `ord` from the position."""
    data = [tuple(str(r.get(c, "")) for c in columns) + (n,) for n, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns) + ", ord long")


def log(spark, statuses):
    return spark.createDataFrame([("c", n + 1, s) for n, s in enumerate(statuses)], "category string, page int, status string")


def test_page_truncation(spark):
    pages = log(spark, ["ok", "empty", "ok"])
    assert paging.until_empty_page(pages, ["category"]).count() == 1
    pages = log(spark, ["ok", "empty", "empty", "ok", "empty", "failed", "empty", "ok"])
    assert [r.page for r in paging.until_empty_streak(pages, ["category"]).orderBy("page").collect()] == list(range(1, 8))
    assert paging.trailing_empty_pages(pages, ["category"]).first().empty_streak == 0


def test_asos_statuses_and_null_price(spark):
    good = json.dumps({"products": [{"name": "a", "url": "p", "imageUrl": "h/a", "price": None}]})
    pages = captures.asos_pages(pages_of(spark, [good, "{}", '{"products":[]}', "not json", None], "asos")).orderBy("page")
    rows = pages.collect()
    assert [r.status for r in rows] == ["ok", "empty", "empty", "failed", "failed"]
    assert rows[0].products[0].price == "" and rows[0].products[0].image_url == "https://h/a.jpg"


def test_tiki_data_must_be_a_list(spark):
    payloads = ['{"data":[{"name":"a"}]}', '{"data":{}}', '{"data":null}', "{}", '{"data":[]}']
    rows = captures.tiki_pages(pages_of(spark, payloads, "tiki")).orderBy("page").collect()
    assert [r.status for r in rows] == ["ok", "failed", "failed", "empty", "empty"]
    assert rows[0].products[0].source_url == "https://tiki.vn/"


def test_product_images(spark):
    def images(additional, primary="p"):
        df = spark.createDataFrame([(additional, primary)], "a array<string>, p string")
        got = df.select(captures.product_images(F.col("a"), F.col("p"))).first()[0]
        return [(i.image_index, i.url.removeprefix("https://").removesuffix(".jpg")) for i in got]

    assert images(["a", "b", "c"]) == [(3, "c"), (0, "p")]
    assert images(["a", "b", "c", "d", "e"]) == [(5, "e"), (3, "c")]
    assert images(["a", "b", "c", "c"], "c") == [(3, "c")]
    assert images(None, "") == []


CARD = (
    '<div class="x" data-qa-locator="product-item"><div class="RfADt"><a href="{href}" title="{title}">{text}</a></div>'
    '<span class="ooOxS">{price}</span><img alt="{alt}" {img}></div>'
)


def card(href="/p", title="", text="", price="1 &amp; 2", alt="", img='src="//h/a.jpg"'):
    return CARD.format(href=href, title=title, text=text, price=price, alt=alt, img=img)


def test_html_cards(spark):
    html = "<body>" + "".join([
        card(title="T"), card(text=" shown <b>text</b> "), card(alt="alt"), card(),
        card(title="no image", img=""), card(title="lazy", img='data-src="/x.jpg_1x1q1.jpg" srcset="z 1x"'),
    ])
    rows = captures.lazada_pages(pages_of(spark, [html], "lazada")).first().products
    assert [r.name for r in rows] == ["T", "shown text", "alt", "lazy"]
    assert rows[0].price == "1 & 2" and rows[0].source_url == "https://www.lazada.vn/p"
    assert [r.image_url for r in rows][-1] == "https://www.lazada.vn/x.jpg"


def test_json_ld_only_where_no_card_is_usable(spark):
    script = (
        '<script type="application/ld+json">{broken</script><SCRIPT data-x="1" type=\'application/ld+json\'>\n'
        + json.dumps({"@type": "ItemList", "itemListElement": ["text", {"item": "text"}, {"item": {"name": " A ", "image": "//i/a.jpg", "url": "/u"}}, {"item": {"name": "no image"}}]})
        + "\n</script>" + '<script type="application/ld+json">{"@type":"Product","itemListElement":[{"item":{"name":"x","image":"y"}}]}</script>'
    )
    pages = captures.lazada_pages(pages_of(spark, [script, card(title="T") + script, "<p>", None], "lazada")).orderBy("page").collect()
    assert [[(p.name, p.image_url, p.source_url) for p in r.products or []] for r in pages] == [
        [("A", "https://i/a.jpg", "https://www.lazada.vn/u")], [("T", "https://h/a.jpg", "https://www.lazada.vn/p")], [], [],
    ]
    assert [r.status for r in pages] == ["ok", "ok", "empty", "failed"]


def test_listing_arguments(spark):
    df = pages_of(spark, ["{}"], "asos")
    for kw in ({"target": 0}, {"max_pages": 0}, {"skip_pages": -1}):
        with pytest.raises(ValueError):
            listing.extract_listings(df, "asos", **kw)
    with pytest.raises(ValueError, match="unknown source"):
        listing.extract_listings(df, "shop")


def test_listing_continues_ids_and_stops_at_the_target(spark):
    def page(names):
        return json.dumps({"data": [{"name": n, "url_path": n, "thumbnail_url": f"i{n}"} for n in names]})

    df = pages_of(spark, [page("ab"), None, page("acd"), page("ef"), '{"data":[]}', page("z")], "tiki")
    existing = table(spark, RAW, [{"id": "000041", "category": "vay", "source_url": "https://tiki.vn/b"}])
    rows = listing.extract_listings(df, "tiki", existing, target=None).orderBy("ord").collect()
    assert [(r.id, r.name) for r in rows] == [("000042", "a"), ("000043", "c"), ("000044", "d"), ("000045", "e"), ("000046", "f")]
    assert [r.name for r in listing.extract_listings(df, "tiki", target=3).orderBy("ord").collect()] == ["a", "b", "c"]


def test_final_prefers_own_values_and_the_last_mapping(spark):
    clean = table(spark, CLEAN + ["filename", "cloudinary_url", "cloudinary_public_id"], [
        {"filename": "f"}, {"filename": "f", "cloudinary_url": "u0"}, {"filename": ""}, {"filename": "g"},
    ])
    mapping = table(spark, ["category", *MAPPING], [
        {"filename": "f", "secure_url": "u1", "public_id": "p1"}, {"filename": "f", "secure_url": "u2", "public_id": "p2"},
        {"filename": "", "secure_url": "u3", "public_id": "p3"}, {"category": "vay", "filename": "f", "secure_url": "u4", "public_id": "p4"},
    ])
    rows = final.build_final(clean, mapping).orderBy("ord").collect()
    assert [(r.ord, r.cloudinaryUrl, r.cloudinaryPublicId) for r in rows] == [(0, "u2", "p2"), (1, "u0", "p2")]
    assert final.build_final(clean.filter("false"), mapping).count() == 0


def test_second_import_adds_nothing(spark):
    rows = [
        {"cloudinaryPublicId": "p", "sourceUrl": "s"}, {"cloudinaryPublicId": "p"}, {"sourceUrl": "s"},
        {"sourceUrl": "t"}, {"originalImageUrl": "i"}, {},
    ]
    batch = table(spark, FINAL, rows)
    new, counts = final.import_documents(batch, batch.filter("false"))
    assert sorted(r.ord for r in new.collect()) == [0, 3, 4]
    assert tuple(counts.select("inserted", "existed", "skipped").first()) == (3, 2, 1)
    again, counts = final.import_documents(batch, new)
    assert again.count() == 0 and tuple(counts.select("inserted", "existed", "skipped").first()) == (0, 5, 1)


def test_publish_ladder_and_results(spark):
    columns = CLEAN + ["cloudinary_url", "cloudinary_public_id", "uploaded_at", "filename"]
    clean = table(spark, columns, [
        {"id": "1", "category": "vay"},
        {"id": "2", "category": "vay", "original_image_url": "i2", "filename": "a.jpg", "cloudinary_url": "u", "cloudinary_public_id": "vay/a", "uploaded_at": "old"},
        {"id": "3", "category": "vay", "original_image_url": "i3", "filename": "b.jpg"},
        {"id": "4", "category": "vay", "original_image_url": "i4", "filename": "c.jpg", "cloudinary_url": "u", "cloudinary_public_id": "other/c"},
        {"id": "5", "category": "vay", "source": "asos", "original_image_url": "https://images.asos-media.com/5"},
        {"id": "6", "original_image_url": "i6"},
    ])
    mapping = table(spark, ["category", *MAPPING], [
        {"category": "vay", "filename": "b.jpg", "secure_url": "mu", "public_id": "mp", "original_image_url": "i3"},
        {"category": "vay", "filename": "c.jpg", "secure_url": "mu", "public_id": "mp"},
        {"category": "quan", "filename": "c.jpg", "secure_url": "other", "public_id": "other", "original_image_url": "i4"},
    ])
    plan = publish.publish_plan(clean, mapping, "NOW").orderBy("ord")
    rows = plan.collect()
    assert [r.action for r in rows] == ["missing_image", "keep_existing", "reuse_mapping", "upload_remote", "upload_local", "upload_remote"]
    assert (rows[3].legacy_mapping_ignored, rows[3].outside_folder) == (True, True)
    assert rows[4].filename == "asos_5.jpg" and rows[5].expected_id == "unknown/10000"
    results = spark.createDataFrame(
        [("vay", 3, "bad", None, True, 1), ("vay", 3, "n3", None, False, 2), ("vay", 4, None, None, True, 1), (None, 5, "n5", "renamed", False, 1), ("vay", 5, "x", "x", False, 1)],
        "category string, ord long, secure_url string, public_id string, failed boolean, attempt int",
    )
    done, new_mapping = publish.apply_upload_results(plan, results, "NOW")
    out = {r.ord: r for r in done.collect()}
    assert (out[1].uploaded_at, out[2].uploaded_at, out[2].cloudinary_url) == ("old", "NOW", "mu")
    assert (out[3].cloudinary_url, out[3].cloudinary_public_id) == ("n3", "vay/c")
    assert (out[4].cloudinary_url, out[4].filename) == ("", "")
    assert out[5].cloudinary_public_id == "renamed"
    assert sorted(r.ord for r in new_mapping.collect()) == [1, 2, 3, 5]


def test_failed_uploads_are_classified(spark):
    plan = spark.createDataFrame(
        [("vay", 1, "https://x"), ("vay", 2, "https://images.asos-media.com/x")], "category string, ord long, image_url string"
    )
    failures = spark.createDataFrame(
        [("vay", 1, "E", "Error in loading x", False), ("vay", 2, "E", "403", True)],
        "category string, ord long, error_class string, error_message string, first_try_local boolean",
    )
    rows = publish.failed_uploads(plan, failures).orderBy("ord").collect()
    assert [(r.source, r.reason, r.retry_local) for r in rows] == [
        ("remote_image_url", "remote_load_failed", True), ("asos_image_url", "http_403_forbidden", False),
    ]


def test_reviews_keep_their_place(spark):
    validated = table(spark, RAW, [{"id": i, "category": "vay"} for i in ("a", "b", "c", "")])
    reviewed = table(spark, REVIEWED, [
        {"id": "b", "category": "vay", "human_status": "approved", "final_category": "x"},
        {"id": "z", "category": "vay", "human_status": "rejected"}, {"id": "c", "category": "quan", "human_status": "approved"},
    ])
    decisions = spark.createDataFrame(
        [("vay", "a", True, "", "1"), ("vay", "a", False, "", "2"), ("vay", "b", True, "", "1"), ("quan", "b", False, "", "3")],
        "category string, id string, reject boolean, final_category string, reviewed_at string",
    )
    merged, clean = review.apply_reviews(validated, reviewed, decisions, "NOW")
    rows = merged.orderBy("ord").collect()
    assert [(r.id, r.human_status, r.final_category) for r in rows] == [
        ("b", "rejected", "x"), ("z", "rejected", ""), ("c", "approved", ""), ("a", "approved", "vay"),
    ]
    assert sorted((r.category, r.id) for r in clean.collect()) == [("quan", "c"), ("vay", "a")]
    assert sorted(r.id for r in review.pending(validated, merged).collect()) == ["", "c"]
    assert review.page_count(51, 25) == 3 and review.page_count(0, 25) == 1


def test_review_page_shows_all_rows_when_none_is_pending(spark):
    validated = table(spark, RAW, [{"id": "a"}, {"id": "b"}])
    reviewed = table(spark, REVIEWED, [{"id": i, "human_status": "approved"} for i in ("a", "b")])
    assert review.review_page(validated, reviewed, 1, 5).count() == 2


def test_renumber_and_attach(spark):
    products = table(spark, ["name", "original_image_url"], [{"name": n, "original_image_url": f"i{n}"} for n in "abc"])
    mapping = table(spark, MAPPING, [{"filename": f"f{n}", "original_image_url": "own"} for n in range(5)])
    rows, attached = maintain.renumber(products, mapping, start=9)
    got = rows.orderBy("ord").collect()
    assert rows.columns[:2] == ["id", "name"] and [(r.id, r.filename) for r in got] == [("000009", "f0"), ("000010", "f1"), ("000011", "f2")]
    assert [r.original_image_url for r in attached.orderBy("ord").collect()] == ["ia", "ib", "ic", "own", "own"]
    with pytest.raises(ValueError, match="5 != 3"):
        maintain.renumber(products, mapping, strict=True)


def test_all_stages_reach_the_target_only_through_a_review(spark):
    payload = json.dumps({"data": [{"name": "a", "url_path": "p", "thumbnail_url": "i"}]})
    df = pages_of(spark, [payload], "tiki")
    empty = table(spark, CLEAN, [])
    reviewed = table(spark, REVIEWED, [{"id": "1", "category": "vay", "original_image_url": "i", "human_status": "approved"}])
    results = spark.createDataFrame(
        [("vay", 0, "u", "vay/10000", False)], "category string, ord long, secure_url string, public_id string, failed boolean"
    )
    target = table(spark, FINAL, []).drop("ord")

    def run(reviews):
        return everything.run_all(
            df, "tiki", None, empty, reviews, table(spark, ["category", *MAPPING], []), results, target, "NOW", auto_pass=True
        )

    done = run(reviewed)
    assert (done.raw.count(), done.validated.count(), done.inserted.count()) == (1, 1, 1)
    assert done.inserted.first().cloudinaryPublicId == "vay/10000"
    assert run(reviewed.filter("false")).inserted.count() == 0


def test_categories_do_not_mix(spark):
    """Ids, file names and `ord` start anew in every category."""
    payload = json.dumps({"data": [{"name": n, "url_path": n, "thumbnail_url": f"i{n}"} for n in "ab"]})
    df = pages_of(spark, [payload], "tiki").unionByName(pages_of(spark, [payload], "tiki", category="quan"))
    raw = listing.extract_listings(df, "tiki")
    assert sorted((r.category, r.id, r.ord) for r in raw.collect()) == [(c, f"{n:06d}", raw_ord) for c in ("quan", "vay") for n, raw_ord in ((1, 1 << 22), (2, (1 << 22) + 1))]
    decisions = raw.selectExpr("category", "id", "false AS reject", "'' AS final_category", "'1' AS reviewed_at")
    reviewed, clean = review.apply_reviews(raw, table(spark, REVIEWED, []), decisions, "NOW")
    assert reviewed.count() == clean.count() == 4
    plan = publish.publish_plan(clean, table(spark, ["category", *MAPPING], []), "NOW")
    assert sorted(r.expected_id for r in plan.collect()) == ["quan/10000", "quan/10001", "vay/10000", "vay/10001"]
    results = plan.selectExpr("category", "ord", "'https://' || expected_id AS secure_url", "expected_id AS public_id", "false AS failed")
    published, mapping = publish.apply_upload_results(plan, results, "NOW")
    rows = final.build_final(published.drop("cloudinary_url", "cloudinary_public_id").withColumns({"cloudinary_url": F.lit(""), "cloudinary_public_id": F.lit("")}), mapping)
    assert sorted((r.category, r.cloudinaryUrl) for r in rows.collect()) == [
        (c, f"https://{c}/{n}") for c in ("quan", "vay") for n in (10000, 10001)
    ]


def test_pages_captured_again(spark):
    def page(names):
        return json.dumps({"data": [{"name": n, "url_path": n, "thumbnail_url": f"i{n}"} for n in names]})

    rows = [("c", "k", 0, "tiki", 1, page("ab"), "1"), ("c", "k", 0, "tiki", 1, page("ac"), "2"), ("c", "k", 0, "tiki", 1, None, "3"),
            ("c", "k", 0, "tiki", 2, "[]", "1"), ("c", "k", 0, "tiki", 3, page("d"), "1")]
    got = listing.extract_listings(spark.createDataFrame(rows, CAPTURES), "tiki").orderBy("ord").collect()
    assert [r.name for r in got] == ["a", "c", "d"]


def test_payloads_that_are_no_object_are_failed_pages(spark):
    for source, read in (("asos", captures.asos_pages), ("tiki", captures.tiki_pages)):
        pages = read(pages_of(spark, ["[]", "null", '"x"', "5", "{}"], source)).orderBy("page").collect()
        assert [r.status for r in pages] == ["failed"] * 4 + ["empty"]


def test_streaks_count_captured_pages_once(spark):
    pages = spark.createDataFrame([("c", p, s) for p, s in ((1, "ok"), (2, "empty"), (2, "empty"), (3, "empty"), (5, "empty"), (6, "ok"))], "category string, page int, status string")
    assert paging.until_empty_streak(pages, ["category"]).count() == 6
    assert paging.trailing_empty_pages(pages.filter("page < 6"), ["category"]).first().empty_streak == 3


def test_rows_without_category_share_the_blank_one(spark):
    rows = spark.createDataFrame([(None, "p1", 0), (None, "p2", 1), ("a", "p3", 2), ("", "p4", 3)], "category string, public_id string, ord long")
    assert maintain.split_dataset(rows).count() == 4


def test_order_column_has_room(spark):
    df = spark.createDataFrame([(0, 1 << 24, 0)], "k int, p int, q int")
    with pytest.raises(Exception, match="beyond the order column"):
        df.select(listing.page_order(F.col("k"), F.col("p"), F.col("q"))).collect()
