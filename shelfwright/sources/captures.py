"""Captured result pages: JSON of two marketplaces and HTML of the third.

Each `*_pages` function adds `status` (ok, empty, failed) and `products`, an array of
one struct shape, so everything after it is the same for all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.fields import filled, first_present, present, stripped
from shelfwright.functions.html import RAW_TEXT, attribute, attributes, element, plain_text, start_tag, value_of
from shelfwright.functions.urls import (
    absolute_url, asos_image_url, asos_product_url, card_image_choice, lazada_image_url,
    tiki_image_url, tiki_product_url,
)
from shelfwright.schemas import ASOS_PAYLOAD, TIKI_PAYLOAD

# 1-based number of an additional image, in order of preference; the
# primary image has number 0 and comes last.
IMAGE_PREFERENCE = [5, 3, 4]
BEST_IMAGE_PREFERENCE = [5, 3]
IMAGES_PER_PRODUCT = 2

# Selectors of a listing page; a card ends where the next one starts.
LAZADA_SELECTORS = {
    "card": 'div[data-qa-locator="product-item"]', "link": ".RfADt a", "price": ".ooOxS", "image": 'img[type="product"]',
}
# Image attributes of a card, in order of preference.
IMAGE_ATTRIBUTES = ["src", "data-src", "data-ks-lazyload", "srcset"]
# Fixed value: the scripts that hold listed products.
JSON_LD = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def product_images(additional: Column, primary: Column) -> Column:
    """Up to two different images of a product as (image_index, url), best first."""
    numbered = [
        F.struct(F.lit(n).alias("image_index"), asos_image_url(F.get(additional, F.lit(n - 1))).alias("url"))
        for n in IMAGE_PREFERENCE
    ]
    numbered.append(F.struct(F.lit(0).alias("image_index"), asos_image_url(primary).alias("url")))
    usable = F.filter(F.array(*numbered), lambda i: i["url"] != "")
    urls = F.transform(usable, lambda i: i["url"])
    first_uses = F.filter(usable, lambda i, at: F.array_position(urls, i["url"]) == at + 1)
    return F.slice(first_uses, 1, IMAGES_PER_PRODUCT)


def best_image(additional: Column, primary: Column) -> Column:
    """The single preferred image, taken as `https://` + path + `.jpg`."""
    listed = [F.get(additional, F.lit(n - 1)) for n in BEST_IMAGE_PREFERENCE]
    path = F.coalesce(*listed, F.nullif(primary, F.lit("")))
    return F.coalesce(F.concat(F.lit("https://"), path, F.lit(".jpg")), F.lit(""))


def _product(name, price, brand, source_url, original, image, index) -> Column:
    return F.struct(
        filled(name).alias("name"), filled(price).alias("price"), filled(brand).alias("brand"),
        source_url.alias("source_url"), original.alias("original_image_url"),
        image.alias("image_url"), index.alias("image_index"),
    )


def _is_object(payload: str) -> Column:
    """Valid JSON whose outermost value is an object; anything else is a failed page."""
    return F.schema_of_variant(F.try_parse_json(payload)).startswith("OBJECT")


def _with_status(df: DataFrame, readable: Column, products: Column) -> DataFrame:
    """Failed if unreadable; empty if it lists nothing."""
    listed = F.coalesce(F.size("_items"), F.lit(0))
    status = F.when(~F.coalesce(readable, F.lit(False)), "failed").when(listed <= 0, "empty").otherwise("ok")
    return (
        df.withColumn("status", status)
        .withColumn("products", F.when(F.col("status") == "ok", products))
        .drop("_items", "payload")
    )


def asos_pages(captures: DataFrame) -> DataFrame:
    """One product per image: a product yields up to two."""
    parsed = captures.withColumn("_items", F.from_json("payload", ASOS_PAYLOAD)["products"])

    def images(p: Column) -> Column:
        return F.transform(
            product_images(p["additionalImageUrls"], p["imageUrl"]),
            lambda i: _product(
                p["name"], p["price"]["current"]["value"], p["brandName"],
                asos_product_url(p["url"]), i["url"], i["url"], i["image_index"],
            ),
        )

    readable = _is_object("payload")
    # The position of a product within its page leaves room for its two images.
    products = F.flatten(F.transform("_items", images))
    return _with_status(parsed, readable, products)


def tiki_pages(captures: DataFrame) -> DataFrame:
    """A page whose `data` is not a list counts as failed."""
    parsed = captures.withColumn("_items", F.from_json("payload", TIKI_PAYLOAD)["data"])
    known = F.array_contains(F.json_object_keys("payload"), "data")
    a_list = F.get_json_object("payload", "$.data").startswith("[")
    readable = _is_object("payload") & (~F.coalesce(known, F.lit(False)) | F.coalesce(a_list, F.lit(False)))
    products = F.transform(
        "_items",
        lambda p: _product(
            p["name"], p["price"], p["brand_name"], tiki_product_url(p["url_path"]),
            filled(p["thumbnail_url"]), tiki_image_url(p["thumbnail_url"]), F.lit(0),
        ),
    )
    return _with_status(parsed, readable, products)


def _usable(products: Column) -> Column:
    return F.filter(products, lambda p: (p["name"] != "") & (p["image_url"] != ""))


def card_products(html: Column, selectors: dict[str, str] = LAZADA_SELECTORS) -> Column:
    """Products from the cards of a page; cards without name or image are dropped.

    Attributes are read as browsers do: quoted with either sign, unquoted or without a value, references resolved.
    A card without an image of the selector uses its first image. Scripts, styles and comments hold no cards.

    Each step is a transform of its own, so that a value used several times in the next
    step is computed once.
    """
    markup = F.regexp_replace(html, RAW_TEXT, " ")
    blocks = F.filter(F.split(markup, start_tag(selectors["card"])), lambda _, at: at > 0)
    link, own, shown = element(selectors["link"])
    price, _, amount = element(selectors["price"])
    parts = F.transform(
        blocks,
        lambda b: F.struct(
            F.regexp_extract(b, link, own).alias("link"), plain_text(F.regexp_extract(b, link, shown)).alias("text"),
            plain_text(F.regexp_extract(b, price, amount)).alias("price"),
            F.regexp_extract(b, start_tag(selectors["image"]), 1).alias("img"),
            F.regexp_extract(b, start_tag("img"), 1).alias("any_img"),
        ),
    )
    read = F.transform(
        parts,
        lambda p: F.struct(
            p["text"].alias("text"), p["price"].alias("price"), attributes(p["link"]).alias("link"),
            attributes(F.when(p["img"] != "", p["img"]).otherwise(p["any_img"])).alias("img"),
        ),
    )
    fields = F.transform(
        read,
        lambda p: F.struct(
            stripped(value_of(p["link"], "title")).alias("title"),
            p["text"].alias("text"), p["price"].alias("price"),
            value_of(p["link"], "href").alias("href"),
            stripped(value_of(p["img"], "alt")).alias("alt"),
            *[value_of(p["img"], a).alias(a.replace("-", "_")) for a in IMAGE_ATTRIBUTES],
        ),
    )
    chosen = F.transform(
        fields,
        lambda f: F.struct(
            first_present(f["title"], f["text"], f["alt"]).alias("name"),
            f["price"].alias("price"), absolute_url(f["href"]).alias("url"),
            card_image_choice(*[f[a.replace("-", "_")] for a in IMAGE_ATTRIBUTES]).alias("image"),
        ),
    )
    located = F.transform(
        chosen,
        lambda c: F.struct(c["name"].alias("name"), c["price"].alias("price"), c["url"].alias("url"),
                           lazada_image_url(c["image"]).alias("image")),
    )
    return _usable(
        F.transform(
            located,
            lambda p: _product(p["name"], p["price"], F.lit("Lazada"), p["url"], p["image"], p["image"], F.lit(0)),
        )
    )


def json_ld_products(html: Column) -> Column:
    """Products from the ItemList scripts of a page; unreadable parts are passed over."""
    scripts = F.transform(F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1)), lambda s: F.try_parse_json(s))
    lists = F.filter(scripts, lambda v: F.try_variant_get(v, '$["@type"]', "string") == "ItemList")
    elements = F.flatten(
        F.transform(
            lists,
            lambda v: F.coalesce(
                F.try_variant_get(v, "$.itemListElement", "array<variant>"), F.array().cast("array<variant>")
            ),
        )
    )

    def text(element: Column, field: str) -> Column:
        return filled(F.try_variant_get(element, f"$.item.{field}", "string")).alias(field)

    fields = F.transform(elements, lambda e: F.struct(text(e, "name"), text(e, "image"), text(e, "url")))
    located = F.transform(
        fields,
        lambda f: F.struct(
            stripped(f["name"]).alias("name"), lazada_image_url(f["image"]).alias("image"),
            absolute_url(f["url"]).alias("url"),
        ),
    )
    return _usable(
        F.transform(
            located,
            lambda p: _product(p["name"], F.lit(""), F.lit("Lazada"), p["url"], p["image"], p["image"], F.lit(0)),
        )
    )


def lazada_pages(captures: DataFrame, selectors: dict[str, str] = LAZADA_SELECTORS) -> DataFrame:
    """Card products of a page, or its JSON-LD products where no card is usable."""
    cards = captures.withColumn("_cards", card_products(F.col("payload"), selectors))
    found = F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(json_ld_products(F.col("payload")))
    parsed = cards.withColumn("_items", found).drop("_cards")
    return _with_status(parsed, F.col("payload").isNotNull(), F.col("_items"))


def html_links(pages: DataFrame) -> DataFrame:
    """Links of a page in order: (page_id, pos, href, text)."""
    opening = start_tag("a")
    tags = F.regexp_extract_all("html", F.lit(rf"(?s)({opening}.*?)</[aA]\s*+>"), F.lit(1))
    return (
        pages.select("page_id", F.posexplode(tags).alias("pos", "_tag"))
        .select(
            "page_id", "pos", attribute(F.regexp_extract("_tag", f"^{opening}", 1), "href").alias("href"),
            plain_text(F.regexp_replace("_tag", f"^{opening}", "")).alias("text"),
        )
    )


PAGES = {"asos": asos_pages, "tiki": tiki_pages, "lazada": lazada_pages}
FIRST_PAGE = {"asos": 0, "tiki": 1, "lazada": 1}


def has_name_and_image() -> Column:
    return present("name") & present("image_url")
