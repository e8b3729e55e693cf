"""URL expressions of the three marketplaces."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwright.functions.fields import col, filled, none_if_blank, stripped

# Addresses and query parts that must match the marketplaces'.
LAZADA_DOMAIN = "https://www.lazada.vn"
ASOS_PRODUCT_PREFIX = "https://www.asos.com/"
ASOS_SEARCH = "https://www.asos.com/api/product/search/v2/"
ASOS_IMAGE_HOST = "images.asos-media.com"
ASOS_PAGE_SIZE = 72
TIKI_PRODUCT_PREFIX = "https://tiki.vn/"
TIKI_SEARCH = "https://tiki.vn/api/v2/products"
TIKI_CACHE_PATH = "salt.tikicdn.com/cache/280x280/"
TIKI_HOST_PATH = "salt.tikicdn.com/"
TIKI_PAGE_SIZE = 40
RESIZE_SUFFIX = r"(\.(?:jpg|jpeg|png|webp))_\d+x\d+q\d+\.(?:jpg|jpeg|png|webp)$"


def absolute_url(c: Column | str, domain: str = LAZADA_DOMAIN) -> Column:
    url = filled(c)
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/"), F.concat(F.lit(domain), url))
        .otherwise(url)
    )


def lazada_image_url(c: Column | str) -> Column:
    """Absolute URL without the resize suffix the marketplace appends."""
    return F.regexp_replace(absolute_url(c), RESIZE_SUFFIX, "$1")


def asos_image_url(c: Column | str) -> Column:
    url = filled(c)
    scheme = (
        F.when(url.startswith("//"), "https:")
        .when(url.startswith("http://") | url.startswith("https://"), "")
        .otherwise("https://")
    )
    suffix = F.when(url.endswith(".jpg"), "").otherwise(".jpg")
    return F.when(url == "", "").otherwise(F.concat(scheme, url, suffix))


def asos_product_url(c: Column | str) -> Column:
    path = filled(c)
    return F.when(path == "", "").otherwise(F.concat(F.lit(ASOS_PRODUCT_PREFIX), path))


def tiki_product_url(c: Column | str) -> Column:
    return F.concat(F.lit(TIKI_PRODUCT_PREFIX), filled(c))


def tiki_image_url(c: Column | str) -> Column:
    return F.replace(filled(c), F.lit(TIKI_CACHE_PATH), F.lit(TIKI_HOST_PATH))


def is_asos_image(c: Column | str) -> Column:
    return F.contains(F.lower(filled(c)), F.lit(ASOS_IMAGE_HOST))


def srcset_choice(c: Column | str) -> Column:
    """URL of the last candidate of a srcset; the raw value if there is none."""
    value = filled(c)
    parts = F.filter(F.transform(F.split(value, ","), stripped), lambda p: p != "")
    last = F.split(F.element_at(parts, -1), r"\s+")[0]
    return F.when(F.size(parts) > 0, last).otherwise(value)


def card_image_choice(src, data_src, lazy, srcset) -> Column:
    """Image address of a listing card by attribute precedence."""
    return F.coalesce(
        none_if_blank(src), none_if_blank(data_src), none_if_blank(lazy),
        F.when(filled(srcset) != "", srcset_choice(srcset)), F.lit(""),
    )


def card_image_url(src, data_src, lazy, srcset) -> Column:
    return lazada_image_url(card_image_choice(src, data_src, lazy, srcset))


def percent_encoded(c: Column | str) -> Column:
    """Percent-encoding of a path: space as %20, `/` and `~` kept, `*` encoded."""
    coded = F.url_encode(col(c))
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        coded = F.replace(coded, F.lit(found), F.lit(wanted))
    return coded


def form_encoded(c: Column | str) -> Column:
    """Form encoding: space as +, `~` kept, `*` encoded."""
    coded = F.url_encode(col(c))
    for found, wanted in (("*", "%2A"), ("%7E", "~")):
        coded = F.replace(coded, F.lit(found), F.lit(wanted))
    return coded


def keyword_slug(keyword: Column | str) -> Column:
    return percent_encoded(F.replace(F.lower(stripped(keyword)), F.lit(" "), F.lit("-")))


def lazada_request(keyword: Column, page: Column) -> Column:
    later = F.when(page > 1, F.concat(F.lit("&page="), page.cast("string"))).otherwise("")
    return F.concat(
        F.lit(f"{LAZADA_DOMAIN}/tag/"), keyword_slug(keyword),
        F.lit("/?spm=a2o4n.homepage.search.d_go&q="), percent_encoded(keyword),
        F.lit("&catalog_redirect_tag=true"), later,
    )


def asos_request(keyword: Column, page: Column) -> Column:
    """Page numbers start at 0; the keyword goes in as it is."""
    offset = (page * F.lit(ASOS_PAGE_SIZE)).cast("string")
    return F.concat(
        F.lit(f"{ASOS_SEARCH}?offset="), offset, F.lit("&q="), keyword,
        F.lit(f"&store=ROW&lang=en-GB&currency=USD&limit={ASOS_PAGE_SIZE}&country=VN"),
    )


def tiki_request(keyword: Column, page: Column, trackity_id: str) -> Column:
    """`trackity_id` names the caller's session; it belongs to no code."""
    return F.concat(
        F.lit(
            f"{TIKI_SEARCH}?limit={TIKI_PAGE_SIZE}&include=advertisement&is_mweb=1&aggregations=2"
            f"&version=&_v=within_promotions&trackity_id={trackity_id}&q="
        ),
        form_encoded(keyword), F.lit("&page="), page.cast("string"),
    )


def request_url(source: Column, keyword: Column, page: Column, trackity_id: str) -> Column:
    return (
        F.when(source == "lazada", lazada_request(keyword, page))
        .when(source == "asos", asos_request(keyword, page))
        .when(source == "tiki", tiki_request(keyword, page, trackity_id))
    )
