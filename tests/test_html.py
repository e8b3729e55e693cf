"""Attributes, character references, selectors and cards against the standard library's reading of HTML."""

import html
import random

import pytest
from pyspark.sql import functions as F

from shelfwright.functions.html import attribute, attributes, decoded, plain_text, start_tag
from shelfwright.sources import captures


def all_of(spark, values, *shown):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v string").coalesce(1)
    return rows.select("n", *[s.alias(f"s{i}") for i, s in enumerate(shown)]).orderBy("n").collect()


TEXTS = [
    "a&amp;b", "T&#243;m &amp; J&eacute;rry", "&#x1F600;&#X1f600 x", "&#8363;1", "&#0;&#xD800;&#x110000;&#99999999999;&#00000000065;",
    "&#128;&#150;&#129;&#x80;", "&copy 2020 &copyright; &notin; &unknown; & &; &#; &#x; &lt&gt", "?a=1&copy=2&lang=en&amp;b=2",
    "&NotEqualTilde;", "&amp;amp;lt;", "plain", "", "&ampx", "&", "&&amp;&", "line\n&quot;two&quot;", None,
]


def test_references_as_the_standard_library_reads_them(spark):
    rng = random.Random(1)
    names = ["&amp", "&lt;", "&#65", "&#x41;", "&hellip;", "&nbsp;", "&frac12", "&", "#", ";", "x", "=", "é", " ", "&Auml", "&#1114112;", "&zwj;"]
    texts = TEXTS + ["".join(rng.choices(names, k=rng.randint(1, 8))) for _ in range(300)]
    for text, row in zip(texts, all_of(spark, texts, decoded("v")), strict=True):
        assert row.s0 == (None if text is None else html.unescape(text)), text


def test_query_strings_in_attributes_are_left_alone(spark):
    got = all_of(spark, ["?a=1&copy=2&amp;lt=3&reg;", "?x&copy", "&ampx;&amp"], decoded("v", in_attribute=True))
    assert [r.s0 for r in got] == ["?a=1&copy=2&lt=3®", "?x©", "&ampx;&"]


TAG = """ href=/p?a=1&amp;b=2 TITLE='x "q" > y' checked data-x="src='no'" src = "a>b" alt=""junk href="second" stray" last=ok"""


def test_attributes_in_every_form(spark):
    listed = all_of(spark, [TAG], attributes(F.col("v")))[0].s0
    assert [tuple(a) for a in listed] == [
        ("href", "/p?a=1&b=2"), ("title", 'x "q" > y'), ("checked", ""), ("data-x", "src='no'"), ("src", "a>b"), ("alt", ""),
        ("junk", ""), ("href", "second"), ('stray"', ""), ("last", "ok"),
    ]
    assert all_of(spark, [TAG], attribute(F.col("v"), "href"), attribute(F.col("v"), "none"))[0][1:] == ("/p?a=1&b=2", "")


@pytest.mark.parametrize("selector, tag, matches", [
    (".RfADt", '<div class="a RfADt b" x=1>', True), (".RfADt", "<div class=RfADt>", True), (".RfADt", "<DIV CLASS='RfADt'>", True),
    (".RfADt", '<div class="RfADtx">', False), (".RfADt", "<div title=\"class='RfADt'\" class=q>", False),
    (".RfADt", '<div  class = "x\nRfADt">', True), (".RfADt", '<p data-class="RfADt">', False), (".RfADt", '<div class="xRfADt RfADt">', True),
    ("div.RfADt", '<p class="RfADt">', False), ('img[type="product"]', "<img a='>' type=product>", True), ('img[type="product"]', "<img type=products>", False),
    ('img[type="product"]', '<image type="product">', False), ('[data-x="1"].b', '<i class="b" data-x=1>', True), ("a", "<a>", True), ("a", "<abbr>", False),
])
def test_selectors(spark, selector, tag, matches):
    assert all_of(spark, [tag], F.col("v").rlike(start_tag(selector)))[0].s0 is matches


def test_unknown_selectors_are_refused():
    for selector in ("", "div > a", "a:hover"):
        with pytest.raises(ValueError):
            start_tag(selector)


def test_tags_with_very_many_attributes(spark):
    tag = "<div " + " ".join(f'a{i}="{i}"' for i in range(20_000)) + ' class="end">'
    row = all_of(spark, [tag], F.col("v").rlike(start_tag(".end")), F.size(attributes(F.regexp_extract("v", start_tag("div"), 1))))[0]
    assert row.s0 and row.s1 == 20_001


def test_text(spark):
    got = all_of(spark, ["a<b>b</b>c <p title='>'>d</p>e&nbsp;&nbsp;f<!-- <p> -->g<br/>h", "1 < 2 & 3", None], plain_text("v"))
    assert [r.s0 for r in got] == ["abc d e fg h", "1 < 2 & 3", None]


def test_cards_of_every_form(spark):
    page = """
      <!-- <div data-qa-locator="product-item"><img src=no alt=none></div> -->
      <script>"<div data-qa-locator='product-item'><img src=no alt=none>"</script>
      <DIV title="a > b" Data-QA-Locator = 'product-item' hidden>
        <p class='x RfADt'><a href=/p?a=1&amp;b=2 download title="T&#243;m &amp; J&#xE9;rry &quot;&#x1F600;&quot;">x</a></p>
        <i class=ooOxS>&#8363;1&nbsp;000</i><img src=//h/logo.png><img src type=product data-src="//h/a.jpg?x=1&amp;y=2"></DIV>
      <div data-qa-locator=product-item><b class="RfADt"><A HREF='/q' title>sh<em>o</em>wn</A></b><img src="//h/b.jpg" alt=only></div>
      <div data-qa-locator="product-items"><img src=no alt=none></div>
    """
    found = all_of(spark, [page], captures.card_products(F.col("v")))[0].s0
    assert [(p["name"], p["price"], p["source_url"], p["image_url"]) for p in found] == [
        ('Tóm & Jérry "\U0001f600"', "₫1 000", "https://www.lazada.vn/p?a=1&b=2", "https://h/a.jpg?x=1&y=2"),
        ("shown", "", "https://www.lazada.vn/q", "https://h/b.jpg"),
    ]


def test_other_selectors(spark):
    page = "<li class=item><h2><a href='/x'>n</a></h2><b id=p>1</b><img src=//i/x.png></li>"
    own = {"card": "li.item", "link": "h2 a", "price": '[id="p"]', "image": "img"}
    found = all_of(spark, [page], captures.card_products(F.col("v"), own))[0].s0
    assert [(p["name"], p["price"], p["image_url"]) for p in found] == [("n", "1", "https://i/x.png")]
