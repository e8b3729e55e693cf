"""HTML as column expressions: start tags by selector, their attributes, character references, text."""

from __future__ import annotations

import html.entities
import json
import re

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from shelfwright.functions.fields import col

# An attribute: a name, and a value in quotes of either sign, without quotes, or none. A sign that is no quote at
# the start of a value has no meaning of its own, so `>` in quotes does not end a tag and a stray quote does not open one.
_VALUE = r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))"""
_NAME = r"[^\s/>][^\s/>=]*+"
ATTRIBUTE = rf"({_NAME})(?:\s*+=\s*+{_VALUE}?+)?+"


def _uncaptured(pattern: str) -> str:
    return re.sub(r"\((?!\?)", "(?:", pattern)


_ONE = rf"(?:[\s/]++|{_uncaptured(ATTRIBUTE)})"
ATTRIBUTES = f"{_ONE}*+"
ANY_TAG = rf"(?s)<!--.*?-->|</?[a-zA-Z][^\s/>]*+{ATTRIBUTES}>|<[!?/][^>]*+>"
# Elements that do not set their text apart from what stands around them.
INLINE = "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
INLINE_TAG = rf"(?is)<!--.*?-->|</?(?:{'|'.join(INLINE)})(?=[\s/>]){ATTRIBUTES}>"
# Elements whose content is no markup.
RAW_TEXT = r"(?is)<!--.*?-->|<(script|style|template|noscript)(?=[\s/>]).*?</\1\s*+>"


def _value_is(text: str) -> str:
    """A quoted or bare value equal to `text`, whatever stands for a quote."""
    return rf"""(?:"{text}"|'{text}'|{text}(?=[\s>]))"""


def _with(name: str, value: str) -> str:
    """Looks ahead, attribute by attribute, for one of this name and value."""
    wanted = rf"{name}\s*+=\s*+{value}"
    return rf"(?=(?:(?!{wanted}){_ONE})*+{wanted})"


def start_tag(selector: str, named: bool = False) -> str:
    """Pattern of a start tag from `tag`, `.class` and `[name="value"]`, in any mix; its last group holds the attributes.

    With `named` a group before that one holds the name of the tag.

    The name of an attribute matches in any case, its value as it is written.
    """
    parsed = re.fullmatch(r"""([a-zA-Z][\w-]*)?((?:\.[\w-]+|\[[\w-]+="[^"]*"\])*)""", selector)
    if not selector or parsed is None:
        raise ValueError(f"unknown selector: {selector!r}")
    tag, conditions = parsed.group(1), ""
    for cls, name, value in re.findall(r"""\.([\w-]+)|\[([\w-]+)="([^"]*)"\]""", parsed.group(2)):
        if cls:
            # The token may follow others, so the quoted forms look for it one by one.
            quoted = [rf"{q}(?:(?!{cls}[\s{q}])[^\s{q}]*+\s++)*+(?:{cls}[\s{q}])" for q in "\"'"]
            conditions += _with("(?i:class)", rf"(?:{'|'.join(quoted)}|{cls}(?=[\s>]))")
        else:
            conditions += _with(f"(?i:{name})", _value_is(re.escape(value)))
    name = f"(?i:{tag})" if tag else "[a-zA-Z][^\\s/>]*+"
    return rf"<{f'({name})' if named else name}(?=[\s/>]){conditions}({ATTRIBUTES})>"


def element(selector: str) -> tuple[str, int, int]:
    """Pattern of an element up to its end tag, each part of the selector somewhere after the one before.

    The numbers of the groups that hold its attributes and its content.
    """
    *outer, last = selector.split()
    start = "".join(f"{start_tag(part)}(?s:.*?)" for part in outer) + start_tag(last, named=True)
    name = len(outer) + 1
    return rf"{start}((?s:.*?))</(?i:\{name})(?=[\s/>])", name + 1, name + 2


def attributes(tag: Column) -> Column:
    """Attributes of a tag as an array of (name in lower case, decoded value); no value is a blank one."""
    space = F.lit(" \t\n\r\f")
    named = F.transform(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)),
        lambda a: F.struct(F.substring_index(a, "=", 1).alias("name"), a.alias("all")),
    )
    given = F.transform(
        named,
        lambda a: F.struct(
            F.lower(F.btrim(a["name"], space)).alias("name"),
            F.ltrim(F.substr(a["all"], F.length(a["name"]) + 2), space).alias("value"),
        ),
    )
    quoted = lambda v: v.startswith('"') | v.startswith("'")
    bare = lambda v: F.when(quoted(v), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return F.transform(given, lambda a: F.struct(a["name"].alias("name"), decoded(bare(a["value"]), in_attribute=True).alias("value")))


def value_of(listed: Column, name: str) -> Column:
    """Value of the first attribute of a name; blank if there is none."""
    return F.coalesce(F.get(F.filter(listed, lambda a: a["name"] == name), F.lit(0))["value"], F.lit(""))


def attribute(tag: Column, name: str) -> Column:
    return value_of(attributes(tag), name)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once: within a lambda Spark computes a repeated expression each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _references() -> tuple[str, str, str]:
    """Characters by the names of HTML as JSON, frequent names first; a pattern of the names that need no semicolon; and
    what numbers of old single-byte text mean to browsers."""
    known = html.entities.html5
    first = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;"]
    bare = sorted((n for n in known if not n.endswith(";")), key=lambda n: (-len(n), n))
    western = {n: bytes([n]).decode("cp1252", "ignore") for n in range(128, 160)}
    return json.dumps({n: known[n] for n in [*first, *known]}), "|".join(bare), json.dumps({n: c for n, c in western.items() if c})


_KNOWN, _BARE, _WESTERN = _references()
REPLACEMENT = "\ufffd"


def _number(code: Column) -> Column:
    """The character of a numeric reference."""
    none = (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    western = F.try_element_at(F.from_json(F.lit(_WESTERN), "map<string,string>"), code.cast("string"))
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(F.coalesce(none, F.lit(True)), F.lit(REPLACEMENT)).when(code.between(128, 159), F.coalesce(western, plain)).otherwise(plain)


def _code(piece: Column) -> Column:
    """The number of a numeric reference; null where it has more digits than any character needs."""
    digits = lambda pattern: F.regexp_replace(F.regexp_extract(piece, pattern, 1), "^0+", "")
    from_hex = _once(digits("^&#[xX]([0-9a-fA-F]+)"), lambda d: F.when(F.length(d) <= 6, F.conv(F.concat(F.lit("0"), d), 16, 10).cast("int")))
    from_decimal = _once(digits("^&#([0-9]+)"), lambda d: F.when(F.length(d) <= 7, F.concat(F.lit("0"), d).cast("int")))
    return F.when(F.substring(piece, 3, 1).isin("x", "X"), from_hex).otherwise(from_decimal)


def _character(piece: Column, in_attribute: bool) -> Column:
    known = F.from_json(F.lit(_KNOWN), "map<string,string>")
    named = F.try_element_at(known, F.substring(piece, 2, 40))
    if not in_attribute:  # in text a name without semicolon may run into what follows
        rest = _once(
            F.regexp_extract(piece, f"^&({_BARE})", 1),
            lambda start: F.when(start != "", F.concat(F.try_element_at(known, start), F.substring(piece, F.length(start) + 2, F.length(piece)))),
        )
        named = F.coalesce(named, rest)
    return F.when(piece.startswith("&#"), _once(_code(piece), _number)).otherwise(F.coalesce(named, piece))


def decoded(c: Column | str, in_attribute: bool = False) -> Column:
    """Text with its character references resolved, as browsers do: by name, decimal or hexadecimal; unknown ones stay.

    In an attribute a name without semicolon stays if `=` follows, so that query strings are left alone.
    """
    end = "(?:;|(?!=))" if in_attribute else ";?+"
    pieces = rf"(?s)&#[xX][0-9a-fA-F]++;?+|&#[0-9]++;?+|&[a-zA-Z][a-zA-Z0-9]*+{end}|[^&]++|&"
    resolved = lambda text: F.transform(
        F.regexp_extract_all(text, F.lit(pieces), F.lit(0)),
        lambda p: F.when(p.startswith("&") & (F.length(p) > 1), _character(p, in_attribute)).otherwise(p),
    )
    return _once(col(c), lambda text: F.when(F.contains(text, F.lit("&")), F.array_join(resolved(text), "")).otherwise(text))


def plain_text(c: Column | str) -> Column:
    """Text of an HTML fragment: tags out, references resolved, spaces collapsed, those that do not break among them.

    Tags other than those of inline elements part words.
    """
    joined = F.regexp_replace(col(c), INLINE_TAG, "")
    text = decoded(F.regexp_replace(joined, ANY_TAG, " "))
    return F.trim(F.regexp_replace(text, r"[\s\u00a0]+", " "))
