"""Row-field expressions: blanks, defaults, ids, categories, keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Every character that counts as white space when a field is trimmed.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """Absent and blank are the same value: ''."""
    return F.coalesce(col(c), F.lit(""))


def present(c: Column | str) -> Column:
    """True for a non-empty value; blanks made of spaces count as present."""
    return filled(c) != ""


def none_if_blank(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def scoped(df: DataFrame, scope: list[str]) -> DataFrame:
    """`df` with its scope columns filled, so that rows without a category share the blank one."""
    lacking = [c for c in scope if c not in df.columns]
    if lacking:
        raise ValueError(f"no column {', '.join(lacking)}: tables of several categories are kept apart by it")
    return df.withColumns({c: filled(F.col(c).cast("string")) for c in scope}) if scope else df


def first_present(*columns: Column | str) -> Column:
    return F.coalesce(*[none_if_blank(c) for c in columns], F.lit(""))


def stripped(c: Column | str) -> Column:
    return F.btrim(filled(c), F.lit(WHITESPACE))


def image_url(original: Column | str = "original_image_url", fallback: Column | str | None = "image_url") -> Column:
    """The row's image URL; trimming happens after the choice."""
    chosen = (original,) if fallback is None else (original, fallback)
    return stripped(first_present(*chosen))


def normal_category(c: Column | str) -> Column:
    return F.lower(stripped(c))


def final_category(default: Column | str | None = None) -> Column:
    extra = [] if default is None else [F.lit(default) if isinstance(default, str) else default]
    return first_present("final_category", "category", *extra)


def parse_id(c: Column | str) -> Column:
    """Whole number in a trimmed field, otherwise 0."""
    text = stripped(c)
    whole = F.when(text.rlike("^[+-]?[0-9]+$"), text)
    return F.coalesce(whole.try_cast("bigint"), F.lit(0).cast("bigint"))


def padded_id(number: Column, width: int = 6) -> Column:
    return F.format_string(f"%0{width}d", number)


def review_key(position: Column) -> Column:
    return first_present("id", "source_url", F.concat(F.lit("row-"), position.cast("string")))


def two_decimals(c: Column | str) -> Column:
    """Two decimals, rounding the exact binary value half to even.

    `format_string` rounds the shortest decimal form half up, which differs for values
    such as 0.125 and 2.675. The rounding error of the product with 100 is recovered by
    splitting the factor into two halves of its digits.
    """
    x = F.abs(col(c))
    product = x * F.lit(100.0)
    spread = x * F.lit(134217729.0)
    high = spread - (spread - x)
    error = (high * F.lit(100.0) - product) + (x - high) * F.lit(100.0)
    whole = F.floor(product)
    part = product - whole
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    cents = whole + up.cast("bigint")
    sign = F.when(col(c) < 0, "-").otherwise("")
    return F.concat(
        sign, ((cents - cents % 100) / 100).cast("bigint").cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def keyword_list(category: Column, configured: Column, explicit: Column | None = None) -> Column:
    """Keywords of a category: explicit ones, else configured ones, else its own name.

    `configured` is null when the category has no entry; an entry without a usable
    keyword falls back to the category with its underscores as spaces.
    """
    def usable(words: Column) -> Column:
        return F.filter(F.transform(words, stripped), lambda w: w != "")

    fallback = (
        F.when(configured.isNull(), F.array(stripped(category)))
        .when(F.size(usable(configured)) > 0, usable(configured))
        .otherwise(F.array(F.replace(category, F.lit("_"), F.lit(" "))))
    )
    if explicit is None:
        return fallback
    return F.when(F.coalesce(F.size(explicit), F.lit(0)) > 0, usable(explicit)).otherwise(fallback)
