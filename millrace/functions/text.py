"""Text as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = "[ \\t\\n\\x0B\\f\\r]"


def first_text(*columns: str | Column) -> Column:
    """The first value that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit("")) for c in columns])


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "(?U)\\s+", " "))


def normalize_company_name(name: Column) -> Column:
    """Lower case with single spaces. (Lower case differs from case folding in a few letters, such as the sharp s.)"""
    return F.lower(collapse(name))


def slugify(name: Column, fallback: str = "company") -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", fallback).otherwise(slug)


def visible_text(html: Column) -> Column:
    """Without scripts, styles and tags; entities stay; spaces collapsed."""
    out = F.regexp_replace(html, "(?is)<script\\b[^>]*>.*?</script>", " ")
    out = F.regexp_replace(out, "(?is)<style\\b[^>]*>.*?</style>", " ")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    return F.trim(F.regexp_replace(out, f"{WS}+", " "))


def normalize_title(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9+#]+", " "))


def whole_term(text: Column, term: str) -> Column:
    """Whether the term stands in the text as a whole token."""
    return text.rlike(f"(^|[^a-z0-9]){term}($|[^a-z0-9])")


def signal(text: Column, term: str) -> Column:
    """Terms of three letters or fewer need word boundaries, longer ones may be part of a word."""
    return text.rlike(f"\\b{term}\\b") if len(term) <= 3 and term.isalpha() else F.contains(text, F.lit(term))


def split_list(text: Column, mark: str = ";") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), mark), lambda x: F.trim(x)), lambda x: x != "")


def distinct_folded(items: Column) -> Column:
    """Without case-insensitive repeats; the first spelling stays, in order."""
    keep = F.aggregate(
        items,
        F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("seen")),
        lambda s, x: F.when(F.array_contains(s["seen"], F.lower(x)), s).otherwise(F.struct(F.array_append(s["out"], x).alias("out"), F.array_append(s["seen"], F.lower(x)).alias("seen"))),
    )
    return keep["out"]


def snippet(text: Column, most: int = 240) -> Column:
    flat = collapse(text)
    return F.when(F.char_length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.left(flat, F.lit(most - 1))), F.lit("…")))


def truthy(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("1", "true", "yes")


def safe_int(text: Column) -> Column:
    """The integer part of a number in text, or null."""
    return text.try_cast("double").try_cast("int")
