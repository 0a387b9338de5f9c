"""JSON objects as text, so that what no job reads passes through as it was written.

An object is built and joined as text. Only where a member must go is it read, as
variants, which keep every value but may write a number in another way (1.50 as 1.5).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def is_object(text: Column) -> Column:
    """The text of an object, given that it is valid JSON."""
    return F.ltrim(text).startswith("{")


def member(name: str, text: Column) -> Column:
    """``"name":text``, or null without a text."""
    return F.concat(F.lit(f'"{name}":'), text)


def array(texts: Column | str) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def members(text: Column) -> Column:
    """An object's text without its braces; null when it is empty."""
    return F.nullif(F.regexp_replace(text, r"^\s*\{\s*|\s*\}\s*$", ""), F.lit(""))


def built(*parts: Column) -> Column:
    """An object of members; null parts are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def extended(head: Column, text: Column) -> Column:
    """The object with the members ``head`` (not empty) before its own."""
    rest = F.regexp_replace(F.regexp_replace(text, r"^\s*\{\s*\}\s*$", "}"), r"^\s*\{\s*", ",")
    return F.concat(F.lit("{"), head, rest)


def is_flat(text: Column) -> Column:
    """No brace or bracket but the outer pair; in such an object a quoted name before a colon
    is a member's name and nothing else."""
    return ~text.rlike(r"^\s*\{.*[{\[]")


def without(text: Column, *names: str) -> Column:
    """The object less the named members; untouched when it has none of them.

    A text without any of the names in quotes, nor an escape that could spell one, is not read.
    """
    values = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    rest = F.to_json(F.map_filter(values, lambda k, _: ~k.isin(*names)))
    found = F.arrays_overlap(F.json_object_keys(text), F.array(*[F.lit(n) for n in names]))
    return F.when(_may_name(text, *names) & found, rest).otherwise(text)


def _may_name(text: Column, *names: str) -> Column:
    return text.rlike('"(?:' + "|".join(map(re.escape, names)) + r')"\s*:|\\u')


def others(text: Column, *names: str) -> Column:
    """Members of an object beside the named ones, without braces; null when there are none."""
    found = F.array_except(F.json_object_keys(text), F.array(*[F.lit(n) for n in names]))
    return F.when(F.size(found) > 0, members(without(text, *names)))
