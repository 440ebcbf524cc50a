"""Column functions for nested paths and record URLs. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_path(record: Column | str, path: str, type_: str, strict: bool = True) -> Column:
    """Typed value of a nested path of a variant; NULL when the path is missing.

    A value of another type raises, or gives NULL when ``strict`` is off. The type is given at
    the edge because a variant can be neither compared, joined nor grouped.
    """
    read = F.variant_get if strict else F.try_variant_get
    return read(record, path, type_)


def json_text_path(text: Column | str, path: str, type_: str, strict: bool = True) -> Column:
    """Same for JSON kept as text."""
    found = F.get_json_object(text, path)
    return found.cast(type_) if strict else found.try_cast(type_)


def endpoint_from_url(url: Column | str) -> Column:
    """Second-to-last segment of a URL; NULL when there are fewer than two."""
    return F.try_element_at(F.split(url, "/"), F.lit(-2))


def id_from_url(url: Column | str, strict: bool = True) -> Column:
    """Numeric id in the second-to-last segment of a URL.

    Strict: a URL of another form raises. Tolerant: it gives NULL.
    """
    if strict:
        # the segment is cut out without splitting the URL; one without a slash raises as it did
        cut = F.substring_index(F.substring_index(url, "/", -2), "/", 1)
        return F.when(F.contains(url, F.lit("/")), cut).otherwise(F.element_at(F.split(url, "/"), -2)).cast("bigint")
    segment = endpoint_from_url(url)
    # The check keeps text that is no number away from try_cast, which catches an exception for each.
    return F.when(segment.rlike(r"^\s*[+-]?\d+\s*$"), segment.try_cast("bigint"))
