"""Payload decoding as column expressions.

Everything here is a built-in expression (JVM side, whole-stage codegen)
except gzip, for which Spark 4.1 has no column function: that one is an
Arrow-batched pandas UDF and the only Python hop of the pipeline.
"""

from __future__ import annotations

import gzip as _gzip
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING_MAP = "map<string,string>"


# -- binary <-> text ------------------------------------------------------------


def to_base64(binary: Column) -> Column:
    """Standard base64 without the line breaks ``base64()`` may insert."""
    return F.regexp_replace(F.base64(binary), "[\\r\\n]", "")


def from_base64(text: Column) -> Column:
    """base64 text -> bytes; NULL for malformed input."""
    return F.try_to_binary(text, F.lit("base64"))


def utf8_text(binary: Column) -> Column:
    """bytes -> text; NULL when the bytes are not valid UTF-8."""
    return F.try_validate_utf8(binary.cast("string"))


@F.pandas_udf(T.BinaryType())
def gunzip(blobs: pd.Series) -> pd.Series:
    """gzip bytes (all members) -> bytes; NULL for missing, cut off or corrupt input
    and for bytes after the last member (Arrow batches)."""

    def one(b):
        if b is None:
            return None
        try:
            rest, out = bytes(b), []
            while True:  # a gzip stream may have several members
                member = zlib.decompressobj(16 + zlib.MAX_WBITS)
                out.append(member.decompress(rest))
                rest = member.unused_data
                if not member.eof:
                    return None
                if not rest:
                    return b"".join(out)
        except (zlib.error, TypeError, ValueError):
            return None

    return blobs.map(one)


@F.pandas_udf(T.BinaryType())
def gzip_bytes(blobs: pd.Series) -> pd.Series:
    """bytes -> gzip bytes with a fixed header time (deterministic output)."""
    return blobs.map(lambda b: None if b is None else _gzip.compress(bytes(b), mtime=0))


# -- JSON objects -------------------------------------------------------------


def last_wins(m: Column) -> Column:
    """Collapse duplicate keys of a parsed map, keeping the last value.

    ``from_json`` keeps every duplicate and lookups return the first one;
    a JSON object read into a hash map keeps the last.  The fast path (no
    duplicates) costs one ``array_distinct`` over the keys.
    """
    entries = F.map_entries(m)
    kept = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]),
    )
    return F.when(F.size(F.array_distinct(F.map_keys(m))) == F.size(m), m).otherwise(F.map_from_entries(kept))


def parse_object(text: Column) -> Column:
    """JSON object text -> ``map<string,string>``.

    NULL for malformed JSON and for JSON that is not an object.  Nested
    values stay JSON text; trailing text after the object is ignored.
    """
    return last_wins(json_map(text))


def json_map(text: Column) -> Column:
    """``parse_object`` before duplicate keys are collapsed."""
    return F.from_json(text, STRING_MAP)


def parse_error(text: Column, parsed: Column) -> Column:
    """Why ``parse_object`` gave NULL: ``not_object`` or ``bad_json``."""
    return (
        F.when(parsed.isNotNull(), F.lit(None).cast("string"))
        .when(F.try_parse_json(text).isNotNull(), F.lit("not_object"))
        .otherwise(F.lit("bad_json"))
    )


def empty_string_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def merge_attributes(payload: Column, attributes: Column) -> Column:
    """payload ∪ attributes, the attribute value winning on a shared key.

    NULL attributes count as an empty map.  (A plain ``map_concat`` fails on
    shared keys, hence the filter first.)
    """
    attrs = F.coalesce(attributes, empty_string_map())
    return F.map_concat(F.map_filter(payload, lambda k, v: ~F.map_contains_key(attrs, k)), attrs)


def merged_json(text: Column, payload: Column, attributes: Column) -> Column:
    """Merged object written back as JSON text, keeping JSON types.

    Payload values keep their JSON type and nesting (through ``variant``);
    attribute values are strings.  An object with duplicate keys cannot be a
    variant, so it falls back to the last-wins string map.
    """
    attrs = F.coalesce(attributes, empty_string_map())
    typed = F.try_parse_json(text)
    as_variant_map = F.when(
        F.schema_of_variant(typed).startswith("OBJECT"), typed.try_cast("map<string,variant>")
    )
    from_strings = F.transform_values(payload, lambda k, v: v.cast("variant"))
    body = F.coalesce(as_variant_map, from_strings)
    merged = F.map_concat(
        F.map_filter(body, lambda k, v: ~F.map_contains_key(attrs, k)),
        F.transform_values(attrs, lambda k, v: v.cast("variant")),
    )
    return F.when(payload.isNotNull(), F.to_json(merged))
