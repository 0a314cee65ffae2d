"""Small column helpers that fix the details (Unicode whitespace, stable ids, null guards) in one place."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace: ASCII blanks and controls, then the Unicode spaces and separators.
_ASCII_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0]))
_WIDE_SPACE = "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WHITESPACE = _ASCII_SPACE + _WIDE_SPACE


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, line breaks included."""
    return F.btrim(c, F.lit(WHITESPACE))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, evaluated once: a lambda over a one-element array. Without the binding every use would repeat the
    expression behind `value`, also below a pushed-down filter."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def truthy(c: Column) -> Column:
    """Null-safe 'has text'."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def sha256(c: Column) -> Column:
    """Lower-case hex SHA-256 of a string (as UTF-8) or binary column."""
    return F.sha2(c, 256)


def stable_id(*parts: Column) -> Column:
    """A UUID-shaped id that depends on its inputs only, so a retried task writes the same row."""
    digest = sha256(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return hex_to_uuid(F.substring(digest, 1, 32))


def hex_to_uuid(hex32: Column) -> Column:
    return F.regexp_replace(hex32, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def trace_uuid(traceparent: Column) -> Column:
    """The trace id inside `00-<32 hex>-<16 hex>-01`, as UUID text; null when the header has another shape."""
    segment = F.split(traceparent, "-").getItem(1)
    return F.when(F.size(F.split(traceparent, "-")) >= 2, F.when(F.length(segment) == 32, hex_to_uuid(segment)))


def lookup(mapping: Mapping[str, str], key: Column, default: str | None = None) -> Column:
    """Constant dictionary lookup."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.element_at(table, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def key_width_64(c: Column) -> Column:
    """Idempotency keys are stored 64 wide: shorter ones are padded with zeros, of longer ones the SHA-256 is stored, so that keys
    with one start stay apart."""
    return F.when(F.length(c) > 64, F.sha2(c, 256)).otherwise(F.rpad(c, 64, "0"))


def html_escape(c: Column) -> Column:
    # Escapes in the order they must be applied.
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def storage_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def split_storage_uri(uri: Column) -> Column:
    pattern = r"^s3://([^/]+)/(.+)$"
    return F.struct(
        blank_to_null(F.regexp_extract(uri, pattern, 1)).alias("bucket"),
        blank_to_null(F.regexp_extract(uri, pattern, 2)).alias("key"),
    )


def dated_key(prefix: str, ts: Column, idempotency_key: Column, filename: Column) -> Column:
    """`<prefix>/YYYY/MM/DD/<first 8 of key>/<filename>`"""
    return F.concat_ws(
        "/", F.lit(prefix), F.date_format(ts, "yyyy/MM/dd"), F.substring(idempotency_key, 1, 8), filename
    )
