"""Pointers and deterministic identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script at either end, including the no-break space and BOM.
_EDGE = r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE, "")


def filled(c: Column) -> Column:
    """Whether strip() leaves anything; a search that ends at the first such character."""
    return c.rlike(r"[^\s\p{Z}\x{FEFF}]")


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalize_pointer(c: Column) -> Column:
    """Trim, upper-case and wrap in ``@…@``; null for null and blank."""
    t = F.upper(strip(c))
    core = F.regexp_replace(t, r"^[@\s]+|[@\s]+$", "")
    return F.when(core != "", F.concat(F.lit("@"), core, F.lit("@")))


def is_pointer(c: Column) -> Column:
    return c.rlike(r"^@[^@\s]+@$")


def uuid_from_key(key: Column) -> Column:
    """The first 32 hex digits of SHA-1, dashed 8-4-4-4-12."""
    h = F.sha1(key.cast("binary"))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut])


def _joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def deterministic_uuid(*parts: Column) -> Column:
    """U2."""
    return uuid_from_key(_joined(*parts))


def uuid_for_pointer(ptr: Column) -> Column:
    """U4; null for a pointer that names nothing."""
    n = normalize_pointer(ptr)
    return F.when(n.isNotNull(), uuid_from_key(F.concat(F.lit("PTR|"), n)))


def uuid_for_name(record: Column, full: Column) -> Column:
    """U6."""
    return uuid_from_key(_joined(F.lit("NAME"), record, full))


def uuid_for_event(record: Column, tag: Column, date: Column, place: Column) -> Column:
    """U7."""
    return uuid_from_key(_joined(F.lit("EVT"), record, F.upper(tag), date, place))


def uuid_for_occupation(record: Column, payload: Column) -> Column:
    """U8."""
    return uuid_from_key(_joined(F.lit("OCCU"), record, payload))


def _json_text(c: Column) -> Column:
    """A JSON string literal with the escapes of a pure-ASCII writer."""
    escaped = F.aggregate(
        F.split(c, ""),
        F.lit(""),
        lambda acc, ch: F.concat(
            acc,
            F.when(ch == "\\", F.lit("\\\\"))
            .when(ch == '"', F.lit('\\"'))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(
                (F.ascii(ch) > 126) | ((F.ascii(ch) < 32) & (ch != "")),
                F.regexp_replace(F.hex(F.encode(ch, "UTF-16BE")), "(....)", "\\\\u$1"),
            )
            .otherwise(ch),
        ),
    )
    # Hex digits of the escapes are lower case.
    lowered = F.aggregate(
        F.regexp_extract_all(escaped, F.lit(r"(?s)(\\u[0-9A-F]{4}|\\.|[^\\]+)"), F.lit(1)),
        F.lit(""),
        lambda acc, t: F.concat(acc, F.when(t.rlike(r"^\\u"), F.lower(t)).otherwise(t)),
    )
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), lowered, F.lit('"')))


def uuid_for_record(tag: Column, value: Column, pointer: Column, lineno: Column, children: Column) -> Column:
    """SHA-1 of ``REC|`` and the record as JSON with sorted keys.

    ``children``: array of ``TAG:value`` texts in line order."""
    kids = F.concat(F.lit("["), F.array_join(F.transform(children, _json_text), ", "), F.lit("]"))
    body = F.concat(
        F.lit('{"children": '), kids,
        F.lit(', "lineno": '), F.coalesce(lineno.cast("string"), F.lit("null")),
        F.lit(', "pointer": '), _json_text(pointer),
        F.lit(', "tag": '), _json_text(tag),
        F.lit(', "value": '), _json_text(value), F.lit("}"),
    )
    return uuid_from_key(F.concat(F.lit("REC|"), body))


def uuid_for_inline_media(owner_uuid: Column, owner: Column, lineno: Column, path: Column, title: Column) -> Column:
    """SHA-1 of ``IMEDIA|`` and what the attachment is, as JSON with sorted keys."""
    body = F.concat(
        F.lit('{"file": '), _json_text(path),
        F.lit(', "lineno": '), F.coalesce(lineno.cast("string"), F.lit("null")),
        F.lit(', "owner_pointer": '), _json_text(owner),
        F.lit(', "owner_uuid": '), _json_text(owner_uuid),
        F.lit(', "title": '), _json_text(title), F.lit("}"),
    )
    return uuid_from_key(F.concat(F.lit("IMEDIA|"), body))


def place_version_id(place: Column, system: Column, year: Column) -> Column:
    """U10; ``..`` stands for an open year."""
    key = F.concat_ws("|", place, system, F.coalesce(year.cast("string"), F.lit("..")))
    return F.concat(F.lit("pv_"), F.substring(F.sha1(key.cast("binary")), 1, 20))
