"""Personal names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinspark.functions.dates import let

#: Closed lists of titles before names, of suffixes, and of surname prefixes.
PREFIXES = ("mr", "mister", "mrs", "misses", "ms", "miss", "dr", "doctor", "prof", "rev", "reverend", "sir", "lord", "lady", "hon", "fr", "sr")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v", "esq", "phd", "m.d", "md", "jd")
SURNAME_PREFIXES = [
    "de", "du", "del", "della", "van", "von", "der", "den", "la", "le", "de la", "de las", "de los",
    "van de", "van der", "von der", "von dem", "ap", "ab", "mac", "mc",
]


def clean(c: Column) -> Column:
    """White space collapsed and trimmed; null when nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def loose_title(c: Column) -> Column:
    """Each word with a capital first and small other letters, all-capital words kept."""
    words = F.split(c, " ")
    return F.array_join(
        F.transform(words, lambda w: F.when((F.upper(w) == w) & (F.lower(w) != w), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))), " "
    )


def canonical(c: Column) -> Column:
    """Lower case without anything but letters, digits, blanks and ``-.'’``."""
    return F.lower(clean(F.regexp_replace(c, r"[^0-9A-Za-z\s\-.'’]", "")))


def name_block(full: Column, given: Column, surname: Column, prefix: Column, suffix: Column, nickname: Column, name_type: Column) -> Column:
    """``struct(parsed, normalized)``. Explicit fields go before what the
    marked surname of the full name says; the first quoted fragment is a nickname,
    the first in parentheses a maiden name."""
    base = F.coalesce(clean(full), F.lit(""))
    marked = base.rlike(r"/[^/]+/")

    def group(i: int) -> Column:
        return F.when(marked, clean(F.regexp_extract(base, r"^(.*?)/([^/]+)/\s*(.*)$", i)))

    all_given = F.coalesce(clean(given), F.when(marked, group(1)).otherwise(clean(base)))
    tokens = F.split(all_given, " ")
    p_given = F.element_at(tokens, 1)
    middle = F.coalesce(F.slice(tokens, 2, 1 << 20), F.array().cast("array<string>"))
    p_surname = F.coalesce(clean(surname), group(2))
    p_suffix = F.coalesce(clean(suffix), group(3))
    nick = F.coalesce(clean(nickname), clean(F.regexp_extract(base, r'"([^"]+)"', 1)))
    maiden = clean(F.regexp_extract(base, r"\(([^()]+)\)", 1))
    core = F.regexp_replace(F.regexp_replace(base, r'"[^"]*"|\([^()]*\)', " "), "/", " ")
    modeled = F.flatten(F.array_compact(F.array(*[F.split(x, " ") for x in (clean(prefix), clean(name_type), p_given, nick, p_surname, p_suffix, maiden)], middle)))
    extra = F.filter(F.split(F.trim(F.regexp_replace(core, r"\s+", " ")), " "), lambda t: (t != "") & ~F.array_contains(modeled, t))
    n_middle = F.transform(middle, loose_title)
    pretty = F.concat_ws(" ", loose_title(p_given), F.array_join(n_middle, " "), loose_title(p_surname), loose_title(p_suffix))
    return F.struct(
        F.struct(
            p_given.alias("given"), middle.alias("middle"), p_surname.alias("surname"), clean(prefix).alias("prefix"), p_suffix.alias("suffix"),
            nick.alias("nickname"), clean(name_type).alias("title"), maiden.alias("maiden_name"), extra.alias("additional_tokens"),
            F.when(p_surname.isNull() & F.contains(base, F.lit("/")), F.array(F.lit("surname_markers_present_but_surname_missing"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
        ).alias("parsed"),
        F.struct(
            loose_title(p_given).alias("given"), n_middle.alias("middle"), loose_title(p_surname).alias("surname"), loose_title(p_suffix).alias("suffix"),
            loose_title(nick).alias("nickname"), loose_title(maiden).alias("maiden_name"), canonical(pretty).alias("full"),
        ).alias("normalized"),
    )


def _bare(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"^[,.]+|[,.]+$", "")


def split_value(value: Column) -> Column:
    """A NAME value by closed lists: ``struct(prefix, given, middle,
    surname_prefix, surname, suffix, full)``."""
    left = clean(F.substring_index(value, "/", 1))
    inner = clean(F.regexp_extract(value, "/([^/]*)/?", 1))
    after = clean(F.regexp_extract(value, r"/[^/]*/\s*(.*)$", 1))
    words = F.coalesce(F.split(left, " "), F.array().cast("array<string>"))
    has_prefix = F.array_contains(F.array(*map(F.lit, PREFIXES)), _bare(F.try_element_at(words, F.lit(1))))
    prefix = F.when(has_prefix, F.try_element_at(words, F.lit(1)))
    names = F.when(F.coalesce(has_prefix, F.lit(False)), F.slice(words, 2, 1 << 20)).otherwise(words)
    tail = F.try_element_at(F.split(F.coalesce(after, left), " "), F.lit(-1))
    suffix = F.when(F.array_contains(F.array(*map(F.lit, SUFFIXES)), _bare(tail)), tail)
    names = F.when(after.isNull() & suffix.isNotNull(), F.slice(names, F.lit(1), F.size(names) - 1)).otherwise(names)
    sw = F.split(inner, " ")
    lists = F.array(*map(F.lit, SURNAME_PREFIXES))
    heads = [F.when((F.size(sw) > k) & F.array_contains(lists, F.lower(F.array_join(F.slice(sw, F.lit(1), F.lit(k)), " "))), k) for k in (3, 2, 1)]
    k = F.coalesce(*heads, F.lit(0))
    sp = F.when(k > 0, F.array_join(F.slice(sw, F.lit(1), k), " "))
    sn = F.when(k > 0, F.array_join(F.slice(sw, k + 1, F.size(sw)), " ")).otherwise(inner)
    given, middle = F.try_element_at(names, F.lit(1)), F.nullif(F.array_join(F.slice(names, 2, 1 << 20), " "), F.lit(""))
    return F.struct(
        prefix.alias("prefix"), given.alias("given"), middle.alias("middle"), sp.alias("surname_prefix"), sn.alias("surname"), suffix.alias("suffix"),
        F.concat_ws(" ", prefix, given, middle, sp, sn, suffix).alias("full"),
    )


def match_token(c: Column) -> Column:
    """Lower-case letters and digits only; ``unknown`` when none is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.lower(c), "[^a-z0-9]+", ""), F.lit("")), F.lit("unknown"))


def merge_tags(value: Column, npfx: Column, givn: Column, spfx: Column, surn: Column, nsfx: Column) -> Column:
    """split_value() with what stands in the lines under the name, which go
    before it: ``struct(prefix, given, middle, surname_prefix, surname, suffix, full)``."""
    words = F.split(clean(givn), " ")

    def merged(p: Column) -> Column:
        parts = {
            "prefix": F.coalesce(clean(npfx), p["prefix"]),
            "given": F.coalesce(F.element_at(words, 1), p["given"]),
            "middle": F.when(givn.isNotNull(), F.nullif(F.array_join(F.slice(words, 2, 1 << 20), " "), F.lit(""))).otherwise(p["middle"]),
            "surname_prefix": F.coalesce(clean(spfx), p["surname_prefix"]),
            "surname": F.coalesce(clean(surn), p["surname"]),
            "suffix": F.coalesce(clean(nsfx), p["suffix"]),
        }
        return F.struct(*[c.alias(k) for k, c in parts.items()], F.concat_ws(" ", *parts.values()).alias("full"))

    return let(split_value(value), merged)


def match_view(given: Column, surname: Column, value: Column) -> Column:
    """The names by which people are compared; those of the value where the
    fields have none: ``struct(given_norm, surname_norm)``."""
    bare = F.regexp_replace(value, r"\([^)]*\)", " ")
    first = F.element_at(F.split(clean(F.substring_index(bare, "/", 1)), " "), 1)
    inner = clean(F.regexp_extract(value, "/([^/]+)/", 1))
    return F.struct(match_token(F.coalesce(clean(given), first)).alias("given_norm"), match_token(F.coalesce(clean(surname), inner)).alias("surname_norm"))
