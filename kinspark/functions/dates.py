"""Dates of lineage records as column expressions (D1-D11). Dates keep their
partial precision as ISO text (``YYYY``, ``YYYY-MM``, ``YYYY-MM-DD``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months and their numbers.
MONTHS = {"JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MAY": 5, "JUN": 6, "JUL": 7, "AUG": 8, "SEP": 9, "SEPT": 9, "OCT": 10, "NOV": 11, "DEC": 12}
#: Calendars by the labels they go under.
CALENDARS = {"JULIAN": "JULIAN", "OLD STYLE": "JULIAN", "GREGORIAN": "GREGORIAN", "NEW STYLE": "GREGORIAN"}
#: Qualifiers, each with its code, the kind of date it makes, and its writings.
QUALIFIERS = [
    ("ABT", "approximate", ("abt", "abt.", "about", "approx", "approx.", "approximately", "circa", "c", "c.", "around", "ca", "ca.")),
    ("BEF", "before", ("before", "bef", "bef.", "pre", "pre-")),
    ("AFT", "after", ("after", "aft", "aft.", "post", "post-", "afterwards")),
    ("BET", "range", ("between", "bet", "bet.", "betw", "betw.", "btw", "btw.")),
    ("CAL", "calculated", ("cal", "cal.", "calculated", "computed")),
    ("EST", "estimated", ("est", "est.", "estimated", "estimate", "guess", "guessed", "roughly", "probable", "assumed")),
    ("FROM", "range_start", ("from", "since")),
    ("TO", "range_end", ("to", "until", "thru", "through")),
]
#: Seasons.
SEASONS = {"spring": "SPRING", "summer": "SUMMER", "autumn": "AUTUMN", "fall": "AUTUMN", "winter": "WINTER"}

def null_text() -> Column:
    return F.lit(None).cast("string")


def lookup(table: dict, key: Column) -> Column:
    """The entry of a literal table, null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(c, ",", " "), r"\s+"), lambda w: w != "")


def _year(token: Column) -> Column:
    return F.when(token.rlike(r"^[0-9]{3,4}$"), token.cast("int"))


def _simple(words: Column) -> Column:
    """A date without qualifier: ``struct(date, precision, kind, season)``."""
    one, two, three = (F.try_element_at(words, F.lit(i)) for i in (1, 2, 3))
    facts = F.struct(
        F.size(words).alias("n"), one.alias("one"), _year(one).alias("y1"), _year(two).alias("y2"), _year(three).alias("y3"),
        lookup(MONTHS, F.upper(one)).alias("m1"), lookup(MONTHS, F.upper(two)).alias("m2"),
        _year(F.regexp_replace(two, "s+$", "")).alias("decade"), lookup(SEASONS, F.lower(one)).alias("season"),
    )

    def made(date: Column, precision: str | None, kind: str, season: Column | None = None) -> Column:
        season = null_text() if season is None else season
        return F.struct(date.alias("date"), F.lit(precision).cast("string").alias("precision"), F.lit(kind).alias("kind"), season.alias("season"))

    def pick(v: Column) -> Column:
        n = v["n"]
        return (
            F.when((n == 2) & v["season"].isNotNull() & v["y2"].isNotNull(), made(v["y2"].cast("string"), "year", "seasonal", v["season"]))
            .when((n == 2) & F.lower(v["one"]).isin("early", "mid", "late") & v["decade"].isNotNull(), made(v["decade"].cast("string"), "year", "unknown"))
            .when((n == 1) & v["y1"].isNotNull(), made(F.format_string("%04d", v["y1"]), "year", "exact"))
            .when((n == 2) & v["y2"].isNotNull() & v["m1"].isNotNull(), made(F.format_string("%04d-%02d", v["y2"], v["m1"]), "month", "exact"))
            .when(
                (n >= 3) & v["y3"].isNotNull() & v["m2"].isNotNull() & v["one"].rlike("^[0-9]{1,4}$"),
                made(F.format_string("%04d-%02d-%02d", v["y3"], v["m2"], v["one"].try_cast("int")), "day", "exact"),
            )
            .otherwise(made(null_text(), None, "unknown"))
        )

    return let(facts, pick)


def parse_date(raw: Column) -> Column:
    """A struct of ten texts. ``normalized`` is the ISO date, or the text
    without its calendar where there is none."""
    s = F.trim(F.coalesce(raw, F.lit("")))

    def with_base(v: Column) -> Column:
        calendar = lookup(CALENDARS, F.upper(F.trim(F.regexp_extract(v, r"\(([^()]*)\)$", 1))))
        base = F.when(calendar.isNotNull(), F.rtrim(F.regexp_replace(v, r"\([^()]*\)$", ""))).otherwise(v)
        return let(F.struct(v.alias("s"), calendar.alias("calendar"), base.alias("base"), _words(base).alias("words")), with_words)

    def with_words(v: Column) -> Column:
        words = v["words"]
        rest = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        low = F.transform(rest, lambda w: F.lower(w))
        head = F.lower(F.try_element_at(words, F.lit(1)))

        def first_of(*stops: str) -> Column:
            at = [F.nullif(F.array_position(low, F.lit(x)), F.lit(0)) for x in stops]
            return F.coalesce(F.least(*at) if len(at) > 1 else at[0], F.lit(0)).cast("int")

        facts = F.struct(
            v["s"].alias("s"), v["calendar"].alias("calendar"), v["base"].alias("base"), words.alias("words"), head.alias("head"), rest.alias("rest"),
            F.when(head.isin("bet", "between", "btw", "betw", "ranging"), first_of("and")).when(head.isin("from", "since"), first_of("to", "until", "thru", "through")).otherwise(0).alias("cut"),
            F.when(head.isin("from", "since"), "FROM").otherwise("BET").alias("range"),
            lookup({a: q for q, _, names in QUALIFIERS for a in names}, head).alias("code"),
            lookup({a: k for _, k, names in QUALIFIERS for a in names}, head).alias("kind"),
        )
        return let(facts, with_parts)

    def with_parts(v: Column) -> Column:
        rest, cut = v["rest"], v["cut"]
        body = F.when(v["code"].isNotNull(), rest).otherwise(v["words"])
        left = F.slice(rest, F.lit(1), F.greatest(cut - 1, F.lit(0)))
        right = F.slice(rest, F.greatest(cut + 1, F.lit(1)), F.size(rest))
        return let(F.struct(v.alias("v"), body.alias("body"), _simple(body).alias("d"), _simple(left).alias("a"), _simple(right).alias("b")), result)

    def result(r: Column) -> Column:
        v, d = r["v"], r["d"]
        empty, ranged = F.size(v["words"]) == 0, v["cut"] > 0
        only = F.size(r["body"]) == 0
        in_season = lookup(SEASONS, F.lower(F.try_element_at(r["body"], F.lit(1)))).isNotNull()
        plain = ~empty & ~ranged & ~only
        kind = F.when(empty, "unknown").when(ranged, "range").when(only, F.coalesce(v["kind"], F.lit("unknown"))).when(in_season, "seasonal").otherwise(F.coalesce(v["kind"], d["kind"]))
        return F.struct(
            v["s"].alias("raw"),
            F.when(empty, v["s"]).when(plain & ~in_season, F.coalesce(d["date"], v["base"])).otherwise(v["base"]).alias("normalized"),
            kind.alias("kind"),
            F.when(ranged, v["range"]).when(~empty, v["code"]).alias("modifier"),
            F.when(plain, d["date"]).alias("date"),
            F.when(plain, d["precision"]).alias("precision"),
            F.when(ranged, r["a"]["date"]).alias("start"),
            F.when(ranged, r["b"]["date"]).alias("end"),
            F.when(~empty, v["calendar"]).alias("calendar"),
            F.when(plain & in_season, d["season"]).alias("season"),
        )

    return let(s, with_base)


def lineage_ymd(raw: Column) -> Column:
    """``struct(y, m, d, precision)`` with precision 0-3, as scoring reads dates."""
    months = {k: v for k, v in MONTHS.items() if k != "SEPT"}

    def facts(w: Column) -> Column:
        at = [F.try_element_at(w, F.lit(i)) for i in (1, 2, 3)]
        cols = [F.size(w).alias("n")]
        cols += [x.try_cast("int").alias(f"i{k}") for k, x in enumerate(at)] + [lookup(months, F.upper(F.substring(at[k], 1, 3))).alias(f"m{k}") for k in (0, 1)]
        return let(F.struct(*cols), pick)

    def made(y, m, d, p) -> Column:
        return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"), F.lit(p).alias("precision"))

    def pick(v: Column) -> Column:
        none = F.lit(None)
        return (
            F.when((v["n"] == 1) & v["i0"].isNotNull(), made(v["i0"], none, none, 1))
            .when((v["n"] == 2) & v["i1"].isNotNull() & v["m0"].isNotNull(), made(v["i1"], v["m0"], none, 2))
            .when((v["n"] == 3) & v["i2"].isNotNull() & v["m1"].isNotNull() & v["i0"].isNotNull(), made(v["i2"], v["m1"], v["i0"], 3))
            .otherwise(made(none, none, none, 0))
        )

    return let(F.split(F.trim(F.coalesce(raw, F.lit(""))), r"\s+"), facts)


def first_year(*texts: Column) -> Column:
    """The first free-standing four digits of the first text that has any."""
    return F.coalesce(*[F.regexp_extract(t, r"(?<![0-9])([0-9]{4})(?![0-9])", 1).try_cast("int") for t in texts])


def iso_day(date: Column) -> Column:
    """A partial ISO date as a day, missing parts 1; null where there is no such day."""
    full = F.when(F.length(date) == 4, F.concat(date, F.lit("-01-01"))).when(F.length(date) == 7, F.concat(date, F.lit("-01"))).otherwise(date)
    return full.try_cast("date")


def age_between(birth: Column, event: Column) -> Column:
    """Age at an event from two parse_date structs, null when negative or
    unknown: ``struct(years, months, days, approximate)``."""

    def facts(v: Column) -> Column:
        x, y = v["x"], v["y"]
        exact = (x["precision"] == "day") & (y["precision"] == "day") & (x["kind"] == "exact") & (y["kind"] == "exact")
        b, e = iso_day(F.coalesce(x["date"], x["start"])), iso_day(F.coalesce(y["date"], y["start"]))
        return let(F.struct(b.alias("b"), e.alias("e"), F.coalesce(exact, F.lit(False)).alias("sure")), counts)

    def counts(v: Column) -> Column:
        b, e = v["b"], v["e"]
        days = F.dayofmonth(e) - F.dayofmonth(b)
        months = F.month(e) - F.month(b) - (days < 0).cast("int")
        years = F.year(e) - F.year(b) - (months < 0).cast("int")
        age = F.struct(
            years.alias("years"),
            F.when(v["sure"], months + 12 * (months < 0).cast("int")).alias("months"),
            F.when(v["sure"], F.greatest(days, F.lit(0))).alias("days"),
            (~v["sure"]).alias("approximate"),
        )
        return F.when(b.isNotNull() & e.isNotNull() & (e >= b), age)

    return let(F.struct(birth.alias("x"), event.alias("y")), facts)
