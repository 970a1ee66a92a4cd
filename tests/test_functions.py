import pytest
from pyspark.sql import functions as F

from kinspark.functions import dates, events as ev, identity, names, places


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("1900", dict(date="1900", precision="year", kind="exact")),
        ("JAN 1900", dict(date="1900-01", precision="month")),
        ("1 JAN 1900", dict(date="1900-01-01", precision="day", normalized="1900-01-01")),
        ("ABT 1900", dict(modifier="ABT", kind="approximate", date="1900")),
        ("circa 1850", dict(modifier="ABT", date="1850")),
        ("BEF 1800", dict(modifier="BEF", kind="before")),
        ("after 1750", dict(modifier="AFT", kind="after")),
        ("BET 1 JAN 1800 AND 2 FEB 1810", dict(kind="range", modifier="BET", start="1800-01-01", end="1810-02-02", date=None)),
        ("FROM 1900 TO 1910", dict(kind="range", modifier="FROM", start="1900", end="1910")),
        ("spring 1880", dict(kind="seasonal", season="SPRING", date="1880", precision="year")),
        ("1 JAN 1750 (Julian)", dict(calendar="JULIAN", date="1750-01-01")),
        ("ABT", dict(kind="approximate", modifier="ABT", date=None)),
        ("nonsense", dict(kind="unknown", date=None, normalized="nonsense")),
        ("", dict(kind="unknown", raw="")),
        (None, dict(kind="unknown", raw="")),
    ],
)
def test_parse_date(spark, text, want):
    got = one(spark, text, dates.parse_date)
    assert {k: got[k] for k in want} == want


def test_age(spark):
    r = one(spark, "1 JAN 1900", lambda c: dates.age_between(dates.parse_date(c), dates.parse_date(F.lit("1 JAN 1950"))))
    assert (r["years"], r["approximate"]) == (50, False)
    assert one(spark, "1 JAN 1960", lambda c: dates.age_between(dates.parse_date(c), dates.parse_date(F.lit("1950")))) is None


@pytest.mark.parametrize("raw, want", [(" @i1@ ", "@I1@"), ("f7", "@F7@"), (" @S3", "@S3@"), ("", None), (" @ ", None), (None, None)])
def test_normalize_pointer(spark, raw, want):
    assert one(spark, raw, identity.normalize_pointer) == want


def test_uuid(spark):
    assert one(spark, "i1", identity.uuid_for_pointer) == "ce0c6720-80f0-4d5a-2764-e9289a22a05c"


def test_record_uuid_escapes(spark):
    import hashlib
    import json

    rec = {"tag": "NOTE", "value": 'é "x"\n', "pointer": None, "lineno": 3, "children": ["SOUR:@S1@"]}
    h = hashlib.sha1(("REC|" + json.dumps(rec, sort_keys=True)).encode()).hexdigest()
    got = spark.range(1).select(identity.uuid_for_record(F.lit("NOTE"), F.lit('é "x"\n'), F.lit(None).cast("string"), F.lit(3), F.array(F.lit("SOUR:@S1@"))).alias("u")).first()["u"]
    assert got.replace("-", "") == h[:32]


def test_places(spark):
    assert one(spark, "  New   York ,   USA  ", places.event_place) == "New York, USA"
    assert one(spark, "W93.456", places.hemisphere_degrees) == -93.456
    assert one(spark, "N45.123", places.hemisphere_degrees) == 45.123
    assert one(spark, "  ", lambda c: places.standard_place(c)["id"]) is None


def test_names(spark):
    n = one(spark, 'John "Jack" /Smith/ Jr.', lambda c: names.name_block(c, *[F.lit(None).cast("string")] * 6))
    assert (n["parsed"]["surname"], n["parsed"]["suffix"], n["parsed"]["nickname"]) == ("Smith", "Jr.", "Jack")


def test_scores(spark):
    assert one(spark, 2.5, lambda c: F.bround(c, 0), "double") == 2
    assert one(spark, "WITN", ev.role_label) == "Witn" and one(spark, "_WITN", ev.role_label) == "Witness"
    assert one(spark, "3", ev.certainty) == 3 and one(spark, "7", ev.certainty) is None
