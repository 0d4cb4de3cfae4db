"""Scalar functions on the FIXTURES edge rows (names, phones, search, dates)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from molarflow.functions import misc, phone, text


def _one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_fold_name_edge_rows(spark):
    rows = [("Paulo Simão",), ("Paulo Simao",), ("Gil  Souza",), (" Bruna",), (None,), ("ÇÉÑ  ö ",)]
    df = spark.createDataFrame(rows, "x string").select(text.fold_name("x").alias("r"))
    assert [r.r for r in df.collect()] == ["paulo simao", "paulo simao", "gil souza", "bruna", None, "cen o"]


def test_fold_text_matches_column(spark):
    for s in ["Paulo Simão", "  Fábio   Núñez ", "JOÃO", "straße"]:
        assert _one(spark, text.fold_name("x"), s) == text.fold_text(s)


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="abcXYZ áéíóúãõçÁÉÇñü  \t", max_size=20))
def test_fold_parity_property(spark, s):
    assert _one(spark, text.fold_name("x"), s) == text.fold_text(s)


def test_search_text_specials():
    assert text.search_text("João (Silva)*") == "joao  silva"
    assert text.search_text("()") == ""


def test_parse_lists():
    assert text.parse_list(" a, ,b ,") == ["a", "b"]
    assert text.parse_list("Paulo Simão| x , y |", sep="|", fold=True) == ["paulo simao", "x , y"]
    assert text.parse_int_list("7, 8,abc, 4x") == [7, 8, 4]


PHONES = [
    ("(11) 98765-4321", "1187654321"),     # 11 digits with mobile 9
    ("1187654321", "1187654321"),          # 10 digits
    ("+55 11 98765-4321", "1187654321"),   # 13 digits: 55 + 9
    ("55 11 8765-4321", "1187654321"),     # 12 digits: 55
    ("5511876543210", "11876543210"),      # 13 digits with 55 but no mobile 9
    ("123", "123"),                        # short numbers stay
    (None, None),
    ("", None),
]


def test_phone_key_variants_equal(spark):
    df = spark.createDataFrame([(p,) for p, _ in PHONES], "x string").select(phone.phone_key("x").alias("k"))
    assert [r.k for r in df.collect()] == [k for _, k in PHONES]


def test_phone_variants_driver():
    assert phone.phone_variants("1187654321") == ["1187654321", "11987654321"]
    assert phone.phone_variants("11987654321") == ["11987654321", "1187654321"]
    assert phone.phone_variants("5511987654321") == ["5511987654321", "11987654321", "1187654321"]
    assert phone.phone_variants("551187654321") == ["551187654321", "1187654321", "11987654321"]
    assert phone.phone_variants("123") == []


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="0123456789", min_size=10, max_size=10))
def test_phone_key_invariant_under_variants(spark, base):
    """Every search variant of a number maps to one key (the equi-join premise)."""
    variants = phone.phone_variants(base) + ["55" + base, "55" + base[:2] + "9" + base[2:]]
    keys = {_one(spark, phone.phone_key("x"), v) for v in variants}
    if base[2] != "9":
        assert len(keys) == 1


def test_epoch_or_iso(spark):
    df = spark.createDataFrame([("1704067200",), ("2024-01-01T00:00:00",), ("garbage",), (None,)], "x string")
    got = [r.t for r in df.select(misc.epoch_or_iso_to_ts("x").alias("t")).collect()]
    assert got[:2] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)]
    assert got[2] is None and got[3] is None


def test_digest(spark):
    import hashlib
    assert _one(spark, misc.digest("x"), "1187654321") == hashlib.sha256(b"1187654321").hexdigest()


def test_fold_both_sides_of_rare_letters(spark):
    for s in ["ȘTEFAN țu", "a\u00a0b", "e\u0301clair", "Ǻ ẞ ø æ Ł", "\u2003x\u2003", "Đặng", "İ"]:
        assert _one(spark, text.fold_name("x"), s) == text.fold_text(s), s


def test_attribute_present(spark):
    df = spark.createDataFrame([({"a": "x"},), ({"a": " "},), ({},), (None,)], "m map<string,string>")
    assert [r.p for r in df.select(misc.attribute_present("m", "a").alias("p")).collect()] == [True, False, False, False]


def test_with_label_keeps_others(spark):
    df = spark.createDataFrame([(["a", "b"],), (None,), (["campanha"],)], "l array<string>")
    got = [r.l for r in df.select(misc.with_label("l", "campanha").alias("l")).collect()]
    assert got == [["a", "b", "campanha"], ["campanha"], ["campanha"]]


def test_total_pages(spark):
    df = spark.createDataFrame([(0,), (1,), (25,), (26,)], "t long")
    assert [r.p for r in df.select(misc.total_pages(F.col("t"), 25).alias("p")).collect()] == [1, 1, 1, 2]
