import hashlib

import pytest

from tillwright.functions import enrich


def one(make, fn, value):
    return make([(value,)], "x string").select(fn("x").alias("y")).first().y


@pytest.mark.parametrize(
    "value, code",
    [
        ("\tusa\n", "US"), ("zz", "ZZ"), ("", "XX"), (" ", "XX"), ("UNITED KINGDOM", "GB"), ("Narnia", "XX"),
        ("jp", "JP"), (None, None), ("  United States", "US"), ("Deutschland 1", "XX"),
        ("\u00a0Italia\u3000", "IT"), ("U.S.A.", "US"), ("\U0001f600", "\U0001f600"),
    ],
)
def test_country_code(make, value, code):
    assert one(make, enrich.country_code, value) == code


def test_email_hash(make):
    expected = hashlib.sha256(b"jo.doe+list@mail.test").hexdigest()
    assert one(make, enrich.email_hash, "jo.doe+list@mail.test") == expected
    assert one(make, enrich.email_hash, "\tJo.Doe+List@Mail.TEST ") == expected
    assert one(make, enrich.email_hash, None) is None
    assert "x" not in enrich.pseudonymise(make([("a",)], "x string"), "x").columns


@pytest.mark.parametrize(
    "value, parts",
    [
        (None, None), (" QZ-4071-33\n", "QZ|4071|33"), ("qz-4071-33", "UNKNOWN|0|0"), ("QZ-4071-3355", "UNKNOWN|0|0"),
        ("QZ-40715-3", "QZ|40715|3"), ("QZ-40-33", "UNKNOWN|0|0"), ("", "UNKNOWN|0|0"), ("QZ-4071", "UNKNOWN|0|0"),
    ],
)
def test_sku_parts(make, value, parts):
    assert one(make, enrich.sku_parts, value) == parts


@pytest.mark.parametrize(
    "value, region",
    [
        ("10.77.3.250", "Internal"), ("192.168.250.9", "Internal"), ("63.4.4.4", "Americas"), ("99.200.7.1", "EMEA"),
        (None, None), ("no address", "Unknown"), (".1.2.3", "Unknown"), ("abc.1", "Unknown"),
        ("191.0.0.1", "APAC"), ("200.1.1.1", "Other"), (" 63.4.4.4 ", "Americas"), ("12", "Unknown"),
        ("1e1.2.3.4", "Unknown"), ("99999999999999999999.1", "Other"), ("", "Unknown"),
    ],
)
def test_ip_region(make, value, region):
    assert one(make, enrich.ip_region, value) == region


def days(spark, make, path=None):
    codes = ["SUP-001", "SUP-002", "SUP-003", "SUP-UNKNOWN", None, "SUP-009", " SUP-002 "]
    df = make([(i, c) for i, c in enumerate(codes)], "i int, code string")
    out = enrich.with_payment_terms(df, enrich.supplier_terms(spark, path), "code")
    return [r.payment_term_days for r in out.orderBy("i").collect()]


def test_standard_payment_terms(spark, make):
    assert days(spark, make) == [30, 45, 60, 30, 30, 30, 45]


def test_payment_terms_file(spark, make, tmp_path):
    listed = "SUP-001,10\nSUP-009,abc\nSUP-009\nSUP-009, 77 ,more\nSUP-001,15\nSUP-001,x\n"
    (tmp_path / "terms.csv").write_text(listed)
    assert days(spark, make, str(tmp_path / "terms.csv")) == [15, 45, 60, 30, 30, 77, 45]


def test_sql_functions_agree_with_the_columns(spark, make):
    from tillwright.plans.register import register_functions

    register_functions(spark)
    values = ["United States", "\tusa\n", "in", "it's", None, "", "\u00a0Italia\u3000", "AP-1234-09", " AP-1234-09\n",
              "8.8.8.8", ".1.2", "1e1.2", "10.1", "99999999999999999999.1", " A@b.C ", "SUP-003", " SUP-002 ", "\\"]
    df = make([(i, v) for i, v in enumerate(values)], "i int, v string")
    with_terms = enrich.with_payment_terms(df, enrich.supplier_terms(spark), "v", "days")
    want = with_terms.select(
        "i", enrich.country_code("v"), enrich.email_hash("v"), enrich.sku_parts("v"), enrich.ip_region("v"), "days"
    )
    have = spark.sql(
        """SELECT i, normalize_country(v), hash_customer_email(v), parse_legacy_sku(v), geoip_city(v),
                  lookup_supplier_terms(v) FROM {df}""",
        df=df,
    )
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, want.collect()))
