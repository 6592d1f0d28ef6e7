"""Column expressions, one value at a time."""

import decimal
import hashlib

import pytest
from pyspark.sql import functions as F

from recordlens.functions import email as E
from recordlens.functions import measure as M
from recordlens.functions import text as T


@pytest.fixture
def evaluate(spark):
    def run(make, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in frame.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]

    return run


def test_clean_domain(evaluate):
    cases = {
        None: None, "": None, "  ": None, "\t": None, "link missing": None, " Link Missing ": None,
        "(blank)": None, "N/A": None, "na": None, "none": None,
        "https://app.hubspot.com/contacts/1": None, "see APP.HUBSPOT.COM": None,
        "HTTPS://WWW.Acme.com/path/x": "acme.com", "http://acme.com/": "acme.com",
        "www.acme.com": "acme.com", "\tacme.com\n": "acme.com", "http:///x": None,
        "www.www.acme.com": "www.acme.com", "acme.com:8080/x": "acme.com:8080",
        "ftp://acme.com": "ftp:", "https://http://acme.com": "http:",
    }
    assert evaluate(T.clean_domain, list(cases)) == list(cases.values())


def test_slugs(evaluate):
    links = ["https://LinkedIn.com/company/Acme/", "acme", " ACME// ", None, "", "x/linkedin.com/company/a?b=1"]
    assert evaluate(T.company_slug, links) == ["acme", "acme", "acme", "", "", "a"]
    links = ["https://www.linkedin.com/in/John-Doe/?x=1", "linkedin.com/in/j#y", "john-doe", None, "linkedin.com/company/a"]
    assert evaluate(T.person_slug, links) == ["john-doe", "j", "", "", ""]


def test_numbers(evaluate):
    values = ["12.7", " -3.9 ", "1e3", "", None, "abc", "inf", "nan", "1d", "1e400", "99999999999999999999", "\t7\n"]
    assert evaluate(T.safe_int, values) == [12, -3, 1000, None, None, None, None, None, None, None, None, 7]
    assert evaluate(T.safe_float, values)[:3] == [12.7, -3.9, 1000.0]
    assert evaluate(T.safe_float, values)[6:10] == [None] * 4


def test_trim_is_wider_at_ingest(evaluate):
    assert evaluate(T.strip, ["\t a \n", " a "]) == ["a", "a"]
    assert evaluate(T.has_text, ["\t", " ", "", None]) == [True, False, False, False]


def test_keys(spark):
    row = spark.range(1).select(
        T.md5_key(F.lit(None).cast("string"), F.lit("a"), F.lit("b")).alias("k"),
        T.run_id(F.lit("2026-05-07").cast("date"), "T").alias("t"),
        T.run_id(F.lit("2026-05-07").cast("date"), "F").alias("f"),
    ).first()
    assert (row.k, row.t, row.f) == (hashlib.md5(b"ab").hexdigest(), "T26.05.07", "F26.05.07")


def test_json(evaluate):
    values = ['{"b":"2","a":"1"}', '{"x":"Unclassified"}', "{}", None, "{broken"]
    assert evaluate(lambda c: T.unless(T.first_map_value(c), "Unclassified"), values) == ["1", None, None, None, None]
    payloads = ['{"employee_count":"37"}', '{"employee_count":37}', '{"employee_count":"n/a"}', "{broken", None, "{}"]
    assert evaluate(lambda c: T.payload_value(c, "$.employee_count", "int"), payloads) == [37, 37, None, None, None, None]
    ids = ['{"id":12}', '{"id":"x"}', '{"id":null}', "{"]
    assert evaluate(lambda c: T.payload_value(c, "$.id", "string"), ids) == ["12", "x", None, None]


def test_roots(evaluate):
    assert evaluate(T.domain_root, [" Acme.com.au", "nodot", "", None, ".x"]) == ["acme", "nodot", "", None, ""]
    assert evaluate(T.email_root, ["a@B.com", "no-at", "a@", None]) == ["b", "", "", None]


def test_labels(evaluate):
    assert evaluate(lambda c: T.label(c, "UNKNOWN"), [" US ", " ", "", None]) == ["US"] + ["UNKNOWN"] * 3
    assert evaluate(T.flag_text, [True, False, None], "boolean") == ["true", "false", "NULL"]


def test_format_class(evaluate):
    cases = {
        None: "empty", " ": "empty", "abc": "invalid_no_at", "a@b": "invalid_format",
        "A.b+c%d@x-y.Com ": "valid", "a@b@c.com": "invalid_format", "a@b.c": "invalid_format",
        "a@b.com\n": "invalid_format", "x a@b.com": "invalid_format",
    }
    assert evaluate(E.format_class, list(cases)) == list(cases.values())


def test_type_class_priority_and_match_mode(evaluate):
    mails = ["noreply@gmail.com", "support@gmail.com", "joe@gmail.com", "info@acme.com", "joe@acme.com",
             "operations@acme.com", "joe@naver.com", "noreplyx@acme.com", "joe@gmail.community"]
    basic = evaluate(lambda c: E.type_class(c, "basic"), mails)
    assert basic == ["system_blocked", "generic_role_based", "free_provider", "generic_role_based",
                     "specific_company", "specific_company", "specific_company", "specific_company", "free_provider"]
    regional = evaluate(lambda c: E.type_class(c, "regional"), mails)
    assert regional[1] == "free_provider" and regional[5:7] == ["generic_role_based", "free_provider"]
    full = evaluate(lambda c: E.type_class(c, "regional", "full"), mails)
    assert "free_provider" not in full
    assert full[1:3] == ["generic_role_based", "specific_company"]


def test_pct_rounds_halves_up_exactly(spark):
    pairs = [(1, 3), (1, 32), (41, 4000), (201, 20000), (1, 20000), (0, 5), (5, 0), (3, None), (1_218_260, 9_064_254)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [r.p for r in frame.select(M.pct(F.col("a"), F.col("b")).alias("p")).collect()]
    for (a, b), p in zip(pairs, got):
        if not b:
            assert p is None
            continue
        exact = decimal.Decimal(100 * a) / decimal.Decimal(b)
        assert decimal.Decimal(repr(p)) == exact.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP)
    signed = spark.range(1).select(M.signed_pct(F.lit(-1), F.lit(32)).alias("p")).first().p
    assert signed == -3.13


def test_mean_pct(spark):
    frame = spark.createDataFrame([(45.2,), (45.3,), (None,)], "v double")
    row = frame.agg(M.mean_pct(F.col("v")).alias("two"), M.mean_pct(F.col("v"), 1).alias("one")).first()
    assert (row.two, row.one) == (45.25, 45.3)
    assert frame.filter("v > 99").agg(M.mean_pct(F.col("v")).alias("m")).first().m is None


def test_clamp_keeps_null(evaluate):
    assert evaluate(M.clamp, [None, -1.0, 50.0, 101.0], "double") == [None, 0.0, 50.0, 100.0]


def test_bands_directions_colours(evaluate):
    assert evaluate(M.quality_band, [100.0, 90.0, 89.99, 75.0, 60.0, 40.0, 39.99, 0.0], "double") == [
        "EXCELLENT", "EXCELLENT", "GOOD", "GOOD", "FAIR", "NEEDS WORK", "POOR", "POOR"]
    assert evaluate(M.direction, [None, 2.01, 2.0, -2.0, -2.01], "double") == [
        "FIRST_RUN", "IMPROVED", "STABLE", "STABLE", "DECLINED"]
    assert evaluate(M.severity, [20.0, 19.99, 5.0, 4.99, None], "double") == ["red", "amber", "amber", "green", None]
    assert evaluate(M.coverage_colour, [49.99, 50.0, 75.0, 75.01, None], "double") == [
        "red", "amber", "amber", "green", None]
