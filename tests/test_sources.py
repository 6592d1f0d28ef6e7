"""Readers: charsets, headers, dates in names, aliases, payload cache."""

import pytest
from pyspark.sql import functions as F

from recordlens.plans import customers, records
from recordlens.sources import files

HEAD = "HUBSPOT_DOMAIN_LINK,STRIPE_CUSTOMER_ID,SUB_CREATED,STRIPE_NAME,SUB_STATUS,SEATS"


@pytest.fixture
def drop(tmp_path):
    def put(name, data):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    put("06/06_01_CTA.csv", ("﻿" + HEAD + "\nacme.com,c1,2026-06-01, Zoë ,active,3\n").encode())
    put("06/06_02_cta.CSV", (HEAD + "\nskipped.com,c1,2026-06-02,x,active,3\n").encode())
    put("06/06_03_CTA.csv", (HEAD + "\nlatin.com,c2,2026-06-03,Zo\xeb,active,\n").encode("latin-1"))
    turned = "SEATS, STRIPE_NAME ,HUBSPOT_DOMAIN_LINK,STRIPE_CUSTOMER_ID,SUB_CREATED,SUB_STATUS"
    put("07/07_04_CTA.csv", (turned + '\n12.7,"two\nlines, ""q""",https://www.Turned.com/x,c3,2026-07-04,\tactive\n').encode())
    put("07/13_40_CTA.csv", (HEAD + "\nbad.com,c1,x,x,active,3\n").encode())
    put("07/notes_CTA.csv", (HEAD + "\nbad.com,c1,x,x,active,3\n").encode())
    return str(tmp_path)


def test_exports(spark, drop):
    rows = customers.ingest(files.read_exports(spark, drop, 2026))
    got = {r.customer_domain: r for r in rows.collect()}
    assert set(got) == {"acme.com", "latin.com", "turned.com"}
    assert got["acme.com"].customer_name == "Zoë" and got["latin.com"].customer_name == "Zoë"
    turned = got["turned.com"]
    assert (turned.customer_name, turned.seats, turned.sub_status) == ('two\nlines, "q"', 12, "active")
    assert str(turned.run_date) == "2026-07-04" and turned.crm_name == ""
    assert got["latin.com"].seats is None


def test_exports_of_a_month_or_day(spark, drop):
    days = lambda **k: sorted(str(r.run_date) for r in files.read_exports(spark, drop, 2026, **k).collect())
    assert days(month="06") == ["2026-06-01", "2026-06-03"]
    assert days(day="2026-07-04") == ["2026-07-04"]
    table = files.read_exports(spark, drop, 2026)
    assert [str(r.run_date) for r in files.stored_dates(table).collect()] == ["2026-06-01", "2026-06-03", "2026-07-04"]


def test_no_files(spark, tmp_path):
    with pytest.raises(Exception):
        files.read_exports(spark, str(tmp_path), 2026)


def test_file_dates(spark):
    names = ["06_01_CTA.csv", "06_01_cta.CSV", "x06_01_CTA.csv", "02_30_CTA.csv", "Master_2026-05-27.csv",
             "dq_people_04_24_26.csv", "none.csv", "a_2026-05-27_01_02_03.csv"]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select(
        "i", files.daily_file_date(F.col("n"), 2026).alias("d"), files.input_file_date(F.col("n")).alias("m"))
    got = [(str(r.d), str(r.m)) for r in frame.orderBy("i").collect()]
    assert [d for d, _ in got] == ["2026-06-01", "2026-06-01"] + ["None"] * 6
    assert [m for _, m in got][4:] == ["2026-05-27", "2026-04-24", "None", "2026-05-27"]


def test_inputs_with_aliases_and_file_order(spark, tmp_path):
    (tmp_path / "dq_people_04_24_26.csv").write_text(
        "Full Name,PERSON LINKEDIN,Provider,Data Source,extra\n"
        "A,linkedin.com/in/x,p1,,1\nB,https://www.linkedin.com/in/X/,,d2,2\nC,,,,3\nD,linkedin.com/in/x,p4,d4,4\n")
    rows = files.read_inputs(spark, [str(tmp_path)])
    assert "extra" in rows.columns and "criteria" in rows.columns
    marked = records.mark_duplicates(rows, "person")
    got = {r.full_name: r for r in marked.collect()}
    assert [got[n].status for n in "ABCD"] == [None, "409", None, "409"]
    # of several headers for the source the first filled one, in listed order
    assert [got[n].source for n in "ABCD"] == ["p1", "d2", "", "d4"]
    assert {str(r.file_date) for r in got.values()} == {"2026-04-24"}
    counts = records.duplicate_counts(marked).first()
    assert tuple(counts) == (4, 3, 1, 2)


def test_inputs_of_different_headers_and_charsets(spark, tmp_path):
    """Line numbers start again in every group of files; the order stays unique."""
    (tmp_path / "a_2026-01-01.csv").write_text("Full Name,PERSON LINKEDIN\nA,linkedin.com/in/x\nB,linkedin.com/in/y\n")
    (tmp_path / "b_2026-01-02.csv").write_text("PERSON LINKEDIN,Full Name\nlinkedin.com/in/x,C\nlinkedin.com/in/z,D\n")
    (tmp_path / "c_2026-01-03.csv").write_bytes("Full Name,PERSON LINKEDIN\nÉ,linkedin.com/in/z\n".encode("latin-1"))
    rows = files.read_inputs(spark, [str(tmp_path)])
    assert rows.select("row_no").distinct().count() == 5
    marked = records.mark_duplicates(rows, "person").collect()
    assert {r.full_name: r.status for r in marked} == {"A": None, "B": None, "C": "409", "D": None, "É": "409"}
    assert len(marked) == 5
    looked_up = records.attach_payloads(
        records.mark_duplicates(rows, "person"),
        spark.createDataFrame([("x", "200", '{"id":1}')], "slug string, status string, raw string"),
    )
    added = records.upsert_rows(looked_up, None, "PERSON").collect()
    assert {(r.handle, r.status_code) for r in added} == {("x", 200), ("y", 404), ("z", 404)}


def test_payload_cache(spark, tmp_path):
    (tmp_path / "co 1.json").write_text('{"id":1,\n"post_count":2}')
    (tmp_path / "co2.json").write_text("{}")
    (tmp_path / "note.txt").write_text("x")
    cache = files.read_payload_cache(spark, str(tmp_path))
    got = {r.slug: r.raw for r in cache.collect()}
    assert got == {"co 1": '{"id":1,\n"post_count":2}', "co2": "{}"}
    rows = spark.createDataFrame([(1, "co2", None), (2, "gone", None), (3, "", None), (4, "co2", "409")],
                                 "row_no bigint, slug string, status string")
    out = {r.row_no: (r.status, r.payload_raw) for r in records.attach_payloads(rows, cache).collect()}
    assert out == {1: ("200", "{}"), 2: ("404", None), 3: ("404", None), 4: ("409", None)}


def test_read_table_prunes_and_renames(spark, tmp_path, plan_of):
    spark.createDataFrame([("C1", 1999, "x")], "ID string, FOUNDED_YEAR int, other string").write.parquet(str(tmp_path / "t"))
    frame = files.read_table(spark, str(tmp_path / "t"), ["id", "year_founded"], {"id": "ID", "year_founded": "FOUNDED_YEAR"})
    assert [tuple(r) for r in frame.collect()] == [("C1", 1999)] and frame.columns == ["id", "year_founded"]
    assert "other" not in plan_of(frame)
