"""Wide CSV files as text lines joined to their headers (S1), and the lines
that are rejected (R3)."""

import os

import pytest

from stratocast.sources import csv_wide as CSV


def _write(folder, name, *lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _long(df, attribute="temperature"):
    return sorted((r.datetime.strftime("%d %H"), r.city, r[attribute]) for r in df.collect())


def test_files_of_several_headers(spark, scratch_dir):
    _write(scratch_dir, "a.csv", "datetime,Boston,Miami", "2017-10-31 00:00:00,1,2", "", "2017-10-31 01:00:00,,4")
    _write(scratch_dir, "b.csv", "Miami,datetime,Boston", "20,2017-11-01 00:00:00,10")
    _write(scratch_dir, "c.csv", 'datetime,"Washington, D.C.","St. ""Louis"""', "2017-11-02 00:00:00,5,NaN", "2017-11-02 01:00:00,6,7")
    _write(scratch_dir, "d.csv", "datetime,Oslo", "datetime,Oslo", "2017-11-03 00:00:00,-1.5")
    _write(scratch_dir, "e.csv", "datetime,Rome")
    _write(scratch_dir, "deep/er/f.csv", "datetime,Boston,Miami", "2017-11-04 00:00:00, 8 ,n/a")
    _write(scratch_dir, "note.txt", "not,a,table")
    out = CSV.read_wide(spark, scratch_dir, "temperature", source_col="from_file")
    assert _long(out) == [
        ("01 00", "Boston", 10.0),
        ("01 00", "Miami", 20.0),
        ("02 00", "Washington, D.C.", 5.0),
        ("02 01", 'St. "Louis"', 7.0),
        ("02 01", "Washington, D.C.", 6.0),
        ("03 00", "Oslo", -1.5),
        ("04 00", "Boston", 8.0),
        ("31 00", "Boston", 1.0),
        ("31 00", "Miami", 2.0),
        ("31 01", "Miami", 4.0),
    ]
    assert {os.path.basename(r.from_file) for r in out.collect()} == {"a.csv", "b.csv", "c.csv", "d.csv", "f.csv"}


def test_the_plan_has_no_list_of_files(spark, scratch_dir):
    """One text scan of the folder, whatever the number of files and headers."""
    for i in range(12):
        order = ["Boston", "Miami", "Oslo"][i % 3 :] + ["Boston", "Miami", "Oslo"][: i % 3]
        _write(scratch_dir, f"secret{i}.csv", ",".join(["datetime", *order]), f"2017-10-31 {i:02d}:00:00,1,2,3")
    out = CSV.read_wide(spark, scratch_dir, "temperature")
    assert out.count() == 36
    plan = out._jdf.queryExecution().toString()
    assert "secret" not in plan and plan.count("Generate explode") <= 6


@pytest.mark.parametrize("line", ["2017-10-31 00:00:00,1", "2017-10-31 00:00:00,1,2,3", "31.10.2017,1,2", "2017-10-31 00:00:00,one,2"])
def test_a_wrong_line_fails_the_load(spark, scratch_dir, line):
    _write(scratch_dir, "a.csv", "datetime,Boston,Miami", "2017-10-31 00:00:00,1,2", line)
    with pytest.raises(Exception):
        CSV.read_wide(spark, scratch_dir, "temperature").collect()


def test_rejected_lines(spark, scratch_dir):
    wrong = {
        "2017-10-31 02:00:00,1": "columns",
        "2017-10-31 02:00:00,1,2,3": "columns",
        "31.10.2017,1,2": "datetime",
        ",1,2": "datetime",
        "2017-10-31 02:00:00,one,2": "value",
        "2017-10-31 02:00:00,1,2e": "value",
    }
    _write(scratch_dir, "a.csv", "datetime,Boston,Miami", "2017-10-31 00:00:00,1,2", *list(wrong)[:3], "2017-10-31 01:00:00,NA,4")
    _write(scratch_dir, "b.csv", "Miami,datetime,Boston", "5,2017-11-01 00:00:00,6")
    _write(scratch_dir, "c.csv", "datetime,Boston,Miami", *list(wrong)[3:])
    good, bad = CSV.read_quarantined(spark, scratch_dir, "temperature")
    assert _long(good) == [("01 00", "Boston", 6.0), ("01 00", "Miami", 5.0), ("31 00", "Boston", 1.0), ("31 00", "Miami", 2.0), ("31 01", "Miami", 4.0)]
    rows = bad.collect()
    assert {r.line: r.reason for r in rows} == wrong and len(rows) == len(wrong)
    assert {os.path.basename(r.file) for r in rows} == {"a.csv", "c.csv"}


def test_text_values_are_never_rejected(spark, scratch_dir):
    _write(scratch_dir, "a.csv", "datetime,Boston", "2017-10-31 00:00:00,light rain", "2017-10-31 01:00:00,")
    good, bad = CSV.read_quarantined(spark, scratch_dir, "weather_description")
    assert _long(good, "weather_description") == [("31 00", "Boston", "light rain")] and bad.count() == 0


def test_tables_without_datetime_pass(spark, scratch_dir):
    _write(scratch_dir, "a.csv", "City,Country", "Boston,United States", '"Washington, D.C.",United States')
    _write(scratch_dir, "b.csv", "Country,City", "Norway,Oslo")
    out = CSV.read_wide(spark, scratch_dir, "city_attributes")
    assert sorted((r.City, r.Country) for r in out.collect()) == [("Boston", "United States"), ("Oslo", "Norway"), ("Washington, D.C.", "United States")]
    assert sorted(out.columns) == ["City", "Country"]


def test_no_files_at_all(spark, scratch_dir):
    _write(scratch_dir, "note.txt", "x")
    with pytest.raises(FileNotFoundError):
        CSV.read_wide(spark, scratch_dir, "temperature")
