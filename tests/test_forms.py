"""Amounts and instants in every form that Python reads; Bronze files; positions; snapshot cells."""

import datetime as dt
import os
import tempfile
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from claimlake.functions import clean
from claimlake.operators import policy_history as ph
from claimlake.operators import reports
from claimlake.sources import bronze

AMOUNTS = ["1e2", "1E+2", "1_000.00", "12.30", "12.345", "1.2300e1", "1.2345e2", "12345e-2", "12345e-3", "0e5", "-1e2", "+5", ".5e1", "5.e0",
           "e5", "1e", "1e16", "1e15", "9999999999999999.99", "99999999999999999e-1", "0.0100e0", "1e-2", "1e-3", "10e-3", "NaN", "Infinity", "",
           "1_0e0_1", "00012e0", "0.00999999999999999999e0", "5.", "."]
STAMPS = ["2026-01-01T06:00:00Z", "2026-01-01T06:00Z", "2026-01-01T06Z", "2026-01-01 06:00:00.25+05:00", "2026-01-01T06:00:00+0500",
          "20260101T060000Z", "20260101T0600-0330", "2026-01-01T06:00:00+20:00", "2026-01-01T06:00:00+05:00:30", "2026-01-01T06:00:00-23:59",
          "2026-01-01T06:00:00.1234567+00:00", "2026-01-01x06:00+01:00", "2026-01-01T06:00:00", "2026-02-30T06:00Z", "2026-01-01T25:00Z",
          "2026-01-01", "2026-01-01T06:0000Z", "2026-01-01T06:00:00+24:00", "2026-01-01T06:00:00,5Z", "", "soon", "2026-01-01T06:61Z"]


def python_amount(text):
    try:
        value = Decimal(text or "invalid")
        if not value.is_finite() or value <= 0 or value >= Decimal("10000000000000000") or value != value.quantize(Decimal("0.01")):
            return None
        return value.quantize(Decimal("0.01"))
    except InvalidOperation:
        return None


def python_instant(text):
    try:
        stamp = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
        return None if stamp.tzinfo is None else stamp.astimezone(dt.timezone.utc).replace(tzinfo=None)
    except ValueError:
        return None


def test_amounts_read_as_python_reads_them(spark):
    frame = spark.createDataFrame([(a,) for a in AMOUNTS], "a string").select("a", clean.exact_money("a").alias("v"))
    assert {r["a"]: r["v"] for r in frame.collect()} == {a: python_amount(a) for a in AMOUNTS}


def test_instants_read_as_python_reads_them(spark):
    frame = spark.createDataFrame([(s,) for s in STAMPS], "s string").select(
        "s", F.date_format(clean.zoned_timestamp("s"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("v"))
    want = {s: python_instant(s) for s in STAMPS}
    assert {r["s"]: r["v"] for r in frame.collect()} == {s: v and v.strftime("%Y-%m-%d %H:%M:%S.%f") for s, v in want.items()}


@pytest.fixture(scope="module")
def tree():
    root = tempfile.mkdtemp(prefix="claimlake-csv-")
    files = {"a": "﻿x,y\r\n1,2\r\n\"1,5\",\"say \"\"no\"\"\"\r\n", "b": "\"x\",\"y\"\n1\n1,2,3\n", "c": "y,x\n", "d": ""}
    for name, text in files.items():
        with open(os.path.join(root, f"{name}.csv"), "w", encoding="utf-8", newline="") as fh:
            fh.write(text)
    return root


def test_headers_of_all_files_in_one_scan(spark, tree):
    found = bronze.header_contract(spark, tree, {"v1": ["x", "y"], "v2": ["x", "y", "z"]}).collect()
    assert {os.path.basename(r["source_file"]): (r["header"], r["contract"]) for r in found} == {
        "a.csv": ("x,y", "v1"), "b.csv": ('"x","y"', "v1"), "c.csv": ("y,x", None)}


def test_short_and_long_rows_are_marked(spark, tree):
    rows = bronze.read_whole_csv(spark, tree, ["x", "y"]).collect()
    got = {(os.path.basename(r["source_file"]), r["x"], r["y"] and r["y"].replace("\\", ""), r[bronze.MALFORMED]) for r in rows}
    assert {("a.csv", "1", "2", None), ("b.csv", "1", None, "1"), ("b.csv", "1", "2", "1,2,3")} <= got
    assert len(rows) == 4 and ("1,5" in {r["x"] for r in rows})


def test_positions_follow_the_global_order(spark):
    values = [(i * 7919) % 1000 for i in range(1000)]
    frame = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r["v"]: r["position"] for r in reports.positioned(frame, F.desc("v")).collect()}
    assert got == {v: n for n, v in enumerate(sorted(values, reverse=True), 1)}
    assert reports.positioned(frame.where("v < 0"), "v").count() == 0


def test_cells_name_what_changed(spark):
    schema = "k string, a int, b string"
    before = spark.createDataFrame([("x", 1, None), ("y", 2, "q"), ("z", 3, "r"), (None, 4, "s")], schema)
    after = spark.createDataFrame([("x", 1, "n"), ("y", 5, None), ("w", 1, "t"), (None, 4, "s")], schema)
    assert set(map(tuple, ph.snapshot_cells(before, after, "k").collect())) == {
        ("x", "changed", "b", None, "n"), ("y", "changed", "a", "2", "5"), ("y", "changed", "b", "q", None),
        ("z", "removed", None, None, None), ("w", "added", None, None, None)}
    assert ph.generation_digest(before).first() == ph.generation_digest(before.repartition(4).select("b", "k", "a")).first()
    assert ph.generation_digest(before).first() != ph.generation_digest(after).first()
    assert ph.generation_digest(before.limit(0)).first()["digest"] == 0
