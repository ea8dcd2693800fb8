"""Deliveries in any layout and any order: columns by name, history of late files, orphans that wait."""

import datetime as dt
import gzip
import itertools
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from lendstar.operators import upsert
from lendstar.plans import pipeline
from lendstar.sources import files, versioned


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opened = gzip.open(path, "wt") if path.endswith(".gz") else open(path, "w")
    with opened as f:
        f.write(text)


def test_columns_by_header_name(spark, scratch):
    schema = _parse_datatype_string("a int, b int, c string")
    write(f"{scratch}/d/1.csv", "a;b;c\n1;2;x\n")
    write(f"{scratch}/d/2.csv", "c;B; a\ny;4;3\n")
    write(f"{scratch}/d/3.csv.gz", "﻿b;note;a\n6;n;5\nbad;n;7\n")
    write(f"{scratch}/d/_hidden.csv", "z\n1\n")
    write(f"{scratch}/d/empty.csv", "")
    write(f"{scratch}/d/header.csv", "a;b;c\n")
    df = files.read_delimited(spark, f"{scratch}/d", schema)
    assert df.columns == ["a", "b", "c", files.CORRUPT]
    good, bad = files.split_corrupt(df)
    assert sorted(map(tuple, good.collect())) == [(1, 2, "x"), (3, 4, "y"), (5, 6, None)]
    assert [r["raw_line"] for r in bad.collect()] == ["bad;n;7"]
    found = files.delivery_layouts(spark, files.data_files(spark, f"{scratch}/d"), schema)
    assert {(x.reordered, tuple(x.missing), tuple(x.extra), len(x.files)) for x in found} == {
        (False, (), (), 2), (True, (), (), 1), (True, ("c",), ("note",), 1)}
    for text, message in (("z;y\n1;2\n", "no declared column"), ("a;b;A\n1;2;3\n", "twice")):
        write(f"{scratch}/e/1.csv", text)
        with pytest.raises(ValueError, match=message):
            files.read_delimited(spark, f"{scratch}/e", schema)
    assert files.read_delimited(spark, f"{scratch}/none*", schema) is None


def history(deliveries):
    """(key, value, from, to) of deliveries {day: {key: value}} in order."""
    out = []
    for k in {k for rows in deliveries.values() for k in rows}:
        runs = []
        for day in sorted(deliveries):
            if k in deliveries[day] and (not runs or runs[-1][0] != deliveries[day][k]):
                runs.append((deliveries[day][k], day))
        out += [(k, v, d, runs[i + 1][1] - dt.timedelta(1) if i + 1 < len(runs) else None) for i, (v, d) in enumerate(runs)]
    return sorted(out, key=repr)


def test_history_of_any_order_of_deliveries(spark):
    """Every pattern of values and absences over four days, in every order of the days."""
    days = [dt.date(2025, 6, d) for d in (1, 8, 15, 22)]
    patterns = list(itertools.product(("a", "b", None, "-"), repeat=3))  # "-": not delivered
    rows = {d: {} for d in days}
    for k, p in enumerate(patterns):
        for d, v in zip(days, (*p, ("a", "b", "-")[k % 3])):
            if v != "-":
                rows[d][k] = v
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2), (2, 0, 3, 1)):
        versions, seen = {}, []
        for i in order:
            d = days[i]
            have = spark.createDataFrame([(k, v, f) for k, vs in versions.items() for v, f in vs], "k int, x string, valid_from date")
            delivery = spark.createDataFrame(list(rows[d].items()), "k int, x string")
            sighted = spark.createDataFrame(seen, "k int, as_of date")
            got = upsert.scd2_merge(have, delivery, "k", ["x"], d, sighted).collect()
            for k in {r["k"] for r in got}:
                versions[k] = [(r["x"], r["valid_from"]) for r in got if r["k"] == k]
                assert sum(r["is_current"] for r in got if r["k"] == k) == 1
            seen += [(k, d) for k in rows[d]]
            done = {days[j]: rows[days[j]] for j in order[:order.index(i) + 1]}
            assert {(k, v, f) for k, vs in versions.items() for v, f in vs} == {(k, v, f) for k, v, f, _ in history(done)}


def test_late_delivery_splits_a_published_version(spark, scratch):
    base = f"{scratch}/dim_account_history"
    frame = lambda **kv: spark.createDataFrame([(int(k[1:]), v) for k, v in kv.items()], "account_id int, x string")
    run = lambda day, **kv: pipeline.update_account_history(frame(**kv), base, day)
    read = lambda: {(r["account_id"], str(r["valid_from"])): r for r in versioned.read_current(spark, base).collect()}
    run("2025-06-01", k1="a", k2="a", k3="a")
    assert run("2025-06-15", k1="a", k2="b", k3="a")["row_count"] == 2
    before = read()
    assert run("2025-06-08", k1="z", k2="a", k3="a")["row_count"] == 3
    after = read()
    assert [(k, r["x"], str(r["valid_to"]), r["is_current"]) for k, r in sorted(after.items())] == [
        ((1, "2025-06-01"), "a", "2025-06-07", False), ((1, "2025-06-08"), "z", "2025-06-14", False),
        ((1, "2025-06-15"), "a", "None", True), ((2, "2025-06-01"), "a", "2025-06-14", False),
        ((2, "2025-06-15"), "b", "None", True), ((3, "2025-06-01"), "a", "None", True)]
    assert all(after[k]["version_key"] == r["version_key"] for k, r in before.items())
    assert len({r["version_key"] for r in after.values()}) == 6
    assert run("2025-06-08", k1="z", k2="a", k3="a")["message"] == "no changes"
    # A correction of the same day that equals its neighbours joins them again.
    run("2025-06-08", k1="a")
    assert [(k, r["x"]) for k, r in sorted(read().items()) if k[0] == 1] == [((1, "2025-06-01"), "a")]


def test_orphans_wait_for_their_account(spark, scratch):
    base = f"{scratch}/fact"
    dim = lambda *ids: spark.createDataFrame([(i,) for i in ids], "account_id int")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, account_id int, x string")
    load = lambda df, d: [(r["step"], r["status"], r["row_count"]) for r in
                          pipeline._load_fact(df, [(d, "account_id")], base, "id", "key")]
    assert load(rows((1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, None, "d")), dim(1)) == [
        ("fact", "ok", 1), ("fact_orphans", "warning", 3)]
    assert load(rows((2, 2, "new")), dim(1)) == [("fact", "ok", 0), ("fact_orphans", "warning", 3)]
    assert load(rows((9, 1, "z")).limit(0), dim(1, 2)) == [("fact", "ok", 1), ("fact_orphans", "warning", 2)]
    got = versioned.read_current(spark, base)
    assert {(r["id"], r["x"]) for r in got.collect()} == {(1, "a"), (2, "new")}
    versions = versioned.current_version(spark, f"{base}_orphans")
    load(rows((3, 3, "c")), dim(1, 2))
    assert versioned.current_version(spark, f"{base}_orphans") == versions  # nothing new waits
    assert load(rows((4, 3, "d")), dim(1, 2, 3)) == [("fact", "ok", 2), ("fact_orphans", "ok", 0)]
    assert versioned.read_current(spark, f"{base}_orphans").filter(F.col("id") > 0).count() == 0
