"""Files, line protocol, layouts and the deterministic generators."""

import pytest
from pyspark.sql import functions as F

from lotwise.operators import warehouse as dw
from lotwise.sources import files
from lotwise.sources import generate as g
from lotwise.streaming.runtime import collected
from lotwise.sources.workspace import names, new_path, scratch, shared_folder, stage


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect() if names else df.collect()), key=repr)


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_scratch_tables_go_when_no_longer_needed(spark):
    folder = shared_folder(spark)
    before = set(names(spark, folder))
    with scratch(spark) as keep_outer:
        one = stage(spark.range(3), "one")
        with scratch(spark) as keep:
            stage(spark.range(4), "two")
            three = keep(stage(one.selectExpr("id + 1 AS id"), "three"))
        assert sorted(name.split("-")[0] for name in set(names(spark, folder)) - before) == ["one", "three"]
        keep_outer(three)
    assert [name.split("-")[0] for name in set(names(spark, folder)) - before] == ["three"]
    assert sorted(r[0] for r in three.collect()) == [1, 2, 3]
    with pytest.raises(ZeroDivisionError), scratch(spark):
        stage(spark.range(1), "failed")
        raise ZeroDivisionError
    assert len(set(names(spark, folder)) - before) == 1


def test_csv_keeps_bad_lines(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame([("code,credits",), ("A1,4.5",), ("B2,many",)], "value string").coalesce(1).write.text(path)
    found = files.read_csv(spark, path, "code string, credits double, _corrupt string")
    assert rows(found) == [("A1", 4.5, None), ("B2", None, "B2,many")]


def test_line_protocol(spark):
    lines = [
        "temperature,location=room1 value=23.5",
        "temperature,location=room2,floor=3 value=21.8,humidity=40i 1700000000000000000",
        "pressure value=1.5",
        "not a line",
    ]
    parsed = files.parse_line_protocol(spark.createDataFrame([(x,) for x in lines], "value string"))
    tagged = parsed.where("tags IS NOT NULL").orderBy(F.col("tags.location")).collect()
    found = [(r["measurement"], r["tags"], r["fields"], r["time_ns"]) for r in tagged]
    assert found == [
        ("temperature", {"location": "room1"}, {"value": 23.5}, None),
        ("temperature", {"location": "room2", "floor": "3"}, {"value": 21.8, "humidity": 40.0}, 1700000000000000000),
    ]
    assert parsed.count() == 3


def test_line_protocol_with_escapes(spark):
    lines = [
        r'my\ sensor\,a,room=up\ stairs,a\=b=c\,d temp=21.5,note="a, \"b\" = c",on=true,n=5i,u=7u 1000',
        "plain value=1",
        "m,t=1,t=2 v=1 5",  # a tag twice
        "m v=1,v=2 5",
        "m,t=1 5",
        "m,t= v=1",
        "no fields",
        "",
        "m,t=ü v=-1e3   -7  ",
    ]
    found = files.parse_line_protocol(spark.createDataFrame([(line,) for line in lines], "value string")).collect()
    assert [tuple(r) for r in found] == [
        ("my sensor,a", {"room": "up stairs", "a=b": "c,d"}, {"temp": 21.5, "note": None, "on": None, "n": 5.0, "u": 7.0}, 1000),
        ("plain", None, {"value": 1.0}, None),
        ("m", {"t": "ü"}, {"v": -1000.0}, -7),
    ]


def test_lines_as_a_stream(spark):
    path = new_path(spark, "lines")
    for part in range(3):
        lines = [(f"m{part},t=a v={n}" + (f" {n}" if n % 2 else ""),) for n in range(10)] + [("broken",)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)
    batch = files.with_arrival(spark.read.text(path).select("value", F.col("_metadata.file_modification_time").alias("arrived")))
    streamed = collected(files.line_stream(spark, path, files_per_batch=1))
    assert rows(streamed) == rows(batch) and streamed.count() == 30
    assert streamed.where("time_ns IS NULL OR time_ns > 1000000000000000000").count() == 15


def test_json_arrays(spark):
    path = new_path(spark, "arrays")
    files.write_json_arrays(spark.range(25), path, F.floor(F.col("id") / 10))
    assert files.read_json_arrays(spark, path, "id bigint, chunk bigint").agg(F.sum("id")).first()[0] == 300


def test_partitioned_write_splits_nothing_away(spark):
    path = new_path(spark, "parts")
    df = spark.range(1000).withColumn("part", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")))
    files.write_partitioned(df, path, "part")
    back = files.read_partitioned(spark, path, "id bigint, part string")
    assert rows(back.groupBy("part").count()) == rows(df.groupBy("part").count())


def test_store_checks(spark):
    checks = g.store_checks(g.series(spark, 1, 70000)).unionByName(g.planted_checks(spark, 70001))
    assert checks.count() == 70004
    day = "shop_id = 77 AND sold_at >= timestamp_ntz'2025-02-14 00:00:00' AND sold_at < timestamp_ntz'2025-02-15 00:00:00'"
    found = checks.where(day)
    assert {"target-1", "target-2", "target-3"} <= {r["cashier_note"] for r in found.collect()}
    assert "outside-range" not in {r["cashier_note"] for r in found.collect()}
    first = checks.where("id = 8").first()
    assert (first["shop_id"], first["payment_type"], str(first["total_sum"])) == (185, "cash", "3.28")


def test_club(spark):
    members, visits = g.club_members(g.series(spark, 1, 22000)), g.club_visits(g.series(spark, 1, 110000))
    counts = dict(rows(members.groupBy("member_level").count()))
    expected = {"premium": 0, "plus": 0, "base": 0}
    for i in range(1, 22001):
        expected["premium" if i % 15 == 0 else "plus" if i % 4 == 0 else "base"] += 1
    assert counts == expected
    assert visits.join(members, F.col("member_id") == members["id"], "left_anti").count() == 0


def test_shipments(spark):
    assert dict(rows(g.shipments(spark).groupBy("region_code").count())) == {"north": 900, "south": 900, "west": 900, "east": 120}


def test_skew_and_nulls(spark):
    keys = spark.range(20000)
    position = g.skewed_position(F.col("id"), F.lit(1000).cast("bigint"))
    share = keys.where(position < 100).count() / 20000
    assert 0.68 < share < 0.78
    assert 0.10 < keys.where(g.chance(F.col("id"), 4, 12)).count() / 20000 < 0.14


def test_catalogue_cleaning(spark):
    raw = spark.createDataFrame(
        [(" a1 ", "First", "4", "u1 ", 1), ("A1", " Second ", "x", "U1", 2), ("b2", "Other", None, "u9", 3)],
        "code string, title string, ects_credits string, unit_code string, position int",
    )
    cleaned = dw.clean_catalogue(raw, "position")
    assert rows(cleaned, "code", "title", "ects_credits", "unit_code") == [("A1", "Second", None, "U1"), ("B2", "Other", None, "U9")]
    units = spark.createDataFrame([(7, "U1"), (5, "U1")], "unit_id int, code_of string")
    found = dw.resolve_parent(cleaned, "unit_code", units, "code_of", "unit_id")
    assert rows(found, "code", "unit_id") == [("A1", 5), ("B2", None)]


def test_room_cleaning(spark):
    raw = spark.createDataFrame(
        [(" Main", "1 ", None, 10, None, True, None, None, 1), ("Main", "1", "North", 99, False, False, False, "closed", 2)],
        "building string, room_number string, campus string, capacity int, has_projector boolean, has_pc boolean, is_accessible boolean, status string, position int",
    )
    cleaned = dw.clean_rooms(raw, "position")
    assert rows(cleaned) == [("Main", "1", "", 10, False, True, False, "active", 1)]


def test_surrogate_keys_repeat(many_slices):
    names = many_slices.createDataFrame([(f"k{i:03}",) for i in range(200)], "code string").repartition(5)
    once, again = dw.dimension(names, "code", "n"), dw.dimension(names, "code", "n")
    assert rows(once) == rows(again) == [(f"k{i:03}", i + 1) for i in range(200)]
