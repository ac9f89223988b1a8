"""Unions of parcels, the full locator, versioned tables, digests, filled ids and specs applied to data."""

import math
import random
import uuid
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from acreage.operators import applications as apps
from acreage.operators import locating, locator, outlines, parcels, specs, spread, syncing
from acreage.sources import sinks

VERTICES = "PID string, ring int, seq int, x double, y double"


def ring(pid, corners, number=0):
    return [(f"{pid:0>8}", number, k, float(x), float(y)) for k, (x, y) in enumerate(corners)]


def square(pid, x, y, size=10, number=0):
    return ring(pid, [(x, y), (x + size, y), (x + size, y + size), (x, y + size)], number)


def union(spark, rows, listed):
    found = spark.createDataFrame([(1, listed)], "Planning_App_Num bigint, PIDs string")
    vertices = spark.createDataFrame(rows, VERTICES)
    area = apps.dissolve_area(found, vertices).first()
    rings = defaultdict(list)
    for r in apps.app_outline_rings(found, vertices).orderBy("ring", "seq").collect():
        rings[r["ring"], r["hole"]].append((r["x"], r["y"]))
    return area, dict(rings)


def signed(corners):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(corners, corners[1:] + corners[:1])) / 2


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_side_split_on_one_side(request, settings):
    spark = request.getfixturevalue(settings)
    # the left square's right side meets two smaller squares
    rows = square(1, 0, 0) + square(2, 10, 0, 5) + square(3, 10, 5, 5)
    area, rings = union(spark, rows, "1, 2, 3")
    assert (area["area"], area["perimeter"], area["dissolve_check"]) == (150.0, 50.0, True)
    assert len(rings) == 1 and signed(rings[1, False]) == 150.0


def test_slanted_side_is_cut_near_its_line(spark):
    third = (10 / 3, 20 / 3)
    rows = ring(1, [(0, 0), (10, 20), (0, 20)]) + ring(2, [(0, 0), (9, 0), third]) + ring(3, [third, (9, 0), (10, 20)])
    area, rings = union(spark, rows, "1, 2, 3")
    whole = [(0, 0), (9, 0), (10, 20), (0, 20)]
    edges = sum(math.dist(a, b) for a, b in zip(whole, whole[1:] + whole[:1]))
    assert area["perimeter"] == pytest.approx(edges) and area["area"] == pytest.approx(signed(whole))
    assert rings == {(1, False): [(0.0, 0.0), (9.0, 0.0), (10.0, 20.0), (0.0, 20.0)]}


def test_parcel_given_twice_counts_once(spark):
    rows = square(1, 0, 0) + square(2, 0, 0) + square(3, 10, 0)
    area, rings = union(spark, rows, "1, 2, 3")
    assert (area["area"], area["perimeter"], area["pids_found"], area["dissolve_check"]) == (200.0, 60.0, 3, False)
    assert [signed(r) for r in rings.values()] == [200.0]


def test_rings_that_touch_in_a_corner_stay_apart(spark):
    area, rings = union(spark, square(1, 0, 0) + square(2, 10, 10), "1, 2")
    assert sorted((k, signed(r)) for k, r in rings.items()) == [((1, False), 100.0), ((2, False), 100.0)]
    assert all(len(r) == 4 for r in rings.values()) and area["n_edges"] == 8


def test_holes_are_told_by_their_sign(spark):
    # eight squares around a gap, and a parcel with a hole of its own, wound the wrong way round
    around = [square(k, 10 * x, 10 * y) for k, (x, y) in enumerate([(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2), (2, 2)], 1)]
    pierced = ring(9, [(40, 0), (40, 10), (50, 10), (50, 0)]) + ring(9, [(43, 3), (46, 3), (46, 6), (43, 6)], 1)
    area, rings = union(spark, sum(around, []) + pierced, "1,2,3,4,5,6,7,8,9")
    assert {(k[1], signed(r)) for k, r in rings.items()} == {(False, 900.0), (True, -100.0), (False, 100.0), (True, -9.0)}
    assert area["area"] == 891.0 and [k[0] for k in rings] == [1, 2, 3, 4]


def test_partial_overlap_is_marked_and_has_no_rings(spark):
    area, rings = union(spark, square(1, 0, 0) + square(2, 5, 0), "1, 2")
    assert area["dissolve_check"] in (True, False) and rings == {}


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_long_ring_is_ranked(request, settings):
    spark = request.getfixturevalue(settings)
    corners = [(round(1000 * math.cos(2 * math.pi * k / 300), 3), round(1000 * math.sin(2 * math.pi * k / 300), 3)) for k in range(300)]
    area, rings = union(spark, ring(1, corners) + square(2, 5000, 0), "1, 2")
    first = min(range(300), key=lambda k: corners[k])
    assert rings[1, False] == corners[first:] + corners[:first] and signed(rings[2, False]) == 100.0
    assert area["area"] == pytest.approx(signed(corners) + 100)


def test_no_parcels_no_rings(spark):
    area, rings = union(spark, square(1, 0, 0), "7")
    assert area is None and rings == {}


def test_parcel_of_many_rings(crowded):
    rows = [r for k in range(400) for r in square(1, 20 * k, 0, 10, k)] + square(2, 0, 50)
    vertices = crowded.createDataFrame(rows, VERTICES)
    got = {r["PID"]: (r["area"], r["perimeter"]) for r in parcels.parcel_measures(vertices).collect()}
    assert got == {"00000001": (40_000.0, 16_000.0), "00000002": (100.0, 40.0)}
    edges = parcels.edges(vertices)
    assert edges.select("PID", "ox", "oy").distinct().count() == 2
    # no window over all rings of a parcel
    assert not any("PID" in line and "ring" not in line for line in edges._jdf.queryExecution().toString().splitlines() if "Window [" in line)


def test_join_with_keys_heavy_on_either_side(crowded):
    rng = random.Random(1)
    left = [(rng.choice("aabc"), k) for k in range(60)] + [(None, 99)]
    right = [(rng.choice("abbbd"), k) for k in range(70)] + [("b", 500)] * 9 + [(None, 99)]
    one = crowded.createDataFrame(left, "k string, x int")
    two = crowded.createDataFrame(right, "k string, y int")
    got = Counter((r["k"], r["x"], r["y"]) for r in spread.salted_join(one, two, ["k"], ["x"]).collect())
    assert got == Counter((a, x, y) for a, x in left for b, y in right if a is not None and a == b)


# the full locator


def names(rng, count, ending=""):
    return sorted({"".join(rng.choice("ABCDEFGHILMNORSTU") for _ in range(rng.randrange(4, 9))) + ending for _ in range(count)})


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("settings", ["spark", "crowded"])
@pytest.mark.parametrize("minimum", [50, 60, 80])
def test_similar_names_against_all_pairs(request, settings, minimum):
    spark, rng = request.getfixturevalue(settings), random.Random(minimum)
    ours = names(rng, 60) + ["AAAA", "AAAAAAAA", "A"]
    changed = [n[:2] + "X" + n[3:] for n in ours[:30]] + [n + "ES" for n in ours[20:40]] + [n[1:] for n in ours[30:50]]
    theirs = sorted(set(names(rng, 40) + changed + ["AAAAA", "A", "AB"]))
    one = spark.createDataFrame([(n,) for n in ours], "name string")
    two = spark.createDataFrame([(n,) for n in theirs], "their_name string")
    got = {(r[0], r[1]): r[2] for r in locator.similar_names(one, two, minimum).collect()}
    score = lambda a, b: 100 * (max(len(a), len(b)) - edits(a, b)) // max(len(a), len(b))
    assert got == {(a, b): score(a, b) for a in ours for b in theirs if score(a, b) > minimum}


def test_a_common_ending_does_not_make_candidates(spark):
    rng = random.Random(5)
    rows = [(n,) for n in names(rng, 150, " STREET")]
    split = spark.createDataFrame(rows, "s string").select(locator.address_fields(*[F.col("s")] * 8)["name"].alias("name"))
    assert not split.where(F.col("name").contains("STREET")).count()
    pairs = locator.name_candidates(split, split.withColumnRenamed("name", "their_name")).count()
    assert pairs < len(rows) ** 2 / 10


def test_fields_of_an_address(spark):
    rows = [("12 A", "main  st", None, "b3h 4r2"), ("7", "The Parkway", "Road", " "), ("7", "Street", None, None)]
    df = spark.createDataFrame(rows, "n string, s string, t string, p string")
    none = F.lit(None).cast("string")
    made = locator.address_fields(F.col("n"), F.col("s"), F.col("t"), none, none, none, none, F.col("p"))
    got = df.select(*(made[c].alias(c) for c in ("house", "name", "type", "postal"))).collect()
    assert [tuple(r) for r in got] == [("12A", "MAIN", "ST", "B3H4R2"), ("7", "THE", "RD", None), ("7", "STREET", None, None)]


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_main_street_matches_main(request, settings):
    spark = request.getfixturevalue(settings)
    civics = spark.createDataFrame(
        [
            (1, "5", "MAIN", "ST", None, "D1", "HERE", "M", "B3H 1A1", 1.0, 1.0),
            (2, "5", "MAIN", "RD", None, "D1", "HERE", "M", "B3H 1A1", 2.0, 2.0),
            (3, "5", "MAIN", "ST", "4", "D2", "THERE", "M", "B4H 1A1", 3.0, 3.0),
            (4, "5", None, "ST", "4", "D2", "THERE", "M", None, 4.0, 4.0),
        ],
        "CIV_ID int, FULL_CIVIC string, STR_NAME string, STR_TYPE string, UNIT_NUM string, DISTRICT string, GSA_NAME string, "
        "MUN_CODE string, CIV_POSTAL string, X double, Y double",
    )
    permits = [
        (1, "5", "Main St", None, None, None, "Here", None, None),
        (2, "5", "Main Rd", None, None, None, "Here", None, None),
        (3, "5", "Main", "Street", "4", None, None, None, "B4H1A1"),
        (4, "5", "Mian", None, None, None, "Here", None, None),
        (5, "6", "Main", None, None, None, "Here", None, None),
        (6, "5", "Main", None, None, None, None, None, None),
        (7, None, None, None, None, None, None, None, None),
    ]
    given = spark.createDataFrame(permits, "no int, Civic_Number string, Street_Name string, Street_Type string, Unit string, District string, Community string, Municipality string, Postal string")
    got = {r["no"]: (r["match_id"], r["score"]) for r in locator.geocode(given, civics).collect()}
    # two letters changed round are two edits of four: no match
    assert got == {1: (1, 100), 2: (2, 100), 3: (3, 100), 4: (None, None), 5: (None, None), 6: (1, 100), 7: (None, None)}
    assert locator.geocode(given, civics.limit(0)).where("match_id IS NOT NULL").count() == 0


# versioned tables


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


def test_readers_see_the_old_table_until_the_new_one_is_whole(spark, path):
    rows = spark.range(10).toDF("a")
    assert sinks.load(rows, path) == (0, 10)
    broken = rows.withColumn("a", F.when(F.col("a") < 9, F.col("a")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")))
    with pytest.raises(PySparkException):
        sinks.load(broken, path)
    assert sinks.stored(spark, path).count() == 10 and len(sinks.manifests(spark, path)) == 1
    # a table can be loaded from itself
    assert sinks.load(sinks.stored(spark, path).where("a > 3"), path) == (10, 6)
    assert sinks.stored(spark, path, 1).count() == 10 and sinks.stored(spark, path).count() == 6
    assert sinks.drop_versions(spark, path) and sinks.stored(spark, path).count() == 6 and len(sinks.manifests(spark, path)) == 1


def test_appends_add_parts_and_empty_loads_change_nothing(spark, path):
    rows = spark.range(4).toDF("a")
    assert sinks.load_guarded(rows.limit(0), path) == (0, 0) and sinks.stored(spark, path) is None
    assert sinks.load_guarded(rows, path) == (0, 4) and sinks.load_guarded(rows, path, truncate=False) == (4, 8)
    assert sinks.load_guarded(rows.where("a > 9"), path) == (8, 8) and sinks.load_guarded(rows.limit(0), path, truncate=False) == (8, 8)
    assert sorted(r["a"] for r in sinks.stored(spark, path).collect()) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert len(sinks.manifest(spark, path).parts) == 2 and sinks.row_count(spark, path) == 8


def test_plain_tables_become_versioned(spark, path):
    rows = spark.range(4).toDF("a")
    rows.write.parquet(path)
    assert sinks.load_guarded(rows, path, truncate=False) == (4, 8) and sinks.stored(spark, path).count() == 8
    # readers that know no manifests still see the table they had
    assert spark.read.parquet(path).count() == 4
    assert sinks.load(rows.limit(0), path) == (8, 0) and sinks.stored(spark, path).count() == 0
    assert sinks.stored(spark, path).columns == ["a"]


def test_two_loads_at_once_do_not_both_win(spark, path, monkeypatch):
    sinks.load(spark.range(3).toDF("a"), path)
    known = sinks.manifest(spark, path)
    sinks.load(spark.range(4).toDF("a"), path)
    monkeypatch.setattr(sinks, "manifest", lambda *_: known)
    with pytest.raises(RuntimeError):
        sinks.publish(spark.range(5).toDF("a"), path)
    monkeypatch.undo()
    assert sinks.stored(spark, path).count() == 4


# copies and ids


@pytest.mark.parametrize("ranges", [1, 7, 4096])
def test_changes_by_digests(spark, ranges):
    rng = random.Random(3)
    old = {k: (rng.randrange(5), None if k % 9 == 0 else f"t{k}") for k in range(200)}
    new = {k: v for k, v in old.items() if k % 17}
    new |= {k: (v[0], "new") for k, v in new.items() if k % 23 == 0}
    new |= {k: (1, None) for k in range(300, 310)}
    schema = "k int, a int, b string"
    rw, ro = (spark.createDataFrame([(k, *v) for k, v in d.items()] + [(None, 1, "x")], schema) for d in (new, old))
    got = Counter((r["k"], r["a"], r["b"], r["change"]) for r in syncing.sync_changes(rw, ro, ["k"], ranges).collect())
    want = Counter((k, *new[k], "insert") for k in new.keys() - old.keys())
    want += Counter((k, *old[k], "delete") for k in old.keys() - new.keys())
    want += Counter((k, *new[k], "update") for k in new.keys() & old.keys() if new[k] != old[k])
    keyless = Counter({(None, 1, "x", "insert"): 1, (None, 1, "x", "delete"): 1})
    assert got - keyless == want and got in (want, want + keyless)
    assert syncing.differing_ranges(ro, ro, ["k"], ranges).count() == 0
    assert syncing.sync_changes(ro, ro, ["k"], ranges).count() == 0


def test_ids_are_filled_later(spark, path):
    rows = spark.createDataFrame([(k, f"A{k}" if k in (3, 8) else None) for k in range(12)], "k int, id string")
    once = syncing.fill_sequence_ids(rows, ["k"], "id", path, "A")
    first = {r["k"]: r["id"] for r in once.collect()}
    # ids that are there stay, and the others go on from the highest
    assert first[3] == "A3" and first[8] == "A8" and sorted(int(i[1:]) for i in first.values()) == [3, *range(8, 19)]
    kept = spark.createDataFrame(list(first.items()), "k int, id string")
    more = kept.unionByName(spark.createDataFrame([(50, None), (40, None)], "k int, id string"))
    second = {r["k"]: r["id"] for r in syncing.fill_sequence_ids(more, ["k"], "id", path, "A").collect()}
    assert second == {**first, 40: "A19", 50: "A20"}
    third = {r["k"]: r["id"] for r in syncing.fill_sequence_ids(spark.createDataFrame(list(second.items()), "k int, id string"), ["k"], "id", path, "A").collect()}
    assert third == second
    assert syncing.fill_sequence_ids(rows.limit(0), ["k"], "id", path, "A").count() == 0


def test_placed_permits_of_no_category_are_reported(spark):
    rows = [(None, "1", "p", "civic"), ("Building", "2", "p", "civic"), ("Odd", "3", "p", "parcel"), ("Odd", "4", "p", None)]
    located = spark.createDataFrame(rows, "Permit_Category string, Permit_Number string, PID string, method string")
    got = {(r["Permit_Number"], r["section"]) for r in locating.uncategorised(located, ["Building"]).collect()}
    assert got == {("1", "Unknown_Category"), ("3", "Unknown_Category")}


# specs


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_cells_are_held_against_their_spec(request, settings):
    spark = request.getfixturevalue(settings)
    schema = spark.createDataFrame(
        [(1, 5, "N", "int", None, "7", None), (1, 6, "T", "string", 3, None, "D"), (1, 7, "N", "string", 1, None, None), (2, 5, "D", "date", None, None, "none")],
        "form_id int, row_no int, field_name string, spark_type string, length int, default_value string, domain string",
    )
    codes = spark.createDataFrame([(1, "D", "a", "Alpha"), (1, "D", "long", "Long")], "form_id int, domain string, code string, description string")
    table = spark.createDataFrame([(1, "12", "a"), (2, None, "long"), (3, "x", "b"), (4, " 5 ", None)], "r int, n string, t string")
    data = specs.long_form(table, 1, "r").unionByName(
        spark.createDataFrame([(2, 1, "d", "2024-02-30"), (2, 2, "d", "2024-02-29"), (2, 2, "q", "1"), (2, 2, "D", "2024-03-01"), (9, 1, "a", "b")], "form_id int, record int, field string, value string")
    )
    checked = specs.checked_cells(data, schema, codes)
    filled = {(r["form_id"], r["record"], r["field"]): (r["value"], r["is_default"], r["description"]) for r in specs.filled_cells(checked).collect()}
    assert filled == {
        (1, 1, "N"): ("12", False, None), (1, 2, "N"): ("7", True, None), (1, 3, "N"): (None, False, None), (1, 4, "N"): ("5", False, None),
        (1, 1, "T"): ("a", False, "Alpha"), (1, 2, "T"): ("long", False, "Long"), (1, 3, "T"): ("b", False, None), (1, 4, "T"): (None, False, None),
        (2, 1, "D"): (None, False, None), (2, 2, "D"): ("2024-02-29", False, None),
    }
    bad = {(r["form_id"], r["record"], r["field"], r["rule"], r["value"]) for r in specs.cell_violations(checked).collect()}
    assert bad == {
        (1, 2, "T", "too_long", "long"), (1, 3, "N", "bad_type", "x"), (1, 3, "T", "not_in_domain", "b"),
        (2, 1, "D", "bad_type", "2024-02-30"), (2, 2, "Q", "unknown_field", "1"), (2, 2, "D", "repeated", "2024-02-29"),
        (9, 1, "A", "unknown_field", "b"),
    }


def test_outline_pieces_of_no_rows(spark):
    assert outlines.corners_on_sides(spark.createDataFrame([], "PID string, x0 double, y0 double, x1 double, y1 double")).count() == 0
