"""Edge cases of single operators, and properties that hold for any data."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.functions import projection
from acreage.functions import text as t
from acreage.functions.markup import without_tags
from acreage.operators import addresses, cleaning, domains, duplicates, forms, locating, metadata, parcels, quality
from acreage.operators import applications as apps
from acreage.operators import syncing
from acreage.plans import permits as jobs
from acreage.plans.queries import TIES, _Inputs
from acreage.session import fresh_folder, stored
from acreage.sources import sinks, tables


def value(spark, column, text, kind="string"):
    return spark.createDataFrame([(text,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, listed, primary",
    [
        (" , ", [], None),
        (", 12", ["00000012"], None),
        ("123456789", ["123456789"], "123456789"),
        ("5, 5", ["00000005", "00000005"], "00000005"),
        ("00130278, 00130286", ["00130278", "00130286"], "00130278"),
        (" 7 ,8", ["00000007", "00000008"], "00000007"),
        ("", [], None),
        (None, [], None),
    ],
)
def test_pid_lists(spark, text, listed, primary):
    assert value(spark, t.pid_list, text) == listed
    assert value(spark, t.primary_pid, text) == primary


@pytest.mark.parametrize("text, number", [("1e3", 1000), ("12", 12), ("x", None), (None, None), ("9007199254740993", 9007199254740993)])
def test_whole_numbers(spark, text, number):
    assert value(spark, t.whole_number, text) == number


def test_text_functions(spark):
    assert value(spark, t.single_spaced, "a  b  c d") == "a b c d"
    assert value(spark, t.known, "nan") is None and value(spark, t.known, "None") is None
    assert value(spark, t.filled, "  ") is None
    assert value(spark, lambda c: t.tag_text(c, "a"), "<a>1\n2</a><a>3</a>") == "3"
    assert value(spark, lambda c: t.tag_text(c, "a"), "<b>1</b>") is None
    twice = "<a>1</a>x<a>1</a><a>2</a>"
    assert value(spark, lambda c: t.with_tag_text(c, "a", F.lit("9")), twice) == "<a>9</a>x<a>9</a><a>2</a>"
    assert value(spark, without_tags, "&lt;b&gt;A&amp;B&lt;/b&gt; <i>c</i>") == "A&B c"
    assert value(spark, without_tags, None) is None
    assert value(spark, t.category_of_file, "PPLC_Issued_Halifax_Water_Permits.csv") == "Halifax_Water"
    assert value(spark, t.category_of_file, "other.csv") == ""


def permit_rows(spark, rows):
    names = "Permit_Category string, Permit_Number string, PID string, Active_Parcel string, Occupancy_Type string, n int"
    return spark.createDataFrame([("Building", *r) for r in rows], names)


def related_of(spark, rows):
    return sorted((r["Permit_Number"], r["PID"]) for r in duplicates.related_rows(permit_rows(spark, rows), ["n"]).collect())


def test_rule_one_removes_first_row_and_its_copies(spark):
    rows = [("p", "1", "Y", "R", 1), ("p", "1", "Y", "R", 1), ("p", "2", "Y", "R", 2)]
    assert related_of(spark, rows) == [("p", "2")]


def test_rule_two_removes_active_rows(spark):
    rows = [("p", "1", "Y", "R", 1), ("p", "2", "N", "R", 2), ("p", "3", None, "R", 3)]
    assert related_of(spark, rows) == [("p", "2"), ("p", "3")]


def test_null_counts_as_a_value(spark):
    rows = [("p", None, "Y", "R", 1), ("p", "2", "Y", "R", 2), ("q", "1", "Y", "R", 1), ("q", "2", "Y", None, 2)]
    assert related_of(spark, rows) == [("p", "2"), ("q", "1"), ("q", "2")]


def test_permits_without_a_number_are_one_permit_and_exempt_from_rules(spark):
    df = permit_rows(spark, [(None, "1", "Y", "R", 1), (None, "2", "Y", "R", 2)])
    assert duplicates.permits_unique(df, ["n"]).count() == 1
    assert duplicates.related_rows(df, ["n"]).count() == 2


def test_null_status_outranks_active_unless_asked(spark):
    df = permit_rows(spark, [("p", "1", "Y", "R", 1), ("p", "2", None, "R", 0), ("p", "3", "N", "R", 3)])
    assert duplicates.permits_unique(df, ["n"]).first()["PID"] == "2"
    assert duplicates.permits_unique(df, ["n"], prefer_active=True).first()["PID"] == "1"


def test_additions_to_an_empty_related_table(spark):
    unique = permit_rows(spark, [("p", "1", "Y", "R", 1), ("q", "2", "Y", None, 1)])
    related = duplicates.related_rows(unique, ["n"])
    got = duplicates.related_table(unique, related).collect()
    assert [tuple(r) for r in got] == [("Building", "p", "00000001", "R", "Y")]


def test_frames_without_occupancy_keep_all_extra_rows(spark):
    df = permit_rows(spark, [("p", "1", "Y", "R", 1), ("p", "2", "Y", "R", 2), ("p", "3", "N", "R", 3)]).drop("Occupancy_Type")
    got = duplicates.related_rows(df, ["n"])
    assert got.columns == ["Permit_Category", "Permit_Number", "PID", "Active_Parcel"]
    assert sorted(r["PID"] for r in got.collect()) == ["1", "3"]


def by_loop(frame):
    """The duplicate rules, permit by permit."""
    kept = []
    for _, g in frame.groupby("Permit_Number", sort=False):
        if len(g) < 2:
            continue
        npid, nocc = len(g["PID"].unique()), len(g["Occupancy_Type"].unique())
        active = g["Active_Parcel"] == "Y"
        if npid > 1 and nocc == 1:
            g = g[g["n"] != g["n"].min()] if active.all() else g[~active]
        kept += list(zip(g["Permit_Number"], g["n"], strict=True))
    return sorted(kept)


def test_rules_agree_with_a_loop(crowded):
    frame = pd.DataFrame(
        [
            (f"p{i % 23}", None if i % 7 == 0 else str(i % 5), "Y" if i % 23 % 2 or i % 3 else "N", "R" if i % 23 % 3 else str(i % 2), i)
            for i in range(200)
        ],
        columns=["Permit_Number", "PID", "Active_Parcel", "Occupancy_Type", "n"],
    )
    df = permit_rows(crowded, [tuple(r) for r in frame.itertuples(index=False)])
    got = duplicates.related_rows(df.withColumn("Permit_Number", F.concat_ws("#", "Permit_Number")), ["n"])
    pairs = df.select("Permit_Number", "PID", "Active_Parcel", "Occupancy_Type", "n")
    want = pd.DataFrame(by_loop(frame), columns=["Permit_Number", "n"]).merge(pairs.toPandas())
    key = ["Permit_Number", "PID", "Active_Parcel", "Occupancy_Type"]
    assert sorted(map(repr, got.select(*key).collect())) == sorted(map(repr, crowded.createDataFrame(want[key], "a string, b string, c string, d string").toDF(*key).collect()))


def vertices(spark, shapes):
    rows = [(pid, ring, i, float(x), float(y)) for pid, rings in shapes.items() for ring, pts in enumerate(rings) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "PID string, ring int, seq int, x double, y double")


BASE = (25560000, 4950000)


def moved(points, dx=0, dy=0):
    return [(BASE[0] + x + dx, BASE[1] + y + dy) for x, y in points]


SQUARE = [(0, 0), (20, 0), (20, 20), (0, 20)]
U_SHAPE = [(0, 0), (20, 0), (20, 20), (16, 20), (16, 4), (4, 4), (4, 20), (0, 20)]
HOLE = [(5, 5), (5, 15), (15, 15), (15, 5)]


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_geometry(request, settings):
    spark = request.getfixturevalue(settings)
    shapes = {"s": [moved(SQUARE)], "u": [moved(U_SHAPE)], "h": [moved(SQUARE), moved(HOLE)]}
    df = vertices(spark, shapes)
    sizes = {r["PID"]: (r["area"], r["perimeter"]) for r in parcels.parcel_measures(df).collect()}
    assert sizes == {"s": (400.0, 80.0), "u": (208.0, 112.0), "h": (300.0, 120.0)}
    inside = {r["PID"]: r["inside"] for r in parcels.centroid_inside(df).collect()}
    assert inside == {"s": True, "u": False, "h": False}
    points = {r["PID"]: (r["x"] - BASE[0], r["y"] - BASE[1], r["kind"]) for r in parcels.parcel_point(df).collect()}
    assert points["s"] == (10.0, 10.0, "centroid")
    assert points["u"] == (2.0, 12.0, "label")
    assert points["h"][2] == "label" and not (5 < points["h"][0] < 15)


def test_first_parcel_row_wins(spark):
    two = vertices(spark, {"a": [moved(SQUARE)]}).withColumn("oid", F.lit(2)).unionByName(
        vertices(spark, {"a": [moved(U_SHAPE)]}).withColumn("oid", F.lit(1))
    )
    assert parcels.parcel_measures(parcels.first_parcels(two, "oid")).first()["area"] == 208.0


@pytest.mark.parametrize("settings", ["spark", "crowded"])
def test_adjacent_parcels_dissolve_in_any_order(request, settings):
    spark = request.getfixturevalue(settings)
    df = vertices(spark, {"00000001": [moved(SQUARE)], "00000002": [moved(SQUARE, dx=20)]})
    rows = spark.createDataFrame([(1, "1, 2"), (2, "2,1,2, 9"), (3, "9"), (4, None)], "Planning_App_Num int, PIDs string")
    got = {r["Planning_App_Num"]: r for r in apps.locate_apps_polygon(rows, df).collect()}
    for n in (1, 2):
        assert (got[n]["area"], got[n]["perimeter"], got[n]["dissolve_check"]) == (800.0, 120.0, True)
    assert (got[2]["pids_total"], got[2]["pids_found"]) == (3, 2)
    assert (got[3]["status"], got[4]["status"]) == ("unlocated", "no_pid")


@pytest.mark.parametrize("settings", ["spark", "crowded"])
@pytest.mark.parametrize("minimum", [60, 20])
def test_addresses_against_all_pairs(request, settings, minimum):
    import random

    spark = request.getfixturevalue(settings)
    random.seed(11)
    names = ["".join(random.choice("ABC") for _ in range(random.randrange(1, 9))) for _ in range(60)]
    wanted = [(str(i % 2), s, "T") for i, s in enumerate(names[:30])]
    civics = [(i, str(i % 2), s, "T", float(i), float(-i)) for i, s in enumerate(names[30:])]
    a = spark.createDataFrame(wanted, "house string, street string, community string")
    c = spark.createDataFrame(civics, "CIV_ID int, house string, street string, community string, X double, Y double")
    got = {(r["house"], r["street"]): (r["score"], r["match_id"]) for r in addresses.match_addresses(a, c, minimum).collect()}

    def distance(p, q):
        row = list(range(len(q) + 1))
        for i, x in enumerate(p, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(q, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {}
    for house, street, _ in wanted:
        scores = [
            (100 * (max(len(street), len(s)) - distance(street, s)) // max(len(street), len(s)), -i)
            for i, h, s, *_ in civics
            if h == house
        ]
        best = max(scores)
        if best[0] > minimum:
            want[house, street] = (best[0], -best[1])
    assert got == want


def test_score_of_sixty_is_no_match(spark):
    a = spark.createDataFrame([("1", "ABCDE", "T")], "house string, street string, community string")
    c = spark.createDataFrame([(0, "1", "ABCXY", "T", 1.0, 1.0)], "CIV_ID int, house string, street string, community string, X double, Y double")
    assert addresses.match_addresses(a, c).count() == 0
    assert addresses.match_addresses(a, c, score_minimum=59).first()["score"] == 60


def test_id_zero_joins_and_repeated_civics_give_pairs(spark):
    p = spark.createDataFrame([("a", 0), ("b", 1), ("c", None), ("d", 7)], "Permit_Number string, Civic_ID bigint")
    c = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 2.0), (1, 3.0, 3.0)], "CIV_ID bigint, X double, Y double")
    got = sorted((r["Permit_Number"], r["X"]) for r in locating.civic_join(p, c).collect())
    assert got == [("a", 1.0), ("b", 2.0), ("b", 3.0)]
    assert [r["Permit_Number"] for r in locating.civic_unjoined(p, c).collect()] == ["d"]


def test_every_permit_is_located_or_reported_once(spark, folder):
    given = _Inputs(spark, folder)
    located = given.located.cache()
    assert located.count() == located.select("Permit_Category", "Permit_Number").distinct().count() == given.unique.count()
    assert located.where((F.col("method").isNull()) == (F.col("reason").isNull())).count() == 0
    assert located.where((F.col("method").isNull()) != (F.col("X").isNull())).count() == 0
    located.unpersist()


def test_related_table_answers_the_occupancy_question(spark, folder):
    given = _Inputs(spark, folder).shared()
    related = given.related_table.cache()
    assert quality.occupancy_missing_in_related(given.permits, related).count() == 0
    assert related.count() == related.distinct().count()
    related.unpersist()


def test_sync_twice_changes_nothing(spark, folder):
    given = _Inputs(spark, folder)
    changes = syncing.sync_changes(given.rw_copy, given.ro_copy, ["c_custkey"])
    assert {r["change"] for r in changes.select("change").distinct().collect()} == {"insert", "update", "delete"}
    after = syncing.synced(given.ro_copy, changes, ["c_custkey"])
    assert syncing.sync_changes(given.rw_copy, after, ["c_custkey"]).count() == 0


def test_sync_rows_without_a_key(spark):
    rw = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    ro = spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    got = sorted(map(tuple, syncing.sync_changes(rw, ro, ["k"]).collect()), key=repr)
    assert got == sorted([(1, "a", "insert"), (None, "b", "insert"), (None, "c", "delete"), (2, "d", "delete")], key=repr)


def test_sequence_ids(spark):
    df = spark.range(120).repartition(7)
    plain = syncing.assign_sequence_ids(df, ["id"], "n", start=10)
    assert sorted(r["n"] for r in plain.collect()) == list(range(10, 130))
    text = syncing.assign_sequence_ids(df, ["id"], "n", "A", pad=True)
    assert {r["id"]: r["n"] for r in text.collect()}[4] == "A005"


def test_global_ids_do_not_change(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    one, two = (sorted(r["GlobalID"] for r in syncing.with_global_ids(df, "T", ["k"]).collect()) for _ in range(2))
    assert one == two and len(set(one)) == 2 and len(one[0]) == 38


def test_domain_code_order(spark):
    rows = [("d", c, d) for c, d in (("a", "10"), ("b", "2"), ("c", "x"), ("e", None), ("f", "w"))]
    df = spark.createDataFrame(rows, "domain string, code string, description string")
    got = [r["description"] for r in domains.domain_order(df).orderBy("ord").collect()]
    assert got == ["2", "10", "w", "x", None]


def test_domain_types_refuse_unknown_types(spark):
    df = spark.createDataFrame([("d",)], "domain string")
    with pytest.raises(ValueError):
        domains.domain_types(df, {"d": "MONEY"})


def test_form_as_schema(spark, folder):
    rows = forms.spec_to_schema(_Inputs(spark, folder).form_cell)
    schema = forms.struct_of(rows, 0)
    assert [(f.name, f.dataType) for f in schema] == [("AREA_ID", T.IntegerType()), ("STATUS", T.StringType()), ("NOTE", T.StringType())]
    data = spark.createDataFrame([("7", "O"), ("x", None)], "AREA_ID string, STATUS string")
    shaped = cleaning.with_defaults(forms.conformed(data, schema), {"STATUS": "O"})
    assert sorted(map(tuple, shaped.collect()), key=repr) == sorted([(7, "O", None), (None, "O", None)], key=repr)


def test_audit_columns_are_ignored_when_tracked(spark):
    cells = [(1, 1, "Feature Class Name:", "f"), (1, 2, "Shape Type:", "Point"), (1, 3, "Feature Type:", "Feature Class"),
             (1, 4, "Alias", "Field Name"), (1, 5, "Added", "ADDBY"), (1, 6, "A", "A"), (1, 7, "GLOBALID", "GLOBALID")]
    df = spark.createDataFrame(cells, "form_id int, row_no int, c0 string, c1 string")
    assert [r["field_name"] for r in forms.spec_to_schema(df).collect()] == ["ADDBY", "A"]
    assert [r["field_name"] for r in forms.spec_to_schema(df, tracking=True).collect()] == ["A"]


def test_cleaning(spark):
    row = ("P1", "nan", "12.0", "12 A", "Elm  St", " ", "a  b", 1, "d", "m")
    names = "Permit_Number string, PID string, Civic_ID string, Civic_Number string, Street_Name string, Community string, Work_Description string, OBJECTID_1 int, Date_Inspection_Completed string, Most_Recent_Inspection string"
    got = cleaning.clean_permits(spark.createDataFrame([row], names))
    assert "OBJECTID_1" not in got.columns
    at = got.columns.index("Most_Recent_Inspection")
    assert got.columns[at + 1] == "Date_Inspection_Completed"
    r = got.first()
    assert (r["PID"], r["Civic_ID"], r["Community"], r["FORMATTEDADDRESS"], r["Work_Description"]) == (None, 12, None, None, "a b")
    assert cleaning.pruned(got, "Public_Works_ROW").columns == [c for c in got.columns if "Inspection" not in c]


def test_one_id_column_for_both_kinds(spark):
    df = spark.createDataFrame([("a", 1)], "Permit_Number string, HRM_ID int")
    df = df.withColumn("Permit_Category", F.lit("Engineering"))
    assert tuple(cleaning.located_by(df).first()) == ("a", "Engineering", 1, "street_segment")
    df = df.withColumn("Permit_Category", F.lit("Building")).withColumn("Civic_ID", F.lit(5))
    assert tuple(cleaning.located_by(df).first()) == ("a", "Building", 5, "civic")


def test_address_line(spark):
    df = spark.createDataFrame([("12 A", "Elm St", "Town")], "a string, b string, c string")
    line = t.address_line(F.col("a"), F.col("b"), F.col("c"))
    assert df.select(line.alias("r")).first()["r"] == "12A Elm St, Town NOVA SCOTIA"


def test_field_map_reports_unknown_targets(spark):
    df = spark.createDataFrame([("1", "x")], "Planning_App_Num string, PIDs string")
    target = T.StructType([T.StructField("APP_NUM", T.LongType()), T.StructField("ZONE", T.StringType())])
    mapped, skipped = cleaning.field_mapped(df, target, cleaning.PLANNING_FIELDS)
    assert tuple(mapped.first()) == (1, None) and "PID" in skipped and len(skipped) == 23
    assert (len(cleaning.PLANNING_FIELDS), len(cleaning.SUBDIVISION_FIELDS)) == (25, 29)


def test_projection(spark):
    df = spark.createDataFrame([(25500000.0, 0.0), (25562459.057, 4951608.9415)], "X double, Y double")
    rows = projection.reprojected(df, "X", "Y", projection.SOURCE_SYSTEM).collect()
    assert rows[0]["X"] == pytest.approx(6378137 * -64.5 * 3.141592653589793 / 180, abs=1e-6)
    assert rows[0]["Y"] == pytest.approx(0, abs=1e-6)
    assert -7.2e6 < rows[1]["X"] < -7.0e6 and 5.5e6 < rows[1]["Y"] < 5.7e6
    with pytest.raises(ValueError):
        projection.reprojected(df, "X", "Y", "WGS_1984")


def test_append_strict_and_lenient(spark):
    target = spark.createDataFrame([(1, "a")], "n int, s string")
    source = spark.createDataFrame([("2", True), ("x", False)], "n string, other boolean")
    assert sorted(map(tuple, tables.appended(target, source).collect()), key=repr) == sorted([(1, "a"), (2, None), (None, None)], key=repr)
    with pytest.raises(ValueError):
        tables.appended(target, source, strict=True)


def test_scan_drops_geometry_and_keeps_zeros(spark):
    df = spark.createDataFrame([("00000007", bytearray(b"x"), [1])], "PID string, SHAPE binary, a array<int>")
    path = fresh_folder(spark, "scan")
    df.write.parquet(path)
    assert tables.scan_attributes(spark, path).columns == ["PID"]
    csv = fresh_folder(spark, "csv")
    sinks.write_csv(df.select("PID"), csv)
    assert tables.scan_csv(spark, csv, T.StructType([T.StructField("PID", T.LongType())])).first()["PID"] == "00000007"
    assert tables.empty_like(df).schema == df.schema


def test_metadata_titles(spark):
    df = spark.createDataFrame(
        [("DB.OWN.roads", None, "<x><CreaDate>1</CreaDate></x>", "&lt;p&gt;hi")], "feature string, title string, xml string, description string"
    )
    r = metadata.metadata_records(df, "DB", "OWN").first()
    assert (r["FEATURE"], r["TITLE"]) == ("OWN.roads", "roads (*NO TITLE in Metadata*)")
    assert (r["DESCRIPTION_SANITIZED"], r["CREATION_DATE"], r["REVISION_DATE"]) == ("hi", "1", "")


def test_whole_jobs(spark, folder):
    given = _Inputs(spark, folder)
    work, publish = fresh_folder(spark, "job"), fresh_folder(spark, "public")
    permits = stored(given.permit_category.withColumns({"HRM_ID": F.col("Civic_ID"), "Estimated_Project_Value": F.lit(1.0)}))
    inputs = jobs.PermitTables(permits, given.active, given.retired, given.parcel_vertex)
    jobs.run_permits(inputs, TIES, work, publish)
    loaded = {c: sinks.stored(spark, f"{publish}/{jobs.permit_table(c)}") for c in cleaning.UNPUBLISHED}
    failed = spark.read.option("header", True).csv(f"{work}/failed_locates")
    assert sum(rows.count() for rows in loaded.values()) + failed.count() == given.unique.count()
    for category, rows in loaded.items():
        own, other = ("HRM_ID", "Civic_ID") if category in ("Engineering", "Public_Works_ROW") else ("Civic_ID", "HRM_ID")
        assert own in rows.columns and other not in rows.columns and "GlobalID" in rows.columns
        assert ("Estimated_Project_Value" in rows.columns) == (category in ("Building", "Construction"))
        assert rows.where("route = '1_civic_id'").count() > 0
    assert "Building_Permits_fails" in {r["section"] for r in failed.select("section").distinct().collect()}
    assert sinks.stored(spark, f"{publish}/permit_info").count() > 0
    # a run that places nothing leaves no permit and no old failure behind
    jobs.run_permits(inputs._replace(permits=permits.where("false")), TIES, work, publish)
    assert sinks.stored(spark, f"{publish}/{jobs.permit_table('Building')}").count() == 0
    assert not [r for r in spark.read.text(f"{work}/failed_locates").collect() if "Building" in str(r)]
    apps_folder, apps_public = fresh_folder(spark, "job"), fresh_folder(spark, "public")
    twice = given.parcel_vertex.withColumn("OBJECTID", F.lit(1))
    twice = twice.unionByName(twice.withColumns({"x": F.col("x") + 7, "OBJECTID": F.lit(2)}))
    sources = [
        jobs.ApplicationSource("planning", given.application, cleaning.PLANNING_FIELDS),
        jobs.ApplicationSource("subdivision", given.application.withColumnRenamed("PIDs", "PID_LIST"), {"APP_NUM": "Planning_App_Num"}, "PID_LIST"),
    ]
    sinks.stored(spark, f"{publish}/permit_info").limit(0).selectExpr("1 AS APP_NUM", "0D AS area").write.parquet(f"{apps_public}/planning")
    jobs.run_applications(sources, twice, apps_folder, apps_public)
    for source in sources:
        placed = sinks.stored(spark, f"{apps_folder}/{source.name}")
        report = spark.read.option("header", True).csv(f"{apps_folder}/{source.name}_failed_locates").count()
        assert placed.count() + report == given.application.count() and placed.where("dissolve_check").count() == placed.count()
    # the lenient copy serves only what is published already
    copy = sinks.stored(spark, f"{apps_public}/planning")
    assert copy.columns == ["APP_NUM", "area"] and copy.count() == placed.count()
    assert sinks.stored(spark, f"{apps_public}/subdivision") is None


def test_closed_rings_have_no_edge_of_length_zero(spark):
    square = lambda pid, x: [(pid, 0, k, x + dx, dy) for k, (dx, dy) in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)])]
    vertices = spark.createDataFrame(square("00000001", 0.0) + square("00000002", 1.0), "PID string, ring int, seq int, x double, y double")
    found = spark.createDataFrame([(1, "1, 2")], "Planning_App_Num bigint, PIDs string")
    row = apps.dissolve_area(found, vertices).first()
    assert (row["area"], row["perimeter"], row["n_edges"], row["dissolve_check"]) == (2.0, 6.0, 6, True)


def test_rows_without_a_ring_or_number_keep_their_edges(spark):
    rows = [(None, 0, 0, 0.0, 0.0), (None, 0, 1, 1.0, 0.0), (None, 0, 2, 0.0, 1.0)]
    vertices = spark.createDataFrame(rows, "PID string, ring int, seq int, x double, y double")
    assert parcels.edges(vertices).count() == 3


def test_synced_replaces_rows_without_a_key(spark):
    rw = spark.createDataFrame([(1, "a"), (None, "new"), (3, "c")], "k int, v string")
    ro = spark.createDataFrame([(1, "b"), (None, "old"), (2, "gone")], "k int, v string")
    once = syncing.synced(ro, syncing.sync_changes(rw, ro, ["k"]), ["k"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, rw.collect()), key=repr)


def test_repeated_heading_takes_the_first_column(spark):
    cells = [(1, 1, "Feature Class Name:", "f", None), (1, 2, "Shape Type:", "Point", None), (1, 3, "Feature Type:", "Feature Class", None),
             (1, 4, "Alias", "Field Name", "Field Name"), (1, 5, "A", "FIRST", "SECOND")]
    df = spark.createDataFrame(cells, "form_id int, row_no int, c0 string, c1 string, c2 string")
    assert [r["field_name"] for r in forms.spec_to_schema(df).collect()] == ["FIRST"]


def test_report_without_failures_replaces_the_old_one(spark):
    path = fresh_folder(spark, "report")
    failed = spark.createDataFrame([("s", 1)], "section string, n int")
    assert sinks.write_report(failed, path) and not sinks.write_report(failed.limit(0), path)
    assert spark.read.text(path).count() == 0
