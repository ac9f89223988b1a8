"""How often rows are shuffled, and that the ways with fewer shuffles give the rows of the plain ones."""

import re

import pytest

from acreage.operators import applications as apps
from acreage.operators import duplicates, outlines, quality
from acreage.operators.spread import heavy_keys_of
from acreage.plans.queries import PLACE, _Inputs

COLUMNS = "Permit_Category string, Permit_Number string, PID string, Occupancy_Type string, Active_Parcel string, n int, note string"
ROWS = [
    ("A", f"P{k % 11}" if k % 13 else None, str(k % 3) if k % 5 else None, ["x", "y", None][k * k % 7 % 3], ["Y", "N", None][k % 17 % 3], k % 9, f"t{k % 2}")
    for k in range(120)
] + [("B", "Q1", str(k % 2), "x", "Y", k % 2, "t") for k in range(6)] * 2


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange \w*partitioning", plan))


def as_rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plain(permits):
    """Unique and related rows, additions and the related table, by going through the permits one by one."""
    groups = {}
    for r in permits:
        groups.setdefault(r[:2], []).append(r)
    top = lambda r: ((r[4] is None) + 1, r[4] or "", r[5], r[6])
    unique, related, added = [], [], []
    for rows in groups.values():
        one = max(rows, key=top)
        several = lambda k: len({r[k] for r in rows}) > 1
        mine = rows if len(rows) > 1 else []
        if mine and several(2) and not several(3) and rows[0][1] is not None:
            first = min(rows, key=lambda r: (r[4] is not None, r[4] or "", r[5], r[6]))
            mine = [r for r in rows if r != first] if all(r[4] == "Y" for r in rows) else [r for r in rows if r[4] != "Y"]
        unique.append(one)
        related += mine
        if one[3] is not None and one[3] not in {r[3] for r in mine}:
            added.append(one)
    table = {(*r[:2], r[2] and r[2].zfill(8), *r[3:5]) for r in related + added}
    return unique, [r[:5] for r in related], [r[:5] for r in added], table


def check_split(spark):
    ties = ["n", "note"]
    permits = spark.createDataFrame(ROWS, COLUMNS)
    marked = duplicates.split_rows(permits, ties)
    unique, related, added, table = plain(ROWS)
    want = lambda rows: sorted(repr(tuple(r)) for r in rows)
    got = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    # rows that tie in all columns may be kept for one another
    assert got(duplicates.permits_unique(marked, ties).select(*duplicates.KEYS, "Active_Parcel", *ties)) == want((*r[:2], *r[4:]) for r in unique)
    assert got(duplicates.related_rows(marked, ties)) == want(related) == got(duplicates.related_rows(permits, ties))
    assert got(duplicates.marked_related_table(marked)) == want(table)
    assert {r[:2] for r in map(tuple, duplicates.marked_additions(marked).collect())} == {r[:2] for r in added}
    by_operators = duplicates.related_table(duplicates.permits_unique(permits, ties), duplicates.related_rows(permits, ties))
    assert by_operators.count() == len(table)


def test_split_rows(spark):
    check_split(spark)


def test_split_rows_of_heavy_permits(crowded):
    check_split(crowded)


def test_permits_are_split_by_one_shuffle(spark):
    permits = spark.createDataFrame(ROWS, COLUMNS)
    marked = duplicates.split_rows(permits, ["n", "note"])
    for df in (marked, duplicates.marked_related_table(marked), duplicates.related_rows(permits, ["n", "note"])):
        assert exchanges(df) == 1


def test_heavy_keys_are_counted_exactly(crowded):
    rows = crowded.createDataFrame([(k % 40 if k < 100 else 1,) for k in range(110)] + [(None,)] * 6, "k int")
    got = {r["k"]: r["_shares"] for r in heavy_keys_of(rows, ["k"]).collect()}
    assert got == {1: 3, None: 2}
    assert heavy_keys_of(rows.where("k > 1"), ["k"]) is None


def test_shared_permits_hold_no_long_texts(spark, folder):
    given = _Inputs(spark, folder).shared(*PLACE)
    assert not {"Work_Description", "FORMATTEDADDRESS"} & set(given.permits.columns)
    # a digest still tells rows apart that differ in a column left out
    two = spark.createDataFrame([("a", None, "x"), ("a", "x", None), ("a", "x", None)], "k string, b string, c string")
    assert duplicates.with_digest(two, ["k"]).distinct().count() == 2


def test_source_joins_shuffle_the_lines_twice(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5k")
    try:
        # the lines by part and by order, orders by customer and by order, parts, customers
        assert exchanges(_Inputs(spark, folder).permit_category) <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counts_are_reconciled_by_one_shuffle_of_the_permits(spark):
    def rows(*numbers):
        return spark.createDataFrame([("A" if n else None, n) for n in numbers], "Permit_Category string, Permit_Number string")

    source, related = rows("1", "1", "2", "3", "4", "4", None), rows("3", "9")
    counts = quality.reconcile_counts(source, rows("1", "7"), rows("1"), rows("2", None), related)
    assert exchanges(counts) == 2
    got = {r["Permit_Category"]: tuple(r)[1:] for r in counts.select("Permit_Category", "source", "rw", "ro", "failed", "related", "missing_rw", "missing_ro").collect()}
    assert got == {"A": (6, 2, 1, 1, 2, 2, 1), None: (1, 0, 0, 1, 0, 0, 0)}


def ground(spark):
    """Three squares in a row, the first with a corner in the middle of a side, a far one with a hole, and one given twice."""
    square = lambda x, y, size: [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    rings = [("1", 0, square(0, 0, 10)), ("2", 0, square(10, 0, 5)), ("3", 0, square(10, 5, 5)), ("4", 0, square(40, 0, 9)), ("4", 1, square(43, 3, 2)[::-1]), ("5", 0, square(0, 0, 10))]
    rows = [(pid.zfill(8), n, k, float(x), float(y)) for pid, n, corners in rings for k, (x, y) in enumerate(corners)]
    listed = [(1, "1,2,3"), (2, "4"), (3, "1,5"), (4, "1, 2, 4"), (5, "3,3"), (5, "1"), (6, "9"), (7, "2,3"), (7, "2,3"), (None, "1,2,3")]
    return spark.createDataFrame(listed, "Planning_App_Num bigint, PIDs string"), spark.createDataFrame(rows, "PID string, ring int, seq int, x double, y double")


@pytest.mark.parametrize("settings", ["spark", "crowded"])
@pytest.mark.parametrize("most", [0, 12])
def test_outlines_in_rows_and_by_joins(request, monkeypatch, settings, most):
    spark = request.getfixturevalue(settings)
    found, vertices = ground(spark)
    want = as_rows(apps.dissolve_area(found, vertices)), as_rows(apps.app_outline_rings(found, vertices))
    assert len(want[0]) == 6 and len(want[1]) > 30
    monkeypatch.setattr(outlines, "ROW_PIECES", most)
    assert (as_rows(apps.dissolve_area(found, vertices)), as_rows(apps.app_outline_rings(found, vertices))) == want


def test_pieces_of_lists_take_one_shuffle(spark):
    found, vertices = ground(spark)
    _, pieces = apps.union_of_parcels(found.where("Planning_App_Num IS NOT NULL"), vertices)
    assert exchanges(pieces) == 1
