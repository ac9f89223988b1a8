"""Every operator as a query over the test tables. Each takes a session and a folder and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.functions import projection
from acreage.functions import text as t
from acreage.functions.markup import without_tags
from acreage.operators import addresses, cleaning, domains, duplicates, forms, locating, locator, metadata, parcels, quality, specs
from acreage.operators import applications as apps
from acreage.operators import syncing
from acreage.session import fresh_folder, stored
from acreage.sources import sinks, tables
from acreage.sources.stand_ins import stand_in, table

# Total order among the rows of a permit.
TIES = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
PERMIT = list(duplicates.KEYS)
# What else a permit is placed by.
PLACE = ["Civic_ID", "Civic_Number", "Street_Name", "Community"]
REGISTRY = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


class _Inputs:
    """The land-record tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        self.__dict__[name] = stand_in(self.spark, self.folder, f"fx_{name}")
        return self.__dict__[name]

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @property
    def permits(self) -> DataFrame:
        return self.__dict__.get("_shared") or cleaning.clean_permits(self.permit_category)

    def shared(self, *columns: str) -> _Inputs:
        """The same inputs with the permits, a join of five test tables, written once for several uses.

        Of the permits only what the related table needs and ``columns`` are written as they are, the others as a digest.
        """
        kept = [*dict.fromkeys([*duplicates.RELATED_COLUMNS, *TIES, *columns])]
        self._shared = stored(duplicates.with_digest(self.permits, kept))
        return self

    def split(self, *columns: str) -> _Inputs:
        """``shared`` with the permits also marked as unique and related, written once with the related table's columns."""
        self.shared(*columns)
        marked = duplicates.split_rows(self.permits, TIES)
        self._split = stored(marked.select(*duplicates.RELATED_COLUMNS, *columns, *duplicates.MARKS))
        return self

    @property
    def marked(self) -> DataFrame:
        """The permits marked as unique and related."""
        return self.__dict__.get("_split") or duplicates.split_rows(self.permits, TIES)

    @property
    def unique(self) -> DataFrame:
        return duplicates.permits_unique(self.__dict__.get("_split") or self.permits, TIES)

    @property
    def related(self) -> DataFrame:
        return duplicates.related_rows(self.marked, TIES)

    @property
    def related_table(self) -> DataFrame:
        return duplicates.marked_related_table(self.marked)

    @property
    def active(self) -> DataFrame:
        return self.civic.where("status = 'ACTIVE'")

    @property
    def retired(self) -> DataFrame:
        return self.civic.where("status = 'RETIRED'")

    @property
    def located(self) -> DataFrame:
        permits = self.unique.select(*PERMIT, "PID", *PLACE)
        return locating.locate_permits(permits, self.active, self.retired, self.parcel_vertex)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Coordinates rounded; the addition turns negative zero into zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _dated(df: DataFrame, column: str = "l_shipdate") -> DataFrame:
    """The date as text, which every engine writes alike."""
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


# --- scans and sinks ---


@query
def scan_attributes(spark, folder):
    return tables.scan_attributes(spark, f"{folder}/embeddings.parquet")


@query
def scan_csv_typed(spark, folder):
    """Permits exported as CSV and read back: ids stay text, dates and numbers keep their types."""
    rows = _Inputs(spark, folder).permits.withColumn("PID", t.padded(F.col("PID")))
    rows = rows.select(*PERMIT, "PID", "Civic_Number", "Civic_ID", *TIES)
    path = fresh_folder(spark, "csv")
    sinks.write_csv(rows, path)
    return _dated(tables.scan_csv(spark, path, rows.schema))


@query
def form_cells(spark, folder):
    return forms.form_rows(_Inputs(spark, folder).form_cell)


@query
def failure_report(spark, folder):
    return locating.failures(_Inputs(spark, folder).located)


@query
def application_failure_report(spark, folder):
    given = _Inputs(spark, folder)
    return apps.application_failures(apps.locate_apps_point(given.application, given.parcel_vertex))


@query
def load_guarded(spark, folder):
    """A load, an append, and a load of nothing, with the row counts before and after each."""
    located = _Inputs(spark, folder).located.where("method IS NOT NULL").select(*PERMIT, "method", "X", "Y")
    path = fresh_folder(spark, "load")
    rows = stored(located)
    steps = [
        ("1_truncate", *sinks.load_guarded(rows, path)),
        ("2_append", *sinks.load_guarded(rows, path, truncate=False)),
        ("3_empty", *sinks.load_guarded(rows.where(F.lit(False)), path)),
        ("4_truncate", *sinks.load_guarded(rows, path)),
    ]
    return spark.createDataFrame(steps, "step string, n_before bigint, n_after bigint")


@query
def replicate_counts(spark, folder):
    """Two reloads of published tables: the first publishes, the second replaces."""
    given = _Inputs(spark, folder)
    rows = {"rw_copy": given.rw_copy, "civic": given.civic, "ro_copy": given.ro_copy}
    path = fresh_folder(spark, "published")
    skipped = [("1_lenient", *c) for c in sinks.replicate(rows, path)]
    first = [("2_strict", *c) for c in sinks.replicate(rows, path, strict=True)]
    second = [("3_lenient", *c) for c in sinks.replicate(rows, path)]
    return spark.createDataFrame(
        skipped + first + second, "step string, name string, n_before bigint, n_after bigint"
    )


@query
def append_by_name(spark, folder):
    given = _Inputs(spark, folder)
    extra = given.table("supplier").select(
        F.concat(F.when(F.col("s_suppkey") % 3 == 0, "x").otherwise(""), F.col("s_suppkey").cast("string")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").cast("string").alias("c_acctbal"),
        F.col("s_nationkey").alias("unknown_column"),
    )
    return tables.appended(given.rw_copy, extra)


@query
def catalog_name_filter(spark, folder):
    return metadata.catalog_name_filter(_Inputs(spark, folder).metadata, "feature", schema="ADM")


@query
def stage_counts(spark, folder):
    given = _Inputs(spark, folder).split(*PLACE)
    located = stored(given.located.select(*PERMIT, "method"))
    return quality.stage_counts(
        {
            "source": given.permits,
            "unique": located,
            "located": located.where("method IS NOT NULL"),
            "failed": located.where("method IS NULL"),
            "related": given.related_table,
        }
    )


# --- projections and filters ---


@query
def clean_permits(spark, folder):
    return _dated(_Inputs(spark, folder).permits)


@query
def apply_field_map(spark, folder):
    return _mapped(_Inputs(spark, folder).application, cleaning.PLANNING_FIELDS)


@query
def apply_subdivision_map(spark, folder):
    return _mapped(_Inputs(spark, folder).application, cleaning.SUBDIVISION_FIELDS)


def _mapped(source: DataFrame, fields: dict[str, str]) -> DataFrame:
    numeric = {"APP_NUM": T.LongType()}
    target = T.StructType([T.StructField(c, numeric.get(c, T.StringType())) for c in fields])
    return cleaning.field_mapped(_dated(source, "Submitted_Date"), target, fields)[0]


@query
def locator_id(spark, folder):
    """The categories' tables with one id column, whatever a category calls its own."""
    rows = _Inputs(spark, folder).unique.select(*PERMIT, "Civic_ID", F.col("l_suppkey").alias("HRM_ID"))
    return cleaning.located_by(rows)


@query
def prune_by_category(spark, folder):
    rows = _Inputs(spark, folder).unique.select(
        *PERMIT,
        F.col("l_extendedprice").alias("Estimated_Project_Value"),
        F.col("l_linenumber").alias("Existing_Residential_Units"),
        F.col("l_suppkey").alias("Total_End_Residential_Units"),
        F.col("l_partkey").alias("Building_Footprint_Area"),
        F.col("l_linenumber").alias("Number_of_Storeys"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Most_Recent_Inspection"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date_Inspection_Completed"),
    )
    return cleaning.pruned_values(rows)


@query
def split_pid(spark, folder):
    return apps.split_pid(_Inputs(spark, folder).application).select("Planning_App_Num", "PIDs", "pid_status")


@query
def route_permits(spark, folder):
    unique = _Inputs(spark, folder).unique
    return unique.select(*PERMIT, cleaning.route().alias("route"))


@query
def apply_defaults(spark, folder):
    rows = cleaning.with_defaults(
        _Inputs(spark, folder).permits, {"Occupancy_Type": "UNKNOWN", "Active_Parcel": "N", "Civic_ID": -1}
    )
    return rows.select(*PERMIT, "Occupancy_Type", "Active_Parcel", "Civic_ID", "l_linenumber", "l_partkey")


@query
def calc_id_field(spark, folder):
    rows = _Inputs(spark, folder).rw_copy
    rows = cleaning.with_calculated_id(rows, "ASSET_ID", "c_custkey", "AST-")
    return cleaning.with_calculated_id(rows, "NATION_ID", "c_nationkey").select("c_custkey", "ASSET_ID", "NATION_ID")


# --- joins ---


@query
def civic_join(spark, folder):
    given = _Inputs(spark, folder)
    unique = stored(given.unique.select(*PERMIT, "Civic_ID"))
    return _rounded(locating.civic_join(unique, given.active).select(*PERMIT, "Civic_ID", "X", "Y"), "X", "Y")


@query
def civic_unjoined(spark, folder):
    given = _Inputs(spark, folder)
    return locating.civic_unjoined(given.unique, given.active).select(*PERMIT, "Civic_ID")


@query
def retired_civic_join(spark, folder):
    given = _Inputs(spark, folder)
    unique = stored(given.unique.select(*PERMIT, "Civic_ID"))
    rows = locating.retired_civic_join(unique, given.active, given.retired)
    return _rounded(rows.select(*PERMIT, "Civic_ID", "X", "Y"), "X", "Y")


@query
def pid_points(spark, folder):
    given = _Inputs(spark, folder)
    rows = locating.pid_points(given.unique, stored(parcels.parcel_point(given.parcel_vertex)))
    return _rounded(rows.select(*PERMIT, "PID", "status", "x", "y"), "x", "y")


@query
def street_segment_points(spark, folder):
    given = _Inputs(spark, folder)
    rows = given.unique.where(F.col("Permit_Category").isin("Engineering", "Public_Works_ROW"))
    placed = locating.street_segment_points(rows.withColumnRenamed("Civic_ID", "HRM_ID"), given.street)
    return _rounded(placed.select(*PERMIT, "HRM_ID", "status", "x", "y"), "x", "y", digits=5)


@query
def geocode_addresses(spark, folder):
    given = _Inputs(spark, folder)
    rows = given.unique.where(cleaning.route() == "2_address").select(
        *PERMIT, "Civic_Number", "Street_Name", "Community", "FORMATTEDADDRESS"
    )
    placed = addresses.geocode_addresses(rows, given.active)
    return placed.select(*PERMIT, "FORMATTEDADDRESS", "match_id", "score")


@query
def geocode_full(spark, folder):
    """Addresses with all their fields against civic addresses with all of theirs."""
    given = _Inputs(spark, folder)
    return locator.geocode(given.locator_permit, given.locator_civic).select("permit_no", "match_id", "score", "match_x", "match_y")


@query
def locate_apps_polygon(spark, folder):
    given = _Inputs(spark, folder)
    rows = apps.locate_applications(given.application, given.parcel_vertex, "POLYGON")
    return _rounded(
        rows.select("Planning_App_Num", "PIDs", "status", "pids_total", "pids_found", "area", "perimeter"),
        "area",
        "perimeter",
    )


@query
def locate_apps_point(spark, folder):
    given = _Inputs(spark, folder)
    rows = apps.locate_applications(given.application, given.parcel_vertex, "POINT")
    return _rounded(rows.select("Planning_App_Num", "PIDs", "primary_pid", "status", "x", "y"), "x", "y")


@query
def occupancy_anti(spark, folder):
    return duplicates.marked_additions(_Inputs(spark, folder).shared().marked)


@query
def occupancy_missing_in_related(spark, folder):
    given = _Inputs(spark, folder).shared()
    rows = quality.occupancy_missing_in_related(given.permits, given.related)
    return rows.select(*PERMIT, "Occupancy_Type", "l_linenumber", "l_partkey")


@query
def missing_permits(spark, folder):
    """Permits that would be lost if partial addresses were neither placed nor reported."""
    given = _Inputs(spark, folder).split(*PLACE)
    located = stored(given.located.select(*PERMIT, "method", "reason"))
    rows = quality.permits_absent(
        given.permits,
        located.where("method IS NOT NULL"),
        located.where("reason <> 'partial_address'"),
        given.related_table,
    )
    return rows.select(*PERMIT, "l_linenumber", "l_partkey")


@query
def load_missing_permits(spark, folder):
    given = _Inputs(spark, folder).shared(*PLACE)
    return quality.load_missing_permits(given.permits, given.located.where("method IS NOT NULL"))


@query
def related_rollup(spark, folder):
    given = _Inputs(spark, folder).split(*PLACE)
    return quality.related_rollup(given.located.where("method IS NOT NULL"), given.related_table)


@query
def related_orphans(spark, folder):
    given = _Inputs(spark, folder).split(*PLACE)
    return quality.related_orphans(given.located.where("method IS NOT NULL"), given.related_table)


@query
def domain_decode(spark, folder):
    given = _Inputs(spark, folder)
    orders = given.table("orders").select("o_orderkey", "o_orderstatus")
    return domains.domain_decode(orders, given.order_domain, "o_orderstatus", "ORD_status")


@query
def domain_violations(spark, folder):
    given = _Inputs(spark, folder)
    orders = given.table("orders").select("o_orderkey", "o_orderstatus")
    return domains.domain_violations(orders, given.order_domain, "o_orderstatus", "ORD_status")


@query
def subtype_domain_check(spark, folder):
    given = _Inputs(spark, folder)
    orders = given.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return domains.subtype_domain_check(
        orders, given.order_subtype, given.order_domain, "o_orderstatus", "o_orderpriority"
    )


@query
def sync_changes(spark, folder):
    given = _Inputs(spark, folder)
    return syncing.sync_changes(given.rw_copy, given.ro_copy, ["c_custkey"])


@query
def sync_applied(spark, folder):
    given = _Inputs(spark, folder)
    changes = syncing.sync_changes(given.rw_copy, given.ro_copy, ["c_custkey"])
    return syncing.synced(given.ro_copy, changes, ["c_custkey"])


@query
def out_of_sync_ids(spark, folder):
    given = _Inputs(spark, folder)
    return syncing.out_of_sync_ids(given.rw_copy, given.ro_copy, ["c_custkey"], "ASSET_ID")


# --- aggregates ---


@query
def permit_group_profile(spark, folder):
    return duplicates.permit_group_profile(_Inputs(spark, folder).permits)


@query
def related_by_category(spark, folder):
    return quality.related_by_category(_Inputs(spark, folder).shared().related_table)


@query
def reconcile_counts(spark, folder):
    """Counts per stage, with a published copy that predates the retired civics."""
    given = _Inputs(spark, folder).split(*PLACE)
    located = stored(given.located.select(*PERMIT, "method"))
    rw = located.where("method IS NOT NULL")
    return quality.reconcile_counts(
        given.permits,
        rw,
        rw.where("method <> 'retired_civic'"),
        located.where("method IS NULL"),
        given.related_table,
    )


@query
def max_text_length(spark, folder):
    """How long descriptions are before they are cut."""
    rows = _Inputs(spark, folder).permit_category
    return quality.max_text_length(rows, "Work_Description", ["Permit_Category"])


@query
def pid_coverage(spark, folder):
    given = _Inputs(spark, folder)
    return apps.pid_coverage(given.application, given.parcel_vertex)


@query
def locate_summary(spark, folder):
    given = _Inputs(spark, folder)
    placed = apps.locate_apps_point(given.application, given.parcel_vertex)
    return quality.locate_summary(placed, ["App_Status", "status"])


@query
def first_parcels(spark, folder):
    """Two parcel rows with one id, of which the first is taken."""
    rows = _Inputs(spark, folder).parcel_vertex
    again = rows.withColumns({"x": F.col("x") + 7, "OBJECTID": F.lit(2)})
    return parcels.first_parcels(again.unionByName(rows.withColumn("OBJECTID", F.lit(1))), "OBJECTID")


@query
def dissolve_outline(spark, folder):
    given = _Inputs(spark, folder)
    return apps.dissolve_outline(given.application, given.parcel_vertex)


@query
def dissolve_area(spark, folder):
    given = _Inputs(spark, folder)
    return _rounded(apps.dissolve_area(given.application, given.parcel_vertex), "area", "perimeter")


@query
def app_union_area(spark, folder):
    """Unions of plots whose sides are split on one side only, with holes and with plots that are given twice."""
    given = _Inputs(spark, folder)
    return _rounded(apps.dissolve_area(given.ground_application, given.ground_vertex), "area", "perimeter")


@query
def app_outline_rings(spark, folder):
    given = _Inputs(spark, folder)
    return apps.app_outline_rings(given.ground_application, given.ground_vertex)


# --- picks, numbering and order ---


@query
def permits_unique(spark, folder):
    return _dated(_Inputs(spark, folder).unique)


@query
def permits_repeated(spark, folder):
    rows = duplicates.permits_repeated(_Inputs(spark, folder).permits)
    return rows.select(*PERMIT, "PID", "l_linenumber", "l_partkey", "l_suppkey")


@query
def permits_extra_rows(spark, folder):
    rows = duplicates.permits_extra_rows(_Inputs(spark, folder).permits, TIES)
    return rows.select(*PERMIT, "PID", "Active_Parcel", "l_linenumber", "l_partkey", "l_suppkey")


@query
def multi_pid_no_occupancy(spark, folder):
    rows = quality.multi_pid_no_occupancy(_Inputs(spark, folder).permits)
    return rows.select(*PERMIT, "PID", "PID_Count", "l_linenumber")


@query
def filled_sequence_ids(spark, folder):
    """Ids given in two runs, to new rows only; a third run finds none."""
    rows = table(spark, folder, "customer").select("c_custkey", F.lit(None).cast("string").alias("ASSET_ID"))
    marks, first = fresh_folder(spark, "marks"), F.col("c_custkey") % 3 == 0
    fill = lambda df: syncing.fill_sequence_ids(df, ["c_custkey"], "ASSET_ID", marks, "AST", start=5, pad=True)
    some = stored(fill(rows.where(first)))
    return fill(stored(fill(some.unionByName(rows.where(~first)))))


@query
def assign_sequence_ids(spark, folder):
    rows = _Inputs(spark, folder).application.select("Planning_App_Num", "App_Status")
    rows = syncing.assign_sequence_ids(rows, ["App_Status", "Planning_App_Num"], "APPID", "APP", start=5)
    return rows


@query
def padded_sequence_ids(spark, folder):
    rows = _Inputs(spark, folder).rw_copy.select("c_custkey", "c_name")
    return syncing.assign_sequence_ids(rows, ["c_custkey"], "ASSET_ID", "C", pad=True)


@query
def domain_order(spark, folder):
    return domains.domain_order(_Inputs(spark, folder).source_domain, subtype_domains=["LND_Brand_2_PROMO"])


# --- set operations ---


@query
def related_table(spark, folder):
    return _Inputs(spark, folder).shared().related_table


@query
def split_duplicates(spark, folder):
    """Unique and related rows side by side."""
    given = _Inputs(spark, folder).split()
    unique = given.unique.select(F.lit("unique").alias("part"), *duplicates.RELATED_COLUMNS)
    related = given.related.select(F.lit("related").alias("part"), *duplicates.RELATED_COLUMNS)
    return unique.unionByName(related)


@query
def drop_duplicate_rows(spark, folder):
    return duplicates.without_copies(duplicates.with_padded_pid(_Inputs(spark, folder).shared().related))


@query
def missing_domains(spark, folder):
    given = _Inputs(spark, folder)
    return domains.missing_domains(given.domain_request, given.target_domain)


@query
def domain_transfer_plan(spark, folder):
    given = _Inputs(spark, folder)
    return domains.domain_transfer_plan(given.domain_request, given.source_domain, given.target_domain)


@query
def domain_types(spark, folder):
    given = _Inputs(spark, folder)
    new = domains.missing_domains(given.domain_request, given.target_domain)
    return domains.domain_types(
        new,
        overrides={"LND_A_PROMO": "SHORT", "LND_N_PROMO": "DOUBLE"},
        subtype_domains=["LND_N_PROMO", "LND_R_SMALL"],
    )


# --- scalar functions ---


@query
def normalize_pids(spark, folder):
    pids = t.pid_list(F.col("PIDs"))
    return _Inputs(spark, folder).application.select(
        "Planning_App_Num", F.array_join(pids, "|").alias("pids"), F.size(pids).alias("n_pids")
    )


@query
def primary_pid(spark, folder):
    return _Inputs(spark, folder).application.select(
        "Planning_App_Num", t.primary_pid(F.col("PIDs")).alias("primary_pid")
    )


@query
def category_from_name(spark, folder):
    rows = _Inputs(spark, folder).permit_category.select("Permit_Category").withColumns(
        {
            "table_name": F.concat(F.lit("PPLC_"), F.col("Permit_Category"), F.lit("_Permits")),
            "file_name": F.concat(F.lit("PPLC_Issued_"), F.col("Permit_Category"), F.lit("_Permits.csv")),
        }
    )
    short = t.renamed(F.concat(F.lit("LND_"), F.col("table_name")), t.SHORT_NAMES)
    return (
        rows.select(
            "table_name",
            t.category_of_table(F.col("table_name")).alias("from_table"),
            t.category_of_file(F.col("file_name")).alias("from_file"),
            short.alias("short_name"),
            t.renamed(short, t.RELATIONSHIPS).alias("relationship"),
        )
        .groupBy("table_name", "from_table", "from_file", "short_name", "relationship")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def strip_html(spark, folder):
    return _Inputs(spark, folder).table("pages").select("page_id", without_tags(F.col("html")).alias("text"))


@query
def tag_text(spark, folder):
    xml = F.col("xml")
    return _Inputs(spark, folder).metadata.select(
        "doc_id", t.tag_text(xml, "CreaDate").alias("created"), t.tag_text(xml, "reviseDate").alias("revised")
    )


@query
def revise_date(spark, folder):
    stamp = t.day_stamp(F.lit("2024-05-17").cast("date"))
    return metadata.revise_date(_Inputs(spark, folder).metadata, stamp).select("doc_id", "xml")


@query
def metadata_records(spark, folder):
    given = _Inputs(spark, folder)
    pages = given.table("pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("description"))
    datasets = given.metadata.join(pages, "doc_id", "left")
    return metadata.metadata_records(datasets, "GISDB", "ADM")


# --- geometry ---


@query
def parcel_centroid(spark, folder):
    return _rounded(parcels.parcel_centroid(_Inputs(spark, folder).parcel_vertex), "x", "y")


@query
def centroid_inside(spark, folder):
    return parcels.centroid_inside(_Inputs(spark, folder).parcel_vertex)


@query
def parcel_label_point(spark, folder):
    return _rounded(parcels.parcel_label_point(_Inputs(spark, folder).parcel_vertex), "x", "y")


@query
def parcel_point(spark, folder):
    return _rounded(parcels.parcel_point(_Inputs(spark, folder).parcel_vertex), "x", "y")


@query
def parcel_measures(spark, folder):
    return _rounded(parcels.parcel_measures(_Inputs(spark, folder).parcel_vertex), "area", "perimeter")


@query
def reproject_points(spark, folder):
    civics = _Inputs(spark, folder).civic.select("CIV_ID", "X", "Y")
    return _rounded(projection.reprojected(civics, "X", "Y", projection.SOURCE_SYSTEM), "X", "Y", digits=3)


# --- specifications and audit ---


@query
def spec_to_schema(spark, folder):
    return forms.spec_to_schema(_Inputs(spark, folder).form_cell)


@query
def spec_violations(spark, folder):
    return forms.spec_violations(_Inputs(spark, folder).form_cell)


def _checked(spark, folder):
    given = _Inputs(spark, folder)
    cells = given.form_cell
    return specs.checked_cells(given.form_value, forms.spec_to_schema(cells), forms.domain_blocks(cells))


@query
def spec_applied(spark, folder):
    """Every cell of the data submitted under the forms that breaks a rule of its form."""
    return specs.cell_violations(_checked(spark, folder))


@query
def spec_filled(spark, folder):
    """The submitted data with types, defaults and decoded values."""
    return specs.filled_cells(_checked(spark, folder))


@query
def domain_blocks(spark, folder):
    return forms.domain_blocks(_Inputs(spark, folder).form_cell)


@query
def spec_domain_fields(spark, folder):
    return forms.spec_domain_fields(_Inputs(spark, folder).form_cell)


@query
def form_metadata(spark, folder):
    return forms.form_metadata(_Inputs(spark, folder).form_note)


@query
def stamp_audit(spark, folder):
    given = _Inputs(spark, folder)
    changes = syncing.sync_changes(given.rw_copy, given.ro_copy, ["c_custkey"])
    stamped = syncing.stamp_audit(changes, "LOADER", F.lit("2024-05-17 00:00:00"))
    return stamped.select("c_custkey", "change", "ADDBY", "ADDDATE", "MODBY", "MODDATE")


@query
def global_ids(spark, folder):
    rows = _Inputs(spark, folder).unique.select(*PERMIT)
    return syncing.with_global_ids(rows, "LND_PPLC_Permit_Info", PERMIT)


@query
def length_violations(spark, folder):
    rows = _Inputs(spark, folder).permit_category
    return quality.length_violations(rows, {"Work_Description": 30, "Occupancy_Type": 8, "Street_Name": 10, "PID": 8})


# --- the whole job ---


@query
def locate_permits(spark, folder):
    rows = _Inputs(spark, folder).located
    return _rounded(rows.select(*PERMIT, "route", "method", "reason", "score", "X", "Y"), "X", "Y")


@query
def locate_permits_summary(spark, folder):
    """How many permits each route and method places, and why the others fail."""
    return quality.locate_summary(
        _Inputs(spark, folder).located, ["Permit_Category", "route", "method", "reason"]
    )
