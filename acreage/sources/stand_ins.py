"""Land-record tables derived from the generic test tables.

Each text is plain SQL that Spark and DuckDB read alike; ``{S}`` is the engine's text type. The texts
refer to each other and to the parquet tables by name, and ``with_tables`` gathers the ones a query needs
into common table expressions, so nothing is registered in the session catalog.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

STAND_INS = {
    # one row per permit and parcel; several rows share a permit number
    "fx_permit": """
        SELECT 'BP-' || lpad(cast(l.l_orderkey AS {S}), 8, '0') AS Permit_Number,
               CASE WHEN l.l_linenumber = 7 THEN NULL ELSE cast(l.l_partkey AS {S}) END AS PID,
               CASE WHEN l.l_returnflag = 'R' THEN 'N' WHEN l.l_returnflag = 'N' AND l.l_linenumber = 1 THEN NULL
                    ELSE 'Y' END AS Active_Parcel,
               CASE o.o_orderkey % 3 WHEN 0 THEN 'RESIDENTIAL' WHEN 1 THEN p.p_type ELSE NULL END AS Occupancy_Type,
               CASE WHEN o.o_orderkey % 4 IN (0, 1) THEN o.o_custkey END AS Civic_ID,
               CASE WHEN o.o_orderkey % 4 = 2 THEN cast(o.o_custkey % 900 + 1 AS {S})
                    || CASE WHEN o.o_custkey % 6 = 0 THEN ' A' ELSE '' END END AS Civic_Number,
               CASE WHEN o.o_orderkey % 4 = 2 OR o.o_orderkey % 8 = 7 THEN
                    CASE WHEN o.o_custkey % 35 = 0 THEN 'XQZ'
                         WHEN o.o_custkey % 5 = 0 THEN replace(c.c_mktsegment, 'I', 'E')
                         ELSE c.c_mktsegment END END AS Street_Name,
               CASE WHEN o.o_orderkey % 4 = 2 THEN n.n_name END AS Community,
               p.p_name || '  ' || o.o_orderpriority || '   ' || l.l_linestatus AS Work_Description,
               l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    # the same rows, told apart by the category table they come from
    "fx_permit_category": """
        SELECT *, CASE l_suppkey % 6 WHEN 0 THEN 'Building' WHEN 1 THEN 'Construction' WHEN 2 THEN 'Engineering'
                  WHEN 3 THEN 'Halifax_Water' WHEN 4 THEN 'Land_Use_Approval' ELSE 'Public_Works_ROW' END
                  AS Permit_Category
        FROM fx_permit""",
    "fx_civic": """
        SELECT c.c_custkey AS CIV_ID,
               cast(c.c_custkey % 900 + 1 AS {S}) || CASE WHEN c.c_custkey % 6 = 0 THEN 'A' ELSE '' END AS FULL_CIVIC,
               c.c_mktsegment AS STR_NAME, n.n_name AS GSA_NAME,
               cast(25560000 + (c.c_custkey % 100) * 25 AS double) AS X,
               cast(4950000 + ((c.c_custkey - c.c_custkey % 100) / 100) * 25 AS double) AS Y,
               CASE WHEN c.c_custkey % 10 < 7 THEN 'ACTIVE' WHEN c.c_custkey % 10 < 9 THEN 'RETIRED'
                    ELSE 'ABSENT' END AS status
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    # civic addresses with all their fields, and permits' addresses with every way to write them not quite so
    "fx_locator_civic": """
        SELECT c.c_custkey AS CIV_ID, cast(c.c_custkey % 40 + 1 AS {S}) AS FULL_CIVIC, upper(p.p_name) AS STR_NAME,
               CASE c.c_custkey % 4 WHEN 0 THEN 'ST' WHEN 1 THEN 'Road' WHEN 2 THEN 'AVE' END AS STR_TYPE,
               CASE WHEN c.c_custkey % 5 = 0 THEN cast(c.c_custkey % 7 AS {S}) END AS UNIT_NUM,
               'D' || cast(c.c_nationkey % 5 AS {S}) AS DISTRICT, n.n_name AS GSA_NAME,
               CASE WHEN c.c_nationkey % 2 = 0 THEN 'EAST' ELSE 'WEST' END AS MUN_CODE,
               'B' || cast(c.c_nationkey % 9 AS {S}) || 'H ' || cast(c.c_custkey % 9 AS {S}) || 'K1' AS CIV_POSTAL,
               cast(25560000 + c.c_custkey * 3 AS double) AS X, cast(4950000 + c.c_custkey * 2 AS double) AS Y
        FROM customer c JOIN part p ON p.p_partkey = c.c_custkey * 7 % 200 JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "fx_locator_permit": """
        SELECT o.o_orderkey AS permit_no,
               CASE WHEN k.form = 6 THEN '9' || c.FULL_CIVIC WHEN k.form = 11 THEN NULL ELSE c.FULL_CIVIC || ' ' END AS Civic_Number,
               CASE k.form WHEN 0 THEN c.STR_NAME || ' ST' WHEN 1 THEN replace(replace(c.STR_NAME, 'I', 'E'), 'O', 'U')
                    WHEN 2 THEN lower(c.STR_NAME) || ' street' WHEN 3 THEN substr(c.STR_NAME, 2) WHEN 8 THEN 'XQZ STREET'
                    WHEN 9 THEN c.STR_NAME || '  ROAD' ELSE c.STR_NAME END AS Street_Name,
               CASE WHEN k.form IN (4, 5) THEN c.STR_TYPE END AS Street_Type,
               CASE WHEN k.form IN (5, 7) THEN cast(o.o_orderkey % 7 AS {S}) END AS Unit,
               CASE WHEN k.form = 5 THEN c.DISTRICT END AS District,
               CASE WHEN k.form = 2 THEN NULL WHEN k.form = 3 THEN 'ELSEWHERE' ELSE c.GSA_NAME END AS Community,
               CASE WHEN k.form IN (5, 10) THEN c.MUN_CODE END AS Municipality,
               CASE WHEN k.form IN (4, 10) THEN replace(c.CIV_POSTAL, ' ', '') WHEN k.form = 3 THEN c.CIV_POSTAL || 'X' END AS Postal
        FROM orders o JOIN (SELECT o_orderkey AS k, o_orderkey % 12 AS form FROM orders) k ON k.k = o.o_orderkey
        JOIN fx_locator_civic c ON c.CIV_ID = o.o_custkey""",
    # squares on a grid; some are U-shaped, so that the centroid falls outside
    "fx_parcel_vertex": """
        SELECT lpad(cast(p.p_partkey AS {S}), 8, '0') AS PID, 0 AS ring, v.seq,
               cast(25560000 + (p.p_partkey % 50) * 20 + v.dx AS double) AS x,
               cast(4950000 + ((p.p_partkey - p.p_partkey % 50) / 50) * 20 + v.dy AS double) AS y
        FROM part p JOIN (VALUES (0,0,0,0),(0,1,20,0),(0,2,20,20),(0,3,0,20),
                                 (1,0,0,0),(1,1,20,0),(1,2,20,20),(1,3,16,20),(1,4,16,4),(1,5,4,4),(1,6,4,20),
                                 (1,7,0,20)) AS v(shape, seq, dx, dy)
          ON v.shape = CASE WHEN p.p_partkey % 7 = 0 THEN 1 ELSE 0 END
        WHERE p.p_partkey % 11 <> 0""",
    "fx_application": """
        SELECT o_orderkey AS Planning_App_Num, o_orderstatus AS App_Status, o_orderdate AS Submitted_Date,
               o_orderpriority AS Application_Type, 'Customer ' || cast(o_custkey AS {S}) AS Application_Name,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL
                    WHEN o_orderkey % 6 = 1 THEN cast(o_orderkey % 2000 AS {S})
                    WHEN o_orderkey % 6 = 5 THEN ' , '
                    ELSE cast(o_orderkey % 2000 AS {S}) || ', ' || cast((o_orderkey + 1) % 2000 AS {S}) END AS PIDs
        FROM orders""",
    # ground plots that do not all meet corner to corner: sides split on one side only, holes, rings wound either way, and
    # plots that lie on the place of another
    "fx_ground_vertex": """
        SELECT lpad(cast(p.p_partkey AS {S}), 8, '0') AS PID, v.ring, v.seq,
               cast(25560000 + (g.cell % 50) * 20 + v.dx AS double) AS x,
               cast(4950000 + ((g.cell - g.cell % 50) / 50) * 20 + v.dy AS double) AS y
        FROM part p JOIN (SELECT p_partkey AS k, CASE WHEN p_partkey % 13 = 0 THEN p_partkey - 1 ELSE p_partkey END AS cell
                          FROM part) g ON g.k = p.p_partkey
        JOIN (VALUES (0,0,0,0,0),(0,0,1,20,0),(0,0,2,20,20),(0,0,3,0,20),
                     (1,0,0,0,0),(1,0,1,20,0),(1,0,2,20,10),(1,0,3,20,20),(1,0,4,15,20),(1,0,5,5,20),(1,0,6,0,20),
                     (2,0,0,0,0),(2,0,1,20,0),(2,0,2,20,20),(2,0,3,0,20),(2,1,0,6,6),(2,1,1,6,14),(2,1,2,14,14),(2,1,3,14,6),
                     (3,0,0,0,0),(3,0,1,0,20),(3,0,2,20,20),(3,0,3,20,0),
                     (4,0,0,0,0),(4,0,1,8,0),(4,0,2,20,0),(4,0,3,20,20),(4,0,4,0,20),(4,0,5,0,7)) AS v(shape, ring, seq, dx, dy)
          ON v.shape = CASE WHEN p.p_partkey % 8 < 5 THEN p.p_partkey % 8 ELSE 0 END""",
    "fx_ground_application": """
        SELECT k.Planning_App_Num,
               CASE k.form WHEN 0 THEN cast(k.pid AS {S})
                    WHEN 1 THEN cast(k.pid AS {S}) || ', ' || cast(k.pid + 1 AS {S})
                    WHEN 2 THEN cast(k.pid AS {S}) || ',' || cast(k.pid + 51 AS {S})
                    WHEN 3 THEN cast(k.pid AS {S}) || ',' || cast(k.pid + 1 AS {S}) || ',' || cast(k.pid + 50 AS {S})
                                || ',' || cast(k.pid + 51 AS {S})
                    ELSE cast(k.pid AS {S}) || ',' || cast(k.pid + 1 AS {S}) || ',' || cast(k.pid + 2 AS {S}) || ','
                         || cast(k.pid + 50 AS {S}) || ',' || cast(k.pid + 52 AS {S}) || ',' || cast(k.pid + 100 AS {S})
                         || ',' || cast(k.pid + 101 AS {S}) || ',' || cast(k.pid + 102 AS {S}) END AS PIDs
        FROM (SELECT o_orderkey AS Planning_App_Num, o_orderkey % 5 AS form, o_orderkey % 97 + 1 AS pid FROM orders) k""",
    "fx_street": """
        SELECT s_suppkey AS FDMID, 0 AS seq,
               cast(25560000 + s_suppkey * 10 AS double) AS x0, cast(4950000 AS double) AS y0,
               cast(25560000 + s_suppkey * 10 + 8 AS double) AS x1, cast(4950000 + s_suppkey AS double) AS y1
        FROM supplier
        UNION ALL
        SELECT s_suppkey, 1, cast(25560000 + s_suppkey * 10 + 8 AS double), cast(4950000 + s_suppkey AS double),
               cast(25560000 + s_suppkey * 10 + 8 AS double), cast(4950000 + s_suppkey + 6 AS double)
        FROM supplier""",
    # the edited copy and the published copy of one table
    "fx_rw_copy": """
        SELECT c_custkey, 'AST' || cast(c_custkey AS {S}) AS ASSET_ID, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "fx_ro_copy": """
        SELECT c_custkey,
               'AST' || cast(CASE WHEN c_custkey % 19 = 0 THEN c_custkey + 1 ELSE c_custkey END AS {S}) AS ASSET_ID,
               c_name, c_nationkey,
               CASE WHEN c_custkey % 13 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 17 <> 0
        UNION ALL
        SELECT s_suppkey + 1000000000, 'AST' || cast(s_suppkey AS {S}), s_name, s_nationkey, s_acctbal, NULL
        FROM supplier""",
    # coded values for order columns
    "fx_order_domain": """
        SELECT * FROM (VALUES ('ORD_status','F','Finished'),('ORD_status','O','Open'),
          ('ORD_prio_open','1-URGENT','1'),('ORD_prio_open','2-HIGH','2'),('ORD_prio_open','3-MEDIUM','10'),
          ('ORD_prio_closed','4-NOT SPECIFIED','None given'),('ORD_prio_closed','5-LOW','Low'),
          ('ORD_prio_closed','3-MEDIUM',NULL)) AS v(domain, code, description)""",
    "fx_order_subtype": """
        SELECT * FROM (VALUES ('O','o_orderpriority','ORD_prio_open'),('F','o_orderpriority','ORD_prio_closed'))
          AS v(subtype_code, field, domain)""",
    # coded-value lists as found in the source, the target and the request
    "fx_source_domain": """
        SELECT 'LND_' || replace(p_brand, '#', '_') || '_' || p_type AS domain,
               cast(p_partkey AS {S}) AS code,
               CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN p_name || ' ' || cast(p_partkey AS {S})
                    ELSE cast(p_size * 7 AS {S}) END AS description
        FROM part""",
    "fx_target_domain": """
        SELECT DISTINCT upper('LND_' || replace(p_brand, '#', '_') || '_' || p_type) AS domain
        FROM part WHERE p_brand LIKE '%2' OR p_type = 'ECONOMY'""",
    "fx_domain_request": """
        SELECT DISTINCT CASE WHEN l_linenumber = 5 THEN lower('LND_' || replace(p_brand, '#', '_') || '_' || p_type)
                             WHEN l_linenumber = 6 THEN 'LND_' || l_returnflag || '_' || p_type
                             ELSE 'LND_' || replace(p_brand, '#', '_') || '_' || p_type END AS domain
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    # one submission form per supplier, as the cells of its sheet
    "fx_form_cell": """
        SELECT s_suppkey AS form_id, v.row_no,
               v.c0 AS c0,
               CASE v.c1 WHEN '#name' THEN 'LND_area_' || cast(s_suppkey AS {S})
                         WHEN '#domain' THEN 'LND_status_' || cast(s_nationkey AS {S})
                         ELSE v.c1 END AS c1,
               v.c2, CASE v.c3 WHEN '#len' THEN cast(s_nationkey + 1 AS {S}) ELSE v.c3 END AS c3,
               v.c4, CASE v.c5 WHEN '#domain' THEN 'LND_status_' || cast(s_nationkey AS {S}) ELSE v.c5 END AS c5,
               v.c6
        FROM supplier JOIN (VALUES
          (0,1,'Feature Class Name:','#name',NULL,NULL,NULL,NULL,NULL),(0,2,'Shape Type:','Polygon',NULL,NULL,NULL,NULL,NULL),
          (0,3,'Feature Type:','Feature Class',NULL,NULL,NULL,NULL,NULL),
          (0,4,'Alias','Field Name','Field Type','Field Length','Default Value','Domain','Subtype Field'),
          (0,5,'Area Id','area_id ','LONG',NULL,NULL,NULL,NULL),(0,6,'Status','STATUS','TEXT','#len','O','#domain','Y'),
          (0,7,'Note','NOTE','TEXT',NULL,NULL,NULL,NULL),(0,8,'Odd','ODD','MONEY',NULL,NULL,NULL,NULL),
          (0,9,'SHAPE_Area','SHAPE_AREA','DOUBLE',NULL,NULL,NULL,NULL),
          (0,10,'SHAPE_Length','SHAPE_LENGTH','DOUBLE',NULL,NULL,NULL,NULL),
          (0,11,'Fields with associated codes(values) and descriptions',NULL,NULL,NULL,NULL,NULL,NULL),
          (0,12,'STATUS','#domain',NULL,NULL,NULL,NULL,NULL),(0,13,'Code','Description',NULL,NULL,NULL,NULL,NULL),
          (0,14,'F','Finished',NULL,NULL,NULL,NULL,NULL),(0,15,'O','Open',NULL,NULL,NULL,NULL,NULL),
          (0,16,'PRIO','ORD prio',NULL,NULL,NULL,NULL,NULL),(0,17,'Code','Description',NULL,NULL,NULL,NULL,NULL),
          (0,18,'1','One',NULL,NULL,NULL,NULL,NULL),(0,19,'2',NULL,NULL,NULL,NULL,NULL,NULL),
          (1,1,'Data Source Name:','#name',NULL,NULL,NULL,NULL,NULL),(1,2,'Shape Type:',NULL,NULL,NULL,NULL,NULL,NULL),
          (1,3,'Feature Type:','Table',NULL,NULL,NULL,NULL,NULL),
          (1,4,'Alias','Field Name','Field Type','Field Length','Default Value','Domain','Subtype Field'),
          (1,5,'Code','CODE','STRING','#len',NULL,'#domain',NULL),(1,6,'Opened','OPENED','DATEONLY',NULL,NULL,NULL,NULL),
          (1,7,'Amount','AMOUNT','DOUBLE',NULL,'1',NULL,NULL),(1,8,'GLOBALID','GLOBALID','TEXT','38',NULL,NULL,NULL),
          (1,9,NULL,'stray',NULL,NULL,NULL,NULL,NULL),
          (1,11,'Fields with associated codes(values) and descriptions',NULL,NULL,NULL,NULL,NULL,NULL),
          (1,12,'CODE_A','#domain',NULL,NULL,NULL,NULL,NULL),(1,13,'Code','Description',NULL,NULL,NULL,NULL,NULL),
          (1,14,'A','Alpha',NULL,NULL,NULL,NULL,NULL),
          (1,15,'EMPTY','LND_empty',NULL,NULL,NULL,NULL,NULL),(1,16,'Code','Description',NULL,NULL,NULL,NULL,NULL),
          (2,1,'Feature Class Name:','#name',NULL,NULL,NULL,NULL,NULL),(2,2,'Shape Type:','Line',NULL,NULL,NULL,NULL,NULL),
          (2,3,'Feature Type:','Feature Class',NULL,NULL,NULL,NULL,NULL),
          (2,4,'Alias','Field Name','Field Type','Field Length','Default Value','Domain','Subtype Field'),
          (2,5,'Road','ROAD','TEXT','#len',NULL,NULL,NULL),(2,6,'GLOBALID','GLOBALID','TEXT','38',NULL,NULL,NULL)
        ) AS v(kind, row_no, c0, c1, c2, c3, c4, c5, c6) ON v.kind = s_suppkey % 3""",
    # data submitted under these forms, one row per cell
    "fx_form_value": """
        SELECT s_suppkey AS form_id, v.record, v.field, CASE v.value WHEN '#name' THEN s_name ELSE v.value END AS value
        FROM supplier JOIN (VALUES
          (0,1,'area_id','17'),(0,1,'STATUS','F'),(0,1,'NOTE','fine'),(0,1,'ODD','any'),(0,2,'AREA_ID','x1'),(0,2,'STATUS','Z'),
          (0,2,'COLOUR','red'),(0,3,'AREA_ID',' 8 '),(0,3,'STATUS',NULL),(0,3,'NOTE','#name'),(0,4,'STATUS','Finished long ago, it seems'),
          (0,4,'STATUS','O'),(1,1,'CODE','A'),(1,1,'OPENED','2024-02-30'),(1,1,'AMOUNT','12.50'),(1,2,'CODE','B'),
          (1,2,'OPENED','2024-02-29'),(1,2,'AMOUNT','twelve'),(1,3,'STRAY','1'),(1,3,'CODE','  '),(2,1,'ROAD','#name'),
          (2,1,'globalid','{1}'),(2,2,' road ','A')) AS v(kind, record, field, value) ON v.kind = s_suppkey % 3""",
    # the descriptive sheet of the same forms
    "fx_form_note": """
        SELECT s_suppkey AS form_id, v.row_no, v.c0,
               CASE WHEN v.row_no = 1 THEN 'Areas of ' || s_name END AS c1
        FROM supplier JOIN (VALUES
          (0,1,'Dataset Name:'),(0,2,'Dataset Description:'),(0,3,'Areas kept by the city'),(0,4,NULL),
          (0,5,'Dataset Purpose:'),(0,6,'Open data'),(0,7,'Dataset Tags:'),(0,8,'area, land'),
          (0,9,'Notes or Disclaimers:'),(0,10,'None known'),
          (1,1,'Dataset Name:'),(1,2,'Dataset Tags:'),(1,3,'table'),(1,4,'Dataset Description:'),(1,5,NULL),
          (1,6,'Notes or Disclaimers:')
        ) AS v(kind, row_no, c0) ON v.kind = s_suppkey % 2""",
    "fx_metadata": """
        SELECT doc_id, 'GISDB.ADM.' || source || '_' || cast(doc_id AS {S})
                 || CASE doc_id % 7 WHEN 0 THEN '_SAP' WHEN 1 THEN '_H' WHEN 2 THEN '_temp' ELSE '' END AS feature,
               CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang || ' dataset' END AS title,
               '<metadata><CreaDate>2024010' || cast(doc_id % 9 + 1 AS {S}) || '</CreaDate>' ||
               CASE WHEN doc_id % 3 = 0 THEN '' ELSE '<reviseDate>2024-02-0' || cast(doc_id % 9 + 1 AS {S})
                    || 'T00:00:00</reviseDate>' END || '</metadata>' AS xml
        FROM documents""",
}

# the same joins in the order in which the fewest bytes are shuffled: the lines' parts first, then the orders with all theirs
_PERMIT_JOINS = STAND_INS["fx_permit"].index("FROM lineitem")
SPARK_TEXTS = {
    "fx_permit": STAND_INS["fx_permit"][:_PERMIT_JOINS]
    + """FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        JOIN (orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
          ON l.l_orderkey = o.o_orderkey"""
}


def with_tables(body: str, texts: dict[str, str] | None = None) -> str:
    """``body`` with the stand-ins it names, and those they name, as common table expressions."""
    texts = texts or STAND_INS
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+\(?([a-z_]\w*)", sql):
            if word in texts and word not in needed:
                visit(texts[word])
                if word not in needed:
                    needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({texts[name]})" for name in needed) + "\n" + body


def stand_in(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The stand-in ``name`` over the parquet tables in ``folder``."""
    tables = {t: f"SELECT * FROM parquet.`{folder}/{t}.parquet`" for t in BASE_TABLES}
    texts = {**tables, **STAND_INS, **SPARK_TEXTS}
    return spark.sql(with_tables(f"SELECT * FROM {name}", texts).replace("{S}", "string"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
