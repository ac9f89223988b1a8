"""The same questions in plain SQL for DuckDB, written without regard to scale."""

from __future__ import annotations

from acreage.operators.cleaning import PLANNING_FIELDS, SUBDIVISION_FIELDS
from acreage.sources.stand_ins import STAND_INS, with_tables

DATED = "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"
TIES = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
TIES_DOWN = ", ".join(f"{c} DESC NULLS LAST" for c in TIES.split(", "))
KEEP_ORDER = f"(Active_Parcel IS NULL) DESC, Active_Parcel DESC, {TIES_DOWN}"
PADDED = "CASE WHEN length({0}) >= 8 THEN {0} ELSE lpad({0}, 8, '0') END"
IGNORED = "('OBJECTID', 'GLOBALID', 'SHAPE', 'SHAPE_AREA', 'SHAPE_LENGTH')"
# street names as the locator reads them: without the type at their end, which counts as a field of its own
STREET_TYPE = "CASE upper({0}) WHEN 'STREET' THEN 'ST' WHEN 'ROAD' THEN 'RD' ELSE upper({0}) END"
_WHOLE = r"trim(regexp_replace(upper({0}), '\s+', ' ', 'g'))"
_LAST = rf"regexp_extract({_WHOLE}, '[A-Z]+$')"
_ENDS = rf"regexp_matches({_WHOLE}, '.+ (ST|STREET|ROAD|RD|AVE)$')"
STREET_NAME = rf"CASE WHEN {_ENDS} THEN regexp_extract({_WHOLE}, '^(.*) [A-Z]+$', 1) ELSE {_WHOLE} END"
STREET_END = f"CASE WHEN {_ENDS} THEN {STREET_TYPE.replace('{0}', _LAST)} END"

STEPS = {
    "clean": r"""
        SELECT * EXCLUDE (PID, Civic_Number, Street_Name, Community, Work_Description),
               nullif(nullif(nullif(trim(PID), ''), 'nan'), 'None') AS PID,
               nullif(nullif(nullif(trim(Civic_Number), ''), 'nan'), 'None') AS Civic_Number,
               nullif(trim(Street_Name), '') AS Street_Name, nullif(trim(Community), '') AS Community,
               substr(regexp_replace(Work_Description, '\s{2,}', ' ', 'g'), 1, 2000) AS Work_Description,
               replace(Civic_Number, ' ', '') || ' ' || Street_Name || ', ' || Community || ' NOVA SCOTIA'
                   AS FORMATTEDADDRESS
        FROM fx_permit_category""",
    "ranked": f"""
        SELECT *, row_number() OVER (PARTITION BY Permit_Category, Permit_Number ORDER BY {KEEP_ORDER}) AS rn,
               count(*) OVER (PARTITION BY Permit_Category, Permit_Number) AS n_rows
        FROM clean""",
    "uniq": "SELECT * EXCLUDE (rn, n_rows) FROM ranked WHERE rn = 1",
    "grouped": f"""
        SELECT *,
               row_number() OVER (PARTITION BY Permit_Category, Permit_Number
                                  ORDER BY Active_Parcel NULLS LAST, {TIES}) AS first_rn,
               count(DISTINCT coalesce(PID, '<null>')) OVER (PARTITION BY Permit_Category, Permit_Number) AS npid,
               count(DISTINCT coalesce(Occupancy_Type, '<null>'))
                   OVER (PARTITION BY Permit_Category, Permit_Number) AS nocc,
               bool_and(coalesce(Active_Parcel = 'Y', false))
                   OVER (PARTITION BY Permit_Category, Permit_Number) AS ally
        FROM ranked WHERE n_rows > 1""",
    "related_raw": """
        SELECT Permit_Category, Permit_Number, PID, Occupancy_Type, Active_Parcel
        FROM grouped
        WHERE NOT coalesce(npid > 1 AND nocc = 1 AND Permit_Number IS NOT NULL
                  AND CASE WHEN ally THEN first_rn = 1 ELSE coalesce(Active_Parcel = 'Y', false) END, false)""",
    "additions": """
        SELECT Permit_Category, Permit_Number, PID, Occupancy_Type, Active_Parcel FROM uniq u
        WHERE Occupancy_Type IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM related_raw r WHERE r.Permit_Category = u.Permit_Category
              AND r.Permit_Number IS NOT DISTINCT FROM u.Permit_Number AND r.Occupancy_Type = u.Occupancy_Type)""",
    "related": f"""
        SELECT DISTINCT Permit_Category, Permit_Number, {PADDED.format("PID")} AS PID, Occupancy_Type, Active_Parcel
        FROM (SELECT * FROM related_raw UNION ALL SELECT * FROM additions)""",
    "active": "SELECT * FROM fx_civic WHERE status = 'ACTIVE'",
    "retired": "SELECT * FROM fx_civic WHERE status = 'RETIRED'",
    "routed": f"""
        SELECT * REPLACE ({PADDED.format("PID")} AS PID),
               CASE WHEN Civic_ID IS NOT NULL THEN '1_civic_id'
                    WHEN Civic_Number IS NOT NULL AND Street_Name IS NOT NULL AND Community IS NOT NULL
                        THEN '2_address'
                    WHEN Civic_Number IS NULL AND Street_Name IS NULL AND Community IS NULL AND PID IS NOT NULL
                        THEN '3_pid'
                    WHEN Civic_Number IS NULL AND Street_Name IS NULL AND Community IS NULL THEN '4_none'
                    ELSE '5_partial' END AS route
        FROM uniq""",
    # every address against every civic of its house number and community
    "scored": """
        SELECT u.Permit_Category, u.Permit_Number, a.CIV_ID, a.X, a.Y,
               CASE WHEN u.Street_Name = a.STR_NAME THEN 100
                    ELSE 100 * (greatest(length(u.Street_Name), length(a.STR_NAME))
                                - levenshtein(u.Street_Name, a.STR_NAME))
                         // greatest(length(u.Street_Name), length(a.STR_NAME)) END AS score
        FROM routed u JOIN active a
          ON a.GSA_NAME = u.Community AND a.FULL_CIVIC = replace(u.Civic_Number, ' ', '')
        WHERE u.route = '2_address'""",
    "matched": """
        SELECT * FROM scored WHERE score > 60
        QUALIFY row_number() OVER (PARTITION BY Permit_Category, Permit_Number ORDER BY score DESC, CIV_ID) = 1""",
    "edge": """
        SELECT PID, ring, seq, x, y, coalesce(lead(x) OVER w, first(x) OVER w) AS nx,
               coalesce(lead(y) OVER w, first(y) OVER w) AS ny,
               first(x) OVER (PARTITION BY PID ORDER BY ring, seq) AS ox,
               first(y) OVER (PARTITION BY PID ORDER BY ring, seq) AS oy
        FROM fx_parcel_vertex WINDOW w AS (PARTITION BY PID, ring ORDER BY seq
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "local_edge": "SELECT PID, ring, seq, ox, oy, x-ox AS x0, y-oy AS y0, nx-ox AS x1, ny-oy AS y1 FROM edge",
    "measure": """
        SELECT PID, min(ox) AS ox, min(oy) AS oy, abs(sum(x0*y1 - x1*y0)) / 2 AS area,
               sum(sqrt((x1-x0)*(x1-x0) + (y1-y0)*(y1-y0))) AS perimeter,
               sum((x0+x1)*(x0*y1-x1*y0)) / (3 * sum(x0*y1-x1*y0)) AS cx,
               sum((y0+y1)*(x0*y1-x1*y0)) / (3 * sum(x0*y1-x1*y0)) AS cy,
               (min(y0) + max(y0)) / 2 AS mid
        FROM local_edge GROUP BY PID""",
    "inside": """
        SELECT e.PID, sum(CASE WHEN (y0 > cy) <> (y1 > cy) AND cx < x0 + (cy-y0)*(x1-x0)/(y1-y0) THEN 1 ELSE 0 END)
                      % 2 = 1 AS inside
        FROM local_edge e JOIN measure m ON e.PID = m.PID GROUP BY e.PID""",
    "scan": """
        SELECT e.PID, (max(CASE WHEN y0 <= mid THEN y0 END) + min(CASE WHEN y0 > mid THEN y0 END)) / 2 AS h
        FROM local_edge e JOIN measure m ON e.PID = m.PID GROUP BY e.PID""",
    "cut": """
        SELECT e.PID, h, x0 + (h-y0)*(x1-x0)/(y1-y0) AS at,
               row_number() OVER (PARTITION BY e.PID ORDER BY x0 + (h-y0)*(x1-x0)/(y1-y0)) AS k
        FROM local_edge e JOIN scan s ON e.PID = s.PID WHERE (y0 > h) <> (y1 > h)""",
    "label": """
        SELECT a.PID, (a.at + b.at) / 2 AS lx, a.h AS ly
        FROM cut a JOIN cut b ON a.PID = b.PID AND b.k = a.k + 1 WHERE a.k % 2 = 1
        QUALIFY row_number() OVER (PARTITION BY a.PID ORDER BY b.at - a.at DESC, a.at) = 1""",
    "point": """
        SELECT m.PID, CASE WHEN inside THEN ox + cx ELSE ox + lx END AS x,
               CASE WHEN inside THEN oy + cy ELSE oy + ly END AS y,
               CASE WHEN inside THEN 'centroid' ELSE 'label' END AS kind
        FROM measure m JOIN inside i ON m.PID = i.PID JOIN label l ON m.PID = l.PID""",
    "placed": """
        SELECT u.*, CASE WHEN a.CIV_ID IS NOT NULL THEN 'civic' WHEN r.CIV_ID IS NOT NULL THEN 'retired_civic'
                         WHEN m.CIV_ID IS NOT NULL THEN 'address'
                         WHEN p.PID IS NOT NULL AND route IN ('2_address', '3_pid') THEN 'parcel' END AS method,
               m.score AS match_score,
               coalesce(a.X, r.X, m.X, CASE WHEN route IN ('2_address', '3_pid') THEN p.x END) AS X,
               coalesce(a.Y, r.Y, m.Y, CASE WHEN route IN ('2_address', '3_pid') THEN p.y END) AS Y
        FROM routed u
        LEFT JOIN active a ON a.CIV_ID = u.Civic_ID
        LEFT JOIN retired r ON r.CIV_ID = u.Civic_ID
        LEFT JOIN matched m ON m.Permit_Category = u.Permit_Category AND m.Permit_Number = u.Permit_Number
        LEFT JOIN point p ON p.PID = u.PID""",
    "located": """
        SELECT *, CASE WHEN method IS NOT NULL THEN NULL WHEN route = '1_civic_id' THEN 'civic_id_not_found'
                       WHEN route = '4_none' THEN 'no_location_info' WHEN route = '5_partial' THEN 'partial_address'
                       WHEN PID IS NULL THEN 'no_pid' ELSE 'pid_not_found' END AS reason
        FROM placed""",
    "listed": f"""
        SELECT DISTINCT Planning_App_Num, {PADDED.format("trim(p)")} AS PID
        FROM (SELECT Planning_App_Num, unnest(string_split(PIDs, ',')) AS p FROM fx_application)
        WHERE trim(p) <> ''""",
    "app_edge": """
        SELECT Planning_App_Num, CASE WHEN x < nx OR (x = nx AND y <= ny) THEN x ELSE nx END AS x0,
               CASE WHEN x < nx OR (x = nx AND y <= ny) THEN y ELSE ny END AS y0,
               CASE WHEN x < nx OR (x = nx AND y <= ny) THEN nx ELSE x END AS x1,
               CASE WHEN x < nx OR (x = nx AND y <= ny) THEN ny ELSE y END AS y1, count(*) AS n
        FROM listed JOIN edge ON listed.PID = edge.PID GROUP BY ALL""",
    "dissolved": """
        SELECT a.Planning_App_Num, a.area, a.pids_found, o.perimeter, o.n_edges, o.dissolve_check
        FROM (SELECT Planning_App_Num, sum(area) AS area, count(*) AS pids_found
              FROM listed JOIN measure ON listed.PID = measure.PID GROUP BY 1) a
        JOIN (SELECT Planning_App_Num,
                     sum(CASE WHEN n = 1 THEN sqrt((x1-x0)*(x1-x0) + (y1-y0)*(y1-y0)) ELSE 0 END) AS perimeter,
                     count(*) FILTER (n = 1) AS n_edges, max(n) <= 2 AS dissolve_check
              FROM app_edge GROUP BY 1) o ON a.Planning_App_Num = o.Planning_App_Num""",
    "full_address": f"""
        SELECT permit_no, replace(Civic_Number, ' ', '') AS house, {STREET_NAME.format("Street_Name")} AS name,
               coalesce({STREET_TYPE.format("Street_Type")}, {STREET_END.format("Street_Name")}) AS type, Unit AS unit,
               District AS district, upper(Community) AS community, Municipality AS municipality,
               upper(replace(Postal, ' ', '')) AS postal
        FROM fx_locator_permit""",
    "full_civic": f"""
        SELECT CIV_ID, X, Y, replace(FULL_CIVIC, ' ', '') AS house, {STREET_NAME.format("STR_NAME")} AS name,
               coalesce({STREET_TYPE.format("STR_TYPE")}, {STREET_END.format("STR_NAME")}) AS type, UNIT_NUM AS unit,
               DISTRICT AS district, upper(GSA_NAME) AS community, MUN_CODE AS municipality,
               upper(replace(CIV_POSTAL, ' ', '')) AS postal
        FROM fx_locator_civic""",
    # every address against every civic of its house number
    "full_scored": """
        SELECT a.permit_no, c.CIV_ID, c.X, c.Y,
               (greatest(length(a.name), length(c.name)) - levenshtein(a.name, c.name)) * 100
                   // greatest(length(a.name), length(c.name)) AS name_score,
               (60 * name_score + CASE WHEN a.type = c.type THEN 1000 ELSE 0 END
                   + CASE WHEN a.community = c.community THEN 1200 ELSE 0 END
                   + CASE WHEN a.postal = c.postal THEN 800 WHEN a.postal[1:3] = c.postal[1:3] THEN 400 ELSE 0 END
                   + CASE WHEN a.district = c.district THEN 400 ELSE 0 END
                   + CASE WHEN a.municipality = c.municipality THEN 300 ELSE 0 END
                   + CASE WHEN a.unit = c.unit THEN 300 ELSE 0 END)
                 // (60 + CASE WHEN a.type IS NULL THEN 0 ELSE 10 END + CASE WHEN a.community IS NULL THEN 0 ELSE 12 END
                     + CASE WHEN a.postal IS NULL THEN 0 ELSE 8 END + CASE WHEN a.district IS NULL THEN 0 ELSE 4 END
                     + CASE WHEN a.municipality IS NULL THEN 0 ELSE 3 END + CASE WHEN a.unit IS NULL THEN 0 ELSE 3 END) AS score
        FROM full_address a JOIN full_civic c ON a.house = c.house""",
    "full_match": """
        SELECT * FROM full_scored WHERE name_score > 60 AND score > 60
        QUALIFY row_number() OVER (PARTITION BY permit_no ORDER BY score DESC, CIV_ID) = 1""",
    "ground_listed": f"""
        SELECT DISTINCT Planning_App_Num AS app, {PADDED.format("trim(p)")} AS PID
        FROM (SELECT Planning_App_Num, unnest(string_split(PIDs, ',')) AS p FROM fx_ground_application)""",
    "ground_ring": """
        SELECT PID, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx,
               coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
        FROM fx_ground_vertex WINDOW w AS (PARTITION BY PID, ring ORDER BY seq)""",
    "ground_side": """
        SELECT PID, CASE WHEN cw THEN nx ELSE x END AS x0, CASE WHEN cw THEN ny ELSE y END AS y0,
               CASE WHEN cw THEN x ELSE nx END AS x1, CASE WHEN cw THEN y ELSE ny END AS y1
        FROM ground_ring JOIN (SELECT PID, sum((x - 25560000) * (ny - 4950000) - (nx - 25560000) * (y - 4950000)) < 0 AS cw
                               FROM ground_ring GROUP BY PID) USING (PID)""",
    "app_side": "SELECT app, s.* FROM ground_listed l JOIN ground_side s ON l.PID = s.PID",
    "app_cut": """
        SELECT DISTINCT s.app, s.PID, s.x0, s.y0, s.x1, s.y1, v.x0 AS px, v.y0 AS py
        FROM app_side s JOIN app_side v ON s.app = v.app AND s.PID <> v.PID
        WHERE (s.x1 - s.x0) * (v.y0 - s.y0) = (s.y1 - s.y0) * (v.x0 - s.x0)
          AND (v.x0 - s.x0) * (s.x1 - s.x0) + (v.y0 - s.y0) * (s.y1 - s.y0) > 0
          AND (v.x0 - s.x1) * (s.x0 - s.x1) + (v.y0 - s.y1) * (s.y0 - s.y1) > 0
        UNION ALL SELECT *, x0, y0 FROM app_side""",
    "app_piece": """
        SELECT app, px AS x0, py AS y0, coalesce(lead(px) OVER w, x1) AS x1, coalesce(lead(py) OVER w, y1) AS y1
        FROM app_cut
        WINDOW w AS (PARTITION BY app, PID, x0, y0, x1, y1 ORDER BY (px - x0) * (px - x0) + (py - y0) * (py - y0))""",
    "app_sides": """
        SELECT app, least((x0, y0), (x1, y1)) AS a, greatest((x0, y0), (x1, y1)) AS b,
               count(*) FILTER ((x0, y0) < (x1, y1)) AS l, count(*) FILTER ((x0, y0) > (x1, y1)) AS r
        FROM app_piece GROUP BY ALL""",
    "app_outline": """
        SELECT app, row_number() OVER () AS id, CASE WHEN l > 0 THEN a[1] ELSE b[1] END AS x0,
               CASE WHEN l > 0 THEN a[2] ELSE b[2] END AS y0, CASE WHEN l > 0 THEN b[1] ELSE a[1] END AS x1,
               CASE WHEN l > 0 THEN b[2] ELSE a[2] END AS y1
        FROM app_sides WHERE (l > 0) <> (r > 0)""",
    # the piece after another is the one that turns most to the left
    "app_next": """
        SELECT i.id, arg_max(o.id, CASE WHEN turn <= -pi() + 1e-9 THEN turn + 2 * pi() ELSE turn END) AS next
        FROM app_outline i JOIN app_outline o ON i.app = o.app AND i.x1 = o.x0 AND i.y1 = o.y0,
        LATERAL (SELECT atan2((i.x1 - i.x0) * (o.y1 - o.y0) - (i.y1 - i.y0) * (o.x1 - o.x0),
                              (i.x1 - i.x0) * (o.x1 - o.x0) + (i.y1 - i.y0) * (o.y1 - o.y0)) AS turn)
        GROUP BY i.id""",
    "app_walk": """
        WITH RECURSIVE walk AS (
            SELECT id AS start, id, 1 AS seq FROM app_next
            UNION ALL SELECT start, next, seq + 1 FROM walk JOIN app_next USING (id) WHERE next <> start)
        SELECT * FROM walk""",
    "app_ring": """
        SELECT app, start, w.id, seq, e.x0, e.y0, x1, y1,
               min((e.x0, e.y0, x1, y1)) OVER (PARTITION BY start) = first_value((e.x0, e.y0, x1, y1))
                   OVER (PARTITION BY start ORDER BY seq) AS leads
        FROM app_walk w JOIN app_outline e ON w.id = e.id""",
    "app_point": f"""
        SELECT a.*, {PADDED.format("nullif(trim(string_split(a.PIDs, ',')[1]), '')")} AS primary_pid, p.x, p.y,
               CASE WHEN a.PIDs IS NULL THEN 'no_pid' WHEN p.PID IS NULL THEN 'unlocated' ELSE 'located' END AS status
        FROM fx_application a LEFT JOIN point p
          ON p.PID = {PADDED.format("nullif(trim(string_split(a.PIDs, ',')[1]), '')")}""",
    "change": """
        SELECT coalesce(w.c_custkey, r.c_custkey) AS c_custkey,
               CASE WHEN w.c_custkey IS NULL THEN r.ASSET_ID ELSE w.ASSET_ID END AS ASSET_ID,
               CASE WHEN w.c_custkey IS NULL THEN r.c_name ELSE w.c_name END AS c_name,
               CASE WHEN w.c_custkey IS NULL THEN r.c_nationkey ELSE w.c_nationkey END AS c_nationkey,
               CASE WHEN w.c_custkey IS NULL THEN r.c_acctbal ELSE w.c_acctbal END AS c_acctbal,
               CASE WHEN w.c_custkey IS NULL THEN r.c_mktsegment ELSE w.c_mktsegment END AS c_mktsegment,
               CASE WHEN r.c_custkey IS NULL THEN 'insert' WHEN w.c_custkey IS NULL THEN 'delete' ELSE 'update' END
                   AS change
        FROM fx_rw_copy w FULL JOIN fx_ro_copy r ON w.c_custkey = r.c_custkey
        WHERE w.c_custkey IS NULL OR r.c_custkey IS NULL OR w.ASSET_ID IS DISTINCT FROM r.ASSET_ID
           OR w.c_name IS DISTINCT FROM r.c_name OR w.c_nationkey IS DISTINCT FROM r.c_nationkey
           OR w.c_acctbal IS DISTINCT FROM r.c_acctbal OR w.c_mktsegment IS DISTINCT FROM r.c_mktsegment""",
    "spec_field": f"""
        SELECT form_id, field_name AS field, spec_type, length, default_value, domain FROM form_field
        WHERE field_name NOT IN {IGNORED}
        QUALIFY row_number() OVER (PARTITION BY form_id, field_name ORDER BY row_no) = 1""",
    "spec_code": """
        SELECT form_id, domain, c0 AS code, min(c1) AS description FROM form_code
        WHERE head IS NULL AND block_row IS NOT NULL AND upper(c0) <> 'CODE' AND c1 IS NOT NULL GROUP BY ALL""",
    "spec_given": """
        SELECT form_id, record, upper(trim(field)) AS field, min(CASE WHEN trim(value) <> '' THEN value END) AS given, count(*) AS n
        FROM fx_form_value GROUP BY ALL""",
    "spec_cell": """
        SELECT f.form_id, r.record, f.field, coalesce(g.given, f.default_value) AS text, g.given IS NULL AS missing,
               CASE f.spec_type WHEN 'LONG' THEN CAST(try_cast(trim(text) AS int) AS varchar)
                    WHEN 'DATEONLY' THEN CAST(try_cast(trim(text) AS date) AS varchar)
                    WHEN 'DOUBLE' THEN CAST(try_cast(trim(text) AS double) AS varchar) ELSE text END AS value,
               c.description, g.n, f.spec_type, f.length, f.domain IN (SELECT d.domain FROM spec_code d WHERE d.form_id = f.form_id) AS listed
        FROM spec_field f JOIN (SELECT DISTINCT form_id, record FROM spec_given) r ON r.form_id = f.form_id
        LEFT JOIN spec_given g ON g.form_id = f.form_id AND g.record = r.record AND g.field = f.field
        LEFT JOIN spec_code c ON c.form_id = f.form_id AND c.domain = f.domain AND c.code = coalesce(g.given, f.default_value)""",
    "form_row": "SELECT *, row_number() OVER (PARTITION BY form_id ORDER BY row_no) AS rk FROM fx_form_cell WHERE c0 IS NOT NULL",
    "form_fact": """
        SELECT form_id, max(CASE WHEN rk <= 3 AND c0 IN ('Feature Class Name:', 'Data Source Name:') THEN 1 END) AS named,
               coalesce(max(CASE WHEN rk <= 3 AND c0 = 'Shape Type:' THEN c1 END), 'Enterprise Geodatabase Table') AS shape,
               upper(max(CASE WHEN rk <= 3 AND c0 = 'Feature Type:' THEN c1 END)) AS kind,
               max(CASE WHEN upper(c0) = 'SHAPE_AREA' THEN 1 END) AS has_area,
               max(CASE WHEN upper(c0) = 'SHAPE_LENGTH' THEN 1 END) AS has_length,
               min(CASE WHEN c0 = 'Alias' THEN row_no END) AS header_row,
               min(CASE WHEN c0 LIKE 'Fields with associated%' THEN row_no END) AS domain_row,
               max(CASE WHEN c0 = 'GLOBALID' THEN row_no END) AS g, max(CASE WHEN c0 = 'SHAPE_Length' THEN row_no END) AS s,
               max(row_no) AS e
        FROM form_row GROUP BY form_id""",
    "form_field": """
        SELECT r.form_id, r.row_no, upper(trim(c1)) AS field_name, trim(c0) AS alias, c2 AS given_type,
               CASE upper(trim(c2)) WHEN 'STRING' THEN 'TEXT' ELSE upper(trim(c2)) END AS spec_type,
               try_cast(c3 AS int) AS length, c4 AS default_value, trim(c5) AS domain, c6 AS subtype_flag
        FROM form_row r JOIN form_fact f ON r.form_id = f.form_id
        WHERE row_no > header_row AND row_no <= coalesce(
            CASE WHEN kind = 'FEATURE CLASS' AND upper(shape) NOT IN ('POINT', 'NOT APPLICABLE') THEN s ELSE g END,
            domain_row - 1, e)""",
    "form_block": """
        SELECT r.*, lead(c0) OVER w AS next_label,
               CASE WHEN upper(lead(c0) OVER w) = 'CODE' THEN r.row_no END AS head
        FROM form_row r JOIN form_fact f ON r.form_id = f.form_id WHERE r.row_no > f.domain_row
        WINDOW w AS (PARTITION BY r.form_id ORDER BY r.row_no)""",
    "form_code": """
        SELECT *, last_value(head IGNORE NULLS) OVER w AS block_row,
               last_value(CASE WHEN head IS NOT NULL THEN c1 END IGNORE NULLS) OVER w AS domain,
               last_value(CASE WHEN head IS NOT NULL THEN c0 END IGNORE NULLS) OVER w AS domain_field
        FROM form_block WINDOW w AS (PARTITION BY form_id ORDER BY row_no)""",
    "note": "SELECT *, lead(c0) OVER (PARTITION BY form_id ORDER BY row_no) AS below FROM fx_form_note",
    "new_domain": """
        SELECT DISTINCT domain FROM fx_domain_request
        WHERE upper(domain) NOT IN (SELECT upper(domain) FROM fx_target_domain)""",
    "stage": """
        SELECT Permit_Category, 'source' AS stage FROM fx_permit_category
        UNION ALL SELECT Permit_Category, 'unique' FROM located
        UNION ALL SELECT Permit_Category, 'located' FROM located WHERE method IS NOT NULL
        UNION ALL SELECT Permit_Category, 'failed' FROM located WHERE method IS NULL
        UNION ALL SELECT Permit_Category, 'related' FROM related""",
}

KEY = "Permit_Category, Permit_Number"
XY6 = "round(X, 6) + 0.0 AS X, round(Y, 6) + 0.0 AS Y"
XY6_LOW = "round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y"
# the four entities of the pages; HTML reads them with and without the semicolon, the ampersand's own last
UNESCAPED = "html"
for _name, _character in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
    UNESCAPED = f"regexp_replace({UNESCAPED}, '&{_name};?', '{_character}', 'g')"

# Krüger series with the third flattening and the eccentricity as numbers
_N = "0.0016792203946287448"
_E = "0.08181919104281579"
_A1, _A2, _A3, _A4 = (
    "(n/2 - 2*n*n/3 + 37*n*n*n/96 - n*n*n*n/360)",
    "(n*n/48 + n*n*n/15 - 437*n*n*n*n/1440)",
    "(17*n*n*n/480 - 37*n*n*n*n/840)",
    "(4397*n*n*n*n/161280)",
)



def _field_map(fields: dict[str, str]) -> str:
    held = {"Planning_App_Num", "Application_Name", "Application_Type", "App_Status", "PIDs"}
    columns = {c: c for c in held} | {"Submitted_Date": "strftime(Submitted_Date, '%Y-%m-%d %H:%M:%S')"}
    return "SELECT " + ", ".join(f"{columns.get(c, 'CAST(NULL AS varchar)')} AS {name}" for name, c in fields.items()) + " FROM fx_application"


def _latitude() -> str:
    """Longitude and latitude of the civics, the latitude by repeated substitution."""
    sql = f"""(
        SELECT CIV_ID, atan2(sinh(e1), cos(x1)) AS lam, chi AS phi, asinh(tan(chi)) AS psi FROM (
            SELECT *, asin(sin(x1) / cosh(e1)) AS chi FROM (
                SELECT *, xi - {_A1}*sin(2*xi)*cosh(2*eta) - {_A2}*sin(4*xi)*cosh(4*eta)
                             - {_A3}*sin(6*xi)*cosh(6*eta) - {_A4}*sin(8*xi)*cosh(8*eta) AS x1,
                       eta - {_A1}*cos(2*xi)*sinh(2*eta) - {_A2}*cos(4*xi)*sinh(4*eta)
                           - {_A3}*cos(6*xi)*sinh(6*eta) - {_A4}*cos(8*xi)*sinh(8*eta) AS e1
                FROM (SELECT CIV_ID, n, Y / (0.9999 * r) AS xi, (X - 25500000.0) / (0.9999 * r) AS eta
                      FROM (SELECT *, 6378137.0 / (1 + n) * (1 + n*n/4 + n*n*n*n/64) AS r
                            FROM (SELECT *, cast({_N} AS double) AS n FROM fx_civic))))))"""
    for _ in range(6):
        sql = f"(SELECT CIV_ID, lam, psi, atan(sinh(psi + {_E} * atanh({_E} * sin(phi)))) AS phi FROM {sql})"
    return sql


_BODIES = {
    "scan_attributes": "SELECT vec_id, label FROM embeddings",
    "scan_csv_typed": f"""
        SELECT Permit_Category, Permit_Number, {PADDED.format("PID")} AS PID, Civic_Number, Civic_ID, l_linenumber,
               l_partkey, l_suppkey, l_extendedprice, {DATED} AS l_shipdate FROM clean""",
    "form_cells": "SELECT * FROM fx_form_cell WHERE c0 IS NOT NULL",
    "failure_report": f"SELECT Permit_Category || '_Permits_fails' AS section, {KEY}, PID, reason FROM located WHERE method IS NULL",
    "application_failure_report": """
        SELECT CASE status WHEN 'no_pid' THEN 'No_PID' ELSE 'Unlocated_PID' END AS section, Planning_App_Num, PIDs
        FROM app_point WHERE status <> 'located'""",
    "load_guarded": """
        SELECT step, n * b AS n_before, n * a AS n_after FROM (SELECT count(*) AS n FROM located WHERE method IS NOT NULL),
        (VALUES ('1_truncate', 0, 1), ('2_append', 1, 2), ('3_empty', 2, 2), ('4_truncate', 2, 1)) v(step, b, a)""",
    "replicate_counts": """
        SELECT step, name, CASE step WHEN '2_strict' THEN 0 ELSE n END AS n_before, n AS n_after
        FROM (SELECT 'rw_copy' AS name, count(*) AS n FROM fx_rw_copy
              UNION ALL SELECT 'civic', count(*) FROM fx_civic
              UNION ALL SELECT 'ro_copy', count(*) FROM fx_ro_copy), (VALUES ('2_strict'), ('3_lenient')) v(step)""",
    "append_by_name": """
        SELECT * FROM fx_rw_copy UNION ALL
        SELECT CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey END, NULL, s_name, NULL, s_acctbal, NULL
        FROM supplier""",
    "catalog_name_filter": r"""
        SELECT DISTINCT feature FROM fx_metadata WHERE feature LIKE '%ADM%' AND NOT regexp_matches(feature,
        '(_SAP|_temp|_H)$|^AR_|SDE_VAT|SDEADM\.AR_|SDEADM\.SAP_|SDEADM\.TMP_|DirtyObjects')""",
    "stage_counts": "SELECT Permit_Category, stage, count(*) AS n FROM stage GROUP BY ALL",
    "clean_permits": f"SELECT * REPLACE ({DATED} AS l_shipdate) FROM clean",
    "apply_field_map": _field_map(PLANNING_FIELDS),
    "apply_subdivision_map": _field_map(SUBDIVISION_FIELDS),
    "locator_id": f"""
        SELECT {KEY}, CASE WHEN Permit_Category IN ('Engineering', 'Public_Works_ROW') THEN l_suppkey ELSE Civic_ID END
               AS locator_id, CASE WHEN Permit_Category IN ('Engineering', 'Public_Works_ROW') THEN 'street_segment' ELSE 'civic' END
               AS id_kind FROM uniq""",
    "prune_by_category": f"""
        SELECT {KEY},
               CASE WHEN Permit_Category IN ('Building', 'Construction') THEN l_extendedprice END AS Estimated_Project_Value,
               CASE WHEN Permit_Category = 'Building' THEN l_linenumber END AS Existing_Residential_Units,
               CASE WHEN Permit_Category = 'Building' THEN l_suppkey END AS Total_End_Residential_Units,
               CASE WHEN Permit_Category = 'Building' THEN l_partkey END AS Building_Footprint_Area,
               CASE WHEN Permit_Category = 'Building' THEN l_linenumber END AS Number_of_Storeys,
               CASE WHEN Permit_Category NOT IN ('Land_Use_Approval', 'Public_Works_ROW')
                    THEN strftime(l_shipdate, '%Y-%m-%d') END AS Most_Recent_Inspection,
               CASE WHEN Permit_Category NOT IN ('Land_Use_Approval', 'Public_Works_ROW')
                    THEN strftime(l_shipdate, '%Y-%m-%d') END AS Date_Inspection_Completed
        FROM uniq""",
    "split_pid": """
        SELECT Planning_App_Num, PIDs, CASE WHEN PIDs IS NULL THEN 'no_pid' ELSE 'has_pid' END AS pid_status
        FROM fx_application""",
    "route_permits": f"SELECT {KEY}, route FROM routed",
    "apply_defaults": f"""
        SELECT {KEY}, coalesce(Occupancy_Type, 'UNKNOWN') AS Occupancy_Type, coalesce(Active_Parcel, 'N') AS Active_Parcel,
               coalesce(Civic_ID, -1) AS Civic_ID, l_linenumber, l_partkey FROM clean""",
    "calc_id_field": """
        SELECT c_custkey, 'AST-' || cast(c_custkey AS varchar) AS ASSET_ID, c_nationkey AS NATION_ID FROM customer""",
    "civic_join": f"SELECT {KEY}, Civic_ID, {XY6} FROM uniq JOIN active ON CIV_ID = Civic_ID",
    "civic_unjoined": f"""
        SELECT {KEY}, Civic_ID FROM uniq WHERE Civic_ID IS NOT NULL AND Civic_ID NOT IN (SELECT CIV_ID FROM active)""",
    "retired_civic_join": f"""
        SELECT {KEY}, Civic_ID, {XY6} FROM uniq LEFT JOIN retired ON CIV_ID = Civic_ID
        WHERE Civic_ID IS NOT NULL AND Civic_ID NOT IN (SELECT CIV_ID FROM active)""",
    "pid_points": f"""
        SELECT {KEY}, u.PID, CASE WHEN u.PID IS NULL THEN 'no_pid' WHEN p.PID IS NULL THEN 'pid_not_found'
               ELSE 'located' END AS status, {XY6_LOW}
        FROM routed u LEFT JOIN point p ON p.PID = u.PID""",
    "street_segment_points": f"""
        SELECT {KEY}, Civic_ID AS HRM_ID,
               CASE WHEN Civic_ID IS NULL THEN 'no_id' WHEN FDMID IS NULL THEN 'unlocated' ELSE 'located' END AS status,
               round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y
        FROM uniq LEFT JOIN (
            SELECT FDMID, sum((x0+x1)/2 * l) / sum(l) AS x, sum((y0+y1)/2 * l) / sum(l) AS y
            FROM (SELECT *, sqrt((x1-x0)*(x1-x0) + (y1-y0)*(y1-y0)) AS l FROM fx_street) GROUP BY FDMID)
          ON FDMID = Civic_ID
        WHERE Permit_Category IN ('Engineering', 'Public_Works_ROW')""",
    "geocode_addresses": """
        SELECT u.Permit_Category, u.Permit_Number, FORMATTEDADDRESS, m.CIV_ID AS match_id, cast(m.score AS int) AS score
        FROM routed u LEFT JOIN matched m
          ON m.Permit_Category = u.Permit_Category AND m.Permit_Number = u.Permit_Number
        WHERE u.route = '2_address'""",
    "geocode_full": """
        SELECT p.permit_no, m.CIV_ID AS match_id, cast(m.score AS int) AS score, m.X AS match_x, m.Y AS match_y
        FROM fx_locator_permit p LEFT JOIN full_match m ON p.permit_no = m.permit_no""",
    "locate_apps_polygon": """
        SELECT a.Planning_App_Num, a.PIDs,
               CASE WHEN a.PIDs IS NULL THEN 'no_pid' WHEN pids_found IS NULL THEN 'unlocated' ELSE 'located' END AS status,
               cast(coalesce(t.n, 0) AS int) AS pids_total, coalesce(pids_found, 0) AS pids_found,
               round(area, 6) + 0.0 AS area, round(perimeter, 6) + 0.0 AS perimeter
        FROM fx_application a LEFT JOIN dissolved d ON a.Planning_App_Num = d.Planning_App_Num
        LEFT JOIN (SELECT Planning_App_Num, count(*) AS n FROM listed GROUP BY 1) t
          ON a.Planning_App_Num = t.Planning_App_Num""",
    "locate_apps_point": f"SELECT Planning_App_Num, PIDs, primary_pid, status, {XY6_LOW} FROM app_point",
    "occupancy_anti": "SELECT * FROM additions",
    "occupancy_missing_in_related": f"""
        SELECT {KEY}, Occupancy_Type, l_linenumber, l_partkey FROM clean c WHERE Occupancy_Type IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM related_raw r WHERE r.Permit_Category = c.Permit_Category AND r.Permit_Number = c.Permit_Number)""",
    "missing_permits": f"""
        SELECT {KEY}, l_linenumber, l_partkey FROM fx_permit_category s
        WHERE NOT EXISTS (SELECT 1 FROM located l WHERE l.Permit_Category = s.Permit_Category
                            AND l.Permit_Number = s.Permit_Number
                            AND (l.method IS NOT NULL OR l.reason <> 'partial_address'))
          AND NOT EXISTS (SELECT 1 FROM related r WHERE r.Permit_Category = s.Permit_Category
                            AND r.Permit_Number = s.Permit_Number)""",
    "load_missing_permits": """
        SELECT Permit_Category, count(*) AS n_missing FROM located WHERE method IS NULL GROUP BY 1""",
    "related_rollup": """
        SELECT l.Permit_Category, l.Permit_Number,
               CASE l.Permit_Category WHEN 'Halifax_Water' THEN 'HW' WHEN 'Land_Use_Approval' THEN 'LU_Approval'
                    WHEN 'Public_Works_ROW' THEN 'PW_ROW' ELSE l.Permit_Category END || '_has_permits' AS relationship,
               count(r.Permit_Number) AS n_related, count(DISTINCT r.PID) AS n_pids, min(r.PID) AS first_pid,
               max(r.PID) AS last_pid, count(DISTINCT r.Occupancy_Type) AS n_occupancies
        FROM located l LEFT JOIN related r
          ON l.Permit_Category = r.Permit_Category AND l.Permit_Number = r.Permit_Number
        WHERE l.method IS NOT NULL GROUP BY l.Permit_Category, l.Permit_Number""",
    "related_orphans": """
        SELECT r.* FROM related r WHERE NOT EXISTS (SELECT 1 FROM located l WHERE l.method IS NOT NULL
            AND l.Permit_Category = r.Permit_Category AND l.Permit_Number = r.Permit_Number)""",
    "domain_decode": """
        SELECT o_orderkey, o_orderstatus, description FROM orders
        LEFT JOIN fx_order_domain ON domain = 'ORD_status' AND code = o_orderstatus""",
    "domain_violations": """
        SELECT o_orderkey, o_orderstatus FROM orders
        WHERE o_orderstatus NOT IN (SELECT code FROM fx_order_domain WHERE domain = 'ORD_status')""",
    "subtype_domain_check": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, s.domain, d.description,
               CASE WHEN s.domain IS NULL THEN 'no_subtype' WHEN d.code IS NOT NULL THEN 'valid' ELSE 'invalid' END AS "check"
        FROM orders LEFT JOIN fx_order_subtype s ON subtype_code = o_orderstatus AND field = 'o_orderpriority'
        LEFT JOIN fx_order_domain d ON d.domain = s.domain AND d.code = o_orderpriority""",
    "sync_changes": "SELECT * FROM change",
    "sync_applied": "SELECT * FROM fx_rw_copy",
    "out_of_sync_ids": """
        SELECT w.c_custkey, w.ASSET_ID AS rw_id, r.ASSET_ID AS ro_id FROM fx_rw_copy w JOIN fx_ro_copy r
          ON w.c_custkey = r.c_custkey WHERE w.ASSET_ID <> r.ASSET_ID""",
    "permit_group_profile": f"""
        SELECT {KEY}, count(*) AS n_rows, count(DISTINCT coalesce(PID, '<null>')) AS n_pids,
               count(DISTINCT coalesce(Occupancy_Type, '<null>')) AS n_occupancies,
               bool_and(coalesce(Active_Parcel = 'Y', false)) AS all_active FROM clean GROUP BY {KEY}""",
    "related_by_category": "SELECT Permit_Category, count(*) AS n FROM related GROUP BY 1",
    "reconcile_counts": """
        SELECT s.Permit_Category, count(*) AS source,
               (SELECT count(*) FROM located l WHERE l.Permit_Category = s.Permit_Category AND method IS NOT NULL) AS rw,
               (SELECT count(*) FROM located l WHERE l.Permit_Category = s.Permit_Category AND method <> 'retired_civic') AS ro,
               (SELECT count(*) FROM located l WHERE l.Permit_Category = s.Permit_Category AND method IS NULL) AS failed,
               (SELECT count(*) FROM related r WHERE r.Permit_Category = s.Permit_Category) AS related,
               (SELECT count(*) FROM fx_permit_category q WHERE q.Permit_Category = s.Permit_Category
                  AND NOT EXISTS (SELECT 1 FROM located l WHERE l.Permit_Category = q.Permit_Category
                                    AND l.Permit_Number IS NOT DISTINCT FROM q.Permit_Number)
                  AND NOT EXISTS (SELECT 1 FROM related r WHERE r.Permit_Category = q.Permit_Category
                                    AND r.Permit_Number IS NOT DISTINCT FROM q.Permit_Number)) AS missing_rw,
               (SELECT count(*) FROM located l WHERE l.Permit_Category = s.Permit_Category AND method = 'retired_civic')
                   AS missing_ro
        FROM fx_permit_category s GROUP BY s.Permit_Category""",
    "max_text_length": "SELECT Permit_Category, cast(max(coalesce(length(Work_Description), 0)) AS int) AS max_length FROM fx_permit_category GROUP BY 1",
    "pid_coverage": """
        SELECT count(*) AS n_pids, count(*) FILTER (f) AS n_found, round(count(*) FILTER (f) / count(*), 6) AS ratio
        FROM (SELECT DISTINCT PID, PID IN (SELECT PID FROM fx_parcel_vertex) AS f FROM listed)""",
    "locate_summary": "SELECT App_Status, status, count(*) AS n FROM app_point GROUP BY ALL",
    "first_parcels": "SELECT * FROM fx_parcel_vertex",
    "dissolve_outline": "SELECT Planning_App_Num, x0, y0, x1, y1 FROM app_edge WHERE n = 1",
    "dissolve_area": """
        SELECT Planning_App_Num, round(area, 6) + 0.0 AS area, pids_found, round(perimeter, 6) + 0.0 AS perimeter, n_edges,
               dissolve_check FROM dissolved""",
    "app_union_area": """
        SELECT app AS Planning_App_Num, round(area, 6) + 0.0 AS area, pids_found, round(perimeter, 6) + 0.0 AS perimeter,
               n_edges, dissolve_check
        FROM (SELECT app, sum((x0 - 25560000) * (y1 - 4950000) - (x1 - 25560000) * (y0 - 4950000)) / 2 AS area,
                     sum(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))) AS perimeter, count(*) AS n_edges
              FROM app_outline GROUP BY app)
        JOIN (SELECT app, max(greatest(l, r)) <= 1 AS dissolve_check FROM app_sides GROUP BY app) USING (app)
        JOIN (SELECT app, count(DISTINCT PID) AS pids_found FROM app_side GROUP BY app) USING (app)""",
    "app_outline_rings": """
        SELECT app AS Planning_App_Num, dense_rank() OVER (PARTITION BY app ORDER BY lead) AS ring, cast(seq AS bigint) AS seq,
               x0 AS x, y0 AS y, hole
        FROM (SELECT *, min((x0, y0, x1, y1)) OVER (PARTITION BY start) AS lead,
                     sum((x0 - 25560000) * (y1 - 4950000) - (x1 - 25560000) * (y0 - 4950000)) OVER (PARTITION BY start) < 0
                         AS hole
              FROM app_ring WHERE leads)""",
    "permits_unique": f"SELECT * REPLACE ({DATED} AS l_shipdate) FROM uniq",
    "permits_repeated": f"SELECT {KEY}, PID, l_linenumber, l_partkey, l_suppkey FROM ranked WHERE n_rows > 1",
    "permits_extra_rows": f"SELECT {KEY}, PID, Active_Parcel, l_linenumber, l_partkey, l_suppkey FROM ranked WHERE rn > 1",
    "multi_pid_no_occupancy": f"""
        SELECT * FROM (SELECT {KEY}, PID, count(DISTINCT PID) OVER (PARTITION BY {KEY}) AS PID_Count, l_linenumber
                       FROM clean WHERE Occupancy_Type IS NULL AND PID IS NOT NULL) WHERE PID_Count > 1""",
    "assign_sequence_ids": """
        SELECT Planning_App_Num, App_Status,
               'APP' || cast(row_number() OVER (ORDER BY App_Status, Planning_App_Num) + 4 AS varchar) AS APPID
        FROM fx_application""",
    "padded_sequence_ids": """
        SELECT c_custkey, c_name, 'C' || CASE WHEN n < 10 THEN '00' WHEN n < 100 THEN '0' ELSE '' END || n AS ASSET_ID
        FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS n FROM customer)""",
    "domain_order": """
        SELECT domain, code, description, row_number() OVER (PARTITION BY domain ORDER BY
               CASE WHEN domain = 'LND_Brand_2_PROMO' THEN cast(code AS int) END,
               CASE WHEN description IS NULL THEN 2 WHEN try_cast(description AS int) IS NULL THEN 1 ELSE 0 END,
               try_cast(description AS int) NULLS LAST, description NULLS LAST, code) AS ord
        FROM fx_source_domain""",
    "related_table": "SELECT * FROM related",
    "split_duplicates": f"""
        SELECT 'unique' AS part, {KEY}, PID, Occupancy_Type, Active_Parcel FROM uniq
        UNION ALL SELECT 'related', {KEY}, PID, Occupancy_Type, Active_Parcel FROM related_raw""",
    "drop_duplicate_rows": f"""
        SELECT {KEY}, {PADDED.format("PID")} AS PID, Occupancy_Type, Active_Parcel, count(*) - 1 AS n_removed
        FROM related_raw GROUP BY ALL""",
    "missing_domains": "SELECT * FROM new_domain",
    "domain_transfer_plan": """
        SELECT domain, action, CASE action WHEN 'copy' THEN n END AS n_codes FROM (
            SELECT q.domain, s.n, CASE WHEN s.n IS NULL THEN 'missing_in_source'
                WHEN upper(q.domain) IN (SELECT upper(domain) FROM fx_target_domain) THEN 'present_in_target'
                ELSE 'copy' END AS action
            FROM fx_domain_request q LEFT JOIN (SELECT domain, count(*) AS n FROM fx_source_domain GROUP BY 1) s
              ON s.domain = q.domain)""",
    "domain_types": """
        SELECT domain, CASE WHEN domain IN ('LND_N_PROMO', 'LND_R_SMALL') THEN 'LONG' WHEN domain = 'LND_A_PROMO'
               THEN 'SHORT' ELSE 'TEXT' END AS field_type FROM new_domain""",
    "normalize_pids": f"""
        SELECT Planning_App_Num, array_to_string(ids, '|') AS pids, cast(len(ids) AS int) AS n_pids FROM (
            SELECT Planning_App_Num, coalesce([{PADDED.format("trim(p)")} FOR p IN string_split(PIDs, ',')
                   IF trim(p) <> ''], []) AS ids FROM fx_application)""",
    "primary_pid": "SELECT Planning_App_Num, primary_pid FROM app_point",
    "category_from_name": """
        SELECT 'PPLC_' || Permit_Category || '_Permits' AS table_name, Permit_Category AS from_table,
               Permit_Category AS from_file, 'LND_PPLC_' || k || '_Permits' AS short_name,
               k || '_has_permits' AS relationship, count(*) AS n
        FROM (SELECT Permit_Category, CASE Permit_Category WHEN 'Halifax_Water' THEN 'HW'
                     WHEN 'Land_Use_Approval' THEN 'LU_Approval' WHEN 'Public_Works_ROW' THEN 'PW_ROW'
                     ELSE Permit_Category END AS k FROM fx_permit_category) GROUP BY Permit_Category, k""",
    "strip_html": f"""
        SELECT page_id, regexp_replace({UNESCAPED}, '<[^<]+?>', '', 'g') AS text FROM pages""",
    "tag_text": """
        SELECT doc_id, nullif(regexp_extract(xml, '<CreaDate>(.*?)</CreaDate>', 1), '') AS created,
               nullif(regexp_extract(xml, '<reviseDate>(.*?)</reviseDate>', 1), '') AS revised FROM fx_metadata""",
    "revise_date": """
        SELECT doc_id, regexp_replace(xml, '<reviseDate>.*?</reviseDate>', '<reviseDate>2024-05-17T00:00:00</reviseDate>')
               AS xml FROM fx_metadata""",
    "metadata_records": f"""
        SELECT replace(feature, 'GISDB.', '') AS FEATURE,
               coalesce(title, replace(feature, 'GISDB.ADM.', '') || ' (*NO TITLE in Metadata*)') AS TITLE,
               coalesce(html, '') AS DESCRIPTION,
               coalesce(regexp_replace({UNESCAPED}, '<[^<]+?>', '', 'g'), '') AS DESCRIPTION_SANITIZED, '' AS SUMMARY,
               regexp_extract(xml, '<CreaDate>(.*?)</CreaDate>', 1) AS CREATION_DATE, '' AS PUBLICATION_DATE,
               regexp_extract(xml, '<reviseDate>(.*?)</reviseDate>', 1) AS REVISION_DATE
        FROM fx_metadata LEFT JOIN pages ON page_id = doc_id""",
    "parcel_centroid": "SELECT PID, round(ox + cx, 6) + 0.0 AS x, round(oy + cy, 6) + 0.0 AS y FROM measure",
    "centroid_inside": "SELECT * FROM inside",
    "parcel_label_point": """
        SELECT m.PID, round(ox + lx, 6) + 0.0 AS x, round(oy + ly, 6) + 0.0 AS y FROM measure m JOIN label l ON m.PID = l.PID""",
    "parcel_point": f"SELECT PID, {XY6_LOW}, kind FROM point",
    "parcel_measures": "SELECT PID, round(area, 6) + 0.0 AS area, round(perimeter, 6) + 0.0 AS perimeter FROM measure",
    "reproject_points": f"""
        SELECT CIV_ID, round(6378137.0 * (radians(-64.5) + lam), 3) + 0.0 AS X,
               round(6378137.0 * asinh(tan(phi)), 3) + 0.0 AS Y
        FROM {_latitude()}""",
    "spec_to_schema": f"""
        SELECT form_id, row_no, field_name, alias, spec_type,
               CASE spec_type WHEN 'TEXT' THEN 'string' WHEN 'FLOAT' THEN 'float' WHEN 'DOUBLE' THEN 'double'
                    WHEN 'SHORT' THEN 'smallint' WHEN 'LONG' THEN 'int' WHEN 'DATE' THEN 'timestamp_ntz'
                    WHEN 'DATEONLY' THEN 'date' WHEN 'TIMEONLY' THEN 'string' END AS spark_type,
               length, default_value, domain
        FROM form_field WHERE field_name NOT IN {IGNORED}""",
    "spec_violations": f"""
        SELECT form_id, row_no, 'text_without_length' AS rule, field_name AS value FROM form_field
        WHERE given_type = 'TEXT' AND coalesce(length, 0) = 0 AND field_name NOT IN {IGNORED}
        UNION ALL SELECT form_id, row_no, 'bad_type', given_type FROM form_field
        WHERE field_name NOT IN {IGNORED}
          AND spec_type NOT IN ('TEXT', 'FLOAT', 'DOUBLE', 'SHORT', 'LONG', 'DATE', 'DATEONLY', 'TIMEONLY')
        UNION ALL SELECT form_id, NULL, 'missing_shape_area', shape FROM form_fact
        WHERE kind = 'FEATURE CLASS' AND upper(shape) = 'POLYGON' AND has_area IS NULL
        UNION ALL SELECT form_id, NULL, 'missing_shape_length', shape FROM form_fact
        WHERE kind = 'FEATURE CLASS' AND upper(shape) IN ('POLYGON', 'LINE') AND has_length IS NULL
        UNION ALL SELECT form_id, NULL, 'missing_name', NULL FROM form_fact WHERE named IS NULL""",
    "spec_applied": """
        SELECT form_id, record, field, 'repeated' AS rule, text AS value FROM spec_cell WHERE n > 1
        UNION ALL SELECT form_id, record, field, 'bad_type', text FROM spec_cell WHERE text IS NOT NULL AND value IS NULL
        UNION ALL SELECT form_id, record, field, 'too_long', text FROM spec_cell
        WHERE spec_type = 'TEXT' AND length > 0 AND length(text) > length
        UNION ALL SELECT form_id, record, field, 'not_in_domain', text FROM spec_cell
        WHERE listed AND text IS NOT NULL AND description IS NULL
        UNION ALL SELECT form_id, record, field, 'unknown_field', given FROM spec_given g
        WHERE NOT EXISTS (SELECT 1 FROM spec_field f WHERE f.form_id = g.form_id AND f.field = g.field)""",
    "spec_filled": """
        SELECT form_id, record, field, value, missing AND text IS NOT NULL AS is_default, description FROM spec_cell""",
    "domain_blocks": """
        SELECT form_id, domain, domain_field, c0 AS code, c1 AS description, domain NOT LIKE '% %' AS valid_name
        FROM form_code WHERE head IS NULL AND block_row IS NOT NULL AND upper(c0) <> 'CODE' AND c1 IS NOT NULL""",
    "spec_domain_fields": """
        SELECT form_id, field_name, domain, spec_type, subtype_flag IS NOT NULL AS is_subtype FROM form_field
        WHERE domain IS NOT NULL OR subtype_flag IS NOT NULL""",
    "form_metadata": """
        SELECT form_id, 'METADATA: ' || max(CASE c0 WHEN 'Dataset Name:' THEN c1 END) AS name,
               max(CASE c0 WHEN 'Dataset Description:' THEN below END) AS description,
               max(CASE c0 WHEN 'Dataset Purpose:' THEN below END) AS summary,
               max(CASE c0 WHEN 'Dataset Tags:' THEN below END) AS tags,
               max(CASE c0 WHEN 'Notes or Disclaimers:' THEN below END) AS limitations
        FROM note GROUP BY form_id""",
    # ids from 5 on, given in two runs: first every third customer, then the others
    "filled_sequence_ids": """
        SELECT c_custkey, 'AST' || CASE WHEN length(CAST(n AS varchar)) >= 3 THEN CAST(n AS varchar)
                                        ELSE lpad(CAST(n AS varchar), 3, '0') END AS ASSET_ID
        FROM (SELECT c_custkey, 4 + row_number() OVER (ORDER BY c_custkey % 3 <> 0, c_custkey) AS n FROM customer)""",
    "stamp_audit": """
        SELECT c_custkey, change, CASE change WHEN 'insert' THEN 'LOADER' END AS ADDBY,
               CASE change WHEN 'insert' THEN '2024-05-17 00:00:00' END AS ADDDATE,
               CASE WHEN change <> 'delete' THEN 'LOADER' END AS MODBY,
               CASE WHEN change <> 'delete' THEN '2024-05-17 00:00:00' END AS MODDATE FROM change""",
    "global_ids": f"""
        SELECT {KEY}, '{{' || upper(h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]) || '}}'
               AS GlobalID
        FROM (SELECT *, sha256('LND_PPLC_Permit_Info|' || Permit_Category || '|' || Permit_Number) AS h FROM uniq)""",
    "length_violations": """
        SELECT field, declared, count(*) FILTER (n > declared) AS n_too_long, cast(coalesce(max(n), 0) AS int) AS longest FROM (
            SELECT 'Work_Description' AS field, 30 AS declared, length(Work_Description) AS n FROM fx_permit_category
            UNION ALL SELECT 'Occupancy_Type', 8, length(Occupancy_Type) FROM fx_permit_category
            UNION ALL SELECT 'Street_Name', 10, length(Street_Name) FROM fx_permit_category
            UNION ALL SELECT 'PID', 8, length(PID) FROM fx_permit_category) GROUP BY ALL""",
    "locate_permits": f"""
        SELECT {KEY}, route, method, reason, CASE method WHEN 'address' THEN cast(match_score AS int) END AS score, {XY6}
        FROM located""",
    "locate_permits_summary": "SELECT Permit_Category, route, method, reason, count(*) AS n FROM located GROUP BY ALL",
}

_TEXTS = {**STAND_INS, **STEPS}
ORACLES = {name: with_tables(body, _TEXTS).replace("{S}", "varchar") for name, body in _BODIES.items()}
