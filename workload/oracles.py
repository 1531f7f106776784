"""DuckDB SQL that states what each query must return on the same tables."""

from __future__ import annotations

from workload.queries import GIVEN_TABLES

_EPOCH = "DATE '1960-01-01'"

# Common table expressions; each names the ones it reads.
_CTES: dict[str, tuple[list[str], str]] = {
    "visit": (
        [],
        f"""SELECT CASE WHEN l_linenumber = 6 AND l_quantity > 40 THEN 'ZZZ'
                ELSE CAST(s_nationkey AS VARCHAR) END AS port, CAST(n_regionkey AS VARCHAR) AS addr,
            c_nationkey AS cit, s_nationkey AS res,
            CAST(date_diff('day', {_EPOCH}, CAST(l_shipdate AS DATE)) AS INTEGER) AS arrdate,
            CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS visa,
            CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 2 END
                AS mode,
            CAST(l_quantity AS INTEGER) AS age,
            CAST(year(l_shipdate) - l_quantity AS INTEGER) AS birth,
            o_orderpriority AS gender, CAST(l_linenumber AS VARCHAR) AS airline
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    ),
    "place": (
        ["visit"],
        """SELECT DISTINCT port AS port_code, addr AS state_code, n_name AS port_name
        FROM visit JOIN nation ON port = CAST(n_nationkey AS VARCHAR)
            AND addr = CAST(n_regionkey AS VARCHAR)""",
    ),
    "location": (
        ["place"],
        """SELECT row_number() OVER (ORDER BY port_code, state_code) AS id, port_code,
            state_code, port_name
        FROM (SELECT *, count(*) OVER (PARTITION BY port_code, state_code) AS n FROM place)
        WHERE n = 1""",
    ),
    "city_whole": (
        [],
        """SELECT c_nationkey, count(*) AS total,
            count(*) FILTER (c_custkey % 2 = 0) AS even,
            count(*) FILTER (c_custkey % 2 = 1) AS odd,
            count(*) FILTER (c_acctbal < 0) AS overdrawn,
            count(*) FILTER (c_acctbal > 5000) AS wealthy,
            nullif(count(*) FILTER (c_mktsegment = 'AUTOMOBILE'), 0) AS automobile,
            nullif(count(*) FILTER (c_mktsegment = 'BUILDING'), 0) AS building,
            nullif(count(*) FILTER (c_mktsegment = 'FURNITURE'), 0) AS furniture,
            nullif(count(*) FILTER (c_mktsegment = 'HOUSEHOLD'), 0) AS household,
            nullif(count(*) FILTER (c_mktsegment = 'MACHINERY'), 0) AS machinery
        FROM customer GROUP BY c_nationkey""",
    ),
    "profile": (
        ["city_whole"],
        """SELECT * EXCLUDE (machinery), 0.5 AS age_part,
            CASE WHEN c_nationkey % 9 <> 4 THEN machinery END AS machinery
        FROM city_whole WHERE c_nationkey % 9 <> 4
            OR coalesce(automobile, building, furniture, household) IS NOT NULL
        UNION ALL BY NAME
        SELECT c_nationkey, total, even, odd, overdrawn, wealthy, machinery, 0.7 AS age_part,
            CAST(NULL AS BIGINT) AS automobile, CAST(NULL AS BIGINT) AS building,
            CAST(NULL AS BIGINT) AS furniture, CAST(NULL AS BIGINT) AS household
        FROM city_whole WHERE c_nationkey % 9 = 4 AND machinery IS NOT NULL""",
    ),
    "demographics": (
        ["place", "profile"],
        """SELECT row_number() OVER (ORDER BY port_code, age_part) AS id, port_code,
            upper(n_name[1]) || lower(n_name[2:]) AS city, r_name AS state, state_code,
            CAST(n_nationkey + 20 + age_part AS FLOAT) AS median_age,
            even AS male_population, odd AS female_population, total AS total_population,
            overdrawn AS number_of_veterans, wealthy AS foreign_born,
            CAST(2 + (n_nationkey % 10) / 10.0 AS DOUBLE) AS average_household_size,
            automobile AS hispanic_latino_population, building AS white_population,
            furniture AS african_american_population, household AS native_population,
            machinery AS asian_population
        FROM place JOIN nation ON port_code = CAST(n_nationkey AS VARCHAR)
        JOIN region ON n_regionkey = r_regionkey
        JOIN profile ON c_nationkey = n_nationkey WHERE n_nationkey % 12 <> 11""",
    ),
    "member": (
        [],
        """SELECT n_nationkey AS code,
            CASE WHEN n_name LIKE 'NATION\\_2%' ESCAPE '\\' THEN 9999 ELSE n_nationkey END
                AS country_id,
            CASE WHEN n_name LIKE 'NATION\\_2%' ESCAPE '\\' THEN 'Unknown Country' ELSE n_name END
                AS country_name
        FROM nation""",
    ),
    "seen_country": (["visit"], "SELECT cit AS code FROM visit UNION SELECT res FROM visit"),
    "country": (
        ["seen_country", "member"],
        """SELECT m.country_id, m.country_name FROM seen_country s
        JOIN (SELECT DISTINCT country_id, country_name FROM member) m ON s.code = m.country_id""",
    ),
    "calendar": (
        ["visit"],
        f"""SELECT arrdate, strftime(day, '%Y-%m-%dT%H:%M:%S') AS arrdate_conv,
            CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
            CAST(dayofmonth(day) AS INTEGER) AS dayofmonth,
            CAST(dayofweek(day) + 1 AS INTEGER) AS dayofweek,
            strftime(day, '%a') AS dayofweek_name,
            CAST(dayofyear(day) AS INTEGER) AS dayofyear,
            CAST(weekofyear(day) AS INTEGER) AS weekofyear,
            CAST(quarter(day) AS INTEGER) AS quarter
        FROM (SELECT DISTINCT arrdate, {_EPOCH} + arrdate AS day FROM visit)""",
    ),
    "junk": (
        [],
        """SELECT CAST((visa_code + 100) || CAST(transport_code AS VARCHAR) AS INTEGER) AS id,
            visa_code, transport_code, visa_type, transport_type
        FROM (VALUES (1, 'Business'), (2, 'Pleasure'), (3, 'Student')) v(visa_code, visa_type)
        CROSS JOIN (SELECT DISTINCT CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END
            AS transport_code, CASE l_linestatus WHEN 'F' THEN 'Air' ELSE 'Sea' END
            AS transport_type FROM lineitem)""",
    ),
    "code_maps": (
        [],
        """SELECT 'map_cit_res' AS map_name, CAST(n_nationkey AS VARCHAR) AS code,
            CASE WHEN n_name LIKE 'NATION\\_2%' ESCAPE '\\' THEN 'INVALID: ' ELSE '' END || n_name
                AS label, CAST(NULL AS VARCHAR) AS state FROM nation
        UNION ALL SELECT 'map_port', CAST(n_nationkey AS VARCHAR), n_name,
            CAST(n_regionkey AS VARCHAR) FROM nation
        UNION ALL SELECT 'map_addr', CAST(r_regionkey AS VARCHAR), r_name, NULL FROM region
        UNION ALL SELECT DISTINCT 'map_transport_mode', CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END,
            CASE l_linestatus WHEN 'F' THEN 'Air' ELSE 'Sea' END, NULL FROM lineitem
        UNION ALL SELECT 'map_visa', code, label, NULL
        FROM (VALUES ('1', 'Business'), ('2', 'Pleasure'), ('3', 'Student')) v(code, label)""",
    ),
    "fact": (
        ["visit", "location", "junk", "country", "demographics"],
        """SELECT l.id AS arrival_location_id, v.arrdate AS arrival_date_id,
            j.id AS visa_transport_id, c.country_id AS country_id_citizenship,
            r.country_id AS country_id_residence, d.id AS arrlocation_demographics_id,
            v.age AS immigrant_age, v.birth AS immigrant_birthyear,
            v.gender AS immigrant_gender, v.airline
        FROM visit v JOIN location l ON l.port_code = v.port
        JOIN junk j ON v.visa = j.visa_code AND v.mode = j.transport_code
        JOIN country c ON c.country_id = v.cit JOIN country r ON r.country_id = v.res
        JOIN demographics d ON d.port_code = v.port""",
    ),
}


def _with(needed: list[str], body: str) -> str:
    """Prefix ``body`` with the expressions it needs, each after its own needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _CTES[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    parts = ", ".join(f"{name} AS ({_CTES[name][1]})" for name in ordered)
    if body.startswith("WITH "):
        return f"WITH {parts}, {body.removeprefix('WITH ')}"
    return f"WITH {parts} {body}"


def _bucket(columns: list[str], digits: int) -> str:
    """Bucket number: the first hex digits of the MD5 of the columns' text."""
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, {digits}) AS BIGINT)"


def _row_key(source: str, columns: list[str], span: int) -> str:
    """Bucket above 40 bits of position, for every copy of every row."""
    listed = ", ".join(columns)
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"""SELECT bucket * 1099511627776
            + row_number() OVER (PARTITION BY bucket ORDER BY {order}, first_copy) - 1 AS id, {listed}
        FROM (SELECT *, {_bucket([*columns, 'first_copy'], 5)} AS bucket
            FROM (SELECT *, (row_number() OVER (PARTITION BY {listed}) - 1) // {span} * {span}
                AS first_copy FROM {source}))"""


_FACT_COLUMNS = [
    "arrival_location_id", "arrival_date_id", "visa_transport_id", "country_id_citizenship",
    "country_id_residence", "arrlocation_demographics_id", "immigrant_age",
    "immigrant_birthyear", "immigrant_gender", "airline",
]
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

_LOCATION_JOIN = "JOIN location l ON f.arrival_location_id = l.id"
_DATE_JOIN = "JOIN calendar d ON f.arrival_date_id = d.arrdate"
_CITIZEN_JOIN = "JOIN country c ON f.country_id_citizenship = c.country_id"
_JUNK_JOIN = "JOIN junk j ON f.visa_transport_id = j.id"


def _per_table(select: str) -> str:
    return " UNION ALL ".join(
        select.format(name=name, columns=columns) for name, columns in GIVEN_TABLES.items()
    )


def _model_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{view}' AS table_name, count(*) AS row_count,
            CAST({columns} AS INTEGER) AS column_count, CAST(0 AS BIGINT) AS repeated_keys
        FROM {name}"""
        for view, name, columns in [
            ("dim_arrival_location", "location", 4),
            ("dim_demographics", "demographics", 17),
            ("dim_origin_country", "country", 2),
            ("dim_arrival_date", "calendar", 10),
            ("dim_junk_visa_transport", "junk", 5),
            ("fact_immigration", "fact", 11),
        ]
    )


_PORT_MISS = "port NOT IN (SELECT port_code FROM location)"
_JUNK_MISS = "mode IS NULL OR (visa, mode) NOT IN (SELECT (visa_code, transport_code) FROM junk)"
_CIT_MISS = "cit NOT IN (SELECT country_id FROM country)"
_RES_MISS = "res NOT IN (SELECT country_id FROM country)"
_CITY_MISS = "port NOT IN (SELECT port_code FROM demographics)"
_MISSES = {
    "location": _PORT_MISS,
    "visa_transport": _JUNK_MISS,
    "citizenship": _CIT_MISS,
    "residence": _RES_MISS,
    "demographics": _CITY_MISS,
    "any": " OR ".join([_PORT_MISS, _JUNK_MISS, _CIT_MISS, _RES_MISS, _CITY_MISS]),
}

_CUBE_KEYS = {
    "arrival_location_id": "BIGINT", "arrlocation_demographics_id": "BIGINT",
    "country_id_citizenship": "INTEGER", "arrival_date_id": "INTEGER", "visa_transport_id": "INTEGER",
    "immigrant_age": "INTEGER", "country_id_residence": "INTEGER",
}
_CUBE_SETS = {
    "place_origin": ["arrival_location_id", "arrlocation_demographics_id", "country_id_citizenship"],
    "place_day": ["arrival_location_id", "arrival_date_id"],
    "place_kind": ["arrival_location_id", "visa_transport_id"],
    "place_age": ["arrival_location_id", "immigrant_age"],
    "origins": ["country_id_citizenship", "country_id_residence"],
}


def _cube_rows() -> str:
    parts = []
    for name, keys in _CUBE_SETS.items():
        columns = ", ".join(
            f"CAST({key if key in keys else 'NULL'} AS {kind}) AS {key}" for key, kind in _CUBE_KEYS.items()
        )
        parts.append(
            f"SELECT {columns}, count(*) AS visits, '{name}' AS grouping_set FROM fact GROUP BY {', '.join(keys)}"
        )
    return " UNION ALL ".join(parts)


_PROFILED = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": _LINE_COLUMNS,
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
}


def _per_column(select: str) -> str:
    return " UNION ALL ".join(
        select.format(table=name, column=column) for name, columns in _PROFILED.items() for column in columns
    )


_REASONS = list(_MISSES)[:-1]
_MASK = " + ".join(
    f"CASE WHEN {_MISSES[name]} THEN {1 << k} ELSE 0 END" for k, name in enumerate(_REASONS)
)
_NAMES = ", ".join(f"CASE WHEN reject_reasons & {1 << k} > 0 THEN '{n}' END" for k, n in enumerate(_REASONS))
_MARKED = f"SELECT *, CAST({_MASK} AS INTEGER) AS reject_reasons FROM visit"
_ODD_HOME = "TRY_CAST(port AS INTEGER) % 2 = 1 AND addr = CAST(TRY_CAST(port AS INTEGER) % 5 AS VARCHAR)"
_FIRST_DAY = f"NOT coalesce({_ODD_HOME}, false) AND arrdate % 3 <> 1"
_BROKEN = """CASE c_custkey % 30
    WHEN 10 THEN concat_ws(';', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'more')
    WHEN 20 THEN concat_ws(';', 'x' || c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)
    ELSE 'broken;line-' || c_custkey END"""
_SPELLED = """spelled AS (
    SELECT c_custkey, c_nationkey, regexp_replace(md5(CAST(c_custkey AS VARCHAR)), '[0-9]', '', 'g') AS n
    FROM customer),
lefts AS (SELECT DISTINCT c_nationkey, CASE WHEN length(n) < 5 OR c_custkey % 4 = 3 THEN n
    WHEN c_custkey % 4 = 0 THEN substr(n, 1, 3) || substr(n, 5)
    WHEN c_custkey % 4 = 1 THEN substr(n, 1, 2) || substr(n, 4, 1) || substr(n, 3, 1) || substr(n, 5)
    ELSE n || 'z' END AS left_name FROM spelled),
rights AS (SELECT DISTINCT c_nationkey, n AS right_name FROM spelled),
pairs AS (SELECT *, CAST(levenshtein(left_name, right_name) AS INTEGER) AS distance
    FROM lefts JOIN rights USING (c_nationkey)
    WHERE left_name <> right_name AND levenshtein(left_name, right_name) <= 2)"""
_FEATURES = {
    "fact_quarantine": _with(
        ["visit", "location", "junk", "country", "demographics"],
        f"""WITH marked AS ({_MARKED})
        SELECT port, addr AS state, CAST(cit AS INTEGER) AS i94cit, CAST(res AS INTEGER) AS i94res,
            arrdate, CAST(mode AS INTEGER) AS transport, airline, reject_reasons,
            concat_ws('+', {_NAMES}) AS reasons
        FROM marked WHERE reject_reasons > 0""",
    ),
    "fact_quarantine_balance": _with(
        ["fact"],
        f"""WITH marked AS ({_MARKED})
        SELECT 0 AS reject_reasons, count(*) AS row_count, '' AS reasons FROM fact
        UNION ALL SELECT reject_reasons, count(*), any_value(concat_ws('+', {_NAMES}))
        FROM marked WHERE reject_reasons > 0 GROUP BY reject_reasons""",
    ),
    "incremental_build": _with(
        ["fact"],
        """SELECT f.* EXCLUDE (arrival_location_id, arrlocation_demographics_id), l.port_code,
            l.state_code, d.city, d.median_age
        FROM fact f JOIN location l ON l.id = arrival_location_id
        JOIN demographics d ON d.id = arrlocation_demographics_id""",
    ),
    "incremental_keys": _with(
        ["location", "demographics"],
        f"""WITH early AS (SELECT DISTINCT port, addr FROM visit WHERE {_FIRST_DAY})
        SELECT 'dim_arrival_location' AS table_name,
            count(*) FILTER ((port_code, state_code) IN (SELECT (port, addr) FROM early)) AS first_members,
            count(*) AS last_members, first_members AS kept_ids, count(*) AS ids FROM location
        UNION ALL SELECT 'dim_demographics',
            count(*) FILTER ((port_code, state_code) IN (SELECT (port, addr) FROM early)) AS first_members,
            count(*), first_members, count(*) FROM demographics""",
    ),
    "scan_csv_quarantine": f"""WITH lines AS (
            SELECT c_custkey // 1000 AS file_number, c_custkey, 0 AS n, '' AS line FROM customer
            UNION ALL SELECT c_custkey // 1000, c_custkey, 1, {_BROKEN} FROM customer
            WHERE c_custkey % 10 = 0)
        SELECT CAST(file_number AS INTEGER) AS file_number, record, line FROM (
            SELECT *, row_number() OVER (PARTITION BY file_number ORDER BY c_custkey, n) AS record
            FROM lines) WHERE n = 1""",
    "keyed_diff": """WITH later AS (
            SELECT CASE WHEN c_custkey % 50 = 8 THEN c_custkey + 1000000000 ELSE c_custkey END AS c_custkey,
                c_custkey % 7 = 0 AS balance, c_custkey % 11 = 0 AND c_mktsegment <> 'OTHER' AS segment
            FROM customer WHERE c_custkey % 50 <> 7)
        SELECT c_custkey, 'removed' AS change, '' AS columns FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM later)
        UNION ALL SELECT c_custkey, 'added', '' FROM later
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT c_custkey, 'changed', concat_ws('+', CASE WHEN balance THEN 'c_acctbal' END,
            CASE WHEN segment THEN 'c_mktsegment' END)
        FROM later WHERE (balance OR segment) AND c_custkey IN (SELECT c_custkey FROM customer)""",
    "bag_diff": """SELECT l_returnflag, l_linestatus, l_linenumber,
            count(*) FILTER (l_orderkey % 100 <> 2 AND NOT (l_returnflag = 'R' AND l_linenumber = 7))
                - count(*) FILTER (l_orderkey % 100 <> 1) AS surplus
        FROM lineitem GROUP BY 1, 2, 3 HAVING surplus <> 0""",
    "build_diff": _with(
        ["location", "demographics", "country", "calendar"],
        f"""WITH early AS (SELECT * FROM visit WHERE {_FIRST_DAY})
        SELECT 'dim_arrival_location' AS table_name, port_code || '|' || state_code AS row_key,
            'added' AS change FROM location
        WHERE (port_code, state_code) NOT IN (SELECT (port, addr) FROM early)
        UNION ALL SELECT 'dim_demographics', concat_ws('|', port_code, city, state_code,
            CAST(median_age AS VARCHAR)), 'added' FROM demographics
        WHERE (port_code, state_code) NOT IN (SELECT (port, addr) FROM early)
        UNION ALL SELECT 'dim_origin_country', CAST(country_id AS VARCHAR), 'added' FROM country
        WHERE country_id NOT IN (SELECT cit FROM early UNION SELECT res FROM early)
        UNION ALL SELECT 'dim_arrival_date', CAST(arrdate AS VARCHAR), 'added' FROM calendar
        WHERE arrdate NOT IN (SELECT arrdate FROM early)""",
    ),
    "fact_compacted": _with(
        ["fact"],
        """SELECT f.* EXCLUDE (arrival_location_id, arrlocation_demographics_id), l.port_code,
            l.state_code, d.city, d.median_age
        FROM fact f JOIN location l ON l.id = arrival_location_id
        JOIN demographics d ON d.id = arrlocation_demographics_id""",
    ),
    "profile_tables": _per_column(
        """SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count,
            count(*) - count({column}) AS null_count, CAST(min({column}) AS VARCHAR) AS least,
            CAST(max({column}) AS VARCHAR) AS greatest,
            round(avg(length(CAST({column} AS VARCHAR))), 6) AS mean_length FROM {table}"""
    ),
    "profile_sketches": _per_column(
        "SELECT '{table}' AS table_name, '{column}' AS column_name, true AS distinct_near, "
        "true AS median_near"
    ),
    "profile_drift": """SELECT 'orders' AS table_name, * FROM (VALUES
        ('o_totalprice', 'range+distribution'), ('o_orderstatus', 'nulls'),
        ('o_custkey', 'distinct+distribution'), ('o_extra', 'new'),
        ('o_orderpriority', 'missing')) v(column_name, findings)""",
    "fact_clustered": _with(
        ["fact"],
        """SELECT * FROM fact
        WHERE arrival_location_id = 3 AND arrival_date_id BETWEEN 13500 AND 14000""",
    ),
    "report_cube": _with(["fact"], _cube_rows()),
    "report_cube_daily": _with(
        ["fact", "calendar"],
        f"""SELECT quarter, port_name AS city, count(*) AS visitor_amount
        FROM fact f {_LOCATION_JOIN} {_DATE_JOIN} GROUP BY 1, 2""",
    ),
    "scan_csv_captured": "SELECT * FROM customer",
    "scan_drifting_feed": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
            CASE l_orderkey % 6 WHEN 3 THEN NULL WHEN 1 THEN trunc(l_quantity) ELSE l_quantity END
                AS l_quantity,
            CASE WHEN l_orderkey % 6 <> 4 THEN l_returnflag END AS l_returnflag,
            CASE WHEN l_orderkey % 6 <> 4 THEN l_shipdate END AS l_shipdate
        FROM lineitem WHERE l_orderkey % 6 <> 5""",
    "join_similar_place": f"WITH {_SPELLED} SELECT * FROM pairs",
    "join_nearest_place": f"""WITH {_SPELLED}, wanted AS (
            SELECT *, min(distance) OVER (PARTITION BY c_nationkey, left_name) AS least FROM pairs
            WHERE (c_nationkey, left_name) NOT IN (SELECT (c_nationkey, right_name) FROM rights))
        SELECT c_nationkey, left_name, min(right_name) AS right_name, least AS distance,
            count(*) - 1 AS rivals
        FROM wanted WHERE distance = least GROUP BY c_nationkey, left_name, least""",
}

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT * FROM customer",
    "scan_csv_dropmalformed": "SELECT * FROM customer",
    "stage_sources": _per_table(
        "SELECT 'staging_{name}' AS table_name, count(*) AS row_count, "
        "CAST({columns} AS INTEGER) AS column_count FROM {name}"
    ),
    "codemap_parse": """SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part
        WHERE p_partkey % 7 <> 3
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'WRONG' FROM part
        WHERE p_partkey % 7 = 3 AND p_partkey % 5 = 2""",
    "codemap_literal": """SELECT visa_code, visa_type, count(*) AS row_count
        FROM (SELECT CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END
            AS visa_code FROM lineitem)
        JOIN (VALUES ('1', 'Business'), ('2', 'Pleasure'), ('3', 'Student'))
            v(visa_code, visa_type) USING (visa_code)
        GROUP BY visa_code, visa_type""",
    "codemap_csv_roundtrip": """SELECT CAST(p_partkey AS VARCHAR) AS code,
        p_name || ' ''' || p_brand || '|' AS label FROM part""",
    "split_place_label": """SELECT c_custkey,
            c_name || CASE c_custkey % 3 WHEN 1 THEN ' ' ELSE '' END AS place_name,
            c_mktsegment AS place_state
        FROM customer WHERE c_custkey % 3 <> 0""",
    "cluster_unknown": """SELECT DISTINCT
            CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 9999
                ELSE CAST(c_custkey AS INTEGER) END AS country_id,
            CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Unknown Country'
                ELSE c_name END AS country_name
        FROM customer""",
    "drop_nulls": """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""",
    "normalize_column_names": """SELECT c_custkey AS cust_key, c_name AS full_name,
            c_nationkey AS nation_key, c_acctbal AS acct_bal, c_mktsegment AS market_segment
        FROM customer""",
    "typed_casts": """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS as_double,
            CAST(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS FLOAT) AS as_float,
            CAST(trunc(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END) AS BIGINT) AS as_long,
            CAST(trunc(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END) AS INTEGER) AS as_int
        FROM customer""",
    "join_case_insensitive": """SELECT a.c_custkey, upper(a.c_name) AS left_name,
            upper(b.c_name[1]) || lower(b.c_name[2:]) AS right_name, b.c_acctbal
        FROM customer a JOIN customer b
        ON lower(a.c_name) = lower(b.c_name) AND a.c_nationkey = b.c_nationkey""",
    "unique_guard_composite": """SELECT l_orderkey, l_linenumber, l_partkey
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
        WHERE n = 1""",
    "unique_guard_single": """SELECT l_orderkey, l_linenumber, l_partkey
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
        WHERE n = 1""",
    "unique_guard_nonnull": """SELECT l_orderkey, l_linenumber, first_part
        FROM (SELECT *, count(first_part) OVER (PARTITION BY l_orderkey) AS n
            FROM (SELECT l_orderkey, l_linenumber,
                CASE WHEN l_linenumber = 1 THEN l_partkey END AS first_part FROM lineitem))
        WHERE n = 1""",
    "duplicate_key_report": """SELECT l_orderkey, l_linenumber, count(*) AS key_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "union_distinct_codes": _with(
        ["seen_country"], "SELECT CAST(code AS DOUBLE) AS code FROM seen_country"
    ),
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem",
    "pivot_long_to_wide": """SELECT l_orderkey, l_linestatus,
            sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS quantity_a,
            sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS quantity_n
        FROM lineitem GROUP BY l_orderkey, l_linestatus""",
    "sas_day_to_date": f"""SELECT o_orderkey, CAST(date_diff('day', {_EPOCH}, day) AS INTEGER)
            AS day_offset, strftime(day, '%Y-%m-%dT%H:%M:%S') AS day_text
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0
            THEN CAST(o_orderdate AS DATE) END AS day FROM orders)""",
    "sql_day_function": """SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT%H:%M:%S')
            AS day_text, count(*) AS orders
        FROM orders GROUP BY 1""",
    "date_dimension": _with(["calendar"], "SELECT * FROM calendar"),
    "junk_dimension": _with(["junk"], "SELECT * FROM junk"),
    "location_dimension": _with(["location"], "SELECT * FROM location"),
    "country_dimension": _with(["country"], "SELECT * FROM country"),
    "country_dimension_unknown_member": _with(
        ["seen_country", "member"],
        "SELECT DISTINCT country_id, country_name FROM seen_country JOIN member USING (code)",
    ),
    "demographics_dimension": _with(["demographics"], "SELECT * FROM demographics"),
    "surrogate_key": """SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_name, c_custkey
        FROM customer""",
    "surrogate_key_bucketed": f"""SELECT row_number() OVER (
            ORDER BY {_bucket(['l_orderkey', 'l_linenumber', 'l_partkey', 'first_copy'], 4)},
            {', '.join(_LINE_COLUMNS)}, first_copy) AS id, {', '.join(_LINE_COLUMNS)}
        FROM (SELECT *, (row_number() OVER (PARTITION BY {', '.join(_LINE_COLUMNS)}) - 1)
            // 100000 * 100000 AS first_copy FROM lineitem)""",
    "surrogate_key_copies": _row_key("lineitem", ["l_returnflag", "l_linestatus"], 1000),
    "fact_lookup_rows": _with(["fact"], "SELECT * FROM fact"),
    "fact_star_join": _with(["fact"], _row_key("fact", _FACT_COLUMNS, 100000)),
    "fact_role_playing": _with(
        ["fact"],
        f"""SELECT c.country_name AS citizenship, r.country_name AS residence,
            count(*) AS visitor_amount
        FROM fact f {_CITIZEN_JOIN} JOIN country r ON f.country_id_residence = r.country_id
        GROUP BY c.country_name, r.country_name""",
    ),
    "codemap_set": _with(
        ["code_maps"],
        "SELECT * FROM code_maps CROSS JOIN (VALUES ('built'), ('file')) o(origin)",
    ),
    "fact_partitioned": _with(
        ["fact"],
        f"""SELECT *, CAST(year({_EPOCH} + arrival_date_id) AS INTEGER) AS arrival_year,
            CAST(month({_EPOCH} + arrival_date_id) AS INTEGER) AS arrival_month FROM fact""",
    ),
    "fact_positional": _with(
        ["fact"], "SELECT *, count(*) AS fact_rows, count(*) AS fact_ids FROM fact GROUP BY ALL"
    ),
    "fact_unknown_member": _with(
        ["visit", "location", "junk", "member", "demographics"],
        """SELECT l.id AS arrival_location_id, v.arrdate AS arrival_date_id,
            j.id AS visa_transport_id, c.country_id AS country_id_citizenship,
            r.country_id AS country_id_residence, d.id AS arrlocation_demographics_id,
            v.age AS immigrant_age, v.birth AS immigrant_birthyear,
            v.gender AS immigrant_gender, v.airline
        FROM visit v JOIN location l ON l.port_code = v.port
        JOIN junk j ON v.visa = j.visa_code AND v.mode = j.transport_code
        JOIN member c ON c.code = v.cit JOIN member r ON r.code = v.res
        JOIN demographics d ON d.port_code = v.port""",
    ),
    "fact_rejects_by_lookup": _with(
        ["fact"],
        " UNION ALL ".join(
            f"""SELECT '{name}' AS lookup_name, count(*) AS feed_rows,
                count(*) FILTER ({miss}) AS rejected_rows FROM visit"""
            for name, miss in _MISSES.items()
        ),
    ),
    "check_not_empty": _per_table(
        "SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM {name}"
    ),
    "check_columns": _per_table(
        "SELECT '{name}' AS table_name, CAST({columns} AS INTEGER) AS column_count, "
        "count(*) AS row_count, true AS passed FROM {name}"
    ),
    "code_length_profile": """SELECT DISTINCT
            CAST(length(CAST(c_custkey AS VARCHAR)) AS INTEGER) AS c_custkey_length,
            CAST(length(c_mktsegment) AS INTEGER) AS c_mktsegment_length
        FROM customer""",
    "model_roundtrip": _with(["fact", "calendar"], _model_rows()),
    "sql_tables": """SELECT c_mktsegment, count(*) AS orders, max(o_totalprice) AS largest
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    **_FEATURES,
    "report_top_locations": _with(
        ["fact"],
        """WITH counted AS (SELECT arrival_location_id AS id, count(*) AS n FROM fact GROUP BY 1)
        SELECT port_name AS city, CAST(sum(n) AS BIGINT) AS visitor_amount
        FROM counted JOIN location USING (id)
        GROUP BY city ORDER BY visitor_amount DESC, city LIMIT 5""",
    ),
    "report_busiest_weekday": _with(
        ["fact", "calendar"],
        """WITH april AS (SELECT * FROM calendar WHERE year = 1998 AND month = 4),
        ports AS (SELECT id, port_name FROM location WHERE port_name = 'NATION_9')
        SELECT dayofweek_name AS arrival_day, port_name AS city, count(*) AS visitor_amount
        FROM april JOIN fact ON arrdate = arrival_date_id JOIN ports ON id = arrival_location_id
        GROUP BY ALL ORDER BY visitor_amount DESC, arrival_day LIMIT 1""",
    ),
    "report_top_origins": _with(
        ["fact"],
        """WITH counted AS (
            SELECT country_id_citizenship AS country_id, count(*) AS n FROM fact GROUP BY 1)
        SELECT country_name, n AS visitor_amount FROM counted JOIN country USING (country_id)
        ORDER BY n DESC, country_name LIMIT 5""",
    ),
    "report_top_locations_for_origin": _with(
        ["fact"],
        """WITH counted AS (
            SELECT arrival_location_id AS id, count(*) AS n FROM fact
            WHERE country_id_citizenship IN (
                SELECT country_id FROM country WHERE country_name = 'NATION_7') GROUP BY 1)
        SELECT port_name AS city, CAST(sum(n) AS BIGINT) AS visitor_amount
        FROM counted JOIN location USING (id)
        GROUP BY city ORDER BY visitor_amount DESC, city LIMIT 5""",
    ),
    "report_origin_vs_share": _with(
        ["fact"],
        """WITH shares AS (
            SELECT id AS profile, 100 * (CAST(asian_population AS DOUBLE)
                / nullif(total_population, 0)) AS share FROM demographics),
        counted AS (
            SELECT arrival_location_id AS id, arrlocation_demographics_id AS profile,
                count(*) AS n FROM fact
            WHERE country_id_citizenship IN (
                SELECT country_id FROM country WHERE country_name = 'NATION_7') GROUP BY ALL),
        summed AS (
            SELECT port_name AS city, share, CAST(sum(n) AS BIGINT) AS amount_visitor
            FROM counted JOIN location USING (id) JOIN shares USING (profile) GROUP BY ALL)
        SELECT 'NATION_7' AS citizenship, city, amount_visitor, round(share, 2) AS ratio
        FROM summed ORDER BY amount_visitor DESC, city, share NULLS FIRST LIMIT 5""",
    ),
    "report_top_locations_by_purpose": _with(
        ["fact"],
        """WITH purposes AS (SELECT id, visa_type FROM junk WHERE visa_type = 'Student')
        SELECT visa_type, port_name AS city, count(*) AS amount
        FROM purposes JOIN fact ON purposes.id = visa_transport_id
        JOIN location ON location.id = arrival_location_id
        GROUP BY ALL ORDER BY amount DESC, city LIMIT 5""",
    ),
    "report_share_correlation": _with(
        ["fact"],
        f"""SELECT count(*) AS locations, round(corr(x, y), 6) AS correlation FROM (
            SELECT CAST(g.asian_population AS DOUBLE) / nullif(g.total_population, 0) * 100 AS x,
                CAST(count(*) FILTER (c.country_name IN
                    ('NATION_3', 'NATION_7', 'NATION_12', 'NATION_17')) AS DOUBLE)
                    / count(*) * 100 AS y
            FROM fact f {_LOCATION_JOIN} {_CITIZEN_JOIN}
            JOIN demographics g ON f.arrlocation_demographics_id = g.id
            GROUP BY l.port_name, 1) WHERE x IS NOT NULL""",
    ),
    "report_bucket_by_location": _with(
        ["fact"],
        f"""SELECT port_name AS city, CAST(floor(immigrant_age / 10.0) * 10 AS INTEGER)
            AS age_group, count(*) AS visitor_amount
        FROM fact f {_LOCATION_JOIN} GROUP BY 1, 2""",
    ),
    "report_season_histogram": _with(
        ["fact", "calendar"],
        f"""SELECT quarter, port_name AS city, count(*) AS visitor_amount
        FROM fact f {_LOCATION_JOIN} {_DATE_JOIN} GROUP BY 1, 2""",
    ),
    "report_by_purpose": _with(
        ["fact"],
        f"SELECT visa_type, count(*) AS visitor_amount FROM fact f {_JUNK_JOIN} GROUP BY 1",
    ),
    "report_by_mode": _with(
        ["fact"],
        f"SELECT transport_type, count(*) AS visitor_amount FROM fact f {_JUNK_JOIN} GROUP BY 1",
    ),
}
