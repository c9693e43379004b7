"""DuckDB SQL for every relational query in the catalog.

Each statement rebuilds the derived views from the raw tables as CTEs and
answers the query the plain SQL way, often in a different form from the Spark
plan (a join of two aggregates where Spark uses one conditional aggregate,
exact quantile functions where Spark reduces to a value histogram first), so
that agreement is evidence rather than repetition.

Type notes: DuckDB's ``year()`` and friends return BIGINT and are cast to
INTEGER to match Spark; ``dayofweek`` starts at 0 on Sunday, Spark's at 1.
Every LIMIT carries a full tie-break with explicit null ordering.
"""

from __future__ import annotations

from aerolens.plans.catalog import ONE_YEAR, STATE_A, STATE_B

FLIGHT_COLUMNS = [
    "FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY",
    "TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "ARR_TIME", "ARR_DELAY",
    "CANCELLED", "DISTANCE",
]
EXTRA_COLUMNS = ["EXTRA_1", "EXTRA_2", "EXTRA_3", "EXTRA_4", "EXTRA_5", "EXTRA_6"]

_VIEWS = """
li AS (
  SELECT CAST(l_shipdate AS DATE) AS FL_DATE,
         CAST(l_orderkey AS BIGINT) * 31 + l_linenumber * 17 + l_partkey * 7 AS x,
         CAST(l_orderkey AS BIGINT) * 13 + l_linenumber * 5 + l_suppkey * 3 AS y,
         CAST(l_partkey AS BIGINT) * 11 + l_suppkey * 19 + l_linenumber AS z
  FROM lineitem),
li2 AS (
  SELECT FL_DATE, x, y, z, x % 53 = 0 AS cxl, y % 89 = 0 AS divd,
         x % 24 AS hh, y % 60 AS mm,
         (x % 61) - 20 + CASE WHEN x % 101 = 0 THEN 450 ELSE 0 END AS dd
  FROM li),
li3 AS (SELECT *, (hh * 60 + mm + dd + 1440) % 1440 AS t FROM li2),
flights AS (
  SELECT FL_DATE,
    concat('C', lpad(CAST(least(x % 18, y % 18) AS VARCHAR), 2, '0')) AS OP_CARRIER,
    concat('A', lpad(CAST(least(x % 125, z % 131) AS VARCHAR), 3, '0')) AS ORIGIN,
    concat('A', lpad(CAST(least(y % 125, z % 137) AS VARCHAR), 3, '0')) AS DEST,
    CAST(CASE WHEN y % 97 = 0 THEN 2400 ELSE hh * 100 + mm END AS INTEGER) AS CRS_DEP_TIME,
    CASE WHEN cxl THEN NULL ELSE CAST(floor(t / 60) * 100 + t % 60 AS DOUBLE) END AS DEP_TIME,
    CASE WHEN cxl THEN NULL ELSE CAST(dd AS DOUBLE) END AS DEP_DELAY,
    CASE WHEN cxl THEN NULL ELSE CAST(5 + z % 30 AS DOUBLE) END AS TAXI_OUT,
    CASE WHEN cxl THEN NULL ELSE CAST((z % 24) * 100 + x % 60 AS DOUBLE) END AS WHEELS_OFF,
    CASE WHEN cxl OR divd THEN NULL ELSE CAST((x % 24) * 100 + z % 60 AS DOUBLE) END AS WHEELS_ON,
    CASE WHEN cxl OR divd THEN NULL ELSE CAST(2 + z % 15 AS DOUBLE) END AS TAXI_IN,
    CASE WHEN cxl OR divd THEN NULL ELSE CAST((y % 24) * 100 + z % 60 AS DOUBLE) END AS ARR_TIME,
    CASE WHEN cxl OR divd THEN NULL ELSE CAST(dd + (y % 31) - 18 AS DOUBLE) END AS ARR_DELAY,
    CASE WHEN cxl THEN 1.0E0 ELSE 0.0E0 END AS CANCELLED,
    CAST(100 + z % 2500 AS DOUBLE) AS DISTANCE,
    CASE WHEN x % 9 = 0 THEN CAST(x % 40 AS DOUBLE) END AS EXTRA_1,
    CASE WHEN x % 9 = 0 THEN CAST(y % 40 AS DOUBLE) END AS EXTRA_2,
    CASE WHEN x % 9 = 0 THEN CAST(z % 40 AS DOUBLE) END AS EXTRA_3,
    CASE WHEN x % 9 = 0 THEN 0.0E0 END AS EXTRA_4,
    CASE WHEN x % 9 = 0 THEN CAST(y % 7 AS DOUBLE) END AS EXTRA_5,
    CAST(NULL AS VARCHAR) AS EXTRA_6
  FROM li3),
airports AS (
  SELECT 'Airport ' || printf('%03d', key) AS Airport,
         'City ' || CAST(key % 80 AS VARCHAR) AS City,
         n_name AS State,
         'A' || printf('%03d', key) AS IATA
  FROM (SELECT c_custkey % 120 AS key, CAST(SUM(c_nationkey) % 25 AS INTEGER) AS nation_key
        FROM customer GROUP BY c_custkey % 120) grouped
  JOIN nation ON nation_key = n_nationkey),
enriched AS (
  SELECT f.FL_DATE, f.OP_CARRIER, f.ORIGIN, f.DEST, f.CRS_DEP_TIME, f.DEP_TIME, f.DEP_DELAY,
    f.TAXI_OUT, f.WHEELS_OFF, f.WHEELS_ON, f.TAXI_IN, f.ARR_TIME, f.ARR_DELAY,
    f.CANCELLED, f.DISTANCE,
    o.City AS OriginCity, o.State AS OriginState,
    d.City AS DestinationCity, d.State AS DestinationState,
    CAST(year(f.FL_DATE) AS INTEGER) AS Year,
    CAST(month(f.FL_DATE) AS INTEGER) AS Month,
    CAST(day(f.FL_DATE) AS INTEGER) AS Day,
    dayname(f.FL_DATE) AS Day_Name,
    CAST(dayofweek(f.FL_DATE) + 1 AS INTEGER) AS Day_OfWeek,
    CASE WHEN month(f.FL_DATE) IN (3, 4, 5) THEN 'SPRING'
         WHEN month(f.FL_DATE) IN (6, 7, 8) THEN 'SUMMER'
         WHEN month(f.FL_DATE) IN (9, 10, 11) THEN 'AUTUMN'
         WHEN month(f.FL_DATE) IN (12, 1, 2) THEN 'WINTER' END AS Seasons,
    CASE WHEN f.CRS_DEP_TIME >= 0 AND f.CRS_DEP_TIME < 400 THEN 'Early Morning'
         WHEN f.CRS_DEP_TIME >= 400 AND f.CRS_DEP_TIME < 1200 THEN 'Morning'
         WHEN f.CRS_DEP_TIME >= 1200 AND f.CRS_DEP_TIME < 1800 THEN 'Afternoon'
         WHEN f.CRS_DEP_TIME >= 1800 AND f.CRS_DEP_TIME <= 2359 THEN 'Evening/Night'
    END AS Parts_of_day
  FROM flights f
  LEFT JOIN airports o ON f.ORIGIN = o.IATA
  LEFT JOIN airports d ON f.DEST = d.IATA),
flown AS (SELECT * FROM enriched WHERE CANCELLED <> 1),
labelled AS (
  SELECT *, CASE WHEN ARR_DELAY < -10 THEN 'Early'
                 WHEN ARR_DELAY > 10 THEN 'Delay'
                 ELSE 'OnTime' END AS Labels
  FROM flown WHERE ARR_DELAY < 400 AND DEP_DELAY < 400)
"""

# Delay distribution CTEs, appended after the views.
_DELAYS = """,
vals AS (
  SELECT 'ARR_DELAY' AS delay, ARR_DELAY AS value FROM flown WHERE ARR_DELAY IS NOT NULL
  UNION ALL
  SELECT 'DEP_DELAY' AS delay, DEP_DELAY AS value FROM flown WHERE DEP_DELAY IS NOT NULL),
quart AS (
  SELECT delay, COUNT(*) AS n_values,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
         AVG(value) AS mean, quantile_cont(value, 0.75) AS q3
  FROM vals GROUP BY delay),
fences AS (
  SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
  FROM quart)
"""


def _with(body: str, extra: str = "") -> str:
    return "WITH " + _VIEWS + extra + body


def _ranked(agg: str, group: str, measure: str, cols: str, k: int = 5) -> str:
    return _with(
        f"""
SELECT {cols} FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY {group} ORDER BY {measure} DESC) AS rnk
  FROM ({agg}) a) r
WHERE rnk <= {k}"""
    )


def _null_share(c: str) -> str:
    return (
        f'CAST(COUNT(*) FILTER (WHERE "{c}" IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)'
        f' * 100.0 AS "{c}"'
    )


def _bin_case(k: int = 10) -> str:
    return "".join(
        f" + CASE WHEN u.value >= CAST({i} AS DOUBLE) * r.step + r.first THEN 1 ELSE 0 END"
        for i in range(1, k)
    )


# The grouping columns and the nine grouping sets of the shared
# aggregate, written out here so that a lost set on the other side shows.
GROUPING_COLUMNS = "Year, Month, OP_CARRIER, Day_Name, DestinationState, DestinationCity, Day_OfWeek, ORIGIN, Seasons, Parts_of_day, OriginCity"
GROUPING_SETS = [
    "(Year, Month)",
    "(Year, OP_CARRIER)",
    "(Year, Day_Name)",
    "(Year, DestinationState, DestinationCity)",
    "(Day_Name, OP_CARRIER, Day_OfWeek)",
    "(OP_CARRIER)",
    "(Year, ORIGIN)",
    "(Seasons, DestinationState)",
    "(Parts_of_day, OriginCity, DestinationCity)",
]


def _report_aggregates() -> str:
    keys, sets = GROUPING_COLUMNS, ", ".join(GROUPING_SETS)
    return _with(
        f"""
SELECT {keys},
       COUNT(*) AS scheduled, COUNT(DEP_TIME) AS flown, COUNT(ARR_TIME) AS arrived,
       COUNT(ORIGIN) AS origins,
       SUM(DEP_DELAY) AS dep_delay_sum, COUNT(DEP_DELAY) AS dep_delay_n,
       SUM(ARR_DELAY) AS arr_delay_sum, COUNT(ARR_DELAY) AS arr_delay_n,
       SUM(TAXI_OUT) AS taxi_out_sum, COUNT(TAXI_OUT) AS taxi_out_n,
       SUM(DISTANCE) AS distance,
       GROUPING({keys}) AS set_id
FROM enriched
GROUP BY GROUPING SETS ({sets})"""
    )


def _parts(share: str) -> str:
    """The labelled rows with the part that a hash of their key puts them in."""
    edge = {"0.8": "cccccccd", "0.7": "b3333333"}[share]
    return f"""parts AS (
  SELECT *, CASE WHEN substr(md5(concat_ws('|', '42', CAST(FL_DATE AS VARCHAR), OP_CARRIER, ORIGIN, DEST,
                                           CAST(CRS_DEP_TIME AS VARCHAR))), 1, 8) < '{edge}'
            THEN 'train' ELSE 'test' END AS part
  FROM labelled)"""


def _feature_vectors() -> str:
    """Indices by frequency in the train part, then by value; unknown values come last."""
    ctes, joins = [_parts("0.7")], []
    for k, c in enumerate(("OP_CARRIER", "ORIGIN", "DEST", "Labels")):
        ctes.append(f"""i{k} AS (
  SELECT {c} AS value, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c} ASC) - 1 AS DOUBLE) AS idx,
         CAST(COUNT(*) OVER () AS DOUBLE) AS many
  FROM parts WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c})""")
        joins.append(f"LEFT JOIN i{k} ON p.{c} = i{k}.value")
    index = ", ".join(
        f"COALESCE(i{k}.idx, (SELECT MAX(many) FROM i{k})) AS {c}_Index"
        for k, c in enumerate(("OP_CARRIER", "ORIGIN", "DEST"))
    )
    numbers = ["TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "DEP_TIME", "DEP_DELAY"]
    return (
        ", " + ", ".join(ctes) + f" SELECT {index}, {', '.join('p.' + n for n in numbers)}, i3.idx AS label_index, p.part"
        f" FROM parts p {' '.join(joins)} WHERE " + " AND ".join(f"p.{n} IS NOT NULL" for n in numbers)
    )


def _vector_summary() -> str:
    """One row for each category of the train part and each number, by part."""
    numbers = ["TAXI_OUT", "WHEELS_OFF", "WHEELS_ON", "TAXI_IN", "DEP_TIME", "DEP_DELAY"]
    usable = " AND ".join(f"{n} IS NOT NULL" for n in numbers)
    each = [
        f"""SELECT m.part, CONCAT('{c}_OneHot_', v.value) AS feature, m.vectors,
       CAST(COUNT(u.part) AS DOUBLE) AS total, COUNT(u.part) AS nonzero
FROM many m CROSS JOIN (SELECT DISTINCT {c} AS value FROM parts WHERE part = 'train' AND {c} IS NOT NULL) v
LEFT JOIN usable u ON u.part = m.part AND u.{c} = v.value GROUP BY ALL"""
        for c in ("OP_CARRIER", "ORIGIN", "DEST")
    ] + [
        f"""SELECT part, '{n}' AS feature, COUNT(*) AS vectors, SUM({n}) AS total,
       COUNT(*) FILTER (WHERE {n} <> 0) AS nonzero FROM usable GROUP BY part"""
        for n in numbers
    ]
    return (
        f", {_parts('0.7')}, usable AS (SELECT * FROM parts WHERE {usable}),"
        " many AS (SELECT part, COUNT(*) AS vectors FROM usable GROUP BY part) "
        + " UNION ALL ".join(each)
    )


def _rule_scores() -> str:
    return """, guess AS (
  SELECT Labels AS label, CASE WHEN DEP_DELAY < -10 THEN 'Early' WHEN DEP_DELAY > 10 THEN 'Delay'
                               ELSE 'OnTime' END AS prediction
  FROM labelled),
classes AS (
  SELECT label, COUNT(*) AS actual, COUNT(*) FILTER (WHERE label = prediction) AS hits,
         (SELECT COUNT(*) FROM guess g WHERE g.prediction = guess.label) AS guessed
  FROM guess GROUP BY label),
rates AS (
  SELECT actual, hits, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision, hits / actual AS recall
  FROM classes)
SELECT ROUND(SUM(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END
                 * actual) / SUM(actual), 12) AS f1,
       ROUND(SUM(hits) / SUM(actual), 12) AS accuracy
FROM rates"""


def _split_counts() -> str:
    """Three lots by the first eight hex digits of a hash of seed and key."""
    low, high = (format(round(x * 16**8), "08x") for x in (0.5, 0.8))
    key = ", ".join(f"CAST({c} AS VARCHAR)" for c in ("FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME"))
    return f""", drawn AS (
  SELECT Year, substring(md5(concat_ws('|', '7', {key})), 1, 8) AS draw FROM labelled)
SELECT Year, COUNT(*) AS Number, CAST(CASE WHEN draw < '{low}' THEN 0 WHEN draw < '{high}' THEN 1 ELSE 2 END AS INTEGER) AS lot
FROM drawn GROUP BY ALL"""


def _parsed_lines() -> str:
    return """, spoilt AS (
  SELECT *, DISTANCE % 97 = 0 AS no_distance, day(FL_DATE) = 31 AS no_date FROM flights)
SELECT OP_CARRIER, COUNT(*) AS lines, COUNT(*) FILTER (WHERE no_distance OR no_date) AS malformed,
       COUNT(FL_DATE) FILTER (WHERE NOT no_date) AS dates, COUNT(ARR_DELAY) AS arrivals,
       SUM(DISTANCE) FILTER (WHERE NOT no_distance) AS distance, SUM(DEP_DELAY) AS delay,
       MAX(FL_DATE) FILTER (WHERE NOT no_date) AS latest
FROM spoilt GROUP BY OP_CARRIER"""


def oracle_sql() -> dict[str, str]:
    flight_cols = ", ".join(FLIGHT_COLUMNS)
    all_cols = FLIGHT_COLUMNS + EXTRA_COLUMNS
    pairs = (
        "SELECT Parts_of_day, OriginCity, DestinationCity, COUNT(DEP_TIME) AS OriginCount,"
        " COUNT(ARR_TIME) AS DestCount FROM enriched"
        " GROUP BY Parts_of_day, OriginCity, DestinationCity"
    )
    return {
        "enriched_flights": _with("SELECT * FROM enriched"),
        "null_percentages": _with(
            "SELECT " + ", ".join(_null_share(c) for c in all_cols) + " FROM flights"
        ),
        "flights_shape": _with(
            f"SELECT COUNT(*) AS row_count, CAST({len(all_cols)} AS INTEGER) AS column_count"
            " FROM flights"
        ),
        "drop_trailing_columns": _with(f"SELECT {flight_cols} FROM flights"),
        "null_percentages_per_year": _with(
            "SELECT CAST(year(FL_DATE) AS INTEGER) AS Year, "
            + ", ".join(_null_share(c) for c in all_cols) + " FROM flights GROUP BY 1"
        ),
        "drop_named_columns": _with(
            "SELECT " + ", ".join(c for c in all_cols if c not in ("EXTRA_1", "DISTANCE")) + " FROM flights"
        ),
        "flights_in_year": _with(f"SELECT * EXCLUDE (FL_DATE) FROM enriched WHERE Year = {ONE_YEAR}"),
        "registered_carrier_counts": _with(
            "SELECT OP_CARRIER, COUNT(*) AS Number FROM enriched GROUP BY OP_CARRIER"
        ),
        "flights_per_month_in_year": _with(
            f"SELECT Month, COUNT(*) AS Number FROM enriched WHERE Year = {ONE_YEAR} GROUP BY Month"
        ),
        "flights_per_carrier_in_year": _with(
            f"SELECT OP_CARRIER, COUNT(*) AS Number FROM enriched WHERE Year = {ONE_YEAR} GROUP BY OP_CARRIER"
        ),
        "flights_per_weekday_in_year": _with(
            f"SELECT Day_Name, COUNT(*) AS Number FROM enriched WHERE Year = {ONE_YEAR} GROUP BY Day_Name"
        ),
        "top_destination_states_in_year": _with(
            f"SELECT DestinationState, COUNT(DEP_TIME) AS Number FROM enriched WHERE Year = {ONE_YEAR}"
            " GROUP BY DestinationState ORDER BY Number DESC, DestinationState ASC NULLS FIRST LIMIT 10"
        ),
        "top_destination_states_per_year": _with(
            """
SELECT Year, DestinationState, Number FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY Year ORDER BY Number DESC, DestinationState ASC NULLS FIRST) AS place
  FROM (SELECT Year, DestinationState, COUNT(DEP_TIME) AS Number FROM enriched GROUP BY Year, DestinationState) a) r
WHERE place <= 10"""
        ),
        "single_pass_carrier_delays": _with(
            "SELECT OP_CARRIER, COUNT(DEP_TIME) AS NumberOfFlightsFlown,"
            " AVG(DEP_DELAY) AS AverageDepartureDelay, AVG(ARR_DELAY) AS AverageArrivalDelay"
            " FROM enriched GROUP BY OP_CARRIER"
            " ORDER BY NumberOfFlightsFlown DESC, OP_CARRIER ASC NULLS FIRST LIMIT 5"
        ),
        "stratified_split_counts": _with(
            f", {_parts('0.8')} SELECT Year, part, COUNT(*) AS Number FROM parts GROUP BY Year, part"
        ),
        "feature_vectors": _with(_feature_vectors()),
        "parsed_lines": _with(_parsed_lines()),
        "flights_from_files": _with(f"SELECT {flight_cols} FROM flights"),
        "stored_table": _with(
            "SELECT Year, COUNT(*) AS Number, SUM(DISTANCE) AS distance, COUNT(OriginState) AS origins"
            f" FROM enriched WHERE Year <> {ONE_YEAR} OR DISTANCE >= 1000 GROUP BY Year"
        ),
        "flights_preview": _with(
            f"SELECT {flight_cols} FROM flights ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in FLIGHT_COLUMNS)
            + " LIMIT 20"
        ),
        "flights_in_order": _with(
            f"SELECT {flight_cols}, ROW_NUMBER() OVER (ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in FLIGHT_COLUMNS)
            + ") AS position FROM flights"
        ),
        "located_by_shuffle": _with(
            "SELECT ORIGIN, DEST, OriginCity, OriginState, DestinationCity, DestinationState,"
            " COUNT(*) AS Number, SUM(DISTANCE) AS distance FROM enriched GROUP BY ALL"
        ),
        "split_counts": _with(_split_counts()),
        "vector_summary": _with(_vector_summary()),
        "classification_scores": _with(_rule_scores()),
        "union_by_name_years": _with(f"SELECT {flight_cols} FROM flights"),
        "top_origins": _with(
            "SELECT ORIGIN, COUNT(ORIGIN) AS Number FROM enriched GROUP BY ORIGIN"
            " ORDER BY Number DESC, ORIGIN ASC NULLS FIRST LIMIT 15"
        ),
        "flights_per_month": _with(
            "SELECT Year, Month, COUNT(*) AS Number FROM enriched GROUP BY Year, Month"
        ),
        "flights_per_carrier": _with(
            "SELECT Year, OP_CARRIER, COUNT(*) AS Number FROM enriched GROUP BY Year, OP_CARRIER"
        ),
        "top_destination_states": _with(
            "SELECT DestinationState, COUNT(DEP_TIME) AS Number FROM enriched"
            " GROUP BY DestinationState"
            " ORDER BY Number DESC, DestinationState ASC NULLS FIRST LIMIT 10"
        ),
        "top_states_per_year": _ranked(
            "SELECT Year, DestinationState, COUNT(DEP_TIME) AS Number FROM enriched"
            " GROUP BY Year, DestinationState",
            "Year", "Number", "Year, DestinationState, Number",
        ),
        "top_cities_in_state_per_year": _ranked(
            "SELECT Year, DestinationCity, COUNT(DEP_TIME) AS Number FROM enriched"
            f" WHERE DestinationState = '{STATE_A}' GROUP BY Year, DestinationCity",
            "Year", "Number", "Year, DestinationCity, Number",
        ),
        "two_state_comparison": _with(
            f"""
, s1 AS (SELECT Year, COUNT(DEP_TIME) AS State1 FROM enriched
         WHERE DestinationState = '{STATE_A}' GROUP BY Year),
  s2 AS (SELECT Year, COUNT(DEP_TIME) AS State2 FROM enriched
         WHERE DestinationState = '{STATE_B}' GROUP BY Year)
SELECT s1.Year, State1, State2 FROM s1 JOIN s2 ON s1.Year = s2.Year"""
        ),
        "flights_per_weekday": _with(
            "SELECT Year, Day_Name, COUNT(*) AS Number FROM enriched GROUP BY Year, Day_Name"
        ),
        "top_carriers_per_weekday": _ranked(
            "SELECT Day_Name, OP_CARRIER, Day_OfWeek, COUNT(DEP_TIME) AS Number FROM enriched"
            " GROUP BY Day_Name, OP_CARRIER, Day_OfWeek",
            "Day_Name", "Number", "Day_Name, OP_CARRIER, Day_OfWeek, Number",
        ),
        "top_carriers_per_year": _ranked(
            "SELECT Year, OP_CARRIER, COUNT(DEP_TIME) AS Number FROM enriched"
            " GROUP BY Year, OP_CARRIER",
            "Year", "Number", "Year, OP_CARRIER, Number",
        ),
        "carrier_average_delays": _with(
            "SELECT OP_CARRIER, COUNT(DEP_TIME) AS NumberOfFlightsFlown,"
            " AVG(DEP_DELAY) AS AverageDepartureDelay, AVG(ARR_DELAY) AS AverageArrivalDelay"
            " FROM enriched GROUP BY OP_CARRIER"
            " ORDER BY NumberOfFlightsFlown DESC, OP_CARRIER ASC NULLS FIRST LIMIT 5"
        ),
        "airport_departure_delay": _ranked(
            "SELECT Year, ORIGIN, COUNT(DEP_TIME) AS NumberOfFlightsFlown,"
            " AVG(DEP_DELAY) AS AverageDepartureDelay FROM enriched GROUP BY Year, ORIGIN",
            "Year", "NumberOfFlightsFlown", "Year, ORIGIN, AverageDepartureDelay",
        ),
        "airport_taxi_out": _ranked(
            "SELECT Year, ORIGIN, COUNT(DEP_TIME) AS NumberOfFlightsFlown,"
            " AVG(TAXI_OUT) AS AverageTakeOff FROM enriched GROUP BY Year, ORIGIN",
            "Year", "NumberOfFlightsFlown", "Year, ORIGIN, AverageTakeOff",
        ),
        "carrier_distance_per_year": _ranked(
            "SELECT OP_CARRIER, Year, COUNT(DEP_TIME) AS NumberOfFlightsFlown,"
            " SUM(DISTANCE) AS TotalDistanceTravelled FROM enriched GROUP BY OP_CARRIER, Year",
            "Year", "TotalDistanceTravelled", "OP_CARRIER, Year, TotalDistanceTravelled",
        ),
        "top_states_per_season": _ranked(
            "SELECT Seasons, DestinationState, COUNT(DEP_TIME) AS NumberOfFlightsFlown"
            " FROM enriched GROUP BY Seasons, DestinationState",
            "Seasons", "NumberOfFlightsFlown", "Seasons, DestinationState, NumberOfFlightsFlown",
        ),
        "parts_of_day_share": _with(
            "SELECT Parts_of_day, COUNT(*) AS Number,"
            " CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS Share"
            " FROM enriched WHERE Parts_of_day IS NOT NULL GROUP BY Parts_of_day"
        ),
        "top_origin_pairs_by_daypart": _ranked(
            pairs, "Parts_of_day", "OriginCount", "Parts_of_day, OriginCity, OriginCount"
        ),
        "top_destination_pairs_by_daypart": _ranked(
            pairs, "Parts_of_day", "DestCount", "Parts_of_day, DestinationCity, DestCount"
        ),
        "report_aggregates": _report_aggregates(),
        "flown_flights": _with("SELECT * FROM flown"),
        "without_outliers": _with("SELECT * FROM labelled"),
        "model_input": _with(
            "SELECT OP_CARRIER, ORIGIN, DEST, TAXI_OUT, WHEELS_OFF, WHEELS_ON, TAXI_IN,"
            " DEP_TIME, DEP_DELAY, Labels, Year FROM labelled"
        ),
        "label_counts": _with(
            "SELECT Labels, COUNT(*) AS Number FROM labelled GROUP BY Labels"
        ),
        "delay_box_summary": _with(
            """,
caps AS (
  SELECT v.delay,
         MIN(CASE WHEN v.value >= f.lower_fence THEN v.value END) AS low_in,
         MAX(CASE WHEN v.value <= f.upper_fence THEN v.value END) AS high_in,
         COUNT(CASE WHEN v.value < f.lower_fence THEN 1 END) AS lower_outliers,
         COUNT(CASE WHEN v.value > f.upper_fence THEN 1 END) AS upper_outliers
  FROM vals v JOIN fences f ON v.delay = f.delay GROUP BY v.delay)
SELECT f.delay, f.n_values AS count,
       CASE WHEN low_in IS NULL OR low_in > q1 THEN q1 ELSE low_in END AS minimum,
       q1, median, mean, q3,
       CASE WHEN high_in IS NULL OR high_in < q3 THEN q3 ELSE high_in END AS maximum,
       lower_fence, upper_fence, lower_outliers, upper_outliers
FROM fences f JOIN caps c ON f.delay = c.delay""",
            _DELAYS,
        ),
        "delay_outliers": _with(
            """
SELECT v.delay, CASE WHEN v.value < f.q1 THEN 'lower' ELSE 'upper' END AS side, v.value
FROM vals v JOIN fences f ON v.delay = f.delay
WHERE v.value < f.lower_fence OR v.value > f.upper_fence""",
            _DELAYS,
        ),
        "outlier_histogram": _with(
            f""",
up AS (SELECT v.delay, v.value FROM vals v JOIN fences f ON v.delay = f.delay
       WHERE v.value > f.upper_fence),
span AS (SELECT f.delay, MIN(up.value) AS lo, MAX(up.value) AS hi
         FROM fences f LEFT JOIN up ON f.delay = up.delay GROUP BY f.delay),
rng AS (
  SELECT delay,
         CASE WHEN lo IS NULL THEN 0.0E0 WHEN lo = hi THEN lo - 0.5 ELSE lo END AS first,
         CASE WHEN hi IS NULL THEN 1.0E0 WHEN lo = hi THEN hi + 0.5 ELSE hi END AS last
  FROM span),
r2 AS (SELECT delay, first, last, (last - first) / 10.0 AS step FROM rng),
bins AS (SELECT delay, first, last, step, CAST(UNNEST(range(10)) AS INTEGER) AS bin FROM r2),
binned AS (SELECT u.delay, 0{_bin_case()} AS bin FROM up u JOIN r2 r ON u.delay = r.delay)
SELECT b.delay, b.bin,
       CAST(b.bin AS DOUBLE) * b.step + b.first AS bin_start,
       CASE WHEN b.bin = 9 THEN b.last ELSE CAST(b.bin + 1 AS DOUBLE) * b.step + b.first END AS bin_end,
       COUNT(binned.delay) AS count
FROM bins b LEFT JOIN binned ON b.delay = binned.delay AND b.bin = binned.bin
GROUP BY b.delay, b.bin, b.first, b.last, b.step""",
            _DELAYS,
        ),
    }
