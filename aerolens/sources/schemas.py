"""Declared schemas.

Files are read with a declared schema instead of type inference: inference
costs one extra pass over every file and lets types drift between years.
"""

from __future__ import annotations

from pyspark.sql import types as T

D = T.DoubleType()
I = T.IntegerType()
S = T.StringType()

# Column layout of the public yearly on-time files (2009-2018),
# in file order. The last six columns (five delay causes and an unnamed
# trailing column) are mostly null and are dropped by position.
FLIGHTS_CSV_SCHEMA = T.StructType([
    T.StructField("FL_DATE", T.DateType()),
    T.StructField("OP_CARRIER", S),
    T.StructField("OP_CARRIER_FL_NUM", I),
    T.StructField("ORIGIN", S),
    T.StructField("DEST", S),
    T.StructField("CRS_DEP_TIME", I),
    T.StructField("DEP_TIME", D),
    T.StructField("DEP_DELAY", D),
    T.StructField("TAXI_OUT", D),
    T.StructField("WHEELS_OFF", D),
    T.StructField("WHEELS_ON", D),
    T.StructField("TAXI_IN", D),
    T.StructField("CRS_ARR_TIME", I),
    T.StructField("ARR_TIME", D),
    T.StructField("ARR_DELAY", D),
    T.StructField("CANCELLED", D),
    T.StructField("CANCELLATION_CODE", S),
    T.StructField("DIVERTED", D),
    T.StructField("CRS_ELAPSED_TIME", D),
    T.StructField("ACTUAL_ELAPSED_TIME", D),
    T.StructField("AIR_TIME", D),
    T.StructField("DISTANCE", D),
    T.StructField("CARRIER_DELAY", D),
    T.StructField("WEATHER_DELAY", D),
    T.StructField("NAS_DELAY", D),
    T.StructField("SECURITY_DELAY", D),
    T.StructField("LATE_AIRCRAFT_DELAY", D),
    T.StructField("Unnamed: 27", S),
])

# Layout of the flights view derived from the driver's tables: the columns the
# reports use plus six mostly-null trailing columns.
FIXTURE_FLIGHTS_SCHEMA = T.StructType([
    T.StructField("FL_DATE", T.DateType()),
    T.StructField("OP_CARRIER", S),
    T.StructField("ORIGIN", S),
    T.StructField("DEST", S),
    T.StructField("CRS_DEP_TIME", I),
    T.StructField("DEP_TIME", D),
    T.StructField("DEP_DELAY", D),
    T.StructField("TAXI_OUT", D),
    T.StructField("WHEELS_OFF", D),
    T.StructField("WHEELS_ON", D),
    T.StructField("TAXI_IN", D),
    T.StructField("ARR_TIME", D),
    T.StructField("ARR_DELAY", D),
    T.StructField("CANCELLED", D),
    T.StructField("DISTANCE", D),
    T.StructField("EXTRA_1", D),
    T.StructField("EXTRA_2", D),
    T.StructField("EXTRA_3", D),
    T.StructField("EXTRA_4", D),
    T.StructField("EXTRA_5", D),
    T.StructField("EXTRA_6", S),
])

# The airport lookup file's header.
AIRPORTS_SCHEMA = T.StructType([
    T.StructField("Airport", S),
    T.StructField("City", S),
    T.StructField("State", S),
    T.StructField("IATA", S),
])

# Number of trailing, mostly-null columns in each flights layout.
TRAILING_COLUMNS = 6

# Columns of the driver's tables that the derived views read, with their
# types. Declaring them skips Parquet schema inference (a footer-reading job
# per table and query) and reads only these columns.
LINEITEM_SOURCE_SCHEMA = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_shipdate TIMESTAMP_NTZ"
)
CUSTOMER_SOURCE_SCHEMA = "c_custkey BIGINT, c_nationkey INT"
NATION_SOURCE_SCHEMA = "n_nationkey INT, n_name STRING"
