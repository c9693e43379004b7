"""File scans (S2, S3), parsing of lines (S2) and table registration.

CSV columns are bound by the names in each file's header. The headers are read
in one small job, a task for each file that stops after the first line; files
of the same header are then one scan, split into
``spark.sql.files.maxPartitionBytes`` chunks, and the scans are put together by
name. Yearly files of one layout are one scan, whatever their number.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolens.sources.schemas import AIRPORTS_SCHEMA, FLIGHTS_CSV_SCHEMA

#: More bytes than any file: with splits and opening costs of this size every
#: file is one unsplit partition of its own.
WHOLE_FILE = str(1 << 50)


def _declared(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(header, files): the first line of every file that has one, with the
    files that begin with it.

    The scan runs in a session of its own whose settings keep files whole and
    apart, so each task has one file and ends after its first line."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", WHOLE_FILE)
    own.conf.set("spark.sql.files.openCostInBytes", WHOLE_FILE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.text([paths] if isinstance(paths, str) else list(paths))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    heads = lines.select("value", F.col("_metadata.file_path").alias("file")).mapInArrow(first, "value string, file string")
    return heads.groupBy(F.col("value").alias("header")).agg(F.array_sort(F.collect_list("file")).alias("files"))


def _header_fields(header: str, declared: T.StructType) -> T.StructType:
    """The columns of a file in its own order; undeclared ones as strings under a
    name that no declared column has."""
    names = next(csv.reader([header.lstrip("\ufeff")]), [])
    types = {f.name: f.dataType for f in declared}
    twice = sorted({n for n in names if n in types and names.count(n) > 1})
    if twice:
        raise ValueError(f"columns stand twice in the header: {twice}")
    if not types.keys() & set(names):
        raise ValueError(f"the header has none of the declared columns: {header!r}")
    spare = (n for k in range(len(names)) if (n := f"_undeclared_{k}") not in types)
    return T.StructType([T.StructField(n if n in types else next(spare), types.get(n, T.StringType())) for n in names])


def _plain_path(uri: str) -> str:
    """A file's path as the reader takes it: decoded, glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    header: bool = True,
    malformed: str | None = None,
) -> DataFrame:
    """CSV with a declared schema, its columns bound by each file's header.

    Columns may stand in any order, a file may lack some (null there) or hold
    others (not read). A file with none of the declared columns fails, as does
    one that holds a declared column twice. Without ``header`` columns are bound
    by position. ``malformed`` names a string column that holds the text of
    lines with a value that doesn't fit its type (null for good lines); without
    it such values are null. ``paths`` may be a single path, a glob or a list
    (S3). Files without a line give no rows.
    """
    declared = _declared(schema)
    extra = [T.StructField(malformed, T.StringType())] if malformed else []

    def scan(files: str | Sequence[str], fields: T.StructType) -> DataFrame:
        reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
        return reader.schema(T.StructType([*fields, *extra])).csv([files] if isinstance(files, str) else list(files))

    if not header:
        return scan(paths, declared)
    out = None
    for row in sorted(file_headers(spark, paths).collect(), key=lambda r: r["files"][0]):
        fields = _header_fields(row["header"], declared)
        frame = scan([_plain_path(f) for f in row["files"]], fields)
        frame = frame.select(
            *(
                F.col(f"`{f.name}`") if f.name in fields.names else F.lit(None).cast(f.dataType).alias(f.name)
                for f in declared
            ),
            *(F.col(f"`{f.name}`") for f in extra),
        )
        out = frame if out is None else out.unionByName(frame)
    return spark.createDataFrame([], T.StructType([*declared, *extra])) if out is None else out


def parse_lines(
    df: DataFrame, line: str, schema: T.StructType | str, malformed: str = "_malformed", keep: Sequence[str] = ()
) -> DataFrame:
    """CSV lines that a frame holds, as columns of ``schema``, parsed in the JVM
    by the rules of the file scan; ``malformed`` has the text of lines with a
    value that doesn't fit. Columns ``keep`` stay in front. A null line gives nulls."""
    declared = _declared(schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*declared, T.StructField(malformed, T.StringType())])
    parsed = F.from_csv(line, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed})
    return df.select(*keep, parsed.alias("_parsed")).select(*keep, "_parsed.*")


def rendered_lines(df: DataFrame, columns: Sequence[str]) -> Column:
    """Rows of a frame as CSV lines, null as an empty field."""
    return F.to_csv(F.struct(*columns), {"nullValue": "", "dateFormat": "yyyy-MM-dd"})


def line_profile(frame: DataFrame, malformed: str = "_malformed") -> DataFrame:
    """One row: ``lines``, ``malformed`` ones (with a value that doesn't fit its
    type), and ``missing_<column>``, the null values of each column."""
    missing = [
        F.count(F.when(F.col(f"`{c}`").isNull(), F.lit(1))).alias(f"missing_{c}")
        for c in frame.columns
        if c != malformed
    ]
    return frame.agg(F.count(F.lit(1)).alias("lines"), F.count(F.col(f"`{malformed}`")).alias("malformed"), *missing)


def load_profile(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str
) -> DataFrame:
    """``line_profile`` of files, from one scan of each layout."""
    return line_profile(read_csv(spark, paths, schema, malformed="_malformed"))


def read_flights(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str = FLIGHTS_CSV_SCHEMA,
) -> DataFrame:
    """All yearly flight files, a scan for each layout."""
    return read_csv(spark, paths, schema)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """The airport lookup (Airport, City, State, IATA). Empty fields read as null."""
    return read_csv(spark, path, AIRPORTS_SCHEMA)


def read_parquet(
    spark: SparkSession, sf_dir: str, table: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One of the driver's parquet tables; with ``schema``, only those columns
    and no schema inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{str(sf_dir).rstrip('/')}/{table}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL (S4). Callers pick unique names; nothing here
    reuses a shared view name."""
    df.createOrReplaceTempView(name)
    return df
