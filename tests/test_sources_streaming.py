import pytest
from pyspark.sql import functions as F

from aerolens.operators.enrich import enrich
from aerolens.operators.filters import for_year
from aerolens.plans.tables import read_enriched, store_enriched
from aerolens.sources import (
    FIXTURE_FLIGHTS_SCHEMA,
    FLIGHTS_CSV_SCHEMA,
    load_airports,
    load_flights,
    read_airports,
    read_flights,
    write_report,
)
from aerolens.sources.files import file_headers, line_profile, load_profile, parse_lines, read_csv
from aerolens.streaming import enriched_stream, start_ingest
from conftest import SF_SMALL, rows


def _write_csv(df, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def test_csv_round_trip_with_declared_schema(spark, scratch):
    flights = load_flights(spark, SF_SMALL)
    _write_csv(flights, f"{scratch}/all")
    back = read_flights(spark, f"{scratch}/all", FIXTURE_FLIGHTS_SCHEMA)
    assert back.schema == FIXTURE_FLIGHTS_SCHEMA
    assert sorted(rows(back), key=str) == sorted(rows(flights), key=str)


def test_multi_file_scan_is_one_read(spark, scratch):
    flights = load_flights(spark, SF_SMALL)
    paths = []
    for year in (1995, 1996, 1997):
        p = f"{scratch}/y{year}"
        _write_csv(for_year(flights, year), p)
        paths.append(p)
    back = read_flights(spark, paths, FIXTURE_FLIGHTS_SCHEMA)
    want = flights.filter(F.year("FL_DATE").between(1995, 1997)).count()
    assert back.count() == want


def test_public_layout_schema_has_six_trailing_columns():
    names = FLIGHTS_CSV_SCHEMA.fieldNames()
    assert names[:2] == ["FL_DATE", "OP_CARRIER"] and len(names) == 28
    assert names[-6:][0] == "CARRIER_DELAY" and names[-1] == "Unnamed: 27"


def test_airport_lookup_parsing(spark, scratch):
    """A lookup file with the traits of real ones: CRLF line ends, quoted
    fields with commas, a state with a leading blank, a junk row with empty
    fields, and a replacement character in a name."""
    lines = [
        "Airport,City,State,IATA",
        "Alpha Regional Airport,Alpha,Texas,AAA",
        '"Beta, Gamma Field","Beta, Gamma",Ohio,BBB',
        "Delta Field,Delta, Utah,DDD",
        "Junk,,,",
        "Epsilon\ufffdZeta Airport,Epsilon,Georgia,EEE",
    ]
    path = f"{scratch}/airports.csv"
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write("\r\n".join(lines) + "\r\n")
    airports = read_airports(spark, path)
    got = {r.IATA: (r.City, r.State) for r in airports.collect()}
    assert got == {
        "AAA": ("Alpha", "Texas"),
        "BBB": ("Beta, Gamma", "Ohio"),
        "DDD": ("Delta", " Utah"),
        None: (None, None),
        "EEE": ("Epsilon", "Georgia"),
    }
    # CRLF line ends leave no carriage return in the join key.
    assert {r[0] for r in airports.selectExpr("length(IATA)").distinct().collect()} == {3, None}


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_columns_are_bound_by_the_header(spark, scratch):
    """Three layouts: as declared, in another order with a column more, and with
    one missing; two files share the first."""
    _write(f"{scratch}/a.csv", "Airport,City,State,IATA\nAlpha Intl,Alpha,Texas,AAA\n")
    _write(f"{scratch}/b [1].csv", "Airport,City,State,IATA\nBeta Intl,\"Beta, B\",Ohio,BBB\n")
    _write(f"{scratch}/c.csv", "IATA,Elevation,City,State,Airport\nCCC,12,Gamma,Utah,Gamma Field\nCC2,x,,Utah,\n")
    _write(f"{scratch}/d.csv", "City,IATA,Airport\nDelta,DDD,Delta Field\n")
    _write(f"{scratch}/empty.csv", "")
    got = read_airports(spark, f"{scratch}/*.csv")
    assert got.columns == ["Airport", "City", "State", "IATA"]
    assert sorted(rows(got), key=lambda r: r[3]) == [
        ("Alpha Intl", "Alpha", "Texas", "AAA"), ("Beta Intl", "Beta, B", "Ohio", "BBB"),
        (None, None, "Utah", "CC2"), ("Gamma Field", "Gamma", "Utah", "CCC"), ("Delta Field", "Delta", None, "DDD"),
    ]
    headers = file_headers(spark, f"{scratch}/*.csv").collect()
    assert sorted(len(r["files"]) for r in headers) == [1, 1, 2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3  # one for each layout


def test_yearly_files_of_several_layouts_are_read_right(spark, scratch):
    flights = load_flights(spark, SF_SMALL)
    by_year = {y: for_year(flights, y) for y in (1995, 1996, 1997)}
    names = flights.columns
    _write_csv(by_year[1995], f"{scratch}/y1995")
    _write_csv(by_year[1996].select(names[::-1]), f"{scratch}/y1996")
    _write_csv(by_year[1997].drop("EXTRA_6", "TAXI_IN").withColumn("New", F.lit(1)), f"{scratch}/y1997")
    back = read_flights(spark, f"{scratch}/y*", FIXTURE_FLIGHTS_SCHEMA)
    assert back.schema == FIXTURE_FLIGHTS_SCHEMA
    want = by_year[1995].union(by_year[1996]).union(by_year[1997].withColumn("TAXI_IN", F.lit(None).cast("double")))
    assert sorted(rows(back), key=str) == sorted(rows(want), key=str)


def test_wrong_headers_fail(spark, scratch):
    _write(f"{scratch}/other.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="none of the declared"):
        read_airports(spark, f"{scratch}/other.csv")
    _write(f"{scratch}/twice.csv", "IATA,City,IATA\nA,B,C\n")
    with pytest.raises(ValueError, match="twice"):
        read_airports(spark, f"{scratch}/twice.csv")
    _write(f"{scratch}/empty.csv", "")
    assert read_airports(spark, f"{scratch}/empty.csv").collect() == []


def test_lines_parse_like_files(spark, scratch):
    text = ["2018-01-05,1,a", "2018-99-05,2,b", ",x,", "2018-02-01,3,\"c, d\"", "2018-02-01,3,e,more", "2018-02-01"]
    schema = "FL_DATE date, N int, S string"
    _write(f"{scratch}/lines.csv", "\n".join(["FL_DATE,N,S", *text]) + "\n")
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(text)], "k int, line string")
    from_lines = parse_lines(frame, "line", schema, keep=["k"])
    assert sorted(rows(from_lines.drop("k")), key=str) == sorted(
        rows(read_csv(spark, f"{scratch}/lines.csv", schema, malformed="_malformed")), key=str
    )
    assert rows(line_profile(from_lines)) == [(6, 4, 0, 2, 2, 2)]


def test_rewriting_one_year_leaves_the_others(spark, scratch):
    import os

    def files(year):
        folder = f"{table}/Year={year}"
        return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder) if f.endswith(".parquet")}

    enriched = enrich(load_flights(spark, SF_SMALL), load_airports(spark, SF_SMALL)).repartition(7)
    table = store_enriched(enriched, f"{scratch}/enriched")
    years = sorted(r[0] for r in enriched.select("Year").distinct().collect())
    before = {y: files(y) for y in years}
    assert all(len(f) == 1 for f in before.values())  # far less than a target size each
    n = enriched.count()
    fewer = for_year(enriched, 1998).limit(10)
    store_enriched(fewer, table, replace="partitions")
    after = {y: files(y) for y in years}
    assert {y for y in years if after[y] != before[y]} == {1998}
    stored = read_enriched(spark, table)
    assert for_year(stored, 1998).count() == 10
    assert stored.count() == n - for_year(enriched, 1998).count() + 10
    store_enriched(fewer, table)
    assert read_enriched(spark, table).count() == 10


def test_malformed_values_are_counted(spark, scratch):
    path = f"{scratch}/dates.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("FL_DATE,N\n2018-01-05,1\n2018-99-05,2\n,x\n2018-02-01,3\n")
    schema = "FL_DATE date, N int"
    assert rows(load_profile(spark, path, schema)) == [(4, 2, 2, 1)]
    lines = read_csv(spark, path, schema, malformed="_bad").collect()
    assert sorted(r["_bad"] for r in lines if r["_bad"]) == [",x", "2018-99-05,2"]


def test_report_sink_writes_the_data(spark, scratch):
    df = spark.createDataFrame([(1998, 3), (1999, 4)], "Year int, Number long")
    path = write_report(df, scratch, "per_year", fmt="csv")
    assert path.endswith("report=per_year")
    back = spark.read.option("header", True).schema("Year int, Number long").csv(path)
    assert sorted(rows(back)) == [(1998, 3), (1999, 4)]
    path = write_report(df, scratch, "per_year_pq", partition_by=["Year"])
    assert sorted(rows(spark.read.parquet(path), "Year", "Number")) == [(1998, 3), (1999, 4)]


def test_stored_table_prunes_year_partitions(spark, scratch):
    enriched = enrich(load_flights(spark, SF_SMALL), load_airports(spark, SF_SMALL))
    store_enriched(enriched, f"{scratch}/enriched")
    stored = read_enriched(spark, f"{scratch}/enriched")
    one_year = for_year(stored, 1998)
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "(Year#" in plan
    assert one_year.count() == enriched.filter("Year = 1998").count()


def test_streaming_ingest_processes_each_file_once(spark, scratch):
    flights = load_flights(spark, SF_SMALL)
    airports = load_airports(spark, SF_SMALL)
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    early = flights.filter(F.year("FL_DATE") <= 1997)
    late = flights.filter(F.year("FL_DATE") > 1997)
    _write_csv(early, f"{src}/part_a")

    def run():
        stream = enriched_stream(spark, f"{src}/*", airports, FIXTURE_FLIGHTS_SCHEMA)
        q = start_ingest(stream, out, checkpoint_location=ckpt, query_name="test_ingest")
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    assert spark.read.parquet(out).count() == early.count()
    _write_csv(late, f"{src}/part_b")
    run()
    run()  # nothing new: no duplicates
    got = spark.read.parquet(out)
    want = enrich(flights, airports)
    cols = [c for c in want.columns]
    assert got.count() == want.count()
    assert sorted(rows(got.select(*cols)), key=str) == sorted(rows(want), key=str)


def test_report_run_end_to_end(spark, scratch):
    from aerolens.plans.catalog import queries
    from aerolens.plans.reporting import run_reports

    flights = load_flights(spark, SF_SMALL)
    airports = load_airports(spark, SF_SMALL)
    _write_csv(flights, f"{scratch}/flights")
    _write_csv(airports, f"{scratch}/airports")
    written = run_reports(
        spark, [f"{scratch}/flights"], f"{scratch}/airports", f"{scratch}/out",
        "NATION_5", "NATION_7", years=[1998], flights_schema=FIXTURE_FLIGHTS_SCHEMA, with_models=True, fit_partitions=2,
    )
    models = spark.read.parquet(written["model_comparison"]).collect()
    assert len(models) == 4 and all(0 < r["accuracy"] <= 1 and 0 < r["f1"] <= 1 for r in models)
    registry = queries()
    for name in ("top_states_per_year", "two_state_comparison", "delay_box_summary",
                 "top_origin_pairs_by_daypart", "label_counts", "null_percentages"):
        got = spark.read.parquet(written[name])
        want = registry[name](spark, SF_SMALL)
        assert sorted(rows(got.select(*want.columns)), key=str) == sorted(rows(want), key=str), name
    assert {r.Year for r in spark.read.parquet(written["top_destination_states_per_year"]).collect()} == {1998}


def test_report_cli_on_public_layout_files(spark, scratch, capsys):
    """The command-line run on yearly CSV files in the public 28-column layout."""
    from aerolens.plans.catalog import queries
    from aerolens.plans.reporting import main

    flights = load_flights(spark, SF_SMALL)
    full = flights.select(*[
        F.col(f.name) if f.name in flights.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in FLIGHTS_CSV_SCHEMA.fields
    ])
    for year in (1996, 1997, 1998):
        _write_csv(full.filter(F.year("FL_DATE") == year), f"{scratch}/flights/{year}")
    _write_csv(load_airports(spark, SF_SMALL), f"{scratch}/airports")
    main([
        "--flights", f"{scratch}/flights/*", "--airports", f"{scratch}/airports",
        "--out", f"{scratch}/out", "--state-a", "NATION_5", "--state-b", "NATION_7",
    ])
    written = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert len(spark.read.parquet(written["null_percentages"]).columns) == 28
    years = F.col("Year").between(1996, 1998)
    want = queries()["flights_per_month"](spark, SF_SMALL).filter(years)
    got = spark.read.parquet(written["flights_per_month"]).select(*want.columns)
    assert sorted(rows(got)) == sorted(rows(want))
