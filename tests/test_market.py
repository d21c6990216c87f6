from datetime import date, datetime, timedelta

from support import rows
from pyspark.sql import functions as F, types as T

from lodestock.operators import audit, contract
from lodestock.plans import market
from lodestock.plans.refresh import last_load_time, refresh_from_sheet

DAY = date(2022, 5, 1)


def sheet(spark, ddl, *data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "row_pos int, " + ddl)


def test_sections_to_rows(spark):
    df = sheet(
        spark, "First_Col string, `Q1-21` string, `Q2-21` string, other string",
        ("Demand", None, None, None), ("PC", "1", "2", "z"), ("Total", "1", "2", None), ("note", "9", "9", None),
        ("Demand", None, None, None), ("Phone", "x", "4", None), ("Total", "0", "0", None),
    )
    out = market.section_measures(df, "First_Col", "Demand", "demand", DAY, False, section_names={1: "segment", 2: "region"})
    assert rows(out.select("type", "row_item", "period", "demand"), "row_item", "period") == [
        ("segment", "PC", "2021-Q01", 1e6), ("segment", "PC", "2021-Q02", 2e6),
        ("region", "Phone", "2021-Q01", None), ("region", "Phone", "2021-Q02", 4e6),
    ]


def test_process_mix(spark):
    df = sheet(
        spark, "First_Col string, `Q1-21` string",
        ("wafers", None), ("1x", "0.4"), ("1y", "0.6"), ("node", "17"), ("bits", None), ("1x", "0.3"), ("1y", "0.7"),
    )
    out = market.process_mix(df, "First_Col", "wafers", "bits", "node", DAY)
    assert rows(out.drop("upload_dt"), "process") == [("1x", "2021-Q01", 0.4, 0.3), ("1y", "2021-Q01", 0.6, 0.7)]


def test_price_table(spark):
    df = sheet(
        spark, "Year string, Month string, `8GB DDR4 SO/DIMM 1Gx8|High` string, blank string",
        ("2021", "Jan", "30.5", None), (None, "Feb", "31", None), (None, "1H", "9", None), ("2022", "Jan", "n", None),
        ("source: x", None, "1", None), (None, None, "2", None), (None, None, "3", None),
    )
    out = market.price_table(df, "Year", "Month", "S", DAY)
    got = rows(out.select("memory_full", "memory_tech", "memory_tech2", "density_gb", "width", "price_type", "forecast_dt", "price"), "forecast_dt")
    name = ("8GB DDR4 SODIMM 1Gx8", "DDR4", "SODIMM", 8.0, "x8", "High")
    assert got == [(*name, date(2021, 1, 1), 30.5), (*name, date(2021, 2, 1), 31.0), (*name, date(2022, 1, 1), None)]


def test_sheets_of_two_files(spark):
    """Two sheets in one frame give what each gives alone."""
    ddl = "Year string, Month string, `8GB DDR4 SO/DIMM 1Gx8|High` string, `4GB DDR3 SO/DIMM 1Gx8|Low` string"
    short = [("2021", "Jan", "1", None), (None, "Feb", "2", None), (None, "x", None, None)]
    long = [("2019", "Mar", None, "5"), (None, "Apr", None, "6"), (None, "May", None, "7"), ("note", None, None, "8")]
    alone = [market.price_table(sheet(spark, ddl, *d), "Year", "Month", "S", DAY, 1) for d in (short, long)]
    both = sheet(spark, ddl, *short).withColumn("file", F.lit("s")).unionByName(sheet(spark, ddl, *long).withColumn("file", F.lit("l")))
    out = market.price_table(both, "Year", "Month", "S", DAY, 1, by=["file"])
    for file, one in zip("sl", alone, strict=True):
        assert rows(out.filter(F.col("file") == file).drop("file"), "forecast_dt") == rows(one, "forecast_dt")
    assert out.count() == 5


def test_refresh_life_cycle(spark, tmp_path):
    source, path, log = (str(tmp_path / n) for n in ("in.csv", "table", "log"))
    (tmp_path / "in.csv").write_text("id,name\n1,a\n2,\n")
    target = T.StructType([T.StructField("Id", T.IntegerType()), contract.text_field("Name", 3)])
    refresh = lambda last, change=lambda d: d.select("id", "name"), when=datetime(2024, 1, 1): refresh_from_sheet(
        spark, source, change, target, path, log, "p", "job.py", "area", last, entry_date=when
    )
    assert refresh(None) == "loaded"
    assert rows(spark.read.schema(target).parquet(path), "Id") == [(1, "a"), (2, None)]
    assert last_load_time(spark, log, "p", "area") == datetime(2024, 1, 1)
    assert refresh(datetime.now() + timedelta(days=2)) == "skipped"
    assert refresh(None, lambda d: d.select("id", F.lit("too long"))) == "failed"
    assert rows(spark.read.schema(target).parquet(path), "Id") == [(1, "a"), (2, None)]
    kinds = [r.log_type for r in spark.read.schema(audit.AUDIT_SCHEMA).parquet(log).collect()]
    assert sorted(kinds) == ["E", "I", "W"]
