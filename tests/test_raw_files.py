"""Raw files that the routing queries are given: as many tasks write them as read the table."""

import datetime

from pyspark.sql import functions as F

from lakestrata.queries import files, tables
from lakestrata.sources import list_files


def trips(spark, years):
    rows = [(i, datetime.datetime(y, 3, 1) if y else None) for y in years for i in range(4)]
    return spark.createDataFrame(rows, "id bigint, day timestamp").repartition(3)


def test_raw_trips_are_written_by_several_tasks(spark, monkeypatch):
    made = trips(spark, [1991, 1992, 1994, 1998, 1999, 2003, None])
    green = made.withColumnRenamed("day", "lpep_dropoff_datetime")
    yellow = made.selectExpr("id as VendorID", "day as tpep_dropoff_datetime")
    monkeypatch.setattr(tables, "green_trips", lambda *_: green)
    monkeypatch.setattr(tables, "yellow_trips", lambda *_: yellow)
    root = files._raw_trip_files(spark, "")
    found = list_files(spark, root).select("file_name").collect()
    names = sorted(r.file_name for r in found)
    for category in ("green", "yellow", "fhv"):
        own = [n for n in names if n.startswith(f"{category}_tripdata_")]
        for part in [*map(str, range(1992, 1999)), "latest"]:
            assert any(n.startswith(f"{category}_tripdata_{part}-") for n in own), part
        assert sum(n.startswith(f"{category}_tripdata_1994-") for n in own) > 1
        assert not any("1991" in n for n in own)
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "green_tripdata_*").parquet(root)
    assert rows.columns == ["id", "lpep_dropoff_datetime"]
    counted = rows.groupBy(F.year("lpep_dropoff_datetime").alias("y")).count().collect()
    assert {r.y: r["count"] for r in counted} == dict.fromkeys([1992, 1994, 1998, 1999, 2003], 4)
