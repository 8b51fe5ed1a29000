"""Taxi trips: route raw files, conform each colour (silver), unite them (gold)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.operators import conform, default_nulls, unify
from lakestrata.plans.paths import require_apart
from lakestrata.sinks import write_layer
from lakestrata.sources import (
    list_files,
    read_layer,
    read_route,
    route_by_filename,
)

# File-name prefix of each trip category; the years kept of the two coloured ones.
ROUTES = {
    "fhv": "fhv_tripdata_",
    "fhvhv": "fhvhv_tripdata_",
    "green": "green_tripdata_",
    "yellow": "yellow_tripdata_",
}
SILVER_ROUTES = {"green": ROUTES["green"], "yellow": ROUTES["yellow"]}
SILVER_YEARS = (2019, 2022)

#: Bytes before compression of a silver file, and with what opening its files is worth, of a task that writes them.
SILVER_FILE_BYTES = 256 << 20

# Raw column -> silver column of each colour, in order.
YELLOW_COLUMNS = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "tpep_pickup_datetime",
    "tpep_dropoff_datetime": "tpep_dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
}
GREEN_COLUMNS = {
    "VendorID": "vendor_id",
    "lpep_pickup_datetime": "lpep_pickup_datetime",
    "lpep_dropoff_datetime": "lpep_dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
    "trip_type": "trip_type",
}

# What a null becomes in silver, and in gold by colour.
SILVER_DEFAULTS = {"rate_code_id": 1}
YELLOW_GOLD_DEFAULTS = {"passenger_count": 1, "improvement_surcharge": 0, "payment_type": 5}
GREEN_GOLD_DEFAULTS = {
    "passenger_count": 1,
    "improvement_surcharge": 0,
    "payment_type": 5,
    "trip_type": 1,
}

# The gold columns in order.
GOLD_COLUMNS = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "rate_code_id",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "payment_type",
    "trip_type",
    "taxi_type",
    "partition_date",
]


@dataclass(frozen=True)
class Silver:
    """Columns of a colour, its timestamps, and whether rows without a pickup stay."""

    columns: dict[str, str]
    pickup: str
    dropoff: str
    keep_null_pickup: bool
    gold_defaults: dict[str, int]


SILVER = {
    "yellow": Silver(
        columns=YELLOW_COLUMNS,
        pickup="tpep_pickup_datetime",
        dropoff="tpep_dropoff_datetime",
        keep_null_pickup=False,
        gold_defaults=YELLOW_GOLD_DEFAULTS,
    ),
    "green": Silver(
        columns=GREEN_COLUMNS,
        pickup="lpep_pickup_datetime",
        dropoff="lpep_dropoff_datetime",
        keep_null_pickup=True,
        gold_defaults=GREEN_GOLD_DEFAULTS,
    ),
}


def silver(raw: DataFrame, colour: str) -> DataFrame:
    """Rename, default the rate code, derive the partition date. Yellow drops null pickups."""
    spec = SILVER[colour]
    return conform(
        raw,
        spec.columns,
        defaults=SILVER_DEFAULTS,
        partition_date_from=spec.pickup,
        require_not_null=() if spec.keep_null_pickup else (spec.pickup,),
    )


def gold(silver_tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the colours in gold columns, tagged by `taxi_type`. Narrow: no shuffle."""
    branches = {}
    for colour, df in silver_tables.items():
        spec = SILVER[colour]
        named = df.withColumnsRenamed(
            {spec.pickup: "pickup_datetime", spec.dropoff: "dropoff_datetime"}
        )
        branches[colour] = default_nulls(named, spec.gold_defaults)
    return unify(branches, "taxi_type", GOLD_COLUMNS)


def route_job(
    spark: SparkSession,
    raw: str,
    target: str,
    routes: dict[str, str] = SILVER_ROUTES,
    years: tuple[int, int] | None = SILVER_YEARS,
) -> None:
    """Write the raw files of each category to `target`/`category`, rows as they are.

    A category without files is left out.
    """
    require_apart(target, raw)
    # One listing for all categories, kept while they are written.
    files = list_files(spark, raw).select("file_path", "file_name").persist()
    try:
        for category, prefix in routes.items():
            if route_by_filename(files, "file_name", prefix, years).isEmpty():
                continue
            write_layer(read_route(spark, raw, prefix, years, files=files), f"{target.rstrip('/')}/{category}")
    finally:
        files.unpersist()


def silver_job(
    spark: SparkSession,
    colour: str,
    source: str,
    target: str,
    *,
    from_raw: bool = False,
    years: tuple[int, int] | None = SILVER_YEARS,
    clustered: bool = False,
    schema: T.StructType | str | None = None,
) -> None:
    """Trips of one colour to a dataset partitioned by date.

    `source` is what `route_job` wrote, or, with `from_raw=True`, the raw files
    of all categories: the colour's files of `years` are then picked while
    reading, which saves writing the routed copy. Routed files share the schema
    that `route_job` gave them, so one footer is read; `schema` saves the footers of
    raw files.

    By default rows are shuffled by date, planned by size: a first pass over the pickups alone
    counts the rows of each date, and a date has one file until it fills several tasks, whatever the size of the
    dataset and the number of shuffle partitions. Raw files that hold few dates each may be written as they lie, without a
    shuffle, by `clustered=True`.
    """
    require_apart(target, source)
    if from_raw:
        trips = read_route(spark, source, SILVER_ROUTES[colour], years, schema=schema)
    else:
        trips = read_layer(spark, source, schema=schema)
    write_layer(
        silver(trips, colour),
        target,
        partition_by="partition_date",
        clustered=clustered,
        file_bytes=None if clustered else SILVER_FILE_BYTES,
    )


def gold_job(spark: SparkSession, silver_paths: dict[str, str], target: str) -> None:
    """Silver datasets to gold.

    Silver files hold one date each, so a scan task already has few dates and
    the write needs no shuffle.
    """
    require_apart(target, *silver_paths.values())
    table = gold({colour: read_layer(spark, path) for colour, path in silver_paths.items()})
    write_layer(table, target, partition_by="partition_date", clustered=True)
