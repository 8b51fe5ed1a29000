from lakestrata.plans.bank import (
    BANK_SOURCES,
    BankSource,
    clean_source,
    clean_source_job,
    delivery_table,
    delivery_table_job,
    suite_for,
)
from lakestrata.plans.delivery import deliver_files_job, deliver_job, export_jdbc_job
from lakestrata.plans.landing import land_new_job, read_landed
from lakestrata.plans.taxi import (
    GOLD_COLUMNS,
    ROUTES,
    SILVER,
    SILVER_ROUTES,
    SILVER_YEARS,
    gold,
    gold_job,
    route_job,
    silver,
    silver_job,
)

__all__ = [
    "BANK_SOURCES",
    "BankSource",
    "GOLD_COLUMNS",
    "ROUTES",
    "SILVER",
    "SILVER_ROUTES",
    "SILVER_YEARS",
    "clean_source",
    "clean_source_job",
    "deliver_files_job",
    "deliver_job",
    "delivery_table",
    "delivery_table_job",
    "export_jdbc_job",
    "gold",
    "gold_job",
    "land_new_job",
    "read_landed",
    "route_job",
    "silver",
    "silver_job",
    "suite_for",
]
