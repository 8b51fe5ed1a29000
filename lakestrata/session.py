"""Session settings and the shared folder jobs may write intermediate data to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "lakestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ANSI mode stays on.

    `master` is only for local runs: on a cluster spark-submit supplies it.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder, readable by every executor, for data a job hands to its next step.

    The cluster names the shared root in `spark.checkpoint.dir`. Only a local
    session, whose executors live in this process, may do without: the folder
    then lies in its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
