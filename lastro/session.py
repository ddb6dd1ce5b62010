"""A local session for tests and benchmarks; clusters bring their own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "lastro", memory: str = "8g",
                  **conf: str) -> SparkSession:
    """``local[cpus]`` session with its warehouse and stages in a fresh folder.

    ``cpus`` may be "cores,attempts" to let failed tasks be tried again.

    Keyword settings use ``__`` for the dots of a Spark key.
    """
    home = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cpus) if str(cpus).isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.warehouse.dir": f"{home}/warehouse",
        "spark.checkpoint.dir": f"{home}/shared",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
