"""Time the headline queries at one scale factor; prints one JSON line.

Each query runs three times in one session; its figure is the median.

BENCH_SF_DIR  folder of the driver's tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mailspark import Archive, compose, decode_mail, read_folder, register, release  # noqa: E402
from mailspark import metadata as M  # noqa: E402
from mailspark.plans import fixtures as X  # noqa: E402
from mailspark.plans.queries import QUERIES  # noqa: E402
from mailspark.session import new_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ALL_COLUMNS = ", ".join(f"`{k}` {t.simpleString()}" for k, t in M.READABLE.items())


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("mailspark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    register(spark)
    return spark


def run(frame: DataFrame) -> None:
    """Compute every column of every row and drop it."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None]) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = session()
    # One import per archive, not counted as part of the queries that read it.
    setup = {name: timed(lambda name=name: X.archive_of(spark, SF_DIR, name))
             for name in ("event_mail", "event_mail_holes", "conv_mail")}
    archive = X.archive_of(spark, SF_DIR, "event_mail")

    # mail in no order, as it comes: the import has to bring it together
    unordered = new_path(spark, "bench-mail")
    X.event_mail(spark, SF_DIR).repartition(16).write.parquet(unordered)

    def imported() -> None:
        Archive(spark, new_path(spark, "bench")).create().append(spark.read.parquet(unordered))

    def scanned(schema: str) -> None:
        run(read_folder(spark, {"archive": archive.path}, schema))

    def parsed(schema: str) -> None:
        run(decode_mail(archive.messages("INBOX").drop("envelope"), schema))

    actions: dict[str, Callable[[], None]] = {
        name: lambda query=query: run(query(spark, SF_DIR)) for name, query in QUERIES.items()
    }
    actions |= {
        "archive_import": imported,
        "scan_all_columns_and_content": lambda: scanned(f"{ALL_COLUMNS}, content string"),
        "scan_metadata_only": lambda: scanned(ALL_COLUMNS),
        "parse_all_columns_and_content": lambda: parsed(f"{ALL_COLUMNS}, content string"),
        "parse_metadata_only": lambda: parsed(ALL_COLUMNS),
        "outbox_compose": lambda: run(compose(X.order_outbox(spark, SF_DIR), {"date-column": "ordered"})),
    }
    runs = [{name: timed(action) for name, action in actions.items()} for _ in range(3)]
    warm = {name: sorted(r[name] for r in runs)[1] for name in actions}
    messages = archive.messages("INBOX").count()
    print(json.dumps({
        "metric": "total time of the headline queries, median of three runs of each",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "first_runs": runs[0],
        "setup": setup,
        "messages_per_sec": {
            name: round(messages / warm[name])
            for name in ("archive_import", "scan_all_columns_and_content", "scan_metadata_only",
                         "parse_all_columns_and_content", "parse_metadata_only")
        },
    }))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
