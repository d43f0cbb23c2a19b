from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
for place in (ROOT, ROOT / "tests"):
    if str(place) not in sys.path:
        sys.path.insert(0, str(place))

import fakes  # noqa: E402

# the fakes run in Python workers, which cannot import this folder
cloudpickle.register_pickle_by_value(fakes)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import mailspark

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    mailspark.register(session)
    yield session
    mailspark.release(session)
    session.stop()


@pytest.fixture
def mail(spark):
    """Make messages in the archive schema from raw bytes."""
    from datetime import datetime, timezone

    schema = "folder string, uid bigint, internal_date timestamp, flags array<string>, raw binary"

    def make(*raws: bytes, flags: tuple[str, ...] = ()):
        date = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
        rows = [("INBOX", i + 1, date, list(flags), bytearray(raw)) for i, raw in enumerate(raws)]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def decode(mail):
    """Decode raw messages into rows, in uid order."""
    from mailspark import decode_mail

    def run(schema: str, *raws: bytes, flags: tuple[str, ...] = (), **options):
        rows = decode_mail(mail(*raws, flags=flags), schema, keep=["uid"], **options).collect()
        return [row[1:] for row in sorted(rows, key=lambda r: r[0])]

    return run
