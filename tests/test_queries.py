"""Every query against its SQL, and the plans they run by."""

from __future__ import annotations

import check_oracles
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from mailspark.plans import fixtures as X
from mailspark.plans import queries as Q
from mailspark.plans.oracles import ORACLES
from mailspark.session import new_path, settings
from mailspark.sources.archive import Archive

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check_oracles.duck(SF)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, database, name):
    assert check_oracles.compare(spark, database, name, SF) is None


def test_every_query_has_its_sql():
    assert Q.QUERIES.keys() == ORACLES.keys()
    assert Q.QUERIES.keys() <= entry_points.queries().keys() and ORACLES.keys() <= entry_points.oracle_sql().keys()


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["subject", "fromFirst", "toFirst", "content"] and frame.count() == 1000


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_projection_reads_no_body(spark):
    text = plan(Q.projection_no_content(spark, SF))
    assert "body" not in text and "Exchange" not in text
    assert "ReadSchema: struct<uid:bigint,flags:array<string>,envelope:struct<subject:string>>" in text


@pytest.mark.parametrize("name", ["inbox", "meta_addresses", "content_base64_utf8", "outbox_envelope", "scan_current",
                                  "catalog_table", "catalog_hint", "catalog_view", "scan_all_folders"])
def test_no_python_in_the_plan(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    assert "Python" not in text and "Arrow" not in text


def test_archive_files_hold_ranges_of_uids(spark):
    """So bounds on the uid skip files."""
    archive = Archive(spark, new_path(spark, "ranges")).create()
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        archive.append(X.event_mail(spark, SF), clustered=True)
    files = archive.messages("INBOX").groupBy(F.input_file_name()).agg(F.min("uid"), F.max("uid")).collect()
    ranges = sorted((r[1], r[2]) for r in files)
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_session_time_zone_does_not_matter(spark, database):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("meta_envelope", "catalog_table"):
            assert check_oracles.compare(spark, database, name, SF) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
