"""Folders as tables."""

from __future__ import annotations

import fakes
import pytest
from cases import message
from fakes import Server
from test_archive import archive, numbered  # noqa: F401

from mailspark import MailCatalog
from mailspark import metadata as M
from mailspark.catalog import table_names


class FakeCatalog(MailCatalog):
    source = fakes.FakeImap
    folder_source = "fake_folders"


@pytest.fixture
def server(spark, tmp_path):
    spark.dataSource.register(fakes.FakeFolders)
    return Server(str(tmp_path / "account")).create("INBOX")


def catalog(spark, server, database="folders", **options):
    return FakeCatalog(spark, {"host": str(server.place), **options}, database)


def test_empty_account_has_an_inbox(spark, server):
    assert catalog(spark, server).list_tables() == ["INBOX"]


def test_only_folders_that_hold_messages(spark, server):
    server.create("Archive", holds=False).create("Archive/2024", "Sent Mail")
    found = catalog(spark, server)
    assert found.list_tables() == ["Archive/2024", "INBOX", "Sent Mail"]
    assert found.table_exists("INBOX") and not found.table_exists("Archive") and not found.table_exists("inbox")


def test_unreachable_account_has_no_tables(spark, tmp_path, server):
    assert FakeCatalog(spark, {"host": str(tmp_path / "gone")}).table_exists("INBOX") is False


def test_a_refused_login_is_an_error(spark, server, monkeypatch):
    import imaplib

    def refuses(self):
        raise imaplib.IMAP4.error("AUTHENTICATIONFAILED")

    found = catalog(spark, server)
    monkeypatch.setattr(FakeCatalog, "folders", refuses)
    with pytest.raises(imaplib.IMAP4.error):
        found.table_exists("INBOX")


def test_many_names_at_once(spark, server):
    server.create("Sent Mail").create("Parent", holds=False)
    names = spark.createDataFrame([("INBOX", 1), ("inbox", 2), ("Sent Mail", 3), ("Parent", 4), (None, 5), ("INBOX", 6)], "name string, n int")
    found = catalog(spark, server).tables_exist(names).collect()
    assert sorted((r.n, r.found) for r in found) == [(1, True), (2, False), (3, True), (4, False), (5, False), (6, True)]


def test_one_database(spark, server):
    found = catalog(spark, server)
    assert found.list_databases() == ["folders"] and found.database_exists("folders")
    assert not found.database_exists("other")
    assert found.get_database("folders") == "One table per mail folder of the account"
    with pytest.raises(ValueError, match="'other' not found"):
        found.get_database("other")


def test_get_table(spark, server):
    schema, options = catalog(spark, server, user="jon", password="p").get_table("INBOX")
    assert schema.names == ["uid", "subject", "sent", "received", "from", "to", "cc", "bcc"]
    assert options == {"host": str(server.place), "user": "jon", "password": "p", "folder": "INBOX"}
    with pytest.raises(ValueError, match="'Nope' not found"):
        catalog(spark, server).get_table("Nope")


def test_sync(spark, server):
    server.create("Sent Mail")
    server.deliver("INBOX", message("Subject: hi", "To: a@b.c"))
    server.deliver("Sent Mail", message("Subject: there"))
    found = catalog(spark, server, "synced")
    tables = found.sync()
    assert tables == {"INBOX": "synced.inbox", "Sent Mail": "synced.sent_mail"}
    assert [(r.uid, r.subject, r.to) for r in spark.table("synced.inbox").collect()] == [(1, "hi", ["a@b.c"])]
    assert spark.sql("SELECT subject FROM synced.sent_mail").first()[0] == "there"
    state = server.read()
    del state["Sent Mail"]
    server.write(state)
    assert found.sync() == {"INBOX": "synced.inbox"}
    assert [r.tableName for r in spark.sql("SHOW TABLES IN synced").collect()] == ["inbox"]


def test_sync_leaves_other_tables_alone(spark, server):
    spark.sql("CREATE DATABASE IF NOT EXISTS shared")
    spark.sql("CREATE TABLE shared.mine USING parquet AS SELECT 1 AS x")
    found = catalog(spark, server, "shared")
    found.sync()
    assert found.sync() == {"INBOX": "shared.inbox"} and spark.table("shared.mine").first().x == 1
    server.create("mine")
    with pytest.raises(ValueError, match="shared.mine exists"):
        found.sync()
    assert spark.table("shared.mine").first().x == 1


def test_query_options_override(spark, server):
    for i in range(6):
        server.deliver("INBOX", message(f"Subject: {i}"))
    tables = catalog(spark, server, "hinted").sync()
    found = spark.sql(f"SELECT uid FROM {tables['INBOX']} WITH ('offset' = '4')").collect()
    assert sorted(r.uid for r in found) == [4, 5, 6]
    with pytest.raises(Exception, match="use spark.readStream"):
        spark.sql(f"SELECT uid FROM {tables['INBOX']} WITH ('mode' = 'new')").collect()
    stream = spark.readStream.option("mode", "new").table(tables["INBOX"])
    assert stream.isStreaming


def test_password_is_not_stored(spark, server):
    tables = catalog(spark, server, "secrets", user="jon", password="hunter2").sync()
    shown = spark.sql(f"SHOW CREATE TABLE {tables['INBOX']}").first()[0]
    described = str(spark.sql(f"DESCRIBE EXTENDED {tables['INBOX']}").collect())
    assert "hunter2" not in shown + described


def test_table_names():
    assert table_names(["INBOX", "Sent Mail", "Archive/2024"]) == {
        "INBOX": "inbox", "Sent Mail": "sent_mail", "Archive/2024": "archive_2024"}
    clashing = table_names(["a b", "a_b", "A/B"])
    assert len(set(clashing.values())) == 3 and all(v.startswith("a_b_") for v in clashing.values())


def test_archive_as_catalog(spark, archive, mail):  # noqa: F811
    archive.append(numbered(mail, 1, 4).unionByName(numbered(mail, 2, folder="Sent Mail")))
    archive.add_folder("Parent", holds_messages=False)
    found = MailCatalog(spark, {"archive": archive.path}, "archived")
    assert found.list_tables() == ["INBOX", "Sent Mail"]
    tables = found.sync()
    assert sorted(r.uid for r in spark.table(tables["INBOX"]).collect()) == [1, 4]
    native = found.table("INBOX", options={"offset": "4"})
    assert native.schema.names == M.DEFAULT_COLUMNS and [r.uid for r in native.collect()] == [4]
    assert sorted(spark.table(tables["INBOX"]).collect()) == sorted(found.table("INBOX").collect())
    assert [r.content for r in found.table("Sent Mail", "content string").collect()] == ["body 2"]
    later = spark.sql("SELECT uid FROM archived_inbox_from(2)")
    assert [r.uid for r in later.collect()] == [4]
    for frame in (spark.table(tables["INBOX"]), later):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "folder#" in plan.split("PartitionFilters")[1]


def test_views_of_an_archive_follow_its_folders(spark, archive, mail):  # noqa: F811
    archive.add_folder("Later")
    archive.append(numbered(mail, 1, folder="it's"))
    found = MailCatalog(spark, {"archive": archive.path}, "followed")
    spark.sql("CREATE DATABASE IF NOT EXISTS followed")
    spark.sql("CREATE VIEW followed.mine AS SELECT 1 AS x")
    tables = found.sync()
    assert spark.table(tables["Later"]).count() == 0 and [r.uid for r in spark.table(tables["it's"]).collect()] == [1]
    archive.append(numbered(mail, 3, folder="Later"))
    found.sync()
    assert [r.uid for r in spark.table(tables["Later"]).collect()] == [3]
    other = type(archive)(spark, archive.path + "-other").create()
    other.add_folder("x")
    assert MailCatalog(spark, {"archive": other.path}, "followed").sync() == {"x": "followed.x"}
    assert {r.viewName for r in spark.sql("SHOW VIEWS IN followed").collect() if not r.isTemporary} == {"it_s", "later", "mine", "x"}
