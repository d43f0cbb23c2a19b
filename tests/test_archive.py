"""The archive: bounded scans, pruning, appends."""

from __future__ import annotations

import pytest
from cases import message
from pyspark.sql import Window, functions as F

from mailspark import Archive, decode_mail, read_folder
from mailspark.operators.numbering import number_rows
from mailspark.session import settings


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, str(tmp_path / "archive")).create()


def numbered(mail, *uids: int, folder: str = "INBOX"):
    frame = mail(*[message(f"Subject: {u}", body=f"body {u}".encode()) for u in uids])
    wanted = spark_map(uids)
    return frame.withColumn("uid", wanted[F.col("uid")]).withColumn("folder", F.lit(folder))


def spark_map(uids):
    pairs = [x for i, u in enumerate(uids) for x in (F.lit(i + 1).cast("bigint"), F.lit(u).cast("bigint"))]
    return F.create_map(*pairs)


def subjects(archive, schema="uid bigint, subject string", **options):
    rows = read_folder(archive.spark, {"archive": archive.path, **options}, schema).collect()
    return sorted(tuple(r) for r in rows)


def test_bounded_scan_has_a_frontier(archive, mail):
    archive.append(numbered(mail, 1, 2, 5))
    scan = read_folder(archive.spark, {"archive": archive.path}, "uid bigint")
    archive.append(numbered(mail, 6, 9))
    assert sorted(r.uid for r in scan.collect()) == [1, 2, 5]
    assert subjects(archive) == [(1, "1"), (2, "2"), (5, "5"), (6, "6"), (9, "9")]
    assert archive.status("INBOX") == (1, 10)


class Crash(Exception):
    pass


def dies(*_):
    raise Crash


def uids_of(archive, folder="INBOX"):
    served = archive.spark.read.format("imap").schema("uid bigint").options(archive=archive.path, folder=folder).load()
    native = sorted(r.uid for r in archive.messages(folder).select("uid").collect())
    assert sorted(r.uid for r in served.collect()) == native
    return native


@pytest.mark.parametrize("more", [(), (5,)], ids=["same mail", "with new mail"])
def test_an_append_that_dies_before_it_is_published(archive, mail, monkeypatch, more):
    """It stays invisible for good, its uids are free, and a second run gives each message once."""
    archive.append(numbered(mail, 1, 2))
    with monkeypatch.context() as patch:
        patch.setattr(archive, "_publish", dies)
        with pytest.raises(Crash):
            archive.append(numbered(mail, 3, 4))
    assert uids_of(archive) == [1, 2] and archive.status("INBOX") == (1, 3)
    archive.append(numbered(mail, 3, 4, *more))
    assert uids_of(archive) == [1, 2, 3, 4, *more]
    archive.append(numbered(mail, 1).drop("uid"), folder="INBOX")
    assert uids_of(archive) == list(range(1, 6 + len(more)))


def test_an_append_that_dies_after_it_is_published(archive, mail, monkeypatch):
    """It is there, whole; whoever writes next tells streams of it."""
    archive.append(numbered(mail, 1, 2))
    create = archive.ledger.create
    with monkeypatch.context() as patch:
        patch.setattr(archive.ledger, "create", lambda text, target: dies() if "/news/" in str(target) else create(text, target))
        with pytest.raises(Crash):
            archive.append(numbered(mail, 3, 4))
    assert uids_of(archive) == [1, 2, 3, 4] == uids_of(Archive(archive.spark, archive.path))
    assert told(archive) == [(1, 2)]
    archive.append(numbered(mail, 5))
    assert uids_of(archive) == [1, 2, 3, 4, 5] and told(archive) == [(1, 2), (3, 4), (5, 5)]


def told(archive):
    """The uid ranges that streams are told of."""
    news = archive.spark.read.schema("folder string, first bigint, last bigint").json(f"{archive.path}/news")
    return sorted((r.first, r.last) for r in news.collect())


@pytest.mark.parametrize("step", ["task", "read back", "version", "taken"])
def test_a_writer_that_dies_leaves_nothing_to_see(archive, mail, spark, monkeypatch, step):
    """At each step before its version: no reader, view, listing of parts or news knows of it, and its uids are free."""
    from mailspark import MailCatalog

    archive.append(numbered(mail, 1, 2))
    view = MailCatalog(spark, {"archive": archive.path}, f"dying_{step.replace(' ', '_')}").sync()["INBOX"]
    rows = numbered(mail, 3, 4)
    if step == "task":  # one task has committed its files, the other fails
        rows = rows.repartition(2, "uid").withColumn("internal_date", F.when(F.col("uid") < 4, F.col("internal_date")).otherwise(F.raise_error(F.lit("dead"))))
    with monkeypatch.context() as patch:
        if step == "read back":
            patch.setattr(Archive, "_publish", dies)
        elif step == "version":
            patch.setattr(archive.ledger, "_name", dies)
        elif step == "taken":
            patch.setattr(archive.ledger, "write", dies)
        with pytest.raises(Exception, match="dead" if step == "task" else None):
            archive.append(rows, clustered=True)
    assert uids_of(archive) == [1, 2] == sorted(r.uid for r in spark.table(view).collect()) and told(archive) == [(1, 2)]
    archive.append(numbered(mail, 3))
    assert uids_of(archive) == [1, 2, 3] == sorted(r.uid for r in spark.table(view).collect())
    assert archive.vacuum(grace=86_400) == 0 and archive.vacuum(grace=-60) == 1
    assert uids_of(archive) == [1, 2, 3]


def test_an_append_moves_nothing(archive, mail, monkeypatch):
    """Files keep the names their tasks gave them; the driver's work does not grow with their number."""
    renamed = []
    monkeypatch.setattr(archive.ledger, "_name", lambda draft, target, plain=archive.ledger._name: (renamed.append(str(target)), plain(draft, target))[1])
    archive.append(numbered(mail, *range(1, 41)).repartition(8), clustered=True)
    files = archive._stored(archive._places(archive.state())).select(F.input_file_name()).distinct().count()
    assert files == 8 and [n.split("/")[-2] for n in renamed] == ["ledger", "news"]


def test_parts_are_chosen_by_uid(archive, mail):
    for uid in range(1, 10, 2):
        archive.append(numbered(mail, uid, uid + 1))
    assert [(p.first, p.last, p.rows) for p in archive.state().parts_of("INBOX", 4, 7)] == [(3, 4, 2), (5, 6, 2), (7, 8, 2)]
    files = archive.messages("INBOX", 8).inputFiles()
    assert len(files) == 2 and subjects(archive, offset="8") == [(8, "8"), (9, "9"), (10, "10")]


# -- compaction -----------------------------------------------------------------------------------


def test_many_small_appends_end_in_a_few_files(archive, mail):
    """Every so often while they come in, as one would; what has been rewritten is not rewritten each time."""
    written = 0
    for i in range(3):
        first = archive.state().folders["INBOX"].uid_next if i else 1
        for uid in range(first, first + 4):
            archive.append(numbered(mail, uid), clustered=True)
        written += archive.compact(neighbours=4)
    archive.compact(neighbours=2)
    assert uids_of(archive) == list(range(1, 13)) and archive.compact(neighbours=2) == 0
    assert len(archive.messages("INBOX").inputFiles()) == 1
    assert written < 3 * 12
    assert archive.vacuum(grace=-60) >= 12
    assert uids_of(archive) == list(range(1, 13)) and archive.state().replaced == []
    listed = archive.ledger.files.listStatus(archive._path("messages"))
    assert len(listed) == 2 == len({s.getPath().getName() for s in listed} | {"append=none"})


def test_compaction_of_many_folders_is_one_job_and_leaves_large_parts(archive, mail):
    for f in ("a", "b/c"):
        for uid in (1, 3, 5):
            archive.append(numbered(mail, uid, uid + 1, folder=f))
    archive.append(numbered(mail, 7, folder="alone"))
    large = archive.state().parts["a"][1].bytes
    assert archive.compact(small=large, neighbours=2) in (0, 6)  # parts of one size: all are large, or none is
    assert archive.compact(neighbours=2) in (0, 6)
    assert [(p.first, p.last, p.rows) for p in archive.state().parts["b/c"]] == [(1, 6, 6)]
    assert uids_of(archive, "a") == uids_of(archive, "b/c") == [1, 2, 3, 4, 5, 6] and uids_of(archive, "alone") == [7]
    found = decode_mail(archive.messages(), "uid bigint", keep=["folder"]).collect()
    assert sorted((r.folder, r.uid) for r in found) == [(f, u) for f in ("a", "alone", "b/c") for u in ([7] if f == "alone" else range(1, 7))]
    archive.append(numbered(mail, 7, folder="a"))
    assert uids_of(archive, "a") == list(range(1, 8))


def test_runs_that_are_rewritten():
    from mailspark.sources.archive import _run
    from mailspark.sources.ledger import Part

    parts = [Part(str(i), i, i, 1, size) for i, size in enumerate([5, 5, 100, 5, 5, 5, 100, 60, 60])]
    assert [p.append for p in _run(parts, 100, 3)] == ["3", "4", "5"]
    assert [p.append for p in _run(parts, 100, 4)] == ["7", "8"]  # few, but a whole part together
    assert _run(parts, 50, 4) == [] == _run([], 50, 2) == _run(parts[:1], 50, 1)


def test_scans_and_streams_go_on_while_parts_are_exchanged(archive, mail, spark, tmp_path):
    """Each gives every uid once, whether it was planned before, between or after."""
    from concurrent.futures import ThreadPoolExecutor

    from mailspark import MailCatalog, stream_folder

    for uid in range(1, 7):
        archive.append(numbered(mail, uid))
    view = MailCatalog(spark, {"archive": archive.path}, "exchanged").sync()["INBOX"]
    before, served = archive.messages("INBOX").select("uid"), spark.read.format("imap").schema("uid bigint").options(archive=archive.path).load()
    seen = []

    def drain():
        stream = stream_folder(archive, "uid bigint", str(tmp_path / "cp"), {"max-files": "1"})
        sink = stream.writeStream.foreachBatch(lambda rows, _: seen.extend(r.uid for r in rows.collect()))
        sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    with ThreadPoolExecutor(2) as pool:
        streaming = pool.submit(drain)
        assert archive.compact(neighbours=2) == 6
        for uid in (7, 8):
            archive.append(numbered(mail, uid))
        streaming.result()
    assert archive.compact(neighbours=2) == 3
    drain()
    assert sorted(seen) == list(range(1, 9))
    assert sorted(r.uid for r in before.collect()) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.uid for r in served.collect()) == uids_of(archive) == list(range(1, 9))
    assert sorted(r.uid for r in spark.table(view).collect()) == list(range(1, 9))


def test_a_compaction_that_comes_second_or_dies_changes_nothing(archive, mail, monkeypatch):
    for uid in range(1, 5):
        archive.append(numbered(mail, uid))
    with monkeypatch.context() as patch:
        patch.setattr(archive, "_exchange", dies)
        with pytest.raises(Crash):
            archive.compact(neighbours=2)
    assert uids_of(archive) == [1, 2, 3, 4] and len(archive.state().parts["INBOX"]) == 4
    first = Archive(archive.spark, archive.path)
    with monkeypatch.context() as patch:
        written = archive._written
        patch.setattr(archive, "_written", lambda *a: (first.compact(neighbours=2), written(*a))[1])
        assert archive.compact(neighbours=2) == 0
    assert uids_of(archive) == [1, 2, 3, 4] and len(archive.state().parts["INBOX"]) == 1
    assert archive.vacuum(grace=-60) == 5 and uids_of(archive) == [1, 2, 3, 4]  # four replaced, one abandoned


def test_appends_at_the_same_time(archive, mail):
    """Numbers are given once, without gaps; messages with uids of their own do not slip under others."""
    from concurrent.futures import ThreadPoolExecutor

    batches = [numbered(mail, *range(1, 11)).drop("uid").repartition(3) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: archive.append(b, folder="INBOX"), batches))
    assert uids_of(archive) == list(range(1, 41)) and archive.status("INBOX") == (1, 41)
    with pytest.raises(ValueError, match="not past the frontier"):
        archive.append(numbered(mail, 40, 41))
    assert uids_of(archive) == list(range(1, 41))


def test_a_batch_is_added_once(archive, mail):
    rows = numbered(mail, 1, 2, 3).drop("uid")
    for number in (0, 0, 1, 0, 1):
        archive.append(rows, folder="INBOX", batch=("stream", number))
    archive.append(rows, folder="INBOX", batch=("other", 0))
    assert uids_of(archive) == list(range(1, 10))


def test_the_ledger_stays_small(archive, monkeypatch):
    monkeypatch.setattr("mailspark.sources.ledger.KEPT_VERSIONS", 3)
    for i in range(8):
        archive.add_folder(f"f{i}")
    assert sorted(archive.state().folders) == [f"f{i}" for i in range(8)]
    assert len(archive.ledger._names()) <= 5


def test_a_message_without_a_folder_is_refused(archive, mail):
    rows = numbered(mail, 1, 2).withColumn("folder", F.when(F.col("uid") == 1, "INBOX"))
    with pytest.raises(ValueError, match="without folder"):
        archive.append(rows)
    assert archive.folders().count() == 0


def test_offset(archive, mail):
    archive.append(numbered(mail, 1, 2, 5))
    assert subjects(archive, offset="2") == [(2, "2"), (5, "5")]
    assert subjects(archive, offset="6") == [] == subjects(archive, offset="600")


def test_empty_folder_and_missing_folder(archive, mail):
    archive.add_folder("Empty")
    assert subjects(archive, folder="Empty") == []
    with pytest.raises(ValueError, match="'Nowhere' not found"):
        subjects(archive, folder="Nowhere")


@pytest.mark.parametrize("folder", ["2024", "Archive/2024", "Sent Mail", "a=b%c", "ünï", "x!", "it's"])
def test_folder_names(archive, mail, folder):
    archive.append(numbered(mail, 1, 2, folder=folder))
    archive.append(numbered(mail, 1, folder="other"))
    assert subjects(archive, folder=folder) == [(1, "1"), (2, "2")]
    served = archive.spark.read.format("imap").schema("uid bigint, subject string").options(
        archive=archive.path, folder=folder).load()
    assert sorted(tuple(r) for r in served.collect()) == [(1, "1"), (2, "2")]


def test_all_folders_at_their_frontiers(archive, mail):
    archive.append(numbered(mail, 1, 2).unionByName(numbered(mail, 7, folder="b")))
    found = decode_mail(archive.messages(), "uid bigint", keep=["folder"]).collect()
    assert sorted(tuple(r) for r in found) == [("INBOX", 1), ("INBOX", 2), ("b", 7)]


def test_uidvalidity(archive, mail):
    archive.append(numbered(mail, 1), folder="INBOX", uidvalidity=7)
    archive.append(numbered(mail, 2), folder="INBOX", uidvalidity=7)
    assert archive.status("INBOX") == (7, 3)
    with pytest.raises(ValueError, match="changed from 7 to 8"):
        archive.append(numbered(mail, 3), folder="INBOX", uidvalidity=8)
    with pytest.raises(ValueError, match="one folder"):
        archive.append(numbered(mail, 3), uidvalidity=8)


def test_uids_are_given_when_missing(archive, mail):
    for _ in range(2):
        archive.append(numbered(mail, 1, 2, 3).drop("uid").repartition(3), folder="INBOX")
    assert [uid for uid, _ in subjects(archive)] == [1, 2, 3, 4, 5, 6] and archive.status("INBOX") == (1, 7)


def test_append_of_nothing(archive, mail):
    archive.append(numbered(mail, 1).where("false"))
    assert archive.folders().count() == 0


def test_bytes_survive(archive, mail):
    raw = b"Subject: \xff\r\n\r\n\x00\xfe\r\n"
    archive.append(mail(raw))
    row = archive.messages("INBOX").first()
    assert bytes(row.head) + bytes(row.body) == raw and row.size == len(raw)


def test_scan_prunes_folder_uids_and_columns(archive, mail):
    archive.append(numbered(mail, 1, 2, 5))
    text = plan(read_folder(archive.spark, {"archive": archive.path, "offset": "2"}, "uid bigint, seen boolean"))
    assert "PartitionFilters: [isnotnull(folder" in text
    assert "GreaterThanOrEqual(uid,2)" in text and "LessThan(uid,6)" in text
    assert "ReadSchema: struct<uid:bigint,flags:array<string>>" in text
    headed = plan(read_folder(archive.spark, {"archive": archive.path}, "subject string, fromFirst string"))
    assert "ReadSchema: struct<uid:bigint,envelope:struct<subject:string,from:array<string>>>" in headed
    assert "Exchange" not in headed and "Python" not in headed and "regexp" not in headed
    content = plan(read_folder(archive.spark, {"archive": archive.path}, "content string"))
    assert "ReadSchema: struct<uid:bigint,body:binary,envelope:struct<type:string,encoding:string>>" in content


def test_unused_columns_are_not_decoded(archive, mail):
    archive.append(numbered(mail, 1))
    folder = read_folder(archive.spark, {"archive": archive.path}, "uid bigint, subject string, content string")
    text = plan(folder.select("uid"))
    assert "ReadSchema: struct<uid:bigint>" in text


def test_filters_reach_the_scan(archive, mail):
    archive.append(numbered(mail, 1))
    columns = "uid bigint, received timestamp, sent timestamp, subject string"
    folder = read_folder(archive.spark, {"archive": archive.path}, columns)
    text = plan(folder.where("uid > 3 and received >= '2024-01-01' and sent < '2025-01-01' and subject = 'x'"))
    for bound in ("GreaterThan(uid,3)", "GreaterThanOrEqual(internal_date,", "LessThan(envelope.sent,",
                  "EqualTo(envelope.subject,x)"):
        assert bound in text


def test_import_is_one_shuffle_of_even_parts(archive, mail, monkeypatch):
    """No sampling pass, and no shuffle at all for rows that lie in order already."""
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, **o: (plans.append(plan(self._df)), write(self, path, **o))[1])
    archive.append(numbered(mail, 1, 2), clustered=True)
    archive.append(numbered(mail, 3, 4))
    found = archive.messages("INBOX").select("uid", "envelope.subject").collect()
    assert sorted(tuple(r) for r in found) == [(1, "1"), (2, "2"), (3, "3"), (4, "4")]
    assert [p.count("Exchange ") for p in plans] == [0, 1]
    assert "REBALANCE" in plans[1] and "rangepartitioning" not in plans[1]


def test_a_scan_of_all_folders_does_not_shuffle_messages(archive, mail):
    archive.append(numbered(mail, 1, 2).unionByName(numbered(mail, 7, folder="b")))
    text = plan(archive.messages())
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_import_spreads_a_hot_folder(archive, spark, monkeypatch):
    hot = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("folder"),
        F.col("id").alias("uid"),
        F.current_timestamp().alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        F.concat(F.lit("Subject: "), F.col("id"), F.lit("\r\n\r\n")).cast("binary").alias("raw"),
    )
    monkeypatch.setattr("mailspark.sources.archive.UID_BUCKET", 1000)
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        archive.append(hot)
    rows = spark.read.parquet(f"{archive.messages_path}/append=*/folder=hot").select(F.input_file_name().alias("f"), "uid")
    files = rows.groupBy(F.floor(F.col("uid") / 1000).alias("b")).agg(F.collect_set("f").alias("f")).collect()
    assert all(len(r.f) == 1 for r in files) and len({r.f[0] for r in files}) > 1
    in_file = rows.withColumn("place", F.monotonically_increasing_id())
    before = F.lag("uid").over(Window.partitionBy("f").orderBy("place"))
    assert in_file.withColumn("before", before).where("before > uid").count() == 0


def test_reads_of_an_archive_hold_a_bounded_number_of_messages(archive, mail, monkeypatch):
    from mailspark.options import IMAP_SPEC, MailOptions
    from mailspark.sources import transport

    archive.append(numbered(mail, *range(1, 21)).coalesce(1), folder="INBOX", clustered=True)
    reader = transport.ArchiveTransport(MailOptions.parse({"archive": archive.path, "batch-size": "100000"}, IMAP_SPEC, substitute="archive"))
    (split,) = reader.splits("INBOX", 1, 21)
    for rows, size, most in ((6, 16 << 20, 6), (4096, 1, 1)):
        monkeypatch.setattr(transport, "PAGE_ROWS", rows)
        monkeypatch.setattr(transport, "PAGE_BYTES", size)
        found = list(reader._batches(split.files, 3, 19, ["head", "uid"]))
        assert max(b.num_rows for b in found) == most and found[0].schema.names == ["head", "uid"]
        assert [u for b in found for u in b.column("uid").to_pylist()] == list(range(3, 19))
        assert [m["uid"] for m in reader.fetch("INBOX", transport.Split(5, 8, split.files), ["head"])] == [5, 6, 7]
        assert sum(b.num_rows for b in reader.read_range("INBOX", 2, 9, ["folder", "uid"])) == 8


def test_mail_of_one_folder_is_not_sorted_by_folder(archive, mail, spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    sorted_by = []
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *names: sorted_by.append(names) or self)
    archive.append(numbered(mail, 1, 2), folder="A=b", clustered=True)
    archive.append(numbered(mail, 1, 2).drop("uid"), folder="A=b")
    monkeypatch.undo()
    assert not sorted_by and [r.uid for r in archive.messages("A=b").orderBy("uid").collect()] == [1, 2, 3, 4]
    assert {r.folder for r in archive.messages().collect()} == {"A=b"}


def test_rows_are_spread_before_they_are_composed(spark, tmp_path, monkeypatch):
    from mailspark.operators import outbox

    plans, compose = [], outbox.compose
    monkeypatch.setattr(outbox, "compose", lambda rows, options: plans.append(rows._jdf.queryExecution().analyzed().toString()) or compose(rows, options))
    archive = Archive(spark, str(tmp_path / "spool")).create()
    rows = spark.createDataFrame([(f"s{i}", ["a@b.test"]) for i in range(50)], "subject string, to array<string>").coalesce(1)
    outbox.send(rows, {"spool": archive.path})
    assert plans[0].startswith("RebalancePartitions")
    found = read_folder(spark, {"archive": archive.path, "folder": "OUTBOX"}, "uid bigint, subject string").collect()
    assert sorted(r.uid for r in found) == list(range(1, 51)) and {r.subject for r in found} == {f"s{i}" for i in range(50)}


def test_number_rows_equals_row_number(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 5 < 3, "hot").when(F.col("id") % 5 < 4, F.concat(F.lit("k"), F.col("id") % 7)).alias("g"),
        (F.col("id") * 7919 % 3001).alias("o"),
    )
    found = number_rows(rows, "g", ["o"], str(tmp_path / "staged"), "n")
    expected = rows.selectExpr("g", "o", "cast(row_number() over (partition by g order by o) as bigint) n")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_staged_tables_are_released(spark, monkeypatch):
    from mailspark import release, session

    monkeypatch.setattr(session, "_made", {})
    path = session.new_path(spark, "staged")
    rows = number_rows(spark.range(10).withColumn("g", F.lit("a")), "g", ["id"], path)
    assert rows.count() == 10 and release(spark) == 1
    with pytest.raises(Exception, match="does not exist"):
        spark.read.parquet(path)
