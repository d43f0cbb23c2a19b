"""Live folders: data source, options, transport."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import fakes
import pytest
from cases import message
from fakes import Server

import mailspark
from mailspark import create_table, read_folder
from mailspark.options import CATALOG_SPEC, IMAP_SPEC, SMTP_SPEC, MailOptions, boolean, duration
from mailspark.sources import transport as T
from mailspark.sources.imap import ImapDataSource


@pytest.fixture
def server(spark, tmp_path):
    spark.dataSource.register(fakes.FakeImap)
    return Server(str(tmp_path / "account")).create("INBOX")


def fill(server, *uids: int) -> None:
    for uid in uids:
        raw = message(f"Subject: s{uid}", "From: sender@mail.test", "To: Ingo <ingo@mail.test>", body=b"Message Content")
        server.deliver("INBOX", raw, ("\\Seen",) if uid % 2 else (), uid)


def load(spark, server, schema, **options):
    reader = spark.read.format("fake_imap").option("host", str(server.place)).schema(schema)
    return reader.options(**{k.replace("_", "-"): v for k, v in options.items()}).load()


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_inbox(spark, server):
    server.deliver("INBOX", message("Subject: Subject", "From: sender@mail.test", "To: ingo@mail.test", body=b"Message Content"))
    found = load(spark, server, "subject string, fromFirst string, toFirst string, content string", user="ingo", password="123")
    assert rows(found) == [("Subject", "sender@mail.test", "ingo@mail.test", "Message Content")]
    assert server.logged("login") == ["login ingo 123"] * len(server.logged("login"))


def test_current_reads_to_the_frontier_and_skips_holes(spark, server):
    fill(server, 1, 2, 5, 9)
    assert rows(load(spark, server, "uid bigint", mode="current")) == [(1,), (2,), (5,), (9,)]
    assert rows(load(spark, server, "uid bigint", offset="5")) == [(5,), (9,)]
    assert rows(load(spark, server, "uid bigint", offset="10")) == []
    assert rows(load(spark, server, "uid bigint", offset="500")) == []


def test_empty_folder(spark, server):
    assert rows(load(spark, server, "uid bigint")) == []


def test_parallel_splits_of_whole_pages(spark, server):
    fill(server, *range(1, 26))
    found = load(spark, server, "uid bigint", batch_size="5", max_connections="3")
    assert found.rdd.getNumPartitions() == 3
    assert [r[0] for r in rows(found)] == list(range(1, 26))
    splits = {tuple(line.split()[1:3]) for line in server.logged("fetch")}
    assert splits == {("1", "11"), ("11", "21"), ("21", "26")}


def test_uid_bounds_are_pushed(spark, server):
    fill(server, *range(1, 26))
    found = load(spark, server, "uid bigint, subject string").where("uid > 3 and uid <= 7 and subject <> 's5'")
    assert rows(found) == [(4, "s4"), (6, "s6"), (7, "s7")]
    assert {tuple(line.split()[1:3]) for line in server.logged("fetch")} == {("4", "8")}


def test_only_needed_items_are_fetched(spark, server):
    fill(server, 1)
    for schema, items in [
        ("uid bigint", "UID"),
        ("uid bigint, received timestamp", "UID INTERNALDATE"),
        ("sizeInBytes int", "UID RFC822.SIZE"),
        ("seen boolean", "UID FLAGS"),
        ("subject string", "UID BODY.PEEK[HEADER]"),
        ("content string", "UID BODY.PEEK[]"),
    ]:
        load(spark, server, schema).collect()
        assert server.logged("fetch")[-1].split(" ", 3)[3] == items


def test_all_columns_as_from_an_archive(spark, server):
    """The per-message decoder and the Column expressions give the same rows."""
    from test_decode import ALL, FULL

    server.deliver("INBOX", FULL, ("\\Answered",))
    direct = load(spark, server, ALL + ", content string").collect()
    spark.dataSource.register(fakes.FakeNamedImap)
    try:
        native = read_folder(spark, {"host": str(server.place)}, ALL + ", content string").collect()
    finally:
        spark.dataSource.register(ImapDataSource)
    assert direct == native and direct[0].answered and direct[0].received == datetime(2024, 5, 6, 7, 8, 9)


def test_import_into_an_archive(spark, server, tmp_path):
    fill(server, *range(1, 8))
    archive = mailspark.Archive(spark, str(tmp_path / "archive")).create()
    account = {"host": str(server.place), "batch-size": "2"}
    mailspark.import_folder(archive, account, fakes.FakeImap)
    assert archive.status("INBOX") == (1, 8)
    assert sorted(int(x.split()[1]) for x in server.logged("fetch")) == [1, 3, 5, 7]
    fill(server, 9)
    mailspark.import_folder(archive, account, fakes.FakeImap)
    mailspark.import_folder(archive, account, fakes.FakeImap)
    found = read_folder(spark, {"archive": archive.path}, "uid bigint, subject string, content string, seen boolean")
    assert rows(found) == [(u, f"s{u}", "Message Content", u % 2 == 1) for u in [1, 2, 3, 4, 5, 6, 7, 9]]
    server.change("INBOX", validity=2)
    with pytest.raises(ValueError, match="changed from 1 to 2"):
        mailspark.import_folder(archive, account, fakes.FakeImap)


def test_casts_and_aliases(spark, server):
    fill(server, 3)
    options = {"metadata.id": "uid", "metadata.is_seen": "seen"}
    found = spark.read.format("fake_imap").option("host", str(server.place)).options(**options).schema(
        "id string, is_seen string, sizeInBytes bigint").load()
    assert rows(found)[0][:2] == ("3", "true")
    with pytest.raises(Exception, match="cannot be declared as"):
        load(spark, server, "subject int").collect()


def test_json_content(spark, server):
    server.deliver("INBOX", message("Subject: a", body=b'{"k": 7, "l": ["x", "y"]}'))
    server.deliver("INBOX", message("Subject: b", body=b"nope"))
    found = load(spark, server, "subject string, k int, l array<string>", format="json")
    assert rows(found) == [("a", 7, ["x", "y"]), ("b", None, None)]


def test_missing_folder_fails_the_query(spark, server):
    with pytest.raises(Exception, match="'Nowhere' not found"):
        load(spark, server, "uid bigint", folder="Nowhere").collect()


def test_mode_rule(spark, server):
    with pytest.raises(Exception, match="use spark.readStream"):
        load(spark, server, "uid bigint", mode="new").collect()
    stream = spark.readStream.format("fake_imap").option("host", str(server.place)).schema("uid bigint")
    with pytest.raises(Exception, match="use spark.read, or mode 'all'"):
        run(stream.option("mode", "current").load())
    with pytest.raises(Exception, match="cannot be combined with mode 'new'"):
        run(stream.option("mode", "new").option("offset", "4").load())


def run(stream, checkpoint=None, name="t"):
    writer = stream.writeStream.format("noop").trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint).start() if checkpoint else writer.start()
    query.awaitTermination()


class Collector:
    """A checkpointed stream into a Parquet table, run over what there is now."""

    def __init__(self, spark, server, tmp_path, **options):
        self.spark, self.place = spark, tmp_path
        reader = spark.readStream.format("fake_imap").option("host", str(server.place))
        self.reader = reader.options(**options).schema("uid bigint, subject string")

    def __call__(self) -> list[int]:
        sink = self.reader.load().writeStream.format("parquet").option("checkpointLocation", str(self.place / "cp"))
        sink.trigger(availableNow=True).start(str(self.place / "out")).awaitTermination()
        found = self.spark.read.schema("uid bigint").parquet(str(self.place / "out")).collect()
        return sorted(r.uid for r in found)


def test_stream_all(spark, server, tmp_path):
    fill(server, 1, 2, 5)
    collect = Collector(spark, server, tmp_path)
    assert collect() == [1, 2, 5]
    fill(server, 6, 9)
    assert collect() == [1, 2, 5, 6, 9]
    assert collect() == [1, 2, 5, 6, 9]


def test_stream_all_from_an_offset_past_the_frontier(spark, server, tmp_path):
    fill(server, 1, 2)
    collect = Collector(spark, server, tmp_path, offset="5")
    assert collect() == []
    fill(server, 3, 4, 5, 6)
    assert collect() == [5, 6]


def test_stream_new(spark, server, tmp_path):
    fill(server, 1, 2)
    collect = Collector(spark, server, tmp_path, mode="new")
    assert collect() == []
    fill(server, 3)
    assert collect() == [3]
    fill(server, 4)
    assert collect() == [3, 4]


def test_stream_stops_when_uids_lose_their_meaning(spark, server, tmp_path):
    fill(server, 1)
    collect = Collector(spark, server, tmp_path)
    assert collect() == [1]
    server.change("INBOX", validity=2, next=5)
    with pytest.raises(Exception, match="uidvalidity of folder 'INBOX' changed from 1 to 2"):
        collect()


def test_table_with_options_hint_and_stream(spark, server):
    fill(server, *range(1, 8))
    create_table(spark, "inbox_t", "uid bigint, subject string", {"host": str(server.place), "offset": "3"},
                 source=fakes.FakeImap, replace=True)
    assert [r[0] for r in rows(spark.table("inbox_t"))] == [3, 4, 5, 6, 7]
    assert [r[0] for r in rows(spark.sql("SELECT uid FROM inbox_t WITH ('offset' = '6') WHERE uid < 7"))] == [6]
    assert spark.readStream.option("mode", "new").option("offset", "1").table("inbox_t").isStreaming
    with pytest.raises(ValueError, match="Unsupported option 'nonsense'"):
        create_table(spark, "t", "uid bigint", {"host": "h", "nonsense": "1"})


def test_not_null_is_kept(spark, server):
    fill(server, 1)
    create_table(spark, "strict_inbox", "uid STRING NOT NULL, subject STRING", {"host": str(server.place)}, fakes.FakeImap, replace=True)
    found = spark.table("strict_inbox")
    assert [(f.name, f.nullable) for f in found.schema] == [("uid", False), ("subject", True)]
    assert rows(found) == [("1", "s1")]


def test_temporary_view_with_options_in_sql(spark, server):
    """The options stand in the statement; it works in any session that knows the format."""
    fill(server, *range(1, 6))
    spark.dataSource.register(fakes.FakeNamedImap)
    try:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW v (uid BIGINT, subject STRING) USING imap OPTIONS (host '{server.place}', offset '4')")
        assert rows(spark.sql("SELECT * FROM v")) == [(4, "s4"), (5, "s5")]
    finally:
        spark.catalog.dropTempView("v")
        spark.dataSource.register(ImapDataSource)


def test_password_from_the_environment(spark, server, monkeypatch):
    fill(server, 1)
    monkeypatch.setenv("MAIL_TEST_PASSWORD", "secret")
    options = MailOptions.parse({"host": "h", "password-env": "MAIL_TEST_PASSWORD"}, IMAP_SPEC)
    assert options.uses_authentication and options.password == "secret"
    with pytest.raises(ValueError, match="not set"):
        MailOptions.parse({"host": "h", "password-env": "MAIL_NO_SUCH"}, IMAP_SPEC).password


def test_login_only_with_a_password(spark, server):
    fill(server, 1)
    load(spark, server, "uid bigint", user="jon").collect()
    assert server.logged("anonymous") and not server.logged("login")


# -- searches -------------------------------------------------------------------------------------

EVERY = "uid bigint, subject string, received timestamp, fromFirst string, toFirst string, sizeInBytes int, seen boolean, answered boolean, draft boolean"
PREDICATES = [
    ("seen", "SEEN"), ("not seen", "UNSEEN"), ("seen = false and draft", "UNSEEN DRAFT"), ("answered <=> true", "ANSWERED"),
    ("received >= '2024-05-06 08:00:00'", "SINCE 4-May-2024"), ("received < '2024-05-06 08:00:00'", "BEFORE 9-May-2024"),
    ("received > '2024-05-09'", "SINCE 7-May-2024"), ("received <= '2024-05-03'", "BEFORE 6-May-2024"),
    ("sizeInBytes > 100", "LARGER 100"), ("sizeInBytes <= 100", "SMALLER 101"), ("sizeInBytes = 75", "LARGER 74 SMALLER 76"),
    ("subject = 'Re: plan b'", None), ("subject like '%Über plan%'", None), ("subject like 'plan%'", None), ("subject like '%B'", None),
    ("subject in ('plan', 'Re: plan b')", None), ("fromFirst like '%jon@mail.test%'", None), ("fromFirst = 'Jon Doe <jon@mail.test>'", None),
    ("toFirst = '\"Doe, J\" <j@mail.test>'", None), ("subject like '%?!%'", ""), ("sent > '2024-01-01'", ""), ("subject is null", ""),
    ("seen or subject = 'plan'", ""), ("subject <> 'plan'", ""), ("uid > 2 and seen", "SEEN"),
]


def correspond(server):
    headers = [
        ("Subject: plan", "From: Jon Doe <jon@mail.test>", "To: \"Doe, J\" <j@mail.test>"), ("Subject: Re: plan\r\n b", "Sender: jon@mail.test"),
        ("Subject: =?utf-8?q?=C3=9Cber_plan_B?=", "From: \"J\\on Doe\" <jon@mail.test>"), ("Subject: =?x-unknown?q?plan?=", "From: (x) jon@mail.test"),
        ("From: =?utf-8?b?Sm9uIERvZQ==?= <jon@mail.test>", "To: a@b.c, j@mail.test"), ("Subject: PLAN B", "To: j@mail.test"),
    ]
    flags = [("\\Seen",), (), ("\\Seen", "\\Draft"), ("\\Answered",), (), ("\\Draft",)]
    for h, f in zip(headers * 2, flags * 2):
        server.deliver("INBOX", message(*h, body=b"x" * len(h[0])), f)


@pytest.mark.parametrize("predicate, keys", PREDICATES, ids=[p for p, _ in PREDICATES])
def test_predicates_are_searched_by_the_server(spark, server, predicate, keys):
    """The same rows with and without; what is searched selects no less."""
    correspond(server)
    columns = EVERY + ", sent timestamp"
    plain = rows(load(spark, server, columns, search="false").where(predicate))
    assert not server.logged("search")
    assert rows(load(spark, server, columns).where(predicate)) == plain
    asked = server.logged("search")
    assert bool(asked) == (keys != "")
    if keys:
        assert asked[-1].split(" ", 3)[3] == keys


def test_only_what_a_search_finds_is_fetched(spark, server, monkeypatch):
    fill(server, *range(1, 41))
    found = load(spark, server, "uid bigint, seen boolean, content string", batch_size="4").where("seen and uid < 31")
    assert [r[0] for r in rows(found)] == list(range(1, 31, 2))
    assert server.logged("search") == ["search 1 31 SEEN"]
    native = mailspark.read_folder  # undecoded messages: the date is searched, too
    spark.dataSource.register(fakes.FakeNamedImap)
    try:
        assert native(spark, {"host": str(server.place)}, "uid bigint, received timestamp, subject string").where("received > '2024-06-01'").count() == 0
    finally:
        spark.dataSource.register(ImapDataSource)
    assert server.logged("search")[-1] == "search 1 41 SINCE 30-May-2024"


def test_search_keys_of_odd_values():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

    from mailspark.sources.search import search_keys

    key = lambda f: search_keys(f, {"d": "received", "s": "sizeInBytes", "t": "subject", "u": "toFirst"})
    assert key(GreaterThan(("d",), datetime(1, 1, 1))) == key(LessThan(("d",), datetime(9999, 12, 31))) == ""
    assert key(GreaterThan(("d",), datetime(2024, 5, 6, 23, tzinfo=timezone(timedelta(hours=-5))))) == "SINCE 5-May-2024"
    assert key(GreaterThan(("s",), -1)) == key(LessThan(("s",), 1 << 40)) == key(GreaterThan(("s",), None)) == ""
    assert key(EqualTo(("t",), 'a"b')).count('"') % 2 == 0 and "日" not in key(EqualTo(("t",), "日本 x"))
    assert key(EqualTo(("t",), None)) == key(EqualTo(("t", "u"), "x")) == key(EqualTo(("v",), "x")) == key(In(("t",), ("a", "?"))) == ""
    assert key(In(("t",), tuple("abcdefghijklmnopqrstuvwxyz"))) == ""


# -- splits of even size ---------------------------------------------------------------------------


class Mailbox:
    """Answers searches and sizes of a folder with holes."""

    capabilities, state = (), "SELECTED"

    def __init__(self, sizes):
        self.sizes, self.commands = sizes, []

    def select(self, folder, readonly):
        return "OK", [b""]

    def uid(self, command, numbers, items=None):
        self.commands.append((command, numbers, items))
        if command == "SEARCH":
            first, last = numbers.split()[1].split(":")
            return "OK", [" ".join(str(u) for u in self.sizes if int(first) <= u <= int(last)).encode()]
        found = [(u, s) for u, s in self.sizes.items() if T.in_set(u, numbers)]
        if "BODY" in items:
            return "OK", [x for u, s in found for x in ((b"1 (UID %d RFC822.SIZE %d BODY[] {4}" % (u, s), b"\r\nxy"), b")")]
        return "OK", [b"1 (UID %d RFC822.SIZE %d)" % (u, s) for u, s in found]


def folder_of(sizes, **options):
    found = T.ImapTransport(MailOptions.parse({"host": "h", **options}, IMAP_SPEC))
    found._connection = Mailbox(sizes)
    return found


def test_splits_have_even_sizes_and_pages_a_bound(monkeypatch):
    monkeypatch.setattr(T, "PAGE_BYTES", 10_000_000)
    sizes = {u: 5_000 for u in range(1, 4000) if u % 7} | {u: 5_000 for u in range(900_000, 901_000)} | {u: 9_000_000 for u in (50, 51, 2000, 900_500)}
    sizes = dict(sorted((sizes | {900_700: 15_000_000}).items()))
    server = folder_of(sizes)
    splits = server.splits("INBOX", 1, 1_000_000, ["body"])
    held = [sum(s for u, s in sizes.items() if x.start <= u < x.end) for x in splits]
    assert len(splits) == 4 and max(held) <= 2 * min(held)
    assert [s.start for s in splits[1:]] >= [s.end for s in splits[:-1]]
    pages = [[u for u in sizes if T.in_set(u, p)] for x in splits for p in x.pages]
    assert [u for p in pages for u in p] == list(sizes)  # each once, in order
    assert all(len(p) == 1 or len(p) <= 50 and sum(sizes[u] for u in p) <= 10_000_000 for p in pages)
    assert [900_700] in pages
    got = [m["uid"] for x in splits for m in server.fetch("INBOX", x, ["body", "head"])]
    assert got == list(sizes)
    assert max(len(n) for c, n, i in server.connection.commands if c == "FETCH") < 20


def test_splits_without_bodies_are_even_by_messages():
    server = folder_of({u: 1 for u in [*range(1, 101), *range(50_000, 50_300)]})
    splits = server.splits("INBOX", 1, 60_000, ["flags"])
    assert [sum(len(p.split(",")) > 0 for p in s.pages) for s in splits] == [2, 2, 2, 2]
    assert [c for c, *_ in server.connection.commands] == ["SEARCH"]
    assert folder_of({}).splits("INBOX", 1, 60_000, ["body"]) == [] == folder_of({}).splits("INBOX", 5, 5)
    small = folder_of({1: 5})
    assert [(s.start, s.end) for s in small.splits("INBOX", 1, 30, ["body"])] == [(1, 30)] and small.connection.commands == []


def test_searched_uids_are_fetched_in_short_commands():
    sizes = {u: 10 for u in range(1, 10_001, 3)}
    server = folder_of(sizes, **{"batch-size": "100000", "max-connections": "2"})
    splits = server.splits("INBOX", 1, 20_000, ["body"], "SEEN")
    assert server.connection.commands[0][1] == "UID 1:19999 SEEN"
    assert [m["uid"] for s in splits for m in server.fetch("INBOX", s, ["body", "head"])] == list(sizes)
    assert max(len(n) for c, n, i in server.connection.commands) < 5_000


def test_uid_sets():
    assert T.uid_set([1, 2, 3, 7, 9, 10]) == "1:3,7,9:10" and T.uid_set([1, 7], dense=True) == "1:7"
    assert [u for u in range(12) if T.in_set(u, "1:3,7,9:10")] == [1, 2, 3, 7, 9, 10]


# -- options --------------------------------------------------------------------------------------


def test_defaults():
    o = MailOptions.parse({"HOST": "h"}, IMAP_SPEC)
    assert (o["folder"], o["mode"], o["offset"], o["batch-size"], o["ssl"], o["format"]) == (
        "INBOX", "all", None, 50, False, "raw")
    assert (o["interval"], o["connection.timeout"]) == (timedelta(seconds=1), timedelta(minutes=1))


@pytest.mark.parametrize("options, text", [
    ({}, "Missing required option 'host'"),
    ({"host": "h", "hots": "x"}, "Unsupported option 'hots'"),
    ({"host": "h", "mode": "some"}, "mode.*must be one of all, new, current"),
    ({"host": "h", "batch-size": "0"}, "batch-size.*at least 1"),
    ({"host": "h", "offset": "x"}, "offset"),
    ({"host": "h", "ssl": "maybe"}, "ssl.*not a boolean"),
    ({"host": "h", "interval": "soon"}, "interval.*not a duration"),
    ({"host": "h", "csv.sep": ";"}, "does not belong to format 'raw'"),
])
def test_bad_options(options, text):
    with pytest.raises(ValueError, match=text):
        MailOptions.parse(options, IMAP_SPEC)


def test_specs_differ():
    MailOptions.parse({"host": "h"}, CATALOG_SPEC)
    with pytest.raises(ValueError, match="Unsupported option 'folder'"):
        MailOptions.parse({"host": "h", "folder": "x"}, CATALOG_SPEC)
    with pytest.raises(ValueError, match="Unsupported option 'mode'"):
        MailOptions.parse({"host": "h", "mode": "all"}, SMTP_SPEC)
    with pytest.warns(UserWarning, match="heartbeat"):
        MailOptions.parse({"host": "h", "heartbeat.interval": "5 min"}, IMAP_SPEC)


def test_option_errors_come_at_load(spark):
    with pytest.raises(Exception, match="Unsupported option 'nonsense'"):
        spark.read.format("imap").option("host", "h").option("nonsense", "1").load()


def test_durations():
    assert [duration(t) for t in ("1 s", "15 min", "500ms", "2 hours", "1d", "250")] == [
        timedelta(seconds=1), timedelta(minutes=15), timedelta(milliseconds=500), timedelta(hours=2),
        timedelta(days=1), timedelta(milliseconds=250)]
    assert boolean("TRUE") is True


def test_poll_interval():
    assert mailspark.poll() == {"processingTime": "1000 milliseconds"}
    assert mailspark.poll({"interval": "2 min"}) == {"processingTime": "120000 milliseconds"}


# -- protocol -------------------------------------------------------------------------------------


class Connection:
    """Answers like imaplib, and keeps the commands."""

    capabilities = ()
    state = "SELECTED"

    def __init__(self):
        self.commands = []

    def select(self, folder, readonly):
        self.commands.append(("select", folder, readonly))
        return ("NO", [b"no such"]) if "Nowhere" in folder else ("OK", [b"3"])

    def status(self, folder, items):
        return "OK", [b'"INBOX" (UIDNEXT 9 UIDVALIDITY 77)']

    def list(self, reference, pattern):
        return "OK", [
            b'(\\HasNoChildren) "/" "INBOX"', b'(\\Noselect \\HasChildren) "/" Archive', b'(\\Marked) NIL "a \\"b\\""',
            (b'() "/" {4}', b"Sent"), b'() "/" "&ZeVnLIqe-/x&-y"', b"",
        ]

    def uid(self, command, numbers, items):
        self.commands.append((command, numbers, items))
        return "OK", [
            (b'1 (UID 2 INTERNALDATE "06-May-2024 07:08:09 +0100" RFC822.SIZE 9 FLAGS (\\Seen) BODY[] {9}', b"A: b\r\n\r\nx"),
            b")",
            (b"2 (BODY[] {4}", b"\r\nyz"), b' UID 3 FLAGS () INTERNALDATE " 6-May-2024 07:08:09 +0000")',
            None,
            b"7 (UID 900 FLAGS ())",
            b"1 (UID 2 FLAGS (\\Seen \\Draft))",
            b"3 (UID 4 FLAGS (\\Seen))",
        ]


def transport(**options):
    found = T.ImapTransport(MailOptions.parse({"host": "h", **options}, IMAP_SPEC))
    found._connection = Connection()
    return found


def test_fetch_pages_read_only():
    found = transport(**{"batch-size": "4"})
    messages = list(found.fetch("INBOX", T.Split(1, 8), ["flags", "body", "head", "internal_date", "size"]))
    assert found.connection.commands[0] == ("select", '"INBOX"', True)
    assert [c[1] for c in found.connection.commands[1:]] == ["1:4", "5:7"]
    assert found.connection.commands[1][2] == "(UID INTERNALDATE RFC822.SIZE FLAGS BODY.PEEK[])"
    assert messages[0] == {
        "uid": 2, "internal_date": datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone(timedelta(hours=1))), "size": 9,
        "flags": ["\\Seen", "\\Draft"], "head": b"A: b\r\n\r\n", "body": b"x"}
    assert messages[1]["uid"] == 3 and messages[1]["body"] == b"yz" and messages[1]["flags"] == []
    assert [m["uid"] for m in messages] == [2, 3]


def test_protocol_status_and_folders():
    found = transport()
    assert found.status("INBOX") == (77, 9)
    with pytest.raises(ValueError, match="'Nowhere' not found"):
        found.status("Nowhere")
    assert found.folders() == [("INBOX", True), ("Archive", False), ('a "b"', True), ("Sent", True), ("日本語/x&y", True)]


def test_folder_name_round_trip():
    for name in ["INBOX", "a&b", "日本語", 'q"\\', "Gelöscht/2024"]:
        assert T.folder_name(T.quoted_folder(name).encode()) == name


def test_splits():
    assert T.uid_splits(1, 1, 50, 4) == [] == T.uid_splits(9, 3, 50, 4)
    assert [(s.start, s.end) for s in T.uid_splits(1, 102, 50, 4)] == [(1, 51), (51, 101), (101, 102)]
    assert [(s.start, s.end) for s in T.uid_splits(1, 1001, 50, 4)] == [(1, 251), (251, 501), (501, 751), (751, 1001)]
