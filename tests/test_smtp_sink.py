"""Rows -> mail: composition, envelope, sending."""

from __future__ import annotations

import email
import email.policy
import re
from datetime import datetime, timedelta, timezone

import fakes
import pytest
from fakes import Server, sent
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from mailspark import Archive, compose, create_table, decode_mail, read_folder, send, send_stream
from mailspark.functions import body as B
from mailspark.options import SMTP_SPEC, MailOptions
from mailspark.sources.smtp import Composer, SmtpDataSource

SCHEMA = (
    "subject string, `from` array<string>, `to` array<string>, cc array<string>, bcc array<string>, "
    "replyTo array<string>, content string"
)
PLAIN = ("Subject", ["sender@mail.test"], ["ingo@mail.test"], None, None, None, "Message Content")


def rows_of(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def composed(spark, *rows, schema=SCHEMA, **options):
    """Messages by Column expressions, checked against the per-row composer of INSERT."""
    frame = rows_of(spark, *rows, schema=schema)
    found = compose(frame, options).collect()
    one = Composer(frame.schema, MailOptions.parse({"host": "h", **options}, SMTP_SPEC))
    for row, message in zip(frame.collect(), found):
        if message.envelope_to:
            sender, recipients, raw = one(row)
            assert (sender, recipients, undated(raw)) == (message.envelope_from, message.envelope_to, undated(message.raw))
    return found


def undated(raw):
    """A message without its Date, which must be there once."""
    out, n = re.subn(rb"\r\nDate: \w{3}, \d{1,2} \w{3} \d{4} \d\d:\d\d:\d\d \+0000(?=\r\n)", b"", b"\r\n" + bytes(raw))
    assert n == 1
    return out


def parsed(message):
    return email.message_from_bytes(bytes(message.raw), policy=email.policy.default)


def test_plain_message(spark):
    message = composed(spark, PLAIN)[0]
    lines = bytes(message.raw).decode().split("\r\n")
    assert lines[:3] == ["From: sender@mail.test", "To: ingo@mail.test", "Subject: Subject"]
    assert lines[3].startswith("Date: ") and lines[4].startswith("Message-ID: ")
    found = parsed(message)
    assert found.get_content_type() == "multipart/mixed"
    (part,) = found.iter_parts()
    assert part["Content-Type"] == 'text/plain; charset="UTF-8"'
    assert part.get_content().rstrip("\n") == "Message Content"
    assert (message.envelope_from, message.envelope_to) == ("sender@mail.test", ["ingo@mail.test"])


def test_headers_and_envelope(spark):
    row = ("S", ["Jon Doe <jon@a.b>", "x@y.z"], ['"Doe, J" <j@a.b>', "k@a.b"], ["c@c.c"], ["b@b.b", "team: t@t.t, u@u.u;"],
           ["r@r.r"], "x")
    message = composed(spark, row)[0]
    found = parsed(message)
    assert found["From"] == "Jon Doe <jon@a.b>, x@y.z" and found["Cc"] == "c@c.c" and found["Reply-To"] == "r@r.r"
    assert [a.addr_spec for a in found["To"].addresses] == ["j@a.b", "k@a.b"]
    assert found["Bcc"] is None and b"b@b.b" not in bytes(message.raw)
    assert message.envelope_from == "jon@a.b"
    assert message.envelope_to == ["j@a.b", "k@a.b", "c@c.c", "b@b.b", "t@t.t", "u@u.u"]


def test_null_values_leave_headers_out(spark):
    found = parsed(composed(spark, (None, None, ["a@b.c", None], [], None, None, None))[0])
    assert found["Subject"] is None and found["From"] is None and found["Cc"] is None
    assert found["To"] == "a@b.c"
    assert next(found.iter_parts()).get_content() == ""


def test_non_ascii(spark):
    row = ("Grüße 😀 " * 20, ["Jörg <j@b.c>"], ['"Ö, x" <o@b.c>', "Plain <p@b.c>"], None, None, None, "grün\nß")
    message = composed(spark, row)[0]
    bytes(message.raw).decode("ascii")
    found = parsed(message)
    assert found["Subject"] == row[0].rstrip(" ") or found["Subject"] == row[0]
    assert found["From"].addresses[0].display_name == "Jörg"
    assert found["To"].addresses[0].display_name == "Ö, x"
    assert next(found.iter_parts()).get_payload(decode=True).decode() == "grün\nß"


@pytest.mark.parametrize("row, text", [
    (("a\r\nBcc: x@y.z", *PLAIN[1:]), "Line break in subject"),
    (("a\nb", *PLAIN[1:]), "Line break in subject"),
    (("s", ["a@b.c\r\nX: y"], *PLAIN[2:]), "Illegal address"),
    (("s", PLAIN[1], ["a@b.c, d@e.f"], *PLAIN[3:]), "Illegal address"),
    (("s", PLAIN[1], ["a@b.c\x01d@e.f"], *PLAIN[3:]), "Illegal address"),
    (("s", PLAIN[1], ["not an address"], *PLAIN[3:]), "Illegal address"),
])
def test_bad_headers_fail(spark, row, text):
    with pytest.raises(Exception, match=text):
        compose(rows_of(spark, row)).collect()
    frame = rows_of(spark, row)
    with pytest.raises(ValueError, match=text):
        Composer(frame.schema, MailOptions.parse({"host": "h"}, SMTP_SPEC))(frame.first())


def test_no_recipients_fail(spark, tmp_path):
    row = ("s", ["a@b.c"], None, [], None, None, "x")
    Archive(spark, str(tmp_path / "spool")).create()
    with pytest.raises(Exception, match="No recipient addresses"):
        send(rows_of(spark, row), {"spool": str(tmp_path / "spool")})


def test_no_content_columns(spark):
    message = composed(spark, ("s", ["a@b.c"]), schema="subject string, `to` array<string>")[0]
    assert bytes(message.raw).endswith(b"Content-Type: text/plain; charset=us-ascii\r\n\r\n")
    assert parsed(message).get_content() == ""


def test_formats(spark):
    schema = "subject string, `to` array<string>, a int, b string"
    rows = [("s", ["x@y.z"], 1, "q"), ("s", ["x@y.z"], None, None)]
    bodies = {
        "json": ['{"a":1,"b":"q"}', '{"a":null,"b":null}'],
        "csv": ["1,q", ","],
    }
    for name, expected in bodies.items():
        found = composed(spark, *rows, schema=schema, format=name)
        assert [next(parsed(m).iter_parts()).get_content().rstrip("\n") for m in found] == expected
    xml = compose(rows_of(spark, rows[0], schema=schema), {"format": "xml"}).first()
    assert "<a>1</a>" in next(parsed(xml).iter_parts()).get_payload(decode=True).decode()
    with pytest.raises(ValueError, match="exactly one"):
        compose(rows_of(spark, rows[0], schema=schema))


def test_content_columns_after_metadata_bind_by_name(spark):
    schema = "a int, subject string, b string, `to` array<string>"
    message = composed(spark, (1, "s", "q", ["x@y.z"]), schema=schema, format="json")[0]
    assert parsed(message)["Subject"] == "s" and b'{"a":1,"b":"q"}' in bytes(message.raw)


def test_aliases_and_unknown_keys(spark):
    schema = "title string, `to` array<string>, subject string"
    options = {"metadata.title": "subject", "content-columns": "subject"}
    message = compose(rows_of(spark, ("t", ["a@b.c"], "the body"), schema=schema), options).first()
    assert parsed(message)["Subject"] == "t" and b"the body" in bytes(message.raw)
    with pytest.raises(ValueError, match="No metadata is called 'uid'"):
        compose(rows_of(spark, ("t", ["a@b.c"], "x"), schema=schema), {"metadata.title": "uid"})


def test_date(spark):
    """The time of sending, or of a column; it does not change the Message-ID."""
    now = datetime.now(timezone.utc)
    plain = composed(spark, PLAIN)[0]
    sent = parsed(plain)["Date"].datetime
    assert abs(sent - now) < timedelta(minutes=5)
    times = [datetime(2024, 5, 6, 7, 8, 9), datetime(1999, 12, 31, 23, 59, 59), None]
    schema = SCHEMA + ", at timestamp"
    frame = rows_of(spark, *[(*PLAIN, t) for t in times], schema=schema)
    options = {"date-column": "at"}
    found = composed(spark, *[(*PLAIN, t) for t in times], schema=schema, **options)
    one = Composer(frame.schema, MailOptions.parse({"host": "h", **options}, SMTP_SPEC))
    for row, message, seconds in zip(frame.collect(), found, frame.select(F.unix_seconds("at")).collect()):
        if seconds[0] is not None:
            assert parsed(message)["Date"].datetime.timestamp() == seconds[0]
            assert one(row)[2] == bytes(message.raw)
    assert abs(parsed(found[2])["Date"].datetime - now) < timedelta(minutes=5)
    assert {m.message_id for m in found} == {plain.message_id}


def test_message_id_is_fixed_by_the_row(spark):
    other = (*PLAIN[:6], "other")
    first, again, different = composed(spark, PLAIN, PLAIN, other)
    assert first.message_id == again.message_id != different.message_id
    assert parsed(first)["Message-ID"] == first.message_id
    keyed = composed(spark, (*PLAIN, 1), (*PLAIN, 2), schema=SCHEMA + ", id int", **{"message-key": "id"})
    assert keyed[0].message_id != keyed[1].message_id
    assert b"Message Content" in bytes(keyed[0].raw)


CONTENT = st.text(st.characters(blacklist_categories=("Cs",)), max_size=300) | st.sampled_from(
    ["", "a\r\nb\r\n", "a\nb", "\r", "x" * 2000, ".\r\n.", "--=_", "grün", "\0", "a\r\n\r\nb", "From x"]
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(CONTENT, min_size=20, max_size=50))
def test_content_round_trip(spark, contents):
    """Content of any kind is read back exactly; what is sent has no long line or lone line break."""
    frame = rows_of(spark, *[(*PLAIN[:6], c) for c in contents])
    messages = compose(frame).collect()
    for row, message in zip(frame.collect(), messages):
        one = Composer(frame.schema, MailOptions.parse({"host": "h"}, SMTP_SPEC))
        assert undated(one(row)[2]) == undated(message.raw)
    raws = [(i, bytearray(m.raw)) for i, m in enumerate(messages)]
    mail = spark.createDataFrame(raws, "uid bigint, raw binary").selectExpr(
        "'x' folder", "uid", "current_timestamp() internal_date", "array() flags", "raw")
    back = decode_mail(mail, "uid bigint, body string").select("uid", B.only_part(F.col("body")).alias("c"))
    for row in back.collect():
        assert bytes(row.c).decode() == contents[row.uid]
    for message in messages:
        text = bytes(message.raw).decode("ascii")
        assert max(len(line) for line in text.split("\r\n")) <= 998
        assert "\n" not in text.replace("\r\n", "") and "\r" not in text.replace("\r\n", "")


def test_binary_content(spark):
    schema = "`to` array<string>, content binary"
    message = composed(spark, (["a@b.c"], bytearray(range(256))), schema=schema)[0]
    assert next(parsed(message).iter_parts()).get_payload(decode=True) == bytes(range(256))


def test_compose_stays_in_the_jvm(spark):
    text = compose(rows_of(spark, PLAIN))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


# -- sending --------------------------------------------------------------------------------------


@pytest.fixture
def place(spark, tmp_path):
    spark.dataSource.register(fakes.FakeNamedSmtp)
    yield Server(str(tmp_path / "smtp")).create("x").place
    spark.dataSource.register(SmtpDataSource)


def test_send(spark, place):
    send(rows_of(spark, PLAIN, ("Second", *PLAIN[1:])).coalesce(1), {"host": str(place), "user": "u", "password": "p"})
    found = sent(place)
    assert len(found) == 2
    assert found[1]["from"] == "sender@mail.test" and found[1]["to"] == ["ingo@mail.test"]
    assert "Subject: Subject\r\n" in found[1]["raw"] and "Message Content" in found[1]["raw"]
    assert Server(place).logged("connect") == ["connect u p"] and len(Server(place).logged("quit")) == 1


def test_insert_into_outbox(spark, place):
    create_table(spark, "outbox_t", "subject string, `from` array<string>, `to` array<string>, content string",
                 {"host": str(place)}, source=fakes.FakeSmtp, replace=True)
    spark.sql("INSERT INTO outbox_t SELECT 'Subject', array('sender@mail.test'), array('ingo@mail.test'), 'Message Content'")
    (message,) = sent(place)
    assert message["to"] == ["ingo@mail.test"] and "Message Content" in message["raw"]
    send(rows_of(spark, PLAIN).select("subject", "from", "to", "content"), {"host": str(place)})
    assert [undated(m["raw"].encode()) for m in sent(place)] == [undated(message["raw"].encode())] * 2


def test_overwrite_is_refused(spark, place):
    with pytest.raises(Exception, match="cannot be overwritten|append"):
        compose(rows_of(spark, PLAIN)).write.format("smtp").option("host", str(place)).mode("overwrite").save()
    assert sent(place) == []


def test_bad_rows_fail_the_insert(spark, place):
    create_table(spark, "outbox_b", "subject string, `to` array<string>", {"host": str(place)},
                 source=fakes.FakeSmtp, replace=True)
    with pytest.raises(Exception, match="Illegal address"):
        spark.sql("INSERT INTO outbox_b SELECT 's', array('a b@c')")
    with pytest.raises(Exception, match="No recipient addresses"):
        spark.sql("INSERT INTO outbox_b SELECT 's', array()")


def test_continuous_send(spark, place, tmp_path):
    source = str(tmp_path / "rows")
    rows_of(spark, PLAIN).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        send_stream(stream, {"host": str(place)}, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    assert len(sent(place)) == 1


def test_spool_round_trip(spark, tmp_path):
    spool = str(tmp_path / "spool")
    Archive(spark, spool).create()
    for subject in ("one", "two"):
        send(rows_of(spark, (subject, *PLAIN[1:])), {"spool": spool, "folder": "Sent"})
    found = read_folder(spark, {"archive": spool, "folder": "Sent"}, "subject string, fromFirst string, toFirst string")
    assert sorted(tuple(r) for r in found.collect()) == [
        ("one", "sender@mail.test", "ingo@mail.test"), ("two", "sender@mail.test", "ingo@mail.test")]


def test_sends_into_one_spool_at_the_same_time(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    spool = str(tmp_path / "spool")
    Archive(spark, spool).create()
    rows = rows_of(spark, *[(f"s{i}", *PLAIN[1:]) for i in range(20)]).repartition(2)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: send(rows, {"spool": spool}), range(2)))
    uids = sorted(r.uid for r in read_folder(spark, {"archive": spool, "folder": "OUTBOX"}, "uid bigint").collect())
    assert uids == list(range(1, 41))


def test_sender_falls_back_to_the_user(spark):
    schema = "`to` array<string>"
    assert composed(spark, (["a@b.c"],), schema=schema, user="me@b.c")[0].envelope_from == "me@b.c"


def test_only_the_host_is_required():
    MailOptions.parse({"host": "h"}, SMTP_SPEC)
    with pytest.raises(ValueError, match="'host'"):
        MailOptions.parse({"user": "u"}, SMTP_SPEC)


# -- journal --------------------------------------------------------------------------------------


@pytest.fixture
def relay(spark, tmp_path):
    server = Server(str(tmp_path / "relay")).create()
    spark.dataSource.register(fakes.FakeNamedSmtp)
    yield server
    spark.dataSource.register(SmtpDataSource)


def mails(spark, n):
    return rows_of(spark, *[(f"S{i}", ["a@b.c"], [f"u{i}@b.c"], None, None, None, "x") for i in range(n)])


def noted(spark, journal):
    from mailspark import outcomes

    return sorted((r.recipient, r.code, r.reason) for r in outcomes(spark, journal).collect())


def test_a_task_that_dies_midway_sends_only_the_rest(spark, relay, tmp_path):
    journal = str(tmp_path / "journal")
    (relay.place / "dies-after").write_text("4")
    options = {"host": str(relay.place), "journal": journal}
    with pytest.raises(Exception, match="gone"):
        send(mails(spark, 10).coalesce(1), options)
    assert len(sent(relay.place)) == 4 == len(noted(spark, journal))
    (relay.place / "dies-after").unlink()
    for _ in range(2):
        send(mails(spark, 10).coalesce(1), options)
        assert sorted(m["to"][0] for m in sent(relay.place)) == sorted(f"u{i}@b.c" for i in range(10))
    assert noted(spark, journal) == sorted((f"u{i}@b.c", 250, None) for i in range(10))


def test_a_refused_recipient_is_a_note(spark, relay, tmp_path):
    rows = rows_of(spark, ("S", ["a@b.c"], ["x@b.c", "refused@b.c"], ["y@b.c"], None, None, "x"))
    with pytest.raises(Exception, match="RecipientsRefused"):
        send(rows, {"host": str(relay.place)})
    send(rows, {"host": str(relay.place), "journal": str(tmp_path / "journal")})
    assert [m["to"] for m in sent(relay.place)] == [["x@b.c", "y@b.c"]] * 2
    assert noted(spark, str(tmp_path / "journal")) == [("refused@b.c", 550, "no such user"), ("x@b.c", 250, None), ("y@b.c", 250, None)]


def test_a_batch_of_a_stream_that_runs_again_sends_the_rest(spark, relay, tmp_path):
    mails(spark, 6).coalesce(1).write.parquet(str(tmp_path / "rows"))
    (relay.place / "dies-after").write_text("2")
    options = {"host": str(relay.place), "journal": str(tmp_path / "journal")}

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "rows"))
        send_stream(stream, options, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()

    with pytest.raises(Exception, match="gone"):
        run()
    (relay.place / "dies-after").unlink()
    run()
    assert sorted(m["to"][0] for m in sent(relay.place)) == [f"u{i}@b.c" for i in range(6)]


def test_a_second_try_of_a_task_knows_what_the_first_noted(tmp_path):
    from mailspark.sources.journal import NOTED, Journal, message_id

    first = Journal(str(tmp_path / "j"), "run", 3, 0)
    for i in range(NOTED + 5):
        first.note(f"<{i}>", ["a"], {})
    second = Journal(str(tmp_path / "j"), "run", 3, 1)
    assert second.known == {f"<{i}>" for i in range(NOTED)}  # the rest of a killed worker is the window
    first.save()
    assert len(Journal(str(tmp_path / "j"), "run", 3, 1).known) == NOTED + 5
    assert not Journal(str(tmp_path / "j"), "run", 3, 0).known and not Journal(str(tmp_path / "j"), "other", 3, 1).known
    assert not Journal(str(tmp_path / "j"), "run", 33, 1).known
    assert message_id(b"From: a\r\nMessage-ID: <x@y>\r\n\r\nMessage-ID: <no>") == "<x@y>"
