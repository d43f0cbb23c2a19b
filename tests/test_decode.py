"""Message -> columns: every readable key, against hand-written messages."""

from __future__ import annotations

from datetime import datetime, timezone

import cases
import pytest
from cases import CRLF, message

from mailspark import decode_mail, physical_row, row_slice, split_raw
from mailspark import metadata as M
from mailspark.sources.message import row_decoder
from mailspark.sources.transport import cut

FULL = message(
    "Received: from a",
    "Received: from b",
    "DATE: Mon, 6 May 2024 07:08:09 +0100",
    "From: Jon Doe <jon@acme.org>",
    "To: a@b.c,",
    "\td@e.f",
    "to: g@h.i",
    "CC: c@c.c",
    "Bcc: b@b.b",
    "Subject: Hello",
    "Content-Type: text/plain; charset=UTF-8",
    body=b"Message Content",
)
ALL = ", ".join(f"`{k}` {t.simpleString()}" for k, t in M.READABLE.items())


def by_message(schema: str, raw: bytes, format: str = "raw", **options) -> tuple:
    """The same row, by the per-message decoder of live tables."""
    head, body = cut(raw)
    layout = M.Layout.of(schema)
    stored = {"uid": 1, "head": head, "body": body, "size": len(raw), "flags": ["\\Seen"],
              "internal_date": datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)}
    return row_decoder(layout, format, options)(stored)


def test_all_keys(decode):
    row = decode(ALL, FULL, flags=("\\Seen", "\\Recent"))[0]
    date = datetime(2024, 5, 6, 7, 8, 9, 123456)
    headers = row[-1]
    assert row[:-1] == (
        1, "Hello", datetime(2024, 5, 6, 6, 8, 9), date, "text/plain; charset=UTF-8", len(FULL), True, False, False,
        ["Jon Doe <jon@acme.org>"], "Jon Doe <jon@acme.org>", ["a@b.c", "d@e.f", "g@h.i"], "a@b.c",
        ["c@c.c"], ["b@b.b"], ["a@b.c", "d@e.f", "g@h.i", "c@c.c", "b@b.b"], ["Jon Doe <jon@acme.org>"],
    )
    assert [tuple(h) for h in headers] == [
        ("Received", "from a"), ("Received", "from b"), ("DATE", "Mon, 6 May 2024 07:08:09 +0100"),
        ("From", "Jon Doe <jon@acme.org>"), ("To", "a@b.c,\td@e.f"), ("to", "g@h.i"), ("CC", "c@c.c"),
        ("Bcc", "b@b.b"), ("Subject", "Hello"), ("Content-Type", "text/plain; charset=UTF-8"),
    ]


def test_absent_headers_are_null(decode):
    row = decode(ALL, message("X-Other: 1", body=b"x"))[0]
    by_key = dict(zip(M.READABLE, row))
    assert by_key["contentType"] == "text/plain"
    for key in M.HEAD_KEYS - {"contentType", "headers"}:
        assert by_key[key] is None, key
    assert (by_key["seen"], by_key["draft"], by_key["answered"]) == (False, False, False)


def test_flags(decode):
    schema = "seen boolean, draft boolean, answered boolean"
    assert decode(schema, FULL, flags=("\\Answered", "\\Draft", "\\Seen")) == [(True, True, True)]
    assert decode(schema, FULL, flags=("Seen",)) == [(False, False, False)]


def test_fallbacks_of_from_and_reply_to(decode):
    schema = "`from` array<string>, replyTo array<string>"
    sender = message("Sender: s@s.s", "From: ")
    both = message("From: f@f.f", "Sender: s@s.s", "Reply-To: r@r.r, q@q.q")
    assert decode(schema, sender, both) == [(["s@s.s"], ["s@s.s"]), (["f@f.f"], ["r@r.r", "q@q.q"])]


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_head_and_body(decode, end):
    lines = [f"Subject: a{end}{end}body{end}{end}more", f"Subject: a{end}", f"{end}only body", f"Subject: a{end}{end}"]
    rows = decode("subject string, content string", *[line.encode() for line in lines])
    assert rows == [("a", f"body{end}{end}more"), ("a", ""), (None, "only body"), ("a", "")]


def test_split_is_byte_exact(mail):
    raw = b"Subject: x\r\nX: \xff\r\n\r\n\x00\xfe\r\n\r\nz"
    row = split_raw(mail(raw)).first()
    assert bytes(row.head) + bytes(row.body) == raw and row.size == len(raw)
    assert (bytes(row.head), bytes(row.body)) == cut(raw)


def test_addresses(decode):
    raws = [message(f"To: {text}") for text, _ in cases.ADDRESSES]
    rows = decode("`to` array<string>, toFirst string", *raws)
    for (text, expected), row, raw in zip(cases.ADDRESSES, rows, raws):
        assert row == (expected, expected[0] if expected else None), text
        assert by_message("`to` array<string>, toFirst string", raw) == tuple(row), text


def test_dates(decode):
    raws = [message(f"Date: {text}") for text, _ in cases.DATES]
    rows = decode("sent timestamp", *raws)
    for (text, seconds), row, raw in zip(cases.DATES, rows, raws):
        expected = None if seconds is None else datetime.fromtimestamp(seconds, timezone.utc)
        assert row[0] == (expected and expected.replace(tzinfo=None)), text
        assert by_message("sent timestamp", raw) == (expected,), text


def test_subjects(decode):
    raws = [message(f"Subject: {text}") for text, _ in cases.SUBJECTS]
    rows = decode("subject string", *raws)
    for (text, expected), row, raw in zip(cases.SUBJECTS, rows, raws):
        assert row[0] == expected, text
        assert by_message("subject string", raw) == (expected,), text


def test_latin1_head(decode):
    raw = b"Subject: gr\xfcn\r\n\r\n"
    assert decode("subject string", raw) == [("grün",)]
    assert by_message("subject string", raw) == ("grün",)


def test_bodies(decode):
    raws = [message("Subject: x", *headers, body=body) for headers, body, _ in cases.BODIES]
    rows = decode("content string", *raws)
    for (headers, body, expected), row, raw in zip(cases.BODIES, rows, raws):
        assert row[0] == expected, (headers, body)
        assert by_message("content string", raw) == (expected,), (headers, body)


def test_every_byte_in_quoted_printable(decode):
    body = "".join(f"={i:02X}" for i in range(256)).encode()
    raw = message("Content-Transfer-Encoding: quoted-printable", body=body)
    assert bytes(decode("content binary", raw)[0][0]) == bytes(range(256))


def test_binary_content_and_fixed_charset(decode):
    raw = message("Content-Type: text/plain; charset=UTF-8", body=b"gr\xfcn")
    assert bytes(decode("content binary", raw)[0][0]) == b"gr\xfcn"
    assert decode("content string", raw, format_options={"charset": "iso-8859-1"}) == [("grün",)]
    assert by_message("content string", raw, charset="iso-8859-1") == ("grün",)


def test_formats(decode):
    json_body = message(body=b'{"a": 1, "b": {"c": ["x"]}, "z": 0}')
    schema = "a int, b struct<c:array<string>>, missing string"
    assert decode(schema, json_body, message(body=b"not json"), message(body=b""), format="json") == [
        (1, (["x"],), None), (None, None, None), (None, None, None)
    ]
    assert by_message(schema, json_body, format="json") == (1, (["x"],), None)
    assert by_message(schema, message(body=b"not json"), format="json") == (None, None, None)
    csv_body = message(body=b'1,"a,b",true\r\n')
    assert decode("i int, s string, t boolean", csv_body, format="csv") == [(1, "a,b", True)]
    assert by_message("i int, s string, t boolean", csv_body, format="csv") == (1, "a,b", True)
    semicolons = message(body=b"1;x")
    assert decode("i int, s string", semicolons, format="csv", format_options={"sep": ";"}) == [(1, "x")]
    xml_body = message(body=b"<ROW><i>1</i><s>x</s></ROW>")
    assert decode("i int, s string", xml_body, format="xml") == [(1, "x")]


def test_undecodable_content_keeps_the_row(decode):
    schema = "subject string, a int, b string"
    assert decode(schema, message("Subject: s", body=b"{"), format="json") == [("s", None, None)]


def test_layout_binds_by_name(spark):
    layout = M.Layout.of("content string, id string, SUBJECT string, `to` int", {"ID": "uid"}, ["to"])
    assert [(c.name, c.key) for c in layout.columns] == [
        ("content", None), ("id", "uid"), ("SUBJECT", "subject"), ("to", None)
    ]
    with pytest.raises(ValueError, match="No metadata is called 'nothing'"):
        M.Layout.of("a string", {"a": "nothing"})
    with pytest.raises(ValueError, match="not declared"):
        M.Layout.of("a string", {"b": "uid"})
    with pytest.raises(ValueError, match="No metadata is called 'nothing'"):
        M.readable("nothing")
    with pytest.raises(ValueError, match="No metadata is called 'uid'"):
        M.writable("uid")


def test_raw_needs_one_text_column(mail):
    for schema in ("a string, b string", "a int"):
        with pytest.raises(ValueError, match="exactly one"):
            decode_mail(mail(FULL), schema)


def test_alias_and_cast(decode):
    row = decode("id string, size string, seen string", FULL, aliases={"id": "uid", "size": "sizeInBytes"})[0]
    assert row == ("1", str(len(FULL)), "false")


def test_row_layout_and_slices(mail):
    layout = M.Layout.of("uid bigint, content string, subject string")
    row = physical_row(decode_mail(mail(FULL), layout), layout)
    assert row.columns == ["content", "uid", "subject"]
    letters = mail(FULL).selectExpr("'a' a", "'b' b", "'c' c", "'d' d", "'e' e")
    found = letters.select(*[row_slice(letters, *s).alias(str(i)) for i, s in enumerate([(0, 2), (3, 4), (4, 4)])])
    assert [tuple(v) for v in found.first()] == [("a", "b"), ("d",), ()]
    with pytest.raises(IndexError):
        row_slice(letters, 3, 6)


def test_long_headers(decode):
    many = ", ".join(f'"Doe, J{i}" <a{i}@b.c>' for i in range(5000))
    odd = '"' * 3000 + "(" * 3000 + "<" * 3000
    rows = decode("`to` array<string>", message(f"To: {many}"), message(f"To: {odd}"), message("To: " + "x " * 20000))
    assert len(rows[0][0]) == 5000 and rows[0][0][4999] == '"Doe, J4999" <a4999@b.c>'


def test_no_python_and_only_needed_columns(mail, spark):
    decoded = decode_mail(split_raw(mail(FULL)), ALL + ", content string")
    assert "Python" not in plan(decoded)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_header_block_of_many_lines(decode):
    noise = [f"X-{i}: {CRLF} folded {i}" for i in range(300)]
    assert decode("subject string", message(*noise, "Subject: x")) == [("x",)]


@pytest.mark.parametrize("format, kind, bodies", [
    ("json", "bigint", ['{"k":"12"}', '{"k":"1_000"}', '{"k":5} trailing', '{"k":9223372036854775808}', '{"k":-9223372036854775808}',
                        '{"k":1.5}', '{"k":true}', '{"k":null}', "[1]", '{"k":7', ' {"k":7}']),
    ("json", "string", ['{"k":1.50}', '{"k":1e22}', '{"k":-2.5e-7}', '{"k":12345678.5}', '{"k":{"a":[1,"x",null]}}', '{"k":"é"}', '{"k":false}']),
    ("json", "double", ['{"k":1}', '{"k":1.5e3}', '{"k":"1.5"}']),
    ("json", "boolean", ['{"k":true}', '{"k":"true"}']),
    ("csv", "bigint", ["1_000", " 7 ", "+7", "9223372036854775808", "", "7.0", "7,8"]),
    ("csv", "string", [r'"q\"r"', '"a,b",c', "plain", '"a', r"a\b", " x "]),
    ("csv", "boolean", ["TRUE", "yes"]),
    ("csv", "double", ["1.5", "1_0.5", ".5e1"]),
])
def test_declared_tables_read_content_as_spark_does(decode, format, kind, bodies):
    """The parser of live tables and Spark's own give the same values."""
    from mailspark import metadata as M
    from mailspark.sources.message import content_decoder

    raws = [message("Content-Type: text/plain; charset=UTF-8", body=b.encode()) for b in bodies]
    native = [r[0] for r in decode(f"k {kind}", *raws, format=format)]
    one = content_decoder(format, M.Layout.of(f"k {kind}", None).content, {})
    assert [one(b.encode(), "utf-8")[0] for b in bodies] == native
