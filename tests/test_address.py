"""Address functions in both directions."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from mailspark.functions import address as A
from mailspark.functions import header as H
from mailspark.functions import words as W
from mailspark.functions.charset import java_charsets
from mailspark.sources import message, smtp


def texts(spark, *values):
    return spark.createDataFrame([(list(v) if v is not None else None,) for v in values], "a array<string>")


def test_encode_first_address(spark):
    rows = texts(spark, ["a@one.ext"], ["a@one.ext", "b@two.ext"], None, [])
    parsed = rows.select(A.decode_addresses(F.col("a")).alias("p"))
    assert [r[0] for r in parsed.select(A.encode_first_address(F.col("p"))).collect()] == [
        "a@one.ext", "a@one.ext", None, None
    ]


def test_encode_addresses_keeps_order_and_length(spark):
    rows = texts(spark, ["a@one.ext"], ["a@one.ext", "b@two.ext"],
                 ["Jon Doe <jon.doe@acme.org>", "Jane Doe <jane.doe@acme.org>"], None, [None, "a@b.c"])
    back = rows.select(A.encode_addresses(A.decode_addresses(F.col("a"))))
    assert [r[0] for r in back.collect()] == [r[0] for r in rows.collect()]


VALID = [
    ("a@b.c", None, "a@b.c"),
    ("joe", None, "joe"),
    ("Jon Doe <jon@acme.org>", "Jon Doe", "jon@acme.org"),
    ('"Doe, Jane" <ops@mail.test>', "Doe, Jane", "ops@mail.test"),
    (r'"a \"b\" c" <x@y.z>', 'a "b" c', "x@y.z"),
    ("J. Doe <j@acme.org>", "J. Doe", "j@acme.org"),
    ("a@b.c (Jon)", "Jon", "a@b.c"),
    ('"odd one"@b.c', None, '"odd one"@b.c'),
    ("x@[10.0.0.1]", None, "x@[10.0.0.1]"),
    ("  x@y.z ", None, "x@y.z"),
    ("Jörg <j@münchen.de>", "Jörg", "j@münchen.de"),
    ("team: a@b.c, Jon <d@e.f>;", None, "team: a@b.c, Jon <d@e.f>;"),
]
INVALID = ["", " ", "a@b.c, d@e.f", "a b@c.d", "a@b c", "a@", "@b.c", "a..b@c.d", ".a@b.c", "a.@b.c", "a@b..c", "a@.b",
           "Jon <a@b.c", "Jon a@b.c>", '"Jon <a@b.c>', "a@b.c\nBcc: x@y.z", "a@b_c.d", "<>"]


def test_decode_address(spark):
    rows = spark.createDataFrame([(v[0],) for v in VALID] + [(None,)], "t string")
    found = [r[0] for r in rows.select(A.decode_address(F.col("t"))).collect()]
    assert [f and tuple(f) for f in found] == [v[1:] for v in VALID] + [None]
    assert [smtp._decode_address(v[0]) for v in VALID] == [v[1:] for v in VALID]


@pytest.mark.parametrize("text", INVALID)
def test_illegal_address(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(A.decode_address(F.col("t"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="Illegal address"):
        rows.select(A.decode_address(F.col("t"))).collect()
    with pytest.raises(ValueError, match="Illegal address"):
        smtp._decode_address(text)


def test_mailboxes(spark):
    rows = texts(spark, ["team: a@b.c, Jon <d@e.f>;", "Jane <x@y.z>"], [], None)
    found = rows.select(A.mailboxes(A.decode_addresses(F.col("a")))).collect()
    assert [r[0] for r in found] == [["a@b.c", "d@e.f", "x@y.z"], [], None]
    assert message.mailboxes("team: a@b.c, Jon <d@e.f>;") == ["a@b.c", "d@e.f"]


def test_encode_headers(spark):
    rows = spark.createDataFrame([(["A: 1", "b :2", "C:", "D: x: y"],)], "l array<string>")
    found = rows.select(H.encode_headers(F.col("l"))).first()[0]
    assert [tuple(h) for h in found] == [("A", "1"), ("b", "2"), ("C", ""), ("D", "x: y")]


_NAME = st.text(st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp")), min_size=1, max_size=30).map(str.strip).filter(bool)
_BARE = st.from_regex(r"\A[a-z0-9_+-]{1,8}(\.[a-z]{1,5})?@[a-z0-9]{1,8}\.[a-z]{2,4}\Z")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_NAME, _BARE), min_size=20, max_size=60))
def test_address_round_trip(spark, parts):
    """decode(encode(x)) == x for any display name."""
    rows = spark.createDataFrame(parts, "name string, address string")
    struct = F.struct("name", "address")
    back = rows.select("name", "address", A.parse_address(A.encode_address(struct)).alias("p"))
    for row in back.collect():
        assert (row.p.name, row.p.address) == (row.name, row.address)
        assert message.parse_address(message.format_address(row.name, row.address)) == (row.name, row.address)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\r\n\0"), max_size=120),
                min_size=20, max_size=60))
def test_subject_round_trip(spark, subjects):
    """Any text without a line break survives header encoding, folding, unfolding and decoding."""
    rows = spark.createDataFrame([(s,) for s in subjects], "s string")
    with java_charsets(spark):
        back = rows.select("s", W.decode_words(H.unfold(W.encode_text(F.col("s")))).alias("b"))
    for row in back.collect():
        assert row.b == row.s
        line = smtp._subject_header(row.s).removeprefix("Subject: ").removesuffix("\r\n")
        assert message.decode_words(line.replace("\r\n ", " ")) == row.s


def test_encoded_lines_are_short(spark):
    rows = spark.createDataFrame([("ü😀" * 200,), ("word " * 300,), ("x" * 1500,)], "s string")
    for row in rows.select(W.encode_text(F.col("s")).alias("e")).collect():
        assert max(len(line) for line in row.e.split("\r\n")) <= 78


def test_classes_spelled_out_mean_the_same():
    import re

    from mailspark.functions.patterns import spelled

    for items in (r"^\t-\r \"(),:;<>@\[\]\\", r"!#-\x27*+\-/-9=?A-Z^-~", r"^\x00-\x20\x7f.", r"A-Za-z0-9\u0080-\uffff-", r"^\[\]\s", r"!#$%&'*+/=?^_`{|}~-"):
        plain, out = f"[{items}]", spelled(f"[{items}]")
        assert [bool(re.fullmatch(plain, chr(c), re.A)) for c in range(700)] == [bool(re.fullmatch(out, chr(c), re.A)) for c in range(700)]
    assert spelled(r"a\s[a-c\s]b") == r"a\s[\x61\x62\x63\x09\x0a\x0b\x0c\x0d\x20]b"
