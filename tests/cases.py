"""Header and body cases read the same by Column expressions and by the per-message decoder."""

CRLF = "\r\n"


def message(*lines: str, body: bytes = b"") -> bytes:
    return CRLF.join([*lines, "", ""]).encode() + body


ADDRESSES = [
    # header value, expected texts
    ("a@one.ext", ["a@one.ext"]),
    ("a@one.ext, b@two.ext", ["a@one.ext", "b@two.ext"]),
    ("Jon Doe <jon.doe@acme.org>, Jane Doe <jane.doe@acme.org>",
     ["Jon Doe <jon.doe@acme.org>", "Jane Doe <jane.doe@acme.org>"]),
    ('"Doe, Jane" <ops@mail.test>, audit@mail.test', ['"Doe, Jane" <ops@mail.test>', "audit@mail.test"]),
    ('"Jon Doe" <jon@acme.org>', ["Jon Doe <jon@acme.org>"]),
    ('"Jon Doe" <jon@acme.org>, "Doe, J." <j@acme.org>', ["Jon Doe <jon@acme.org>", '"Doe, J." <j@acme.org>']),
    ("J. Doe <j@acme.org>", ['"J. Doe" <j@acme.org>']),
    ("<a@b.c>", ["a@b.c"]),
    ("Jon<a@b.c>", ["Jon <a@b.c>"]),
    ("a@b.c (Jon Doe)", ["Jon Doe <a@b.c>"]),
    ("a@b.c (Doe, Jon (x)), d@e.f", ['"Doe, Jon (x)" <a@b.c>', "d@e.f"]),
    (r'"Jon \"JD\" Doe" <a@b.c>', [r'"Jon \"JD\" Doe" <a@b.c>']),
    ("team: a@b.c, d@e.f;, x@y.z", ["team: a@b.c, d@e.f;", "x@y.z"]),
    ("undisclosed-recipients:;", ["undisclosed-recipients:;"]),
    ("=?UTF-8?B?SsO2cmc=?= <j@b.c>", ["=?UTF-8?B?SsO2cmc=?= <j@b.c>"]),
    ("=?UTF-8?Q?J=C3=B6rg_M.?= <j@b.c>", ['"=?UTF-8?Q?J=C3=B6rg_M.?=" <j@b.c>']),
    ("Jörg <j@b.c>", ['"Jörg" <j@b.c>']),
    ('"very odd"@b.c', ['<"very odd"@b.c>']),
    ("a@b.c; d@e.f", ["a@b.c", "d@e.f"]),
    ("a@b.c,, d@e.f,", ["a@b.c", "d@e.f"]),
    ("  a@b.c  ,\r\n\td@e.f", ["a@b.c", "d@e.f"]),
    ("joe", ["joe"]),
    ('Broken "quote <a@b.c>', ['"Broken \\"quote" <a@b.c>']),
    ('A "B C" <a@b.c>', [r'"A \"B C\"" <a@b.c>']),
    ("", None),
    (" , ", None),
]

DATES = [
    # header value, epoch seconds
    ("Mon, 6 May 2024 07:08:09 +0100", 1714975689),
    ("Mon, 06 May 2024 07:08:09 -0730", 1715006289),
    ("6 May 2024 07:08:09 +0000", 1714979289),
    ("Mon, 6 May 2024 07:08:09 GMT", 1714979289),
    ("Mon, 6 May 2024 07:08:09 +0000 (UTC)", 1714979289),
    ("Mon, 6 May 2024 07:08 +0000", 1714979280),
    ("Mon, 6 May 24 07:08:09 +0000", 1714979289),
    ("Mon, 1 Jul 96 07:08:09 EST", 836222889),
    ("Mon,  6 May 2024  7:08:09 PDT", 1715004489),
    ("Mon, 6 May 2024 07:08:09", 1714979289),
    ("Monday, 06-May-24 07:08:09 GMT", 1714979289),
    ("Mon (x), 6 May (y) 2024 07:08:09 +0000", 1714979289),
    ("yesterday", None),
    ("Mon, 32 May 2024 07:08:09 +0000", None),
    ("Mon, 6 Foo 2024 07:08:09 +0000", None),
    ("", None),
]

SUBJECTS = [
    ("plain", "plain"),
    ("=?UTF-8?B?SMOpbGxv?=", "Héllo"),
    ("=?utf-8?q?H=C3=A9llo_w=5Frld?=", "Héllo w_rld"),
    ("=?ISO-8859-1?Q?H=E9llo?= there", "Héllo there"),
    ("=?UTF-8?B?SMOp?= =?UTF-8?B?bGxv?=", "Héllo"),
    ("=?UTF-8?B?SMOp?=\r\n =?UTF-8?Q?llo?= x", "Héllo x"),
    ("a =?UTF-8?B?SMOp?= b", "a Hé b"),
    ("=?windows-1252?Q?=80_5?=", "€ 5"),
    ("=?koi8-r?B?8NLJ18XU?=", "Привет"),
    ("=?iso-2022-jp?B?GyRCRnxLXBsoQg==?=", "日本"),
    ("=?UTF-8*en?Q?ok?=", "ok"),
    ("=?x-unknown?Q?ab?=", "=?x-unknown?Q?ab?="),
    ("=?UTF-8?B?SMOpbGxv", "=?UTF-8?B?SMOpbGxv"),
    ("50% + 1 = 51", "50% + 1 = 51"),
    ("=?UTF-8?Q?50%_+_1?=", "50% + 1"),
    ("a folded\r\n subject", "a folded subject"),
    ("raw ütf-8", "raw ütf-8"),
    ("", ""),
]

BODIES = [
    # content headers, body bytes, text
    ([], b"plain\r\n", "plain\r\n"),
    ([], b"", ""),
    (["Content-Type: text/plain; charset=UTF-8"], "grün\nß".encode(), "grün\nß"),
    (["Content-Type: text/plain; charset=ISO-8859-1"], "grün".encode("latin-1"), "grün"),
    (['Content-Type: text/plain;\r\n charset="windows-1252"'], "5 €".encode("cp1252"), "5 €"),
    (["Content-Type: text/plain; charset=shift_jis"], "日本".encode("shift_jis"), "日本"),
    (["Content-Type: text/plain; charset=utf-16"], "日本".encode("utf-16"), "日本"),
    (["Content-Type: text/plain; charset=UTF-8"], b"a\xffb", "a�b"),
    (["Content-Type: text/plain; charset=nonsense"], "grün".encode(), "grün"),
    (["Content-Transfer-Encoding: base64"], b"Z3LDvG4=\r\n", "grün"),
    (["Content-Transfer-Encoding: BASE64 "], b"Z3LD\r\nvG4", "grün"),
    (["Content-Transfer-Encoding: base64"], b"!Z3L*Dv G4=?", "grün"),
    (["Content-Transfer-Encoding: quoted-printable"], b"gr=C3=BCn =\r\nx\r\n100% a+b", "grün x\r\n100% a+b"),
    (["Content-Transfer-Encoding: quoted-printable"], b"gr=c3=bcn  \t\r\nno =ZZ esc", "grün\r\nno =ZZ esc"),
    (["Content-Transfer-Encoding: quoted-printable", "Content-Type: text/plain; charset=iso-8859-1"],
     b"gr=FCn =80", "grün \x80"),
    (["Content-Transfer-Encoding: 8bit"], "grün".encode(), "grün"),
    (['Content-Type: multipart/mixed; boundary="b"'], b"--b\r\n\r\nx\r\n--b--\r\n", "--b\r\n\r\nx\r\n--b--\r\n"),
]
