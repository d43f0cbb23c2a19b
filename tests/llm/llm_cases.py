"""Tables that every operator must bear: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random
import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, row int, digest string, fp long"
PAGES = "page_id long, url string, html string, host string, verdict string, k int"

_rng = random.Random(7)


def prose(n: int, words: str = "the of and to in thation ing erou sh whand ble ti") -> str:
    return " ".join(_rng.choice(words.split()) + _rng.choice(["", "", ",", "er", "s."]) for _ in range(n))


LONG = prose(20_000)
PASSAGE = prose(120)
TEXTS = [
    prose(40), None, "", " ", "\t\n x  y ", "Aa bB", "ÀÉ日本語 ümlaut Ω", "12 34 !! ??", PASSAGE, prose(30) + " " + PASSAGE + " " + prose(30),
    "word", "word", "word ", " word", LONG, LONG[:5000] + " changed " + LONG[5000:], "a" * 3000, "z" * 399, "z" * 399,
    prose(60) + "\n" + prose(60), prose(200), prose(200).upper(),
]
TEXTS.append(TEXTS[-2].replace(" ", "  "))


def documents(spark):
    """Rows of all texts; one twice with the same id, two without an id."""
    ids = list(range(len(TEXTS)))
    rows = [(i, TEXTS[i]) for i in ids] + [(8, TEXTS[8]), (None, TEXTS[8]), (None, "lost and found")]
    langs = ["en", "de", None]
    data = [(i, t, langs[n % 3], "s", None, 0.5, 1, "d", 9) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, DOCUMENTS).repartition(3)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def rows(frame, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def low(text):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))
