"""What each filter of a chain removes, in every order, from one pass over the texts.

A document that fails the filters F survives a subset S of them if S and F have none in common. Its survival word has
one bit for each of the 32 subsets of five filters. How many documents of a part survive each subset is a count per bit
position over the words of the part; carry-save adders count all positions of many words at once. Every order, step and
average over orders is then arithmetic on 32 numbers.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailspark.llm.common import prepare, slices, stage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Populations that are counted apart: all documents, those of good quality, toxic ones.
POPULATIONS = ("n", "good", "toxic")
#: Texts longer than this are split into words one at a time, so that memory follows their distinct words.
LONG_BYTES = 1 << 20
#: Parts whose words one task holds before it counts them.
PARTS_HELD = 1 << 10
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_NOT_UPPER = bytes(set(range(256)) - set(range(0x41, 0x5B)))
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = re.compile(rb"[#$%&*|]")

#: For each set of failed filters, the subsets of filters that a document survives, a bit each.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, a bit each."""
    if len(text) > LONG_BYTES:
        words, distinct = 0, set()
        for m in _WORD.finditer(text):
            words += 1
            distinct.add(m[0])
    else:
        found = text.split()  # of bytes: at ASCII white space
        words, distinct = len(found), set(found)
    points = len(text.translate(None, _CONTINUATION))
    upper = len(text.translate(None, _NOT_UPPER))
    a, b, c = words < 200, 100 * len(distinct) < 50 * words, 100 * upper > 2 * points
    return a | b << 1 | c << 2 | bool(_SYMBOLS.search(text)) << 3


def positional_counts(words: np.ndarray) -> np.ndarray:
    """For each of 32 bit positions, how many words have it.

    Three words of one weight become their sum of the same weight and a carry of twice the weight, a bit position apart
    from the others, until at most two words are left of each weight.
    """
    counts, layers, weight = np.zeros(32, np.int64), [words.astype(np.uint32)], 0
    while weight < len(layers):
        layer = layers[weight]
        while len(layer) > 2:
            third = len(layer) // 3
            a, b, c = layer[:third], layer[third : 2 * third], layer[2 * third : 3 * third]
            either = a ^ b
            carry = (a & b) | (c & either)
            layer = np.concatenate([either ^ c, layer[3 * third :]])
            if weight + 1 == len(layers):
                layers.append(carry)
            else:
                layers[weight + 1] = np.concatenate([layers[weight + 1], carry])
        for word in layer:
            counts += ((int(word) >> np.arange(32)) & 1) << weight
        weight += 1
    return counts


def _facts(documents: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``key``, ``part``, ``digest`` and ``failed`` of every document."""
    rows = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t.as_py() or b"" for t in batch.column("text")]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            masks = pa.array([failed(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), digests, masks], ["key", "part", "digest", "failed"])

    return rows.mapInArrow(run, "key long, part string, digest binary, failed int")


def _labelled(facts: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``facts`` with ``good`` and ``toxic``: whether any label of the key says so."""
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.groupBy(F.col(key).cast("long").alias("of")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    joined = facts.join(known.where("good or toxic"), F.col("key") == F.col("of"), "left")
    return joined.select(*facts.columns, *(F.coalesce(c, F.lit(False)).alias(c) for c in POPULATIONS[1:]))


def survivors(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per ``part`` with three arrays of 32 counts, ``n``, ``good`` and ``toxic``: survivors of each subset.

    Filters are bits, A the lowest. A fails under 200 words (runs without ASCII white space); B if less than half of the
    words are distinct; C if over 2 % of the code points are A-Z; D with any of ``#$%&*|``; E if a row with a smaller key
    has the identical text (by SHA-256), in any part. A null text is empty; a null part is ''. A row with a null key has
    no smaller key and is none, so it passes E; rows that repeat a key and its text stand or fall together. A key with
    several labels is good or toxic if any says so. Tables without rows give no parts. Very long texts are split one
    word at a time. Texts do not leave their task: only digests are shuffled, and the first key of each digest is
    joined back by digest and key, so that a third of all rows being copies burdens no task.
    """
    prepare(documents.sparkSession)
    facts = stage(_facts(documents, key, text, part), "facts")
    first = facts.groupBy("digest").agg(F.min("key").alias("least")).withColumnRenamed("digest", "same")
    joined = _labelled(facts, labels, key).join(first, (F.col("digest") == F.col("same")) & (F.col("key") == F.col("least")), "left")
    later = F.col("least").isNull() & F.col("key").isNotNull()
    mask = F.col("failed") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)
    return _counted(joined.select("part", mask.alias("failed"), *POPULATIONS[1:]))


def _counted(rows: DataFrame) -> DataFrame:
    """Positional counts of the survival words of each part; a task gives a row a part, which are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            counts = [[positional_counts(np.concatenate(held[p][k::3])).tolist() for p in held] for k in range(3)]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(c, pa.list_(pa.int64())) for c in counts)], ["part", *POPULATIONS])
            held.clear()
            return out

        size = 0
        for batch in batches:
            words = SURVIVAL[batch.column("failed").to_numpy()]
            member = [np.ones(len(words), bool), *(batch.column(c).to_numpy(zero_copy_only=False) for c in POPULATIONS[1:])]
            parts = batch.column("part").dictionary_encode()
            order = np.argsort(parts.indices.to_numpy(), kind="stable")
            ends = np.cumsum(np.bincount(parts.indices.to_numpy(), minlength=len(parts.dictionary)))
            for name, rows in zip(parts.dictionary.to_pylist(), np.split(order, ends[:-1])):
                held.setdefault(name, []).extend(words[rows[m[rows]]] for m in member)
            size += len(words)
            if len(held) > PARTS_HELD or size > 1 << 20:
                yield flush()
                size = 0
        if held:
            yield flush()

    per_task = rows.mapInArrow(run, "part string, n array<long>, good array<long>, toxic array<long>")
    sums = [F.sum(F.get(p, F.lit(s))).alias(f"{p}{s}") for p in POPULATIONS for s in range(SUBSETS)]
    added = per_task.groupBy("part").agg(*sums)
    return added.select("part", *(F.array(*(f"{p}{s}" for s in range(SUBSETS))).alias(p) for p in POPULATIONS))


def steps() -> list[tuple[str, int, int, int]]:
    """Every order of the filters, step by step: order, step from 1, its filter, the subset before it."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            own = FILTERS.index(name)
            out.append(("".join(order), i + 1, own, before))
            before |= 1 << own
    return out


def _over_orders(own: int) -> str:
    """What a filter removes, summed over all orders, as SQL: each set before it counts once for each order of that set
    and of the filters after it."""
    terms = []
    for before in range(SUBSETS):
        if not before >> own & 1:
            k = before.bit_count()
            ways = math.factorial(k) * math.factorial(len(FILTERS) - 1 - k)
            terms.append(f"(get(n, {before}) - get(n, {before | 1 << own})) * {ways}L")
    return " + ".join(terms)


def interactions(counts: DataFrame) -> DataFrame:
    """600 rows for each part of ``survivors``: every order of the five filters, every step of it.

    ``kept`` documents after the step, ``removed`` by it, ``redundant`` ones that fail its filter but were removed
    earlier, ``unique_fails`` that fail no other filter, ``good_lost`` and ``toxic_lost`` of the removed, ``shapley``,
    the filter's removals summed over all 120 orders.
    """
    shapley = F.expr(f"array({', '.join(_over_orders(own) for own in range(len(FILTERS)))})")
    fields = "struct('{}' AS filter_order, {} AS step, {} AS own, {} AS before)".format
    plan = F.expr(f"array({', '.join(fields(*x) for x in steps())})")
    rows = counts.withColumn("shapley", shapley).select("*", F.explode(plan).alias("x")).select("*", "x.*")
    bit = F.call_function("shiftleft", F.lit(1), F.col("own"))
    after = F.col("before").bitwiseOR(bit)
    n = lambda p, s: F.get(p, s)
    lost = lambda p: n(p, F.col("before")) - n(p, after)
    fails = n("n", F.lit(0)) - n("n", bit)
    return rows.select(
        "part", "filter_order", "step", n("n", after).alias("kept"), lost("n").alias("removed"), (fails - lost("n")).alias("redundant"),
        (n("n", F.lit(SUBSETS - 1).bitwiseXOR(bit)) - n("n", F.lit(SUBSETS - 1))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shapley", F.col("own")).alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The interactions of the five filters in each part of ``documents``; see ``survivors`` for odd rows."""
    return interactions(survivors(documents, labels, key, text, part))
