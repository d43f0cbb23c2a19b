"""Phrases whose words stand together more often than their parts would: counted by rolling fingerprints.

Every n-gram of a text gets a Rabin-Karp fingerprint: the difference of two running sums of its words' hashes times
powers of a base. Tasks add up equal fingerprints where they find them, a shuffle adds up the tasks' sums, packed by
ranges of fingerprints. A phrase can only be frequent if the phrases within it are, so each length is screened by the frequent fingerprints of the length
before, as a bitmap of fixed size that knows them all and few others. Text is taken only in the end, of what is still
frequent: each task reads it at the first place where it met the fingerprint, holds all other places of that fingerprint
against it word by word, and the shuffle counts texts, so two phrases of one fingerprint cannot be mixed up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailspark.llm.common import POWERS, mix, prefix_hashes, prepare, slices, span_hashes, stage, utf8

UNDETERMINED = "und"
#: Bytes of text handled at once; longer texts are taken in pieces that overlap by a phrase.
TEXT_BYTES = 1 << 20
#: Bits of a screen, as a power of two: 16 MB. More frequent phrases than that only let more others pass.
SCREEN_BITS = 27
#: Text whose fingerprints one group adds up; groups are a power of two, at most 2^20.
GROUP_BYTES = 8 << 20
#: Fingerprints, and phrases, that a task collects before it adds them up and hands them on.
HELD, HELD_PHRASES = 1 << 20, 1 << 18
#: Parts of a language that are ranked on their own before their first phrases are ranked together.
SALTS = 256

_SPACE, _BREAK, _WORD = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GAP = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_SPELLED = ["g", "lang", "phrase", "c"]
_SALT = 0x9E3779B97F4A7C15


@dataclass
class Words:
    """The words of some texts: ``ids`` into ``names``, the ``run`` that all words of a phrase share, ``lang`` into ``langs``.

    ``counted`` marks words that begin phrases which count; the others do so in the next piece of their text.
    """

    ids: np.ndarray
    names: pa.Array
    run: np.ndarray
    lang: np.ndarray
    langs: list[str]
    counted: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray, langs: pa.Array, counted: np.ndarray) -> Words:
        """Words of texts that stand one after another; those that begin before ``counted`` bytes of a text count."""
        kind = _KIND[data]
        inside = kind == _WORD
        edge = np.empty(len(data), bool)
        if len(data):
            edge[0] = inside[0]
            edge[1:] = inside[1:] & ~inside[:-1]
            begins = offsets[:-1][offsets[:-1] < offsets[1:]]
            edge[begins] = inside[begins]
        starts = np.flatnonzero(edge)
        before = np.zeros(len(data) + 1, np.int64)
        np.cumsum(inside, out=before[1:])
        ends = np.append(before[starts], before[-1]).astype(np.int64)
        if ends[-1] >= 1 << 31:
            raise ValueError("texts of 2 GB at once")
        spelled = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(_LOWER[data[inside]])])
        coded = spelled.dictionary_encode()
        row = np.searchsorted(offsets, starts, side="right") - 1
        breaks = np.cumsum(kind == _BREAK)[starts] if len(starts) else starts
        run = breaks + row  # both rise along the texts, so that their sum rises wherever either does
        names = langs.dictionary_encode()
        return cls(
            coded.indices.to_numpy().astype(np.int64), coded.dictionary, run,
            names.indices.to_numpy().astype(np.int64)[row], names.dictionary.to_pylist(), starts - offsets[row] < counted[row],
        )

    @cached_property
    def _sums(self) -> np.ndarray:
        """Running sums of the words' hashes times powers of a base."""
        spans, data = _binary(self.names)
        own = span_hashes(prefix_hashes(data), spans[:-1], spans[1:]) + np.diff(spans).astype(np.uint64)
        up, _ = POWERS.get(len(self.ids) + 1)
        sums = np.zeros(len(self.ids) + 1, np.uint64)
        np.cumsum(mix(own)[self.ids] * up[:-1], out=sums[1:])
        return sums

    def fingerprints(self, n: int, all_words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of ``n`` words begin that count, and their fingerprints, which also tell languages apart."""
        at = np.arange(max(len(self.ids) - n + 1, 0))
        at = at[(self.run[at] == self.run[at + n - 1]) & (self.counted[at] | all_words)]
        tongue = np.array([_text_hash(x) for x in self.langs], np.uint64)
        _, down = POWERS.get(len(self.ids) + 1)
        rolled = (self._sums[at + n] - self._sums[at]) * down[at]
        return at, mix(rolled + tongue[self.lang[at]] + np.uint64(_SALT * n & (1 << 64) - 1))


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary array that is no slice."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[: len(column) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)


def _text_hash(text: str) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    return int(span_hashes(prefix_hashes(data), np.zeros(1, np.int64), np.array([len(data)]))[0]) ^ len(data)


class Screen:
    """A bitmap of fingerprints: it holds every one it was made of, and few others."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @classmethod
    def of(cls, words: DataFrame, bits: int) -> Screen:
        """From the columns ``i`` and ``w``, words of the bitmap; at most 2^(bits - 6) rows come to the driver."""
        rows, out = words.toArrow(), np.zeros(max(1, 1 << (bits - 6)), np.int64)
        np.bitwise_or.at(out, rows["i"].to_numpy(), rows["w"].to_numpy())
        return cls(bits, out.view(np.uint64))

    def holds(self, prints: np.ndarray) -> np.ndarray:
        place = prints >> np.uint64(64 - self.bits)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Words]:
    """Words of a few texts at a time; of a long text piece by piece, each with the words that follow it."""
    for batch in slices(batches, "text", TEXT_BYTES):
        langs = batch.column("lang")
        data, offsets = utf8(batch.column("text"))
        if len(data) <= 2 * TEXT_BYTES:
            yield Words.of(data, offsets, langs, np.diff(offsets))
            continue
        text, at = data.tobytes(), 0  # one row: `slices` puts no others with it
        tail = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}" % (most - 1))
        while at < len(text):
            gap = _GAP.search(text, at + TEXT_BYTES)
            to = gap.start() if gap else len(text)  # no word is cut
            end = tail.match(text, to).end()
            data = np.frombuffer(text, np.uint8)[at:end]
            yield Words.of(data, np.array([0, end - at]), langs.slice(0, 1), np.array([to - at]))
            at = to


def _passing(words: Words, n: int, screens: list[Screen]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of ``n`` words that pass their own screen, if there is one, and within which all of a word less pass."""
    at, prints = words.fingerprints(n)
    if len(screens) >= n:
        keep = screens[n - 1].holds(prints)
        at, prints = at[keep], prints[keep]
    if n > 1:
        where, inner = words.fingerprints(n - 1, all_words=True)
        fine = np.zeros(len(words.ids) + 1, bool)
        fine[where] = screens[n - 2].holds(inner)
        keep = fine[at] & fine[at + 1]
        at, prints = at[keep], prints[keep]
    return at, prints


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: all first bytes, all second bytes, and so on, which compresses well for small ones."""
    return numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def _ends(sorted_prints: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups that fingerprints fall in, by their first bits, and where each group ends."""
    group = (sorted_prints >> np.uint64(64 - groups)).astype(np.int64) if groups else np.zeros(len(sorted_prints), np.int64)
    last = np.flatnonzero(np.append(group[1:] != group[:-1], True)) if len(group) else group
    return group[last], last + 1


def _frequent(documents: DataFrame, n: int, screens: list[Screen], most: int, least: int, groups: int, bits: int) -> DataFrame:
    """``i`` and ``w``: words of a bitmap of the fingerprints of ``n``-word phrases that pass and occur ``least`` times.

    A row of the shuffle has the fingerprints of a task in one of 2^``groups`` ranges, as differences in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            prints, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            group, ends = _ends(prints, groups)
            cut = list(zip(np.append(0, ends[:-1]) if len(ends) else ends, ends))
            steps = [_planes(np.diff(prints[a:b], prepend=np.uint64(0))) for a, b in cut]
            return pa.RecordBatch.from_arrays([pa.array(group), pa.array(steps, pa.binary()), pa.array([_planes(counts[a:b]) for a, b in cut], pa.binary())], ["g", "fp", "c"])

        for words in _texts(batches, most):
            held.append(_passing(words, n, screens)[1])
            if sum(map(len, held)) >= HELD:
                yield flush()
        yield flush()

    def add(rows: pa.Table) -> pa.Table:
        prints = np.concatenate([np.cumsum(_from_planes(x), dtype=np.uint64) for x in rows["fp"].to_pylist()])
        counts = np.concatenate([_from_planes(x) for x in rows["c"].to_pylist()])
        prints, place = np.unique(prints, return_inverse=True)
        total = np.zeros(len(prints), np.uint64)
        np.add.at(total, place, counts)
        place = np.unique(prints[total >= np.uint64(least)] >> np.uint64(64 - bits))
        words, at = np.unique(place >> np.uint64(6), return_inverse=True)
        out = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(out, at, np.uint64(1) << (place & np.uint64(63)))
        return pa.table({"i": words.astype(np.int32), "w": out.view(np.int64)})

    return documents.mapInArrow(run, "g long, fp binary, c binary").groupBy("g").applyInArrow(add, "i int, w long")


def _phrases(documents: DataFrame, screens: list[Screen], most: int, least: int, groups: int) -> DataFrame:
    """``lang``, ``phrase``, ``len``, ``c``: words and phrases that pass and occur ``least`` times, as text.

    ``len`` 0 has the number of all words of a language. A row of the shuffle has the phrases of one language that a
    task has met in a range of fingerprints, in order and compressed; texts are added up, not fingerprints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            held.clear()
            return _packed(rows.group_by(["g", "lang", "phrase"], use_threads=False).aggregate([("c", "sum")]).sort_by([("g", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]))

        for words in _texts(batches, most):
            n = np.bincount(words.lang[words.counted], minlength=len(words.langs))
            none = pa.array([b""] * len(n), pa.large_binary())
            held.append(pa.RecordBatch.from_arrays([pa.array([0] * len(n)), pa.array(words.langs, pa.string()), none, pa.array(n)], _SPELLED))
            for n in range(1, most + 1):
                held.append(_spelled(words, n, *_passing(words, n, screens), groups))
            if sum(b.num_rows for b in held) >= HELD_PHRASES:
                yield flush()
        if held:
            yield flush()

    def add(rows: pa.Table) -> pa.Table:
        out = []
        for lang in rows["lang"].unique().to_pylist():
            own = rows.filter(pc.equal(rows["lang"], lang))
            texts = pa.concat_arrays([_lines(x.as_py(), n.as_py()) for x, n in zip(own["text"], own["size"])])
            counts = np.concatenate([_from_planes(x) for x in own["c"].to_pylist()])
            coded = texts.dictionary_encode()
            total = np.zeros(len(coded.dictionary), np.uint64)
            np.add.at(total, coded.indices.to_numpy(), counts)
            keep = (total >= np.uint64(least)) | pc.equal(coded.dictionary, b"\n").to_numpy(zero_copy_only=False)
            text = pc.binary_slice(coded.dictionary.filter(pa.array(keep)).cast(pa.binary()), 0, -1).cast(pa.string())
            size = pc.add(pc.count_substring(text, " "), pc.not_equal(text, "").cast(pa.int32()))
            out.append(pa.table({"lang": pa.array([lang] * len(text), pa.string()), "phrase": text, "len": size.cast(pa.int32()), "c": total[keep].astype(np.int64)}))
        return pa.concat_tables(out)

    packed = documents.mapInArrow(run, "g long, lang string, text binary, size long, c binary")
    return packed.groupBy("g").applyInArrow(add, "lang string, phrase string, len int, c long")


def _packed(rows: pa.Table) -> pa.RecordBatch:
    """One row for each group and language of sorted rows: its phrases as lines, compressed, and their numbers."""
    group, lang = rows["g"].to_numpy(), rows["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
    ends = np.flatnonzero(np.append((group[1:] != group[:-1]) | (lang[1:] != lang[:-1]), True)) + 1
    lines = pc.binary_join_element_wise(rows["phrase"], pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary())).combine_chunks()
    _, offsets, data = lines.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]
    counts, texts, sizes, numbers = rows["c_sum"].to_numpy(), [], [], []
    for a, b in zip(np.append(0, ends[:-1]), ends):
        text = data.slice(offsets[a], offsets[b] - offsets[a])
        sizes.append(text.size)
        texts.append(pa.compress(text, "zstd", asbytes=True))
        numbers.append(_planes(counts[a:b]))
    langs = rows["lang"].combine_chunks().take(pa.array(ends - 1))
    return pa.RecordBatch.from_arrays([pa.array(group[ends - 1]), langs, pa.array(texts, pa.binary()), pa.array(sizes, pa.int64()), pa.array(numbers, pa.binary())], ["g", "lang", "text", "size", "c"])


def _lines(packed: bytes, size: int) -> pa.Array:
    """The lines of a compressed text, with their ends."""
    data = pa.decompress(packed, size, "zstd")
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x0A) + 1
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), data])


def _spelled(words: Words, n: int, at: np.ndarray, prints: np.ndarray, groups: int = 0) -> pa.RecordBatch:
    """One row for each phrase: the text at its first place, and its places, all of them compared with the first."""
    order = np.argsort(prints, kind="stable")
    at, prints = at[order], prints[order]
    new = np.ones(len(at), bool)
    new[1:] = prints[1:] != prints[:-1]
    firsts = at[new][np.cumsum(new) - 1] if len(at) else at
    same = words.lang[at] == words.lang[firsts]
    for i in range(n):
        same &= words.ids[at + i] == words.ids[firsts + i]
    heads, group = at[new], prints[new]
    counts = np.add.reduceat(same, np.flatnonzero(new), dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    odd = at[~same]  # phrases that share a fingerprint with another: each place is a row
    heads, counts = np.concatenate([heads, odd]), np.concatenate([counts, np.ones(len(odd), np.int64)])
    group = np.concatenate([group, prints[~same]])
    group = (group >> np.uint64(64 - groups)).astype(np.int64) if groups else np.zeros(len(group), np.int64)
    parts = [words.names.take(pa.array(words.ids[heads + i])).cast(pa.large_binary()) for i in range(n)]
    text = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
    langs = pa.array(words.langs, pa.string()).take(pa.array(words.lang[heads]))
    return pa.RecordBatch.from_arrays([pa.array(group), langs, text, pa.array(counts)], _SPELLED)


def _cut(left: bool, k: Column) -> Column:
    """The first ``k`` words of ``w``, or the others."""
    return F.array_join(F.slice("w", 1, k) if left else F.slice("w", k + 1, F.size("w") - k), " ")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a^2 / (l r)), exact for counts below 10^16."""
    exact = [c.cast("decimal(16,0)") for c in (a, left, right)]
    return F.call_function("div", exact[0] * exact[0] * F.lit(1_000_000).cast("decimal(7,0)"), exact[1] * exact[2])


def mine(
    documents: DataFrame, lang: str = "lang", text: str = "text", most: int = 3, least: int = 10, percent: int = 50, first: int = 2000,
    screen_bits: int = SCREEN_BITS,
) -> DataFrame:
    """The ``first`` phrases of 2 to ``most`` words of each language: ``lang rank phrase a l r n score``.

    A-Z is lower-cased. Phrases lie within pieces (between ``.,;:!?`` and line ends), words are runs without space and
    tab. ``n`` counts all words of a language, ``a`` all places of a phrase; those with ``a`` of ``least`` or more are
    candidates. Of its cuts into two the one of the lowest score counts, the earlier of equal ones, with ``l`` and ``r``
    the places of its parts. Dropped are candidates within a longer candidate that has ``percent`` of their places.
    Order: score and ``a`` descending, then the phrase by its bytes. A null or empty text has no words; a null language
    is 'und', alike with one of that name; repeated rows count each; without rows, words or candidates there is no
    result. Texts of any length are taken in pieces of about 1 MB that overlap by a phrase.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = min(max(size // GROUP_BYTES, 1).bit_length(), 20)
    screens: list[Screen] = []
    for n in range(1, most + 1):
        screens.append(Screen.of(_frequent(rows, n, screens, most, least, groups, screen_bits), screen_bits))
    counts = stage(_phrases(rows, screens, most, least, groups), "phrases")
    return _ranked(counts.where("len > 0"), counts.where("len = 0").select("lang", F.col("c").alias("n")), percent, first)


def _ranked(counts: DataFrame, totals: DataFrame, percent: int, first: int) -> DataFrame:
    part = lambda side: counts.select(F.col("lang").alias(f"lang_{side}"), F.col("phrase").alias(side), F.col("c").alias(f"c_{side}"))
    candidates = counts.where("len > 1").withColumn("w", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("c").alias("a"), "k", _cut(True, F.col("k")).alias("left_part"), _cut(False, F.col("k")).alias("right_part"))
    for side in ("left_part", "right_part"):
        cuts = cuts.join(part(side).withColumnRenamed(side, f"of_{side}"), (F.col("lang") == F.col(f"lang_{side}")) & (F.col(side) == F.col(f"of_{side}")))
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("c_left_part"), F.col("c_right_part")))
    best = F.min(F.struct("score", "k", F.col("c_left_part").alias("l"), F.col("c_right_part").alias("r"))).alias("x")
    scored = cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    # the most frequent longer phrase around each
    within = F.expr("flatten(transform(sequence(2, len - 1), m -> transform(sequence(1, len - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inner = candidates.where("len > 2").select(F.col("lang").alias("lang_in"), F.col("c").alias("around"), F.explode(within).alias("inner"))
    inner = inner.groupBy("lang_in", "inner").agg(F.max("around").alias("around"))
    scored = scored.join(inner, (F.col("lang") == F.col("lang_in")) & (F.col("phrase") == F.col("inner")), "left")
    kept = scored.where(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first)
    top = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    named = totals.withColumnRenamed("lang", "lang_of")
    out = top.join(named, F.col("lang") == F.col("lang_of"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
