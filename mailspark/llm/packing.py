"""Best-fit packing of token sequences: exact complements first, best fit for what they leave."""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from mailspark.llm.common import prepare, slices, stage

#: A space next to white space or at an end of the text: such texts are encoded whole, not word by word.
_ODD_SPACES = (
    r"^ | $| [\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


#: Words whose ids a Python worker keeps from one batch to the next, and then starts anew.
KEPT_WORDS = 250_000
#: Words that are encoded at once; the tokenizer's own results are large.
_AT_ONCE = 10_000


class Vocabulary:
    """A tokenizer with the ids of the words it has met, laid out in one array.

    A word stands for itself with a space before it, or, as ``lead``, at the start of a text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that begin with a space
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.spaced[i] = token.startswith("Ġ")
        self._clear()

    def _clear(self) -> None:
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, words: list[str], lead: bool) -> None:
        if lead:
            found = self.encode(words)
            sizes, ids = np.array([len(f) for f in found]), np.concatenate(found)
        else:  # all in one text: each begins with the one id that begins with a space
            (ids,) = self.encode(["".join(f" {w}" for w in words)])
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(words):
                raise ValueError("this vocabulary does not begin every word after a space with a token of its own")
            sizes = np.diff(np.append(starts, len(ids)))
        self.known[lead].update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids)

    def numbers(self, follow: list[str], lead: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words are laid out, by their place in ``starts`` and ``sizes``."""
        if len(self.starts) > KEPT_WORDS:
            self._clear()
        for words, is_lead in ((follow, False), (lead, True)):
            new = [w for w in words if w not in self.known[is_lead]]
            for k in range(0, len(new), _AT_ONCE):
                self._add(new[k : k + _AT_ONCE], is_lead)
        return tuple(np.array([self.known[k][w] for w in words], np.int64) for k, words in ((0, follow), (1, lead)))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(column: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, ``end`` after each, and the offsets of the texts among them. Null is empty.

    A byte-level vocabulary splits text before any space that stands alone between visible characters, so each
    distinct word is encoded once and its ids are laid out wherever it occurs. A text that holds the name of an added
    token is encoded whole, as one with odd spaces is.
    """
    made = vocabulary(path)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    odd = pc.match_substring_regex(column, _ODD_SPACES).to_numpy(zero_copy_only=False)
    for name in made.added:
        odd = odd | pc.match_substring(column, name).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(odd), "", column)
    parts = pc.split_pattern(plain, " ")
    at = parts.offsets.to_numpy().astype(np.int64)
    words = parts.flatten().dictionary_encode()
    chunk = words.indices.to_numpy().astype(np.int64)
    n = len(words.dictionary)
    first = np.zeros(len(chunk), bool)
    first[at[:-1]] = True
    follow, lead = np.unique(chunk[~first]), np.unique(chunk[first])
    found = made.numbers(*(words.dictionary.take(pa.array(x)).to_pylist() for x in (follow, lead)))
    place, size = np.zeros(2 * n + 1, np.int64), np.zeros(2 * n + 1, np.int64)
    for where, number in ((follow, found[0]), (n + lead, found[1])):
        place[where], size[where] = made.starts[number], made.sizes[number]
    place[-1], size[-1] = len(made.ids), 1
    chunk[first] += n
    chunk = np.insert(chunk, at[1:], 2 * n)  # an end after each text
    at = at + np.arange(len(at))
    size, place = size[chunk], place[chunk]
    before = np.zeros(len(chunk) + 1, np.int64)
    np.cumsum(size, out=before[1:])
    ids = np.append(made.ids, np.uint32(end))[np.repeat(place - before[:-1], size) + np.arange(before[-1])]
    offsets = before[at]
    if odd.any():
        parts = np.split(ids, offsets[1:-1])
        for i in np.flatnonzero(odd):
            parts[i] = np.append(made.encode([column[int(i)].as_py()])[0], np.uint32(end))
        ids = np.concatenate(parts)
        offsets = np.append(0, np.cumsum([len(p) for p in parts]))
    return ids, offsets


def tokenize(
    documents: DataFrame, path: str, capacity: int, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``: a row per piece of at most ``capacity`` tokens.

    Of a longer document the first piece holds what is left over, all others ``capacity`` tokens.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 4 << 20):
            ids, offsets = encode(batch.column("__text"), path, end)
            ids = ids.astype("<u4")
            n = np.diff(offsets)
            count = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            shift = (-n) % capacity
            start = np.maximum(piece * capacity - shift[row], 0)
            stop = (piece + 1) * capacity - shift[row]
            crc = [zlib.crc32(ids[a:b].data) for a, b in zip(offsets[row] + start, offsets[row] + stop)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(stop - start), pa.array(crc, pa.int64())],
                [key, "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Slots of the sequences: of the pieces of one length, those numbered from ``rank`` on, ``count`` of them, go to
    sequences numbered from ``sequence`` on, at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by their length and their number among those of that length."""
        at = np.searchsorted((self.length << 44) | self.rank, (length << 44) | rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


class _Stock:
    """How many pieces of each length are left, and the sums that singles, pairs and triples of them make."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64)
        self._pairs: int | None = None

    def take(self, lengths: tuple[int, ...], n: int) -> None:
        for length in lengths:
            self.left[length] -= n
            if not self.left[length]:
                self._pairs = None

    def pair_sums(self) -> int:
        """Bit s is set if two lengths that are left add up to s."""
        if self._pairs is None:
            have = np.flatnonzero(self.left).tolist()
            single = sum(1 << x for x in have)
            self._pairs = 0
            for x in have:
                self._pairs |= single << x
        return self._pairs

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the pieces left can make this combination."""
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)

    def _pairs_of(self, total: int) -> Iterator[tuple[int, int]]:
        a = np.arange((total + 1) // 2, min(total, len(self.left)))
        for x in a[(self.left[a] > 0) & (self.left[total - a] > 0)][::-1].tolist():
            yield x, total - x

    def exact(self, gap: int) -> Iterator[tuple[int, ...]]:
        """Combinations of one, two or three lengths that are left and fill the gap."""
        if gap < len(self.left) and self.left[gap]:
            yield (gap,)
        if self.pair_sums() >> gap & 1:
            yield from self._pairs_of(gap)
        for x in np.flatnonzero(self.left[:gap])[::-1].tolist():
            rest = gap - x
            if 3 * x < gap:
                break
            if self.left[x] and self.pair_sums() >> rest & 1:
                for y, z in self._pairs_of(rest):
                    if y <= x:
                        yield x, y, z

    def largest(self, most: int) -> int:
        fits = np.flatnonzero(self.left[: most + 1])
        return int(fits[-1]) if len(fits) else 0


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """Sequences for so many pieces of each length (``counts[length]``).

    The longest pieces left open sequences. A gap is filled by combinations that fit it exactly, as often as the
    pieces last; if there is none, the longest piece that fits goes in and the smaller gap is tried again. Alike
    sequences are made together, so the work depends on the number of different lengths, not of pieces.
    """
    stock = _Stock(np.append(counts, np.zeros(max(0, capacity + 1 - len(counts)), np.int64)))
    made: list[tuple[tuple[int, ...], int]] = []
    while longest := stock.largest(capacity):
        n = -(-int(stock.left[longest]) // (capacity // longest))
        stock.take((longest,), n)
        todo = [((longest,), n)]
        while todo:
            held, n = todo.pop()
            gap = capacity - sum(held)
            while n and gap:
                found = 0
                for combination in stock.exact(gap):
                    if found := min(n, stock.times(combination)):
                        stock.take(combination, found)
                        made.append((held + combination, found))
                        n -= found
                        break
                if not found:
                    break
            if n and gap and (x := stock.largest(gap)):
                found = min(n, int(stock.left[x]))
                stock.take((x,), found)
                todo += [(held, n - found)] * (n > found) + [((*held, x), found)]
            elif n:
                made.append((held, n))
    used = np.zeros(len(stock.left), np.int64)
    slots, sequence = [], 0
    for lengths, n in made:
        offset = 0
        for x in lengths:
            slots.append((x, used[x], n, sequence, offset))
            used[x] += n
            offset += x
        sequence += n
    slots.sort()
    columns = np.array(slots, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequence)


def pack(
    documents: DataFrame, path: str, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text",
    pieces_per_group: int = 20_000,
) -> DataFrame:
    """Tokenise and pack documents: a row per piece with its ``sequence_id`` and ``offset`` there.

    Only the number of pieces of each length goes to the driver, which plans the sequences, and the plan goes back
    (five numbers per slot kind; their number follows from the lengths, not from the rows). Pieces of a length are
    numbered in groups of about ``pieces_per_group`` by a hash, so a length of any frequency spreads over tasks. A
    null or empty text is one token, the end. Rows that repeat are packed each; an empty table gives no rows.
    """
    spark = documents.sparkSession
    pieces = stage(tokenize(documents, path, capacity, end, key, text), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    shared = spark.sparkContext.broadcast(plan(counts, capacity))
    groups = max(1, -(-int(counts.sum()) // pieces_per_group))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(F.col(key).cast("string"), "piece", "ids_crc32"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = base.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy(key, "piece", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(base, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("rank") - 1 + F.col("base")).alias("rank"))

    names = [*pieces.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = shared.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], names)

    kind = pieces.schema[key].dataType.simpleString()
    return ranked.mapInArrow(
        place, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
