"""Brown class-based bigrams: exchange clustering puts words into classes; transitions and emissions score texts.

Frequent words and groups of endings are exchanged first, in the driver. That gives every word a class to begin with.
Then every word of the vocabulary, however rare, goes to the class that its own neighbours make likeliest: tasks sum the
classes that stand before and after each of their words, Spark brings the sums of a word together, and a bucket of words
is placed at a time. The classes of all words stay in Spark; those of a text's rare words come by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mailspark.llm.common import fold, mix, prefix_hashes, prepare, slices, span_hashes, stage, sums, utf8

#: Stands after the last word of every text; no word can be it, as words hold no white space.
END = " "
#: Bytes of text whose words a task holds at once.
HELD_BYTES = 4 << 20
#: Tokens whose words are placed together, in expectation, and words whose sums are held at once.
BUCKET_TOKENS, PLACED = 1 << 20, 1 << 13


@dataclass(frozen=True)
class Settings:
    """``classes`` of words. To begin with, ``frequent`` words are exchanged each on its own and all others in ``tails``
    groups by their last letters, which also are the classes of unseen words; then each word is placed on its own.
    ``listed`` words have their classes and counts in every task, the others by joins, with the same results."""

    frequent: int = 384
    tails: int = 128
    classes: int = 48
    passes: int = 4
    listed: int = 50_000
    smoothing: float = 0.1


def tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch, the number of each token's word there, and the offsets of the texts.

    A-Z are lower-cased; the end of a text is the token ``END``. Null is an empty text.
    """
    column = pc.ascii_lower(pc.fill_null(column, ""))  # before the cast, which leaves a slice with offsets it misreads
    parts = pc.ascii_split_whitespace(column.cast(pa.large_string()))
    words, at = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    empty = np.append(0, np.cumsum(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)))
    words = words.filter(pc.greater(pc.binary_length(words), 0))
    at = at - empty[at]  # white space at the ends leaves empty parts
    coded = words.dictionary_encode()
    code = np.insert(coded.indices.to_numpy().astype(np.int64), at[1:], len(coded.dictionary))
    known = pa.concat_arrays([coded.dictionary.cast(pa.large_string()), pa.array([END], pa.large_string())])
    return known, code, at + np.arange(len(at))


def tail_of(words: pa.Array, s: Settings) -> np.ndarray:
    """The group of a word that is not frequent: a hash of its last four bytes."""
    data, offsets = utf8(words)
    ends = span_hashes(prefix_hashes(data), np.maximum(offsets[:-1], offsets[1:] - 4), offsets[1:])
    return (mix(ends) % np.uint64(s.tails)).astype(np.int64)


def units(words: pa.Array, top: pa.Array, s: Settings) -> np.ndarray:
    """The unit of each word that is clustered: its tail group, or after these its own number if it is in ``top``."""
    found = pc.index_in(words, value_set=top).fill_null(-1).to_numpy(zero_copy_only=False)
    return np.where(found >= 0, s.tails + found.astype(np.int64), tail_of(words, s))


def before(now: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What stands before each token; before the first of a text, its end."""
    out = np.empty_like(now)
    out[1:] = now[:-1]
    out[offsets[:-1]] = now[offsets[1:] - 1]
    return out


def after(now: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What stands after each token; after the end of a text, its first."""
    out = np.empty_like(now)
    out[:-1] = now[1:]
    out[offsets[1:] - 1] = now[offsets[:-1]]
    return out


def _blobs(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values."""
    offsets = pa.py_buffer((cut * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _array(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as one array, and the offsets of the rows in it."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]].view(kind), (offsets - offsets[0]) // kind.itemsize


def count_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``n`` over all texts; batches sum their own words before they are shuffled."""
    prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", HELD_BYTES):
            words, code, _ = tokens(batch.column("t"))
            n = np.bincount(code, minlength=len(words))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n)], ["word", "n"])

    rows = documents.select(F.col(text).alias("t")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def count_pairs(documents: DataFrame, top: list[str], s: Settings, text: str = "text") -> np.ndarray:
    """How often each unit follows each over all texts; an end stands before every text.

    A task sends its matrix (at most units squared numbers, as (a, b, n)); Spark adds them up.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(top)
    size = s.tails + len(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(shared.value, pa.large_string())
        seen = np.zeros(size * size, np.int64)
        for batch in slices(batches, "t", HELD_BYTES):
            words, code, offsets = tokens(batch.column("t"))
            now = units(words, listed, s)[code]
            seen += np.bincount(before(now, offsets) * size + now, minlength=size * size)
        yield _matrix(seen, size)

    return _add(documents.select(F.col(text).alias("t")).mapInArrow(run, "a int, b int, n long"), size)


def _matrix(seen: np.ndarray, size: int) -> pa.RecordBatch:
    at = np.flatnonzero(seen)
    columns = [pa.array((at // size).astype(np.int32)), pa.array((at % size).astype(np.int32)), pa.array(seen[at])]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "n"])


def _add(rows: DataFrame, size: int) -> np.ndarray:
    found = rows.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((size, size))
    out[found["a"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int, passes: int) -> np.ndarray:
    """The class of each unit: every unit in turn moves to the class that raises the likelihood of the pairs most.

    With N(c, d) pairs of classes and N(c), N(d) their sums, the log-likelihood is the sum of N log N over pairs less
    that over both sums, up to a constant. Units start by frequency rank modulo the number of classes. Ties go to the
    class with the smallest number; it ends when no unit moves or after ``passes`` rounds.
    """
    size = len(pairs)
    order = np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")
    own = np.empty(size, np.int64)
    own[order] = np.arange(size) % classes
    one = np.zeros((size, classes))
    one[np.arange(size), own] = 1
    out = pairs @ one  # units by following class
    into = pairs.T @ one  # units by class before
    both = one.T @ out
    left, right = pairs.sum(1), pairs.sum(0)
    for _ in range(passes):
        moved = 0
        for u in order:
            if not left[u] and not right[u]:
                continue
            c, self_pairs = own[u], pairs[u, u]
            row, column = out[u].copy(), into[u].copy()  # without the unit's pairs with itself
            row[c] -= self_pairs
            column[c] -= self_pairs
            rest = both.copy()
            rest[c] -= row
            rest[:, c] -= column
            rest[c, c] -= self_pairs
            gain = (_xlogx(rest + row) - _xlogx(rest)).sum(1) + (_xlogx(rest + column[:, None]) - _xlogx(rest)).sum(0)
            diagonal = np.diag(rest)
            gain += _xlogx(diagonal + row + column + self_pairs) - _xlogx(diagonal + row) - _xlogx(diagonal + column) + _xlogx(diagonal)
            rows, columns = both.sum(1), both.sum(0)
            rows[c] -= left[u]
            columns[c] -= right[u]
            gain -= _xlogx(rows + left[u]) - _xlogx(rows) + _xlogx(columns + right[u]) - _xlogx(columns)
            to = int(np.argmax(np.round(gain, 6)))
            if to != c and gain[to] > gain[c] + 1e-6:
                rest[to] += row
                rest[:, to] += column
                rest[to, to] += self_pairs
                both, own[u] = rest, to
                for table, counts in ((out, pairs[:, u]), (into, pairs[u])):
                    table[:, c] -= counts
                    table[:, to] += counts
                moved += 1
        if not moved:
            break
    return own


def place(documents: DataFrame, top: list[str], own: np.ndarray, both: np.ndarray, tokens_in_all: int, s: Settings, text: str = "text") -> DataFrame:
    """``word``, ``n``, ``c``: every word of the texts, its count and the class that its neighbours make likeliest.

    Neighbours have the classes ``own`` of their units, ``both`` counts pairs of these classes. A word goes where the
    sum of log P(class before it | class) + log P(class after it | class) is largest, which is what the likelihood of
    all pairs gains to first order; ties, to the ninth decimal a token, go to the class with the smallest number. A
    task sends what stands around each of its words once for 4 MB of text, so a common word is no bucket's burden.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((top, own))
    width, buckets = 2 * s.classes, max(1, -(-tokens_in_all // BUCKET_TOKENS))
    kind = np.min_scalar_type(width)
    likely = np.log(both + s.smoothing)
    ends = np.log(both.sum(0) + s.smoothing * s.classes), np.log(both.sum(1) + s.smoothing * s.classes)
    gains = np.concatenate([likely - ends[0], likely.T - ends[1]])  # by class before, then by class after

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, own = shared.value
        listed = pa.array(top, pa.large_string())
        for batch in slices(batches, "t", HELD_BYTES):
            words, code, offsets = tokens(batch.column("t"))
            data, at = utf8(words)
            bucket = (mix(span_hashes(prefix_hashes(data), at[:-1], at[1:])) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            place_of = np.empty(len(order), np.int64)
            place_of[order] = np.arange(len(order))
            now, base = own[units(words, listed, s)][code], place_of[code] * width
            key, n = np.unique(np.concatenate([base + before(now, offsets), base + s.classes + after(now, offsets)]), return_counts=True)
            word, bucket = key // width, bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            cut = np.append(first, len(bucket))
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), words.take(pa.array(order)).cast(pa.string()))
            at = np.searchsorted(word, cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[first]), pc.binary_join(lists, "\n"), _blobs(np.bincount(word, minlength=len(words)).astype(kind), cut),
                 _blobs((key % width).astype(kind), at), _blobs(n.astype(np.int32), at)], ["bucket", "words", "many", "context", "n"])

    def choose(table: pa.Table) -> pa.Table:
        lists = pc.split_pattern(pa.concat_arrays(table.column("words").chunks), "\n")  # no word holds white space
        found = lists.flatten().dictionary_encode()
        many, context, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("many", kind), ("context", kind), ("n", np.int32)))
        word = np.repeat(found.indices.to_numpy().astype(np.int64), many)
        order = np.argsort(word, kind="stable")
        word, context, n = word[order], context[order].astype(np.int64), n[order]
        size = len(found.dictionary)
        count, c = np.zeros(size, np.int64), np.zeros(size, np.int32)
        for a in range(0, size, PLACED):
            lo, hi = np.searchsorted(word, (a, a + PLACED))
            held = min(PLACED, size - a)
            sums = np.bincount((word[lo:hi] - a) * width + context[lo:hi], n[lo:hi], held * width).reshape(held, width)
            times = sums[:, : s.classes].sum(1)
            count[a : a + held] = times
            c[a : a + held] = np.argmax(np.round(sums @ gains / times[:, None], 9), axis=1)
        return pa.table({"word": found.dictionary.cast(pa.string()), "n": pa.array(count), "c": pa.array(c)})

    rows = documents.select(F.col(text).alias("t")).mapInArrow(around, "bucket long, words string, many binary, context binary, n binary")
    return rows.groupBy("bucket").applyInArrow(choose, "word string, n long, c int")


@dataclass(frozen=True)
class Classes:
    """The table of all words with their counts and classes, in Spark; the same of listed words, and classes of the tail
    groups, in the driver; log10 of the emission denominators."""

    settings: Settings
    words: DataFrame
    tails: np.ndarray
    below: np.ndarray
    listed: list[str]
    counts: np.ndarray
    kinds: np.ndarray
    train_tokens: int
    vocabulary: int


@dataclass(frozen=True)
class Model:
    """Classes of all words, and log10 of the transitions between classes."""

    classes: Classes
    steps: np.ndarray

    @cached_property
    def _collected(self) -> list:
        return self.classes.words.orderBy("word").collect()

    @property
    def top(self) -> list[str]:
        """All words in the driver, for a look at a small vocabulary."""
        return [r["word"] for r in self._collected]

    @property
    def own(self) -> np.ndarray:
        """The classes of the units if ``top`` is all words: of the tail groups, then of the words."""
        return np.append(self.classes.tails, [r["c"] for r in self._collected]).astype(np.int64)


def learn(documents: DataFrame, settings: Settings = Settings(), text: str = "text") -> Classes:
    """Counts and classes of all words of the texts.

    The driver gets the words that occur at least 2^k times, with the smallest k of which there are at most ``listed``
    (ties of the most frequent in alphabetical order), and the matrix of unit pairs: both of a bounded size.
    """
    s = settings
    counts = stage(count_words(documents, text), "counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("k")).count().orderBy(F.desc("k")).collect()
    least, held = 1 << 62, 0
    for r in sizes:  # at most 63 rows
        held += r["count"]
        if held > s.listed:
            break
        least = 1 << r["k"]
    most = sorted(counts.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    top = [END, *[r["word"] for r in most if r["word"] != END][: s.frequent - 1]]
    pairs = count_pairs(documents, top, s, text)
    own = exchange(pairs, s.classes, s.passes)
    one = np.zeros((len(own), s.classes))
    one[np.arange(len(own)), own] = 1
    words = stage(place(documents, top, own, one.T @ pairs @ one, n, s, text), "words")
    size, distinct = np.zeros(s.classes), np.zeros(s.classes)
    for r in words.groupBy("c").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        size[r["c"]], distinct[r["c"]] = r["n"], r["v"]
    below = np.log10(size + s.smoothing * (distinct + 1))
    most = sorted(words.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    listed, kinds = [r["word"] for r in most], np.array([r["c"] for r in most], np.int64)
    return Classes(s, words, own[: s.tails], below, listed, np.array([r["n"] for r in most], float), kinds, n, v)


def classify(documents: DataFrame, classes: Classes, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_tokens``, ``n_known``, ``__above`` (sum of log10 of the smoothed counts) and
    ``__classes``, the classes of the tokens.

    Tasks know the listed words; counts and classes of all others come by a join, so that the vocabulary may be of any
    size. An unseen word has the class of its tail group.
    """
    spark = documents.sparkSession
    prepare(spark)
    s = classes.settings
    shared = spark.sparkContext.broadcast((classes.listed, classes.counts, classes.kinds, classes.tails))
    rows = documents.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in documents.select(*keep).schema)
    kind, number = np.min_scalar_type(s.classes), np.dtype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts, kinds, tails = shared.value
        listed, counts, kinds = pa.array(listed, pa.large_string()), np.append(counts, 0.0), np.append(kinds, s.classes)
        for batch in slices(batches, "__text", HELD_BYTES):
            words, code, offsets = tokens(batch.column("__text"))
            at = pc.index_in(words, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False)
            known = (at >= 0)[code]
            above = np.where(at >= 0, np.log10(counts[at] + s.smoothing), 0.0)[code]
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))[~known]
            pair, rare = np.unique((row << 32) | code[~known], return_inverse=True)  # the rare words of each text
            cut = np.append(0, np.cumsum(np.bincount(pair >> 32, minlength=batch.num_rows)))
            many = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows)))
            words = words.take(pa.array(pair & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(np.diff(offsets)), pa.array(sums(known.astype(np.int64), offsets)),
                 pa.array(sums(above, offsets)), _blobs(kinds[at].astype(kind)[code], offsets),
                 _blobs((rare.ravel() - cut[row]).astype(number), many), _blobs(tails[tail_of(words, s)].astype(kind), cut),
                 pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), words.cast(pa.string()))],
                [*keep, "n_tokens", "__listed", "__above", "__classes", "__rare", "__spare", "__words"])

    schema = f"{types}n_tokens long, __listed long, __above double, __classes binary, __rare binary, __spare binary, __words array<string>"
    parts = stage(rows.mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id()), "parts")
    rare = parts.select("__row", F.posexplode("__words").alias("k", "word")).join(classes.words, "word")
    found = rare.groupBy(F.col("__row").alias("__of")).agg(F.collect_list(F.struct("k", "c", "n")).alias("__found"))
    whole = parts.drop("__words").join(found, F.col("__row") == F.col("__of"), "left").drop("__row", "__of")

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__classes", HELD_BYTES):
            now, offsets = _array(batch.column("__classes"), kind)
            rare, many = _array(batch.column("__rare"), number)
            own, cut = _array(batch.column("__spare"), kind)
            own, n = own.copy(), np.zeros(len(own), np.int64)
            lists = batch.column("__found")
            held = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            k, c, times = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            at = np.repeat(cut[:-1], held) + k
            own[at], n[at] = c, times
            at = np.repeat(cut[:-1], np.diff(many)) + rare
            now = now.copy()
            now[now == s.classes] = own[at]
            known = batch.column("__listed").to_numpy() + sums((n[at] > 0).astype(np.int64), many)
            above = batch.column("__above").to_numpy() + sums(np.log10(n[at] + s.smoothing), many)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), batch.column("n_tokens"), pa.array(known), pa.array(above), _blobs(now, offsets)],
                [*keep, "n_tokens", "n_known", "__above", "__classes"])

    return stage(whole.mapInArrow(complete, f"{types}n_tokens long, n_known long, __above double, __classes binary"), "classes")


def finish(classes: Classes, classified: DataFrame) -> Model:
    """The model with transitions counted in the classified texts; a task sends its matrix of classes."""
    s = classes.settings
    kind = np.min_scalar_type(s.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(s.classes**2, np.int64)
        for batch in slices(batches, "__classes", HELD_BYTES):
            now, offsets = _array(batch.column("__classes"), kind)
            now = now.astype(np.int64)
            seen += np.bincount(before(now, offsets) * s.classes + now, minlength=s.classes**2)
        yield _matrix(seen, s.classes)

    both = _add(classified.select("__classes").mapInArrow(run, "a int, b int, n long"), s.classes)
    return Model(classes, np.log10((both + s.smoothing) / (both.sum(1, keepdims=True) + s.smoothing * s.classes)))


def train(documents: DataFrame, settings: Settings = Settings(), text: str = "text") -> tuple[Model, DataFrame]:
    """A model and the table of all words with their counts and classes, which stays in Spark."""
    classes = learn(documents, settings, text)
    return finish(classes, classify(documents, classes, [], text)), classes.words


def rate(classified: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    m, s = model.classes, model.classes.settings
    shared = classified.sparkSession.sparkContext.broadcast((model.steps, m.below))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in classified.select(*keep).schema)
    kind = np.min_scalar_type(s.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, below = shared.value
        for batch in slices(batches, "__classes", HELD_BYTES):
            now, offsets = _array(batch.column("__classes"), kind)
            part = sums(steps[before(now, offsets), now] - below[now], offsets)
            columns = [*(batch.column(k) for k in (*keep, "n_tokens", "n_known", "__above")), pa.array(part)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_tokens", "n_known", "__above", "__part"])

    out = classified.mapInArrow(run, f"{types}n_tokens long, n_known long, __above double, __part double")
    floor = float(np.log10(m.train_tokens + 0.1 * (m.vocabulary + 1)))
    return out.select(
        *keep, "n_tokens", "n_known", F.lit(m.train_tokens).cast("long").alias("train_tokens"),
        (F.col("__above") - F.col("n_tokens") * floor).alias("base_score"), (F.col("__above") + F.col("__part")).alias("score"),
    )


def score(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    P(word | word before) = P(class | class before) P(word | class), both smoothed, one unseen word per class
    included. A null or empty text is its end alone; repeated rows are scored each.
    """
    return rate(classify(documents, model.classes, keep, text), model, keep)


def evaluate(documents: DataFrame, folds: int = 10, key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """Learn from the documents outside the held-out fold and score all; a null key is held out."""
    held: Column = F.coalesce(fold(key, folds) == 0, F.lit(True))
    classes = learn(documents.where(~held), settings)
    classified = classify(documents.select(key, held.alias("held_out"), "text"), classes, [key, "held_out"])
    return rate(classified, finish(classes, classified.where(~F.col("held_out"))), [key, "held_out"])
