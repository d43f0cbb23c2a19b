"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailspark.llm.common import fold, mix, prepare, slices, sums

UNDETERMINED = "und"
_SPACE = np.uint32(32)
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str], bits: int, orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams of all texts, the offsets of the texts among them, and which have a letter.

    Texts are lower-cased, anything but letters becomes a space, and a space stands before and after each text.
    """
    texts = [f" {t.lower()} " for t in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    known = letters()[points]
    lettered = sums(known.astype(np.int64), offsets) > 0
    points = np.where(known, points, _SPACE).astype(np.uint64)
    for order in orders:
        n = max(len(points) - order + 1, 0)
        code = np.full(n, order, np.uint64)
        for k in range(order):
            code = code * np.uint64(0x100000001B3) + points[k : k + n]
        code = (mix(code) >> np.uint64(64 - bits)).astype(np.int64)
        inside = np.ones(n, bool)
        for k in range(1, order):  # n-grams that would reach into the next text
            at = offsets[1:-1] - k
            inside[at[(at >= 0) & (at < n)]] = False
        counts = np.zeros(n + 1, np.int64)
        np.cumsum(inside, out=counts[1:])
        yield code[inside], counts[np.minimum(offsets, n)], lettered


@dataclass(frozen=True)
class LanguageModel:
    """Log priors by language and log probabilities by (n-gram slot, language)."""

    languages: tuple[str, ...]
    priors: np.ndarray
    matrix: np.ndarray
    bits: int
    orders: tuple[int, ...]

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the likeliest language, its posterior probability, and whether the text has a letter."""
        total = np.tile(self.priors, (len(texts), 1))
        lettered = np.zeros(len(texts), bool)
        for code, offsets, lettered in grams(texts, self.bits, self.orders):
            for k in range(len(self.languages)):
                total[:, k] += sums(self.matrix[k][code].astype(np.float64), offsets)
        best = total.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), np.int64)
        if not len(self.languages):
            return best, np.zeros(len(texts)), lettered
        share = np.exp(total - total.max(axis=1, keepdims=True))
        return best, 1.0 / share.sum(axis=1), lettered


def train(
    documents: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    bits: int = 16,
    orders: tuple[int, ...] = (1, 2, 3),
    max_per_language: int = 8_000,
    smoothing: float = 0.5,
) -> LanguageModel:
    """Count n-grams of labelled texts and turn the counts into log probabilities.

    Rows with a null text, label or key are not learned from. ``max_per_language`` bounds the labelled rows: of a
    language with more, the share that fits is taken by a hash of the key, so the bound holds in expectation. Counts
    are summed by Spark; the driver gets one number per n-gram slot and language, whatever the input. Languages are
    in alphabetical order, which decides ties.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("l")).where(
        "k is not null and t is not null and l is not null"
    )
    have = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(have))
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col("k").cast("string")), F.lit(1 << 30)).cast("double") / (1 << 30)
    share = F.lit(0.0)
    for language in languages:
        share = F.when(F.col("l") == language, min(1.0, max_per_language / have[language])).otherwise(share)
    rows = rows.where(draw < share).select("t", "l").repartition(16)
    place = {language: i for i, language in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(languages), 1 << bits), np.int64)
        for batch in slices(batches, "t", 1 << 20):
            own = np.array([place[x] for x in batch.column("l").to_pylist()])
            for code, offsets, _ in grams(batch.column("t").to_pylist(), bits, orders):
                whose = np.repeat(own, np.diff(offsets))
                seen += np.bincount((whose << bits) | code, minlength=seen.size).reshape(seen.shape)
        which, slot = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(seen[which, slot])],
            ["which", "slot", "n"],
        )

    total = np.full((len(languages), 1 << bits), smoothing)
    if languages:
        found = rows.mapInArrow(count, "which int, slot int, n long").groupBy("which", "slot").agg(F.sum("n").alias("n"))
        found = found.toArrow()
        total[found["which"].to_numpy(), found["slot"].to_numpy()] += found["n"].to_numpy()
    matrix = np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32)
    known = np.array([have[x] for x in languages], float)
    return LanguageModel(languages, np.log(known / known.sum()) if languages else known, matrix, bits, orders)


def predict(
    documents: DataFrame, model: LanguageModel, keep: list[str], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` with the predicted language and its posterior probability, called ``names``.

    A text that is null or has no letter is ``und`` with score 0, as is any text under a model of no language. The
    model goes to the tasks as a broadcast of (slots x languages) numbers. ``names`` must not be in ``keep``; other
    columns of the input may have any name.
    """
    spark = documents.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = documents.select(*[F.col(c) for c in dict.fromkeys([*keep, text])])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, text, 1 << 20):
            best, score, lettered = model.score([t or "" for t in batch.column(text).to_pylist()])
            known = lettered & bool(model.languages)
            found = [model.languages[i] if ok else UNDETERMINED for i, ok in zip(best, known)]
            out = [batch.column(c) for c in keep] + [pa.array(found, pa.string()), pa.array(np.where(known, score, 0.0))]
            yield pa.RecordBatch.from_arrays(out, [*keep, *names])

    return rows.mapInArrow(run, f"{types}, {names[0]} string, {names[1]} double")


def identify(documents: DataFrame, folds: int = 5, key: str = "doc_id") -> DataFrame:
    """Learn from the documents outside the held-out fold and predict all of them.

    Held out is a row whose key's crc32 is 0 modulo ``folds``; a null key is held out.
    """
    model = train(documents.where(fold(key, folds) != 0), key=key)
    marked = documents.select(F.col(key), F.coalesce(fold(key, folds) == 0, F.lit(True)).alias("held_out"), "text")
    return predict(marked, model, [key, "held_out"])
