"""Benchmark decontamination with Spark functions alone: a hash set of normalised n-grams meets every token window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailspark.llm.common import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows up to which the set of hashes is sent to every task, as part of the plan; beyond it, windows are joined.
BROADCAST_WINDOWS = 100_000


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; the quick way where a text is all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """ASCII letters, digits and non-ASCII characters in runs; null has none."""
    return F.regexp_extract_all(F.coalesce(lowered(text), F.lit("")), F.lit(WORD), F.lit(0))


def _gram(column: Column, start: Column, n: int) -> Column:
    return F.array_join(F.slice(column, start, n), " ")


def windows(items: DataFrame, n: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, ``gram``, ``len``: the distinct windows of each item; items without words have none."""
    rows = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    grams = F.transform(starts, lambda i: F.array_join(F.slice(F.col("w"), i, size), " "))
    return rows.select("item", size.alias("len"), F.explode(grams).alias("gram")).distinct()


def _scan(rows: DataFrame, grams: DataFrame, lengths: list[int], broadcast_windows: int) -> DataFrame:
    """``row``, ``i``, ``len``, ``gram``: windows of the documents whose hash is one of a window of an item."""
    w = F.col("w")
    hashes = grams.select("len", F.xxhash64("gram").alias("h"), F.xxhash64(F.substring_index("gram", " ", 2)).alias("two")).distinct()
    found = hashes.limit(broadcast_windows + 1).collect() if lengths else []

    if len(found) > broadcast_windows:  # more than a task should hold: every window meets the set in a join

        def every(n: int) -> Column:
            starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.struct(i.alias("i"), F.lit(n).alias("len"), _gram(w, i, n).alias("gram")))

        rows = rows.select("row", F.explode(F.concat(*map(every, lengths))).alias("x")).select("row", "x.*")
        return rows.join(grams.select("len", "gram").distinct(), ["len", "gram"], "left_semi").select("row", "i", "len", "gram")

    def hits_of(n: int) -> Column:
        """The first two words screen the windows; only those left over are put together and looked up whole."""
        sets = {name: ",".join(f"{x}L" for x in sorted({r[name] for r in found if r["len"] == n})) for name in ("two", "h")}
        gram = "xxhash64(array_join(slice(w, i, {}), ' '))".format
        return F.expr(
            f"transform(filter(if(size(w) >= {n}, sequence(1, size(w) - {n} + 1), cast(array() AS array<int>)), "
            f"i -> {gram(min(n, 2))} IN ({sets['two']}) AND {gram(n)} IN ({sets['h']})), i -> struct(i AS i, {n} AS len))"
        )

    hits = [hits_of(n) for n in lengths]
    none = F.array().cast("array<struct<i:int,len:int>>")
    rows = rows.withColumn("hits", F.concat(*hits) if hits else none).where(F.size("hits") > 0)
    rows = rows.select("row", "w", F.explode("hits").alias("x"))
    gram = F.array_join(F.slice("w", F.col("x.i"), F.col("x.len")), " ")
    return rows.select("row", "x.i", "x.len", gram.alias("gram"))


def contamination(
    documents: DataFrame, items: DataFrame, keep: list[str], n: int = 10, text: str = "text", key: str = "item_id",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``.

    A window is ``n`` consecutive words of an item, or all words of a shorter one. A document word is hit if it lies in
    any occurrence of a window; ``spans`` are the maximal runs of hit words as (first word from 0, length). Hashes of
    windows only screen: every hit is compared as text with the windows. Null and empty texts have no words and no
    hits; items with null keys count as one item without a name in the list; repeated rows are judged each.
    """
    rows = documents.select(*keep, F.monotonically_increasing_id().alias("__row"), words(F.col(text)).alias("__words"))
    rows = stage(rows, "words")  # numbers of rows stay the same from here on
    grams = stage(windows(items, n, key, text), "windows")
    lengths = sorted(r["len"] for r in grams.select("len").distinct().collect())
    found = stage(_scan(rows.select(F.col("__row").alias("row"), F.col("__words").alias("w")), grams, lengths, broadcast_windows), "hits")
    verified = found.join(grams.select("gram", "len").distinct(), ["gram", "len"], "left_semi")
    order = Window.partitionBy("row").orderBy("i", "len")
    hits = verified.select("row", "i", (F.col("i") + F.col("len") - 1).alias("last"), "len").distinct()
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hits = hits.withColumn("new", F.when(F.col("i") <= reach + 1, 0).otherwise(1))
    runs = hits.withColumn("run", F.sum("new").over(order)).groupBy("row", "run").agg(F.min("i").alias("i"), F.max("last").alias("last"))
    span = F.struct((F.col("i") - 1).alias("start"), (F.col("last") - F.col("i") + 1).alias("len"))
    places = runs.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    named = verified.select("row", "gram", "len").distinct().join(grams, ["gram", "len"]).select("row", "item").distinct()
    named = named.groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_set("item")), ",").alias("items"))
    judged = places.join(named, "row").withColumnRenamed("row", "__of")
    out = rows.select(*keep, "__row", F.size("__words").cast("long").alias("n_words"))
    out = out.join(judged, F.col("__row") == F.col("__of"), "left")
    hit = F.aggregate(F.coalesce("spans", F.array().cast("array<struct<start:int,len:int>>")), F.lit(0).cast("long"), lambda a, s: a + s["len"])
    return out.select(
        *keep, "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "spans",
    )


def remove_spans(documents: DataFrame, judged: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without their hit words; a clean text stays as it is, any other becomes its remaining words.

    ``judged`` is the result of ``contamination`` with ``key`` among its columns; keys are unique in it.
    """
    spans = judged.where("contaminated").select(F.col(key).alias("__key"), F.col("spans").alias("__spans"))
    joined = documents.join(spans, documents[key] == spans["__key"], "left")
    w = words(F.col(text))
    left = F.filter(w, lambda _, i: ~F.exists("__spans", lambda s: (i >= s["start"]) & (i < s["start"] + s["len"])))
    columns = [F.when(F.col("__key").isNull(), F.col(text)).otherwise(F.array_join(left, " ")).alias(text) if c == text else F.col(c) for c in documents.columns]
    return joined.select(*columns)
