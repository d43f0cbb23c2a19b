"""Phrases, largest inner products and filter interactions against brute force, on rows with every oddity."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import DOCUMENTS, empty, low, prose, rows
from pyspark.sql import functions as F

from mailspark.llm import audit, phrases, topk

# -- phrases ----------------------------------------------------------------------------------------


def phrases_by_hand(texts, most=3, least=10, percent=50, first=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, most + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            s, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= percent * a for b in longer):
                scored.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out, key=repr)


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocated(spark, texts):
    return spark.createDataFrame([(i, t, lang, "s", None, 0.5, 1, "d", 9) for i, (lang, t) in enumerate(texts)], DOCUMENTS).repartition(3)


@pytest.fixture(scope="module")
def prosaic():
    fixed = "New York, a the; new  york\tCity. été de là! ÀB c?\nof the of the of the of the"
    texts = [("en", prose(400) + " " + fixed) for _ in range(14)] + [("fr", fixed), (None, fixed * 12), ("und", fixed), ("de", None), ("de", ""), ("es", " \t\n.,")]
    return texts + texts[:3]


@pytest.mark.parametrize("bits", [27, 6, 7], ids=["fine", "full", "nearly"])
def test_phrases(spark, prosaic, bits):
    out = phrases.mine(collocated(spark, prosaic), screen_bits=bits)
    assert rows(out, *PHRASE) == phrases_by_hand(prosaic)


def test_phrases_of_four_words_and_few_of_them(spark, prosaic):
    out = phrases.mine(collocated(spark, prosaic), most=4, least=5, percent=80, first=7)
    assert rows(out, *PHRASE) == phrases_by_hand(prosaic, 4, 5, 80, 7)


def test_phrases_of_long_texts_do_not_depend_on_where_they_are_cut(spark, monkeypatch):
    texts = [("en", prose(600)), ("en", "x" * 500 + " the of " * 40), ("en", prose(300).replace(" ", "\t  "))]
    batch = pa.RecordBatch.from_pydict({"lang": [x for x, _ in texts], "text": [t for _, t in texts]})

    def counted(size):
        monkeypatch.setattr(phrases, "TEXT_BYTES", size)
        out = Counter()
        for words in phrases._texts(iter([batch]), 3):
            names = words.names.to_pylist()
            for n in (1, 2, 3):
                at, _ = words.fingerprints(n)
                out.update(tuple(names[words.ids[i + j]] for j in range(n)) for i in at)
        return out

    whole = counted(1 << 20)
    assert all(counted(size) == whole for size in (1, 7, 64, 1000))


def test_equal_fingerprints_of_unlike_phrases_are_told_apart(spark, prosaic, monkeypatch):
    true = phrases.Words.fingerprints
    monkeypatch.setattr(phrases.Words, "fingerprints", lambda *a, **b: (lambda at, fp: (at, fp & np.uint64(0xC0 << 56)))(*true(*a, **b)))
    words = next(phrases._texts(iter([pa.RecordBatch.from_pydict({"lang": ["en", None and "x" or "fr"], "text": [prosaic[0][1], prosaic[0][1]]})]), 3))
    for n in (1, 2):
        out = phrases._spelled(words, n, *words.fingerprints(n))
        got = Counter()
        for lang, phrase, c in zip(out["lang"].to_pylist(), out["phrase"].to_pylist(), out["c"].to_pylist()):
            got[lang, phrase.decode()] += c
        names = [x.decode() for x in words.names.to_pylist()]
        at, _ = true(words, n)
        assert got == Counter((words.langs[words.lang[i]], " ".join(names[words.ids[i + j]] for j in range(n))) for i in at)


def test_many_groups_and_small_batches_are_added_up(spark, prosaic, monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_BYTES", 64)
    monkeypatch.setattr(phrases, "HELD", 100)
    monkeypatch.setattr(phrases, "HELD_PHRASES", 100)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 900)
    out = phrases.mine(collocated(spark, [*prosaic, ("odd\nname\t", prosaic[0][1] * 12)]))
    assert rows(out, *PHRASE) == phrases_by_hand([*prosaic, ("odd\nname\t", prosaic[0][1] * 12)])


def test_numbers_survive_packing():
    for numbers in ([], [0], [1, 2, 300, 1 << 40, (1 << 64) - 1]):
        assert phrases._from_planes(phrases._planes(np.array(numbers, np.uint64))).tolist() == numbers


def test_scores_are_exact_past_64_bits(spark):
    cases = [(10**15 - 1, 10**15, 10**15 + 7), (3 * 10**9, 4 * 10**9, 5 * 10**9), (10, 10, 10), (10, 10**12, 10**12)]
    out = spark.createDataFrame(cases, "a long, l long, r long").select("a", "l", "r", phrases.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in out.collect())


def test_phrases_of_nothing(spark, docs):
    assert phrases.mine(empty(spark, DOCUMENTS)).columns == list(PHRASE)
    assert rows(phrases.mine(empty(spark, DOCUMENTS)), *PHRASE) == []
    assert rows(phrases.mine(docs), *PHRASE) == phrases_by_hand([(r.lang, r.text) for r in docs.collect()])


# -- largest inner products -------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row long, x int, block int, level string"


def products_by_hand(data, every, k=5):
    big = 1 << 63
    clip = lambda v: max(min(v, big - 1), -big)
    vectors = []
    for i, v in data:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            vectors.append((i, [clip(math.floor(256 * c)) for c in np.array(v, np.float32).astype(float)]))
    out = []
    for at, (q, a) in enumerate(vectors):
        if q is not None and q % every == 0:
            found = [(-clip(sum(x * y for x, y in zip(a, b))), i is None, i or 0, i) for n, (i, b) in enumerate(vectors) if n != at]
            out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, data, every, **options):
    frame = spark.createDataFrame([(i, v, 1, 5, 6, 7, "l") for i, v in data], VECTORS).repartition(3)
    return rows(topk.search(frame, F.col("vec_id") % every == 0, **options), "query_id", "rank", "vec_id", "score")


def vector_cases():
    rng = np.random.default_rng(3)
    skewed = rng.normal(size=(400, 12)) * rng.exponential(1, (400, 1)) * (0.5 ** np.arange(12))
    data = [(i, v.tolist()) for i, v in enumerate(skewed)]
    data += [(1000 + i, [0.1] * 12) for i in range(90)]  # one vector many times: ties, and levels that are full
    data += [(10, [0.5] * 12), (10, [0.5] * 12), (None, [2.0] * 12), (None, [2.0] * 12)]
    data += [(2000, None), (2001, [None] * 12), (2002, [math.nan] * 12), (2003, [math.inf] * 12), (2010, []), (2020, [1.0]), (2030, [0.0] * 12)]
    return data


@pytest.mark.parametrize("block", [(4096, 2048), (16, 8)])
def test_largest_inner_products(spark, block):
    data = vector_cases()
    assert searched(spark, data, 10, block=block) == products_by_hand(data, 10)
    assert searched(spark, data, 1, block=block, k=1) == products_by_hand(data, 1, 1)


def test_scores_of_huge_components_are_exact_or_clipped(spark):
    data = [(i, [s * 3e7, 1.0 + i / 256, s * 1e5]) for i, s in enumerate([1, -1, 1, 1, -1])] + [(9, [1e30, 0.0, 0.0]), (10, [-1e30, 1.0, 0.0])]
    assert searched(spark, data, 1) == products_by_hand(data, 1)


def test_few_and_no_vectors(spark):
    assert searched(spark, [], 1) == []
    assert searched(spark, [(0, [1.0])], 1) == []
    assert searched(spark, [(1, [1.0]), (3, [2.0])], 2) == []
    assert searched(spark, [(0, [1.0]), (3, [2.0])], 2) == [(0, 1, 3, 131072)]


def test_short_vectors_are_passed_over():
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.integers(200, 256, (600, 8)), rng.integers(-3, 3, (3000, 8))])
    table = lambda x: {"row": np.arange(len(x)), "x": pa.array(x.tolist(), pa.list_(pa.int64()))}
    seen = []

    def counting(queries, vectors, plain=topk._products):
        seen.append(len(vectors))
        return plain(queries, vectors)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(topk, "_products", counting)
        q = pa.table({**table(p[:3]), "floor": pa.array([None] * 3, pa.int64())})
        topk._compare(q, pa.table({**table(p), "id": np.arange(len(p))}), np.eye(8), 5, 5)
    assert sum(seen) <= 1024


# -- filter interactions ----------------------------------------------------------------------------


def failures_by_hand(documents):
    least = {}
    for i, t, _ in documents:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, part in documents:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t or "")) > 2 * len(t or ""),
            "D": bool(re.search(r"[#$%&*|]", t or "")), "E": i is not None and least[t or ""] < i,
        }
        out.append((i, part or "", {f for f, x in fails.items() if x}))
    return out


def audit_by_hand(documents, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[n] == 1} for n in range(2))
    out, judged = [], failures_by_hand(documents)
    for part in {p for _, p, _ in judged}:
        own, removals, lines = [(i, f) for i, p, f in judged if p == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                removals[name] += len(gone)
                redundant = sum(name in f for _, f in own) - len(gone)
                lines.append((name, (part, "".join(order), step, len(left), len(gone), redundant, sum(f == {name} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        out += [(*line, removals[name]) for name, line in lines]
    return sorted(out, key=repr)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
LABELS = "doc_id long, quality int, toxic int, part string, failed int"


def audited(spark, documents, labels):
    schema = "doc_id long, text string, source string, part string, failed int, digest string, n long, least long"
    frame = spark.createDataFrame([(*d, "p", 1, "d", 2, 3) for d in documents], schema).repartition(3)
    marks = spark.createDataFrame([(*x, "p", 1) for x in labels], LABELS)
    return rows(audit.audit(frame, marks), *AUDIT)


def test_filter_interactions(spark, docs):
    documents = [(r.doc_id, r.text, ["a", "b", "", None][n % 4]) for n, r in enumerate(docs.collect())]
    plain = " ".join(f"w{i}" for i in range(300))
    at = len(documents)
    documents += [(at + i, t, "c") for i, t in enumerate([plain, plain + " $", plain + " É" + "A" * 40, plain, plain, " ".join(["a"] * 200), " ".join(["a", "b"] * 100), "Ab" * 49, "A" + "é" * 49])]
    documents += [(at + 3, plain, "d"), (-5, "later", "b"), (7_000, "later", "c"), (None, plain, "c"), (6_000, plain, "d")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(at + 9)] + [(2, 1, None), (3, None, 1), (None, 1, 1), (6_000, 1, 1), (6_000, 0, 0), (99_999, 1, 1)]
    assert audited(spark, documents, labels) == audit_by_hand(documents, labels)


def test_filter_interactions_without_rows_or_labels(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    documents = [(1, "x", "s"), (2, None, None)]
    assert audited(spark, documents, []) == audit_by_hand(documents, [])


def test_long_texts_fail_alike(monkeypatch):
    texts = [prose(n).encode() + x for n in (0, 1, 199, 200, 5000) for x in (b"", b"\x0b\x0c #", b" ABC" * 50)]
    short = [audit.failed(t) for t in texts]
    monkeypatch.setattr(audit, "LONG_BYTES", 0)
    assert [audit.failed(t) for t in texts] == short


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10, 1000, 4097])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    assert audit.positional_counts(words).tolist() == [int((words >> b & 1).sum()) for b in range(32)]


def test_many_parts_and_batches_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(audit, "PARTS_HELD", 2)
    documents = [(i, f"t{i % 50}", f"s{i % 9}") for i in range(200)]
    assert audited(spark, documents, []) == audit_by_hand(documents, [])
