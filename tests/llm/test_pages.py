"""Operators on pages, and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import DOCUMENTS, LONG, PAGES, PASSAGE, TEXTS, empty, prose, rows, spaced, tokens
from pyspark.sql import functions as F

import check_oracles
import corpus_pipeline
from mailspark.llm import exact, nearcopies, urlfilter, warc
from mailspark.llm.oracles import ORACLES
from mailspark.llm.queries import URL_RULES
from mailspark.session import new_path

HTML = prose(300)
PAGE_ROWS = [
    (1, "http://A.example.net/en/1?x#y", HTML), (2, "http://a.example.net/en", HTML), (3, "https://example.net/de/", HTML),
    (4, "http://net/", HTML + "!"), (5, "http://www.example.com/de/x", "x" * 999), (6, "http://www.example.com/en/", "x" * 999),
    (7, "http://notexample.com/de/", "y" * 1000), (8, "http://x.org/fr/://q", "y" * 1000), (9, "http://x.org?fr/", None), (10, None, ""),
    (11, "no scheme/en/", "ü" * 500), (12, "a://b://c/d", "ü" * 500), (13, "http://h.net#f", "ü" * 499), (None, "http://q.org/fr/", HTML),
    (14, "http://z.net/" + "p" * 5000, "WARC/1.1\r\n" * 300), (14, "http://z.net/\r\nx", "WARC/1.1\r\n" * 300), (15, "", "\x1f\x8b\x08" * 2),
    (16, "http://ÀB.com/de/", prose(20_000)),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "h", "v", 1) for r in PAGE_ROWS], PAGES).repartition(3).cache()


# -- urls -------------------------------------------------------------------------------------------


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", url.partition("://")[2], re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_by_hand(host, path):
    fits = [r for r in URL_RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(str(r)), default=None)


def spread_by_hand(seeds, links, damping, steps):
    """The ranks as repeated products of a matrix."""
    names = sorted({h for e in links for h in e} | set(seeds))
    at = {h: i for i, h in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for (a, b), n in links.items():
        m[at[b], at[a]] += n
    m = m / np.where(m.sum(0) > 0, m.sum(0), 1)
    start = np.array([seeds.get(h, 0.0) for h in names])
    r = (1 - damping) * start
    for _ in range(steps):
        r = (1 - damping) * start + damping * m @ r
    return dict(zip(names, r / (1 - damping)))


def judge_by_hand(pages, s):
    split = [(i, *split_url(u), h or "") for i, u, h in pages]
    found = [rule_by_hand(h, p) for _, h, p, _ in split]
    ruled = defaultdict(list)
    for (_, h, _, _), r in zip(split, found):
        if h:
            ruled[h].append(r.verdict if r else None)
    share = {v: {h: x.count(v) / len(x) for h, x in ruled.items()} for v in ("allow", "block")}
    links = Counter()
    for _, host, _, html in split:
        for to in re.findall(urlfilter.LINK, html):
            to = re.sub(r"^.*@|:\d*$", "", to).lower()
            if host and to and to != host:
                links[host, to] += 1
    trust = spread_by_hand(share["allow"], links, s.damping, s.rounds)
    distrust = spread_by_hand(share["block"], Counter({(b, a): n for (a, b), n in links.items()}), s.damping, s.rounds)
    out = []
    for (i, h, p, _), r in zip(split, found):
        bad = distrust.get(h, 0) >= s.threshold and distrust.get(h, 0) > trust.get(h, 0)
        out.append((i, h, p, str(r) if r else None, r.verdict if r else "block" if bad else "allow"))
    return sorted(out, key=repr)


def test_rules(pages):
    got = rows(urlfilter.judge(pages, URL_RULES), "page_id", "host", "path", "rule", "verdict")
    assert got == judge_by_hand(PAGE_ROWS, urlfilter.Settings())


def test_trust_and_distrust_spread(spark):
    rng = random.Random(5)
    hosts = [f"h{i}.example.{t}" for i in range(12) for t in ("com", "net", "org")]
    table = []
    for i in range(200):
        links = "".join(f'<a href="{rng.choice(["http://", "//", "HTTPS://u@"])}{rng.choice(hosts).upper()}{rng.choice(["", ":80"])}/x">' for _ in range(rng.randrange(4)))
        table.append((i, f"http://{rng.choice(hosts)}/{rng.choice(['de', 'en', 'fr'])}/", links + "<a href='/own'><a href=rel>"))
    frame = spark.createDataFrame(table, "page_id long, url string, html string")
    for threshold in (0.2, 0.5):
        s = urlfilter.Settings(threshold=threshold)
        got = rows(urlfilter.judge(frame, URL_RULES, s), "page_id", "host", "path", "rule", "verdict")
        assert got == judge_by_hand(table, s)
        assert {v for *_, r, v in got if r is None} == {"allow", "block"}


# -- archives ---------------------------------------------------------------------------------------


def archive_by_hand(table):
    same = defaultdict(list)
    for i, _, h in table:
        same[h or ""].append(i)
    out = []
    for i, _, h in table:
        body, ids = (h or "").encode(), [x for x in same[h or ""] if x is not None]
        keep = max(ids, default=None)
        again = len(body) >= 1000 and keep is not None and i != keep
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=repr)


def test_archives_say_what_was_written(pages):
    got = rows(warc.archive(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == archive_by_hand(PAGE_ROWS)


def folder_of(spark):
    path = new_path(spark, "warc-test")
    return path if "://" in path else f"file://{path}"


def test_payloads_come_back_and_only_listed_files_count(spark, pages):
    path = folder_of(spark)
    listed = warc.write(pages, path, file_bytes=500)
    assert listed.count() > 3
    warc.write(pages, path)  # what a task that ran twice would leave
    found = warc.read(spark, path, listed, payloads=True).where("type = 'response'").collect()
    assert Counter(bytes(r.payload).decode() for r in found if r.record_id == "urn:page:16") == {PAGE_ROWS[-1][2]: 1}
    assert len(found) == sum(r[3] == "response" for r in archive_by_hand(PAGE_ROWS))
    assert {r.uri for r in found if r.record_id == "urn:page:14"} == {PAGE_ROWS[14][1], "http://z.net/%0D%0Ax"}


def damaged(data, at, kind):
    out = bytearray(data)
    if kind == "flip":
        out[at] ^= 0x55
    elif kind == "cut":
        del out[at : at + 37]
    else:
        out[at:at] = b"garbage WARC/1.0\r\n \x1f\x8b\x08 more"
    return bytes(out)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("kind", ["flip", "cut", "junk"])
def test_salvage_recovers_what_is_whole(packed, kind):
    rng = random.Random(11)
    records = [warc.record("response", f"urn:page:{i}", "http://a/", (HTML * (i % 4) + "WARC/1.1\r\n" * (i % 3)).encode()) for i in range(25)]
    parts = [warc.member(r) if packed else r for r in records]
    data, payloads = b"".join(parts), {warc._parse(r, 0).payload for r in records}
    for _ in range(40):
        at = rng.randrange(len(data))
        bad = damaged(data, at, kind)
        found = list(warc.salvage(bad))
        ids = [x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record)]
        assert 23 <= len(ids) <= 25 and len(set(ids)) == len(ids)
        assert {x.payload for x in found if isinstance(x, warc.Record)} <= payloads
        spans = [(x.start, x.end) for x in found]
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(bad)  # nothing is passed over in silence


@pytest.mark.parametrize("kind", ["flip", "cut"])
def test_salvage_goes_on_inside_a_member(kind):
    """Records before the damage always come back, those after it if they still hold; nothing false does."""
    rng = random.Random(12)
    noise = [bytes(rng.choices(range(33, 127), k=3000)) for _ in range(5)]
    records = [warc.record("response", f"urn:page:{i}", "http://a/", n) for i, n in enumerate(noise)]
    packed, after = warc.member(b"".join(records)), warc.member(warc.record("response", "urn:page:9", None, b"last"))
    most = 0
    for at in rng.sample(range(40, len(packed) - 10), 40):
        data = packed[:at] if kind == "cut" else damaged(packed, at, "flip") + after
        found = list(warc.salvage(data))
        ids = [x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record)]
        sure = zlib.decompressobj(31).decompress(packed[: at - 1])  # zlib may still hold some of it back
        whole = sum(len(b"".join(records[: i + 1])) <= len(sure) - 300 for i in range(5))
        assert ids[:whole] == [f"<urn:page:{i}>" for i in range(whole)] and len(set(ids)) == len(ids)
        assert all(x.payload in (*noise, b"last") for x in found if isinstance(x, warc.Record))
        assert any(isinstance(x, warc.Gap) for x in found) and (kind == "cut" or ids[-1] == "<urn:page:9>")
        spans = sorted({(x.start, x.end) for x in found if x.end > x.start})
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == len(data)
        most = max(most, len([i for i in ids if i != "<urn:page:9>"]))
    assert most >= 4  # all five where only the checksum is hit
    (first, *_, gap) = warc.salvage(packed[:-30])
    assert first.end == gap.end == len(packed) - 30 and gap.inner[1] > gap.inner[0] and gap.reason


def test_a_bad_record_in_a_whole_member():
    records = [warc.record("response", f"urn:page:{i}", None, b"x" * 50) for i in range(4)]
    records[1] = records[1].replace(b"xxx", b"yyy", 1)
    found = list(warc.salvage(warc.member(b"".join(records))))
    assert [x.headers["warc-record-id"][-2] for x in found if isinstance(x, warc.Record)] == ["0", "2", "3"]
    assert [x.inner for x in found if isinstance(x, warc.Gap)] == [(len(records[0]), len(records[0]) + len(records[1]))]


def test_salvage_of_nothing():
    assert list(warc.salvage(b"")) == []
    (gap,) = warc.salvage(b"no archive at all")
    assert (gap.start, gap.end) == (0, 17)


def test_empty_pages(spark):
    none = empty(spark, PAGES)
    assert urlfilter.judge(none, URL_RULES).count() == 0
    assert warc.archive(none).count() == 0


# -- sql ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_and_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert check_oracles.compare(spark, check_oracles.duck(folder), name, folder) is None


# -- pipeline ---------------------------------------------------------------------------------------


def test_stages_of_the_pipeline(spark, docs, tmp_path):
    spark.createDataFrame([(1, PASSAGE[:400])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_copies", "near_copies", "decontaminate", "pack"]
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, step(spark, docs, str(tmp_path)).cache()
        assert docs.schema == before.schema
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    has_letter = lambda t: any(c.isalpha() for c in t or "")
    assert all(has_letter(t) for _, t in kept["language"])
    assert {t for t in TEXTS if has_letter(t) and len(t) > 100} <= {t for _, t in kept["language"]}
    first = {}
    for i, t in kept["language"]:
        first.setdefault(spaced(t), []).append(i)
    want = {t: min((i for i in ids if i is not None), default=None) for t, ids in first.items()}
    assert {spaced(t): i for i, t in kept["exact_copies"]} == want and len(kept["exact_copies"]) == len(want)
    near = {t for _, t in kept["near_copies"]}
    assert near <= {t for _, t in kept["exact_copies"]} and len(near) == len(kept["near_copies"])
    assert all(PASSAGE not in t for _, t in kept["decontaminate"]) and len(near) - len(kept["decontaminate"]) == 2
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in kept["decontaminate"]}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    empty(spark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    empty(spark, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def shingles_by_hand(text):
    words = tokens(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def first_by_hand(table):
    """The rows that stay, by all pairs."""
    sets = [shingles_by_hand(t) for _, t in table]
    group = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both * 10 >= 8 * (len(sets[i]) + len(sets[j]) - both):
                group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for g, row in zip(group, table):
        least.setdefault(g, []).append((row[0] is None, row[0] or 0, row))
    return sorted((min(x, key=lambda r: r[:2])[2] for x in least.values()), key=repr)


@pytest.mark.parametrize("at_once", [4, 0])
def test_near_copies_are_those_of_similarity(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(nearcopies, "PAIRS_A_DOCUMENT", at_once)
    rng, table = random.Random(8), []
    vocabulary = [f"w{i}" for i in range(3000)]
    for n in (3, 5, 9, 40, 200, 1500):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(n)]
            table.append(" ".join(base))
            for share in (0.0, 0.01, 0.02, 0.025, 0.03, 0.05, 0.2):  # words replaced, each breaks five shingles
                copy = list(base)
                for at in rng.sample(range(n), int(share * n)):
                    copy[at] = "x" + copy[at]
                table.append(" ".join(copy).upper() + " " * (share == 0.0))
    rng.shuffle(table)
    table = [(None if i == 3 else i, t) for i, t in enumerate(dict.fromkeys(table))]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    want = first_by_hand(table)
    assert len(table) / 4 < len(want) < len(table) * 3 / 4
    assert rows(corpus_pipeline.near_copies(spark, docs, str(tmp_path)), "doc_id", "text") == want


def crowd(kind: str, n: int) -> list[str]:
    """Copies of one text: ``around`` it, all far from each other; ``below``, none alike to any; or a ``chain``."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(700)]
    out = [" ".join(base)] if kind == "around" else []
    for i in range(n):
        copy = list(base)
        if kind == "chain":
            copy[: 7 * i] = [f"c{k}" for k in range(7 * i)]
        else:
            for at in rng.sample(range(10, 690, 7), {"around": 10, "below": 22}[kind]):
                copy[at] = f"x{i}y{at}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("kind, groups, pairs", [("around", 1, 2), ("below", 300, 4), ("chain", 1, 60)])
def test_crowds_are_not_compared_pair_by_pair(spark, tmp_path, monkeypatch, kind, groups, pairs):
    texts = crowd(kind, 300 if kind != "chain" else 90)
    compared, alike = [], nearcopies._alike
    monkeypatch.setattr(nearcopies, "_alike", lambda p, *a: (compared.append(p.count()), alike(p, *a))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert corpus_pipeline.near_copies(spark, docs, str(tmp_path)).count() == groups
    assert sum(compared) <= pairs * len(texts)


def test_texts_that_differ_in_rare_words_are_not_compared(spark, tmp_path, monkeypatch):
    base, rng = [f"b{i}" for i in range(150)], random.Random(6)
    texts = []
    for i in range(120):  # half of them copies of the base, the others too far from it; words replaced occur twice
        copy = list(base)
        for at in rng.sample(range(5, 145, 6), 2 if i % 2 else 6):
            copy[at] = f"x{i // 4}y{at}"
        texts.append(" ".join(copy))
    table = list(enumerate(dict.fromkeys([" ".join(base), *texts])))
    seen, found = [], nearcopies._crowded_pairs
    monkeypatch.setattr(nearcopies, "PAIRS_A_DOCUMENT", 0)
    monkeypatch.setattr(nearcopies, "_crowded_pairs", lambda *a: (seen.append(found(*a).distinct().count()), found(*a))[1])
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert rows(corpus_pipeline.near_copies(spark, docs, str(tmp_path)), "doc_id", "text") == first_by_hand(table)
    assert seen and sum(seen) <= len(table)


def test_near_copies_keep_columns_of_any_name_and_repeated_rows(spark, tmp_path):
    names = ["node", "root", "size", "buckets", "bucket", "held", "parity", "a", "b", "m", "n", "of", "at", "top", "pairs"]
    texts = [None, "", " ", "a b c", "A b  c", LONG, LONG + " more", LONG]
    data = [(i, t, *range(len(names))) for i, t in enumerate(texts)] + [(5, LONG, *range(len(names)))]
    docs = spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"{c} long" for c in names))
    out = corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    assert out.schema == docs.schema and rows(out, "doc_id", "pairs") == [(0, 14), (3, 14), (5, 14), (5, 14)]


def test_parities_never_rule_out_what_is_alike():
    rng = np.random.default_rng(2)
    for n in (0, 1, 30, 400, 5000):
        a = rng.integers(0, 1 << 64, n, np.uint64)
        for k in (0, 1, n // 20, n // 8, n // 2):
            b = np.concatenate([a[min(k, n) :], rng.integers(0, 1 << 64, k, np.uint64)])
            x, y = (nearcopies.parities(s).view(np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_older_half_is_by_key(spark):
    ids = spark.createDataFrame([(i,) for i in (5, 6, 9, 15, None)], "doc_id long")
    assert [r.doc_id for r in ids.where(exact.older_half(ids)).collect()] == [5, 6, 9]
    assert ids.where("false").where(F.coalesce(exact.older_half(ids.where("false")), F.lit(False))).count() == 0
