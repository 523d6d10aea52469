"""Importance resampling, filter audit and WARC archives against brute force, round trips and on edge rows."""

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from churnlens.llm import filter_audit, ngram_table as nt, queries, resample, warc

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, weight string, PART string, removed long"
EDGE = [(1, None, None, None, "x", "y", 1), (2, "", "en", "a", "x", "y", 1), (3, " \n\t", "en", "a", "x", "y", 1),
        (4, "one two", "en", "a", "x", "y", 1), (4, "one two", "en", "a", "x", "y", 1), (5, "one two", "de", "a", "x", "y", 1),
        (None, "the of and TO a in is that it for was on # $", None, "b", "x", "y", 1), (None, "one two", "en", "b", "x", "y", 1),
        (6, "word " * 30_000, "en", "a", "x", "y", 1), (7, "12 ½ … 漢字 <b> \\ ### ÀÉ " * 9, "zz", None, "x", "y", 1)]
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def feature_words(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


# --- importance resampling -------------------------------------------------------

def _texts(seed):
    rng = random.Random(seed)
    letters = "abcXYZ019 \n.,-é漢½"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(200)] + [
        "", "a" * 100 + " " + "a" * 100 + " " + "a" * 99 + "b", "x"]


@pytest.mark.parametrize("n", [1, 3])
def test_spans_hashes_and_slots(n):
    texts = _texts(n)
    for i, j, data, offsets in nt.text_slices(pa.array(texts), 3_000):
        s = nt.runs_of(nt.words_of(data, offsets), n)
        want = [(d, b" ".join(w[q:q + k])) for k in range(1, n + 1) for d, t in enumerate(texts[i:j])
                for w in [feature_words(t)] for q in range(len(w) - k + 1)]
        assert [(d, s.data[a:a + m].tobytes()) for a, m, d in zip(s.start, s.length, s.doc)] == want
        key = nt.xxh64(s)
        assert key.tolist() == [xxhash.xxh64_intdigest(x) for _, x in want]
        # With all keys alike, or few distinct ones, bytes alone keep n-grams apart.
        for keys in (key, np.zeros_like(key), key % np.uint64(7)):
            t = nt.intern(s, keys)
            of = {}
            assert all(of.setdefault(slot, x) == x for slot, (_, x) in zip(t.slot, want))
            assert len(of) == len({x for _, x in want})
            bucket, count = nt.buckets_of(s, t, 100), Counter(x for _, x in want)
            assert all(bucket[k] == zlib.crc32(x) % 100 and t.count[k] == count[x] for k, x in of.items())


def brute_resample(docs, target, n=1, buckets=10_000, percent=10):
    def features(text):
        w = feature_words(text)
        return [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, score, None, len(feature_words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = k + 1
    return Counter(tuple(r) for r in rows)


def test_resample_query_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    target = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()["text"]
    got = queries.op11_resample(spark, SF)
    assert got.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(list(zip(docs["doc_id"], docs["text"])), target)


def test_resample_edges(spark):
    rows = [*EDGE, *[(100 + k, f"Alpha beta {k} " * 12, "en", "a", "x", "y", 1) for k in range(30)],
            *[(100, "Alpha beta 0 " * 12, "en", "a", "x", "y", 1)] * 3]
    df, target = spark.createDataFrame(rows, DOC), spark.createDataFrame([("alpha 7 beta",), (None,)], "text string")
    got = resample.ranked_documents(df, target, n=2, buckets=64, percent=40)
    assert Counter(map(tuple, got.collect())) == brute_resample([r[:2] for r in rows], ["alpha 7 beta", None], 2, 64, 40)
    none = resample.ranked_documents(df, target.limit(0), buckets=64)
    assert none.count() == len(rows)
    assert resample.ranked_documents(df.limit(0), target).count() == 0
    assert resample.resample(df.limit(0), target).count() == 0


def test_resample_returns_whole_rows_and_prefers_the_target(spark):
    words = [f"w{i}" for i in range(50)]
    rng = random.Random(5)
    rows = [(i, " ".join(["goal"] * 20 if i < 40 else rng.choices(words, k=20)), "en", "s", "x", "y", 1) for i in range(400)]
    df = spark.createDataFrame(rows, DOC)
    target = spark.createDataFrame([("goal " * 30,)], "text string")
    got = resample.resample(df, target, percent=10)
    assert got.columns == df.columns
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(40))


def test_resample_does_not_depend_on_partitions(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one, many = (set(map(tuple, resample.ranked_documents(docs.repartition(n), target).collect())) for n in (1, 7))
    assert one == many


# --- filter audit ----------------------------------------------------------------

def brute_audit(docs, labels):
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc_id, text, lang in docs:
        text = text or ""
        w = text.encode().split()
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
             "E": doc_id is not None and first[text] < doc_id}
        fails.append((lang or "", doc_id, {k for k, v in f.items() if v}))
    out, shares = [], defaultdict(int)
    for part in {p for p, _, _ in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [(d, f) for p, d, f in fails if p == part]
            everyone = left
            for step, name in enumerate(order, 1):
                gone = [d for d, f in left if name in f]
                failing = sum(name in f for _, f in everyone)
                left = [(d, f) for d, f in left if name not in f]
                shares[part, name] += len(gone)
                out.append([part, order, step, len(left), len(gone), failing - len(gone),
                            sum(f == {name} for _, f in everyone), sum(d in good for d in gone),
                            sum(d in toxic for d in gone)])
    return Counter(tuple([*r, shares[r[0], r[1][r[2] - 1]]]) for r in out)


def test_audit_equals_brute_force_and_bears_edges(spark):
    rng = random.Random(2)
    rows = [*EDGE, *[(rng.choice([None, *range(20, 60)]), rng.choice(["A b c", "x " * 250, "W # w " * 300, "once " * 9]),
                      rng.choice(["en", None, "de"]), "s", "x", "y", 1) for _ in range(150)]]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in [*range(0, 60, 2), None, 20, 20]]
    got = filter_audit.audit(spark.createDataFrame(rows, DOC),
                             spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert Counter(map(tuple, got)) == brute_audit([r[:3] for r in rows], labels)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], DOC)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    some = filter_audit.audit(spark.createDataFrame(EDGE[:1], DOC), labels).collect()
    assert len(some) == 600 and all(r["removed"] == (r["filter_order"][r["step"] - 1] == "A") for r in some)


def test_audit_stores_one_id_table_per_filter(spark):
    rows = filter_audit.failing_rows(spark.createDataFrame(EDGE, DOC))
    tables = filter_audit.store_id_tables(rows, ["A", "B", "E"])
    assert {f: sorted({r["doc_id"] for r in t.collect()}, key=str) for f, t in tables.items()} == {
        "A": [1, 2, 3, 4, 5, 7, None], "B": [6, 7], "E": [2, 5]}


# --- WARC ------------------------------------------------------------------------

PAGE = "page_id long, url string, html string, digest string, PAYLOAD string"
LONG = "<p>" + "same " * 40
PAGES = [(5, "http://a/5", LONG, "x", "y"), (3, "http://a/3", LONG, "x", "y"), (3, "http://a/3", LONG, "x", "y"),
         (None, None, LONG, "x", "y"), (8, "http://a/\r\nWARC-Type: x \t", "short", "x", "y"), (9, "é ü", "short", "x", "y"),
         (10, "", None, "x", "y"), (11, "u", "", "x", "y"), (12, "v", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "x", "y"),
         (13, "w", "ä漢" * 200_000, "x", "y"), (14, "w", "ä漢" * 200_000, "x", "y")]


def test_warc_round_trip_with_edges(spark, scratch):
    df = spark.createDataFrame(PAGES, PAGE).repartition(3)
    got = warc.round_trip(df, os.path.join(scratch, "w")).collect()

    def size(html):
        return len((html or "").encode()), hashlib.sha256((html or "").encode()).hexdigest()

    first = {5: 3, None: 3, 14: 13}
    want = [(p, *size(h), "revisit" if p in first else "response", first.get(p)) for p, _, h, _, _ in PAGES]
    assert Counter(map(tuple, got)) == Counter(want)
    assert warc.round_trip(df.limit(0), os.path.join(scratch, "none")).count() == 0


def test_warc_ranges_own_what_starts_in_them(spark, scratch):
    df = spark.createDataFrame(PAGES + [(100 + i, f"http://b/{i}", f"page {i} " * i, "x", "y") for i in range(60)], PAGE)
    files = warc.write_warc(df.repartition(2), os.path.join(scratch, "r"), file_bytes=4_000)
    assert files.count() > 2
    whole = warc.read_warc(files).collect()
    for size in (64, 1_000):
        parts = warc.read_warc(files, range_bytes=size).collect()
        assert Counter(map(tuple, parts)) == Counter(map(tuple, whole))
    assert {r["target_uri"] for r in whole} >= {"http://a/\r\nWARC-Type: x \t", "é ü", "", None}
    # Every end is another record's start, or the file's end.
    ends = {(r["path"], r["offset"] + r["bytes"]) for r in whole}
    starts = {(r["path"], r["offset"]) for r in whole}
    assert ends - starts == {(f["path"], f["bytes"]) for f in files.collect()}
    # Any gzip reader sees the same records, end to end.
    for f in files.collect():
        with gzip.open(f["path"]) as g:
            assert g.read().count(b"WARC/1.1\r\nWARC-Type") >= f["records"]
    listed = warc.archive_files(spark, os.path.join(scratch, "r"))
    assert warc.read_warc(listed).count() == len(whole)


def test_warc_damage_and_false_magic(spark, scratch):
    os.makedirs(os.path.join(scratch, "d"))
    path = os.path.join(scratch, "d", "a.warc.gz")
    good = [warc._member(warc.record_bytes(i, f"u{i}", bytes([i]) * 500, "0", None), 0) for i in range(4)]
    broken = bytearray(good[1])
    broken[-6] ^= 1  # the checksum
    stray = [warc.MAGIC, b"\x1f\x8b\x08\xff" + bytes(9), gzip.compress(b"no record")]
    with open(path, "wb") as f:
        f.write(stray[0] + good[0] + stray[1] + bytes(broken) + stray[2] + good[2] + good[3][:-20])
    files = warc.archive_files(spark, path)
    got = warc.read_warc(files).orderBy("offset").collect()
    assert [(r["page_id"], r["problem"] is None) for r in got] == [(0, True), (None, False), (2, True), (None, False)]
    with pytest.raises(Exception, match="at "):
        warc.read_warc(files, strict=True).collect()


def test_warc_foreign_records_and_nulls(spark, scratch):
    """Archives of other writers: no page ids, other kinds of records, HTTP heads of their own."""
    os.makedirs(os.path.join(scratch, "f"))
    path = os.path.join(scratch, "f", "b.warc.gz")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    body = b"HTTP/1.0 404 Not Found\r\nX: y\r\n\r\n<b>"
    page = (b"WARC/1.0\r\nwarc-type: response\r\nContent-Type: application/http;msgtype=response\r\nWARC-Target-URI: http://x\r\n"
            b"Content-Length: %d\r\n\r\n" % len(body)) + body + b"\r\n\r\n"
    with open(path, "wb") as f:
        f.write(gzip.compress(info) + gzip.compress(page))
    got = warc.read_warc(warc.archive_files(spark, path)).orderBy("offset").collect()
    assert [(r["warc_type"], bytes(r["payload"]), r["target_uri"]) for r in got] == [
        ("warcinfo", b"abc", None), ("response", b"<b>", "http://x")]
    assert warc.resolved_pages(warc.read_warc(warc.archive_files(spark, path))).first()["payload_bytes"] == 3
