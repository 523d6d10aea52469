"""All rows of the pipeline against the stages' brute-force versions, one after the other."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pandas as pd

from churnlens.llm.queries import ORACLE_SQL
from test_llm import brute_groups
from test_quality import JUNK, brute as brute_quality, words

SF = "/root/testdata/sf0.001"


def shards(drawn, n=24, whole_share=0.02):
    """``(doc_id, size, crc, shard, slot)`` of ``(doc_id, text)`` rows by the law of equal bytes."""
    rows = sorted((hashlib.md5(t.encode()).hexdigest(), i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in drawn)
    starts, at = [], 0
    for r in rows:
        starts.append(at)
        at += r[2]
    group = {}
    for r, lo in zip(rows, starts):
        first, _ = group.get(r[0], (lo, lo))
        group[r[0]] = (first, lo + r[2])
    cuts = []
    for k in range(1, n):
        j = next(j for j, r in enumerate(rows) if starts[j] * n < k * at <= (starts[j] + rows[j][2]) * n)
        lo, hi = group[rows[j][0]]
        if (hi - lo) * n > whole_share * at:
            lo, hi = starts[j], starts[j] + rows[j][2]
        cuts.append(max([lo if k * at - lo * n < hi * n - k * at else hi, *cuts[-1:]]))
    seen, out = Counter(), []
    for r, lo in zip(rows, starts):
        shard = sum(c <= lo for c in cuts)
        out.append((r[1], r[2], r[3], shard, seen[shard]))
        seen[shard] += 1
    return sorted(out)


def holds(text, item):
    return " ".join(["", *words(item), ""]) in " ".join(["", *words(text), ""])


def test_rows_equal_brute_force(spark, scratch):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).toPandas()
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hosts = docs[docs["text"].str.split().str.len() > 80].head(12)
    made, at = [], int(docs["doc_id"].max()) + 1

    def plant(text, like):
        made.append((at + len(made), text, like["lang"], like["source"], len(text)))
    for (_, host), item in zip(hosts.iterrows(), items):
        w = host["text"].split()
        plant(host["text"], host)  # a copy
        plant(" ".join([*w[:-1], "changed"]), host)  # a near copy
        plant(" ".join([*w[10:], item, *w[:10]]) + " tail", host)  # a benchmark item inside
    plant(JUNK, hosts.iloc[0])
    plant("too short", hosts.iloc[1])
    docs = pd.concat([docs, pd.DataFrame(made, columns=docs.columns)], ignore_index=True)
    spark.createDataFrame(docs, spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).schema).repartition(
        6).write.parquet(f"{scratch}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{scratch}/benchmark.parquet")

    rows = [(i, t, x, s) for i, t, x, s in docs[["doc_id", "text", "lang", "source"]].itertuples(index=False)]
    rows = [r for r, v in zip(rows, brute_quality([(r[1], r[2]) for r in rows])) if v[4]]
    first = {i: component for i, _, component in brute_groups([(r[0], r[1]) for r in rows])}
    rows = [r for r in rows if first[r[0]] == r[0]]
    left = [r for r in rows if not any(holds(r[1], item) for item in items)]
    assert len(left) < len(rows)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(r[0], r[1], r[3]) for r in left], columns=["doc_id", "text", "source"]))
    text = {r[0]: r[1] for r in left}
    drawn = [(r[0], text[r[0]]) for r in con.sql(f"SELECT doc_id FROM ({ORACLE_SQL['op3_mix_sources']})").fetchall()]
    got = corpus_pipeline.run(spark, scratch).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    kept = {r[0] for r in got}
    assert kept - set(text) == set(), "kept a document that a stage drops"
    assert sorted(tuple(r) for r in got) == shards(drawn)
