"""N-gram Jaccard join by PartEnum signatures (operator 8).

Two documents link when the Jaccard similarity of their sets of five-word
shingles is 0.75 or more. Sets fall into bands of sizes (u/2, u]; a set that can
link with a larger band signs for that one too. For a band the feature domain is
cut into ``SPLIT * u`` partitions and a set is projected on each. Linked sets of
n and m elements differ in at most (n + m) / 7 elements, so at most k partitions
differ; among any k + 1 non-empty projections of a set, taken in one global
order, is the first that both share, so k + 1 signatures a set suffice. The
order takes projections last that consist of frequent shingles only, which
keeps common passages out of most signatures. A set with too few non-empty
partitions signs again for a finer cut until it has more than k.

Sharing a signature only makes a candidate pair. Candidates are checked in
three rounds, so that a family of thousands of near copies does not become all
of its pairs: every member of a signature group against the group's first
member; then, in groups that still hold several components, the nearest pairs
by parity bitmaps that would join these, a forest for each task; then, in blocks,
all pairs of members still in different components that the bitmaps allow.
What passes is checked exactly on the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.checkpoint import materialize, materialize_counted
from ..operators.joins import attach_by_key
from .common import side
from .shingles import U, chunks, mix, shingle_sets

SPLIT = 0.4  # partitions per element of the band's largest set
BLOCK = 512  # members compared at a time in the second round
MANY = 20  # a shingle in fewer documents is never called frequent


def _reduce(op, values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``op`` over each document's values; 0 for a document without any."""
    out = np.zeros(len(n), values.dtype)
    has = n > 0
    if has.any():
        out[has] = op.reduceat(values, (np.cumsum(n) - n)[has])
    return out


def _nodes(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A set's 64-bit name."""
    return mix(_reduce(np.add, mix(h ^ U(0xA5A5A5A55A5A5A5A)), n) + n.astype(U)).view(np.int64)


def _batches(frames: Iterator[pd.DataFrame]):
    for f in frames:
        texts = [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in f["text"]]
        for lo, hi in chunks(texts):
            h, n = shingle_sets(texts[lo:hi])
            yield f.iloc[lo:hi], h, n, _nodes(h, n)


def _profile(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document, and the shingles that come several times in one batch of documents."""
    for f, h, n, node in _batches(frames):
        yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "th": f["th"].astype("Int64"), "node": node,
                            "n": n.astype(np.int64), "seen": np.zeros(len(f), np.int64)})
        shingle, seen = np.unique(h, return_counts=True)
        some = seen >= 4
        none = pd.array([None] * int(some.sum()), "Int64")
        yield pd.DataFrame({"doc_id": none, "th": none, "node": shingle[some].view(np.int64), "n": np.full(int(some.sum()), -1, np.int64),
                            "seen": seen[some].astype(np.int64)})


def _first_copies(n: np.ndarray, node: np.ndarray, done: set) -> np.ndarray:
    """Which documents have a set that this task has not seen."""
    keep = np.zeros(len(n), bool)
    for i, x in enumerate(node.tolist()):
        if n[i] and x not in done:
            done.add(x)
            keep[i] = True
    return keep


def signatures(h: np.ndarray, n: np.ndarray, hot: np.ndarray, rate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document index) of sets given as in ``shingle_sets``, all of them non-empty."""
    weight = np.zeros(len(h), np.uint8)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        weight = np.where(hot[at] == h, rate[at], 0).astype(np.uint8)
    mixed = mix(h)
    band = np.array([int(x - 1).bit_length() for x in n.tolist()], np.int64)
    out_s, out_d = [], []
    for up in (0, 1):
        u = np.int64(1) << (band + up)
        most = np.minimum(u, 4 * n // 3)
        k = (n + most) // 7
        docs = np.flatnonzero(4 * n > 3 * (u >> 1)) if up else np.arange(len(n))
        cut = np.maximum(1, np.ceil(SPLIT * u).astype(np.int64))
        while len(docs):
            s, p, d = _project(h, mixed, weight, n, docs, cut, band + up)
            order = np.lexsort((s, p, d))
            s, d = s[order], d[order]
            first = np.searchsorted(d, d)
            keep = np.arange(len(d)) - first <= k[d]
            out_s.append(s[keep])
            out_d.append(d[keep])
            have = np.bincount(d, minlength=len(n))
            docs = docs[(have[docs] <= k[docs]) & (have[docs] < n[docs])]
            cut = cut * 2
    return np.concatenate(out_s), np.concatenate(out_d)


def _project(h, mixed, weight, n, docs, cut, band):
    """Hash, weight and document of each non-empty projection of the sets ``docs``."""
    starts = np.cumsum(n) - n
    if len(docs) == len(n):
        pick = slice(None)
        doc = np.repeat(docs, n)
    else:
        lens = n[docs]
        doc = np.repeat(docs, lens)
        pick = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(starts[docs], lens)
    # The hashes of a set ascend, so its partitions, cut by the high half, do too.
    part = ((h[pick] >> U(32)) * cut[doc].astype(U)) >> U(32)
    new = np.ones(len(doc), bool)
    new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(0, U), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    d = doc[at]
    salt = mix(part[at] * U(0x9E3779B97F4A7C15) + (cut[d] * 64 + band[d]).astype(U))
    return (mix(np.add.reduceat(mixed[pick], at) + salt), np.minimum.reduceat(weight[pick], at), d)


def _sign(hot_rows):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot, rate = hot_rows.value
        done: set = set()
        for _, h, n, node in _batches(frames):
            keep = _first_copies(n, node, done)
            if not keep.any():
                continue
            s, d = signatures(h[np.repeat(keep, n)], n[keep], hot, rate)
            yield pd.DataFrame({"sig": s.view(np.int64), "node": node[keep][d]})
    return run


def parity_bits(h: np.ndarray) -> bytes:
    """A parity bitmap of twice to four times as many bits as elements.

    The bits in which two bitmaps differ are at most the elements in which the
    sets differ; a bitmap twice as long folds by XOR of its halves.
    """
    size = max(64, 2 << int(len(h) - 1).bit_length())
    at = (h & U(size - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=size).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _each_set(column: str, make):
    """A task body: ``node, n`` and ``make(set)`` for every set that the task has not seen."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set = set()
        for _, h, n, node in _batches(frames):
            ends = np.cumsum(n)
            at = np.flatnonzero(_first_copies(n, node, done))
            if len(at):
                yield pd.DataFrame({"node": node[at], "n": n[at].astype(np.int64),
                                    column: [make(h[ends[i] - n[i]:ends[i]]) for i in at]})
    return run


def _sets_of(texts: DataFrame, names: DataFrame, n_names: int, column: str, make) -> DataFrame:
    """``node, n`` and ``column`` of the sets in ``names`` (``node, th``), from their texts (``th, text``) alone.

    ``th``, the hash of one text of the node, picks the rows before any shingle
    is made; another text of the same hash is left out by its node.
    """
    wanted = side(names.select("th").distinct(), n_names, 16)
    return (texts.join(wanted, "th", "left_semi").select("text")
            .mapInPandas(_each_set(column, make), f"node long, n long, {column} binary")
            .join(side(names.select("node"), n_names, 16), "node", "left_semi")
            .groupBy("node").agg(F.first("n").alias("n"), F.first(column).alias(column)))


def _differ(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Differing bits of all pairs of two lists of parity bitmaps."""
    size = min(map(len, (*a, *b)))

    def fold(x: bytes) -> np.ndarray:
        v = np.frombuffer(x, np.uint64)
        while len(v) * 8 > size:
            v = v[:len(v) // 2] ^ v[len(v) // 2:]
        return v
    x, y = np.stack([fold(v) for v in a]), np.stack([fold(v) for v in b])
    out = np.zeros((len(x), len(y)), np.int64)
    for j in range(x.shape[1]):
        out += np.bitwise_count(x[:, j, None] ^ y[None, :, j])
    return out


def _fold(v: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row each) folded by XOR to ``words`` 64-bit words."""
    while v.shape[1] > words:
        half = v.shape[1] // 2
        v = v[:, :half] ^ v[:, half:]
    return v


def _near_bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose sizes and bitmaps leave a link possible; pairs of equal bitmap lengths are compared at once."""
    for f in frames:
        n, m = f["n_a"].to_numpy(), f["n_b"].to_numpy()
        ok = 4 * np.minimum(n, m) >= 3 * np.maximum(n, m)
        x, y = f["bits_a"].to_numpy(), f["bits_b"].to_numpy()
        lens = np.array([(len(p), len(q)) for p, q in zip(x, y)], np.int64).reshape(-1, 2) // 8
        for wide, high in np.unique(lens[ok], axis=0).tolist():
            at = np.flatnonzero(ok & (lens == (wide, high)).all(axis=1))
            for part in np.array_split(at, -(-len(at) * max(wide, high) // (1 << 20)) or 1):
                p = np.frombuffer(b"".join(x[part]), np.uint64).reshape(-1, wide)
                q = np.frombuffer(b"".join(y[part]), np.uint64).reshape(-1, high)
                words = min(wide, high)
                differ = np.bitwise_count(_fold(p, words) ^ _fold(q, words)).sum(axis=1, dtype=np.int64)
                ok[part] = 7 * differ <= n[part] + m[part]
        yield f.loc[ok, ["a", "b"]]


def _linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        keep = []
        for i, (x, y) in enumerate(zip(f["items_a"], f["items_b"], strict=True)):
            both = np.concatenate([np.frombuffer(x, U), np.frombuffer(y, U)])
            total = len(both)
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= 75 * (total - common):
                keep.append(i)
        yield f.iloc[keep][["a", "b"]]


_COLUMNS = ["sig", "i", "j", "node", "comp", "n", "blk", "bits"]


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each whole (sig, i, j) run of sorted rows."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        if not len(f):
            continue
        cols = {c: f[c].to_numpy() for c in _COLUMNS}
        new = np.zeros(len(f), bool)
        for c in ("sig", "i", "j"):
            new[1:] |= cols[c][1:] != cols[c][:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        held = f.iloc[cuts[-1]:]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield {c: v[lo:hi] for c, v in cols.items()}
    if held is not None and len(held):
        yield {c: held[c].to_numpy() for c in _COLUMNS}


def _allowed(run: dict[str, np.ndarray]):
    """(left, right, allowed, differing bits) of a run's two blocks, or None.

    A pair is allowed when its components differ and neither the sizes nor the bitmaps rule a link out.
    """
    comp = run["comp"]
    if (comp == comp[0]).all():
        return None
    n, blk, bits = run["n"], run["blk"], run["bits"]
    i, j = run["i"][0], run["j"][0]
    left = right = np.arange(len(n))
    if i != j:
        left, right = left[blk == i], left[blk == j]
    if not len(left) or not len(right):
        return None
    a, b = n[left][:, None], n[right][None, :]
    ok = (comp[left][:, None] != comp[right][None, :]) & (4 * np.minimum(a, b) >= 3 * np.maximum(a, b))
    if not ok.any():
        return None
    differ = _differ(list(bits[left]), list(bits[right]))
    ok &= 7 * differ <= a + b
    return (left, right, ok, differ) if ok.any() else None


def _pairs(a: list, b: list) -> pd.DataFrame:
    both = np.array([a, b], np.int64).reshape(2, -1)
    both = np.unique(np.stack([both.min(axis=0), both.max(axis=0)], 1), axis=0)
    return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Allowed pairs (a, b) that would join the components of each run, nearest first, and the runs' groups (sig).

    A task takes no pair of components that its earlier pairs would have
    joined, so it gives fewer pairs than it has components. A group is named if
    it has an allowed pair at all: components only grow together, so the other
    groups need no further look.
    """
    parent: dict[int, int] = {}
    a, b, sigs = [], [], set()

    def find(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    def told() -> Iterator[pd.DataFrame]:
        pairs = _pairs(a, b)
        yield pairs.assign(sig=pd.array([None] * len(pairs), "Int64")).astype("Int64")
        named = pd.array(sorted(sigs), "Int64")
        none = pd.array([None] * len(named), "Int64")
        yield pd.DataFrame({"a": none, "b": none, "sig": named})
        a.clear()
        b.clear()
        sigs.clear()
    for run in _runs(frames):
        found = _allowed(run)
        if found is None:
            continue
        sigs.add(int(run["sig"][0]))
        left, right, ok, differ = found
        node = run["node"]
        label = np.array([find(c) for c in run["comp"].tolist()], np.int64)
        ok = ok & (label[left][:, None] != label[right][None, :])
        while ok.any():
            best = np.where(ok, differ, np.iinfo(np.int64).max)
            to, rows = best.argmin(axis=1), np.flatnonzero(ok.any(axis=1))
            for x in rows[np.argsort(best[rows, to[rows]], kind="stable")].tolist():
                u, v = left[x], right[to[x]]
                p, q = find(int(label[u])), find(int(label[v]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    a.append(node[u])
                    b.append(node[v])
            label = np.array([find(c) for c in label.tolist()], np.int64)
            ok &= label[left][:, None] != label[right][None, :]
        if len(a) + len(sigs) > 10_000:
            yield from told()
    yield from told()


def _across(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All allowed pairs of different components of each run."""
    a, b = [], []
    for run in _runs(frames):
        found = _allowed(run)
        if found is None:
            continue
        left, right, ok, _ = found
        x, y = np.nonzero(ok)
        a.extend(run["node"][left[x]])
        b.extend(run["node"][right[y]])
        if len(a) > 100_000:
            yield _pairs(a, b)
            a, b = [], []
    if a:
        yield _pairs(a, b)


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node reachable) for the nodes of ``edges`` (``a, b``).

    Alternating large-star and small-star rounds, each a grouped minimum and a
    join, written to the shared folder; the edges never leave the executors.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.filter("m < u").select("u", F.col("m").alias("v")))).distinct()
        small_m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_m, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_m.select("u", F.col("m").alias("v")))).distinct()
        edges, n = materialize_counted(small, "edges")
        now = edges.agg(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()["h"]
        if (n, now) == mark:
            break
        mark = (n, now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _check(pairs: DataFrame, sets: DataFrame, texts: DataFrame, text_of: DataFrame) -> DataFrame:
    """The linked ones of the distinct pairs ``a, b``: bitmaps first, then the sets themselves."""
    def put(df, s, cols, sfx):
        return df.join(s.select(F.col("node").alias(sfx), *[F.col(c).alias(f"{c}_{sfx}") for c in cols]), sfx)
    small = put(put(pairs, sets, ["n", "bits"], "a"), sets, ["n", "bits"], "b")
    near = materialize(small.mapInPandas(_near_bits, "a long, b long"), "near-pairs")
    names, n = materialize_counted(near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
                                   .join(text_of, "node"), "near")
    items = materialize(_sets_of(texts, names, n, "items", lambda h: h.tobytes()), "items")
    return materialize(put(put(near, items, ["items"], "a"), items, ["items"], "b")
                       .mapInPandas(_linked, "a long, b long"), "links")


def _open_groups(members: DataFrame, comp: DataFrame) -> DataFrame:
    """``sig, node, comp`` of the groups that still hold several components.

    In a group of two the first round has compared the only pair; groups with
    the same members count once.
    """
    marked = members.select("sig", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    marked = materialize(marked, "marked")
    mixed = (marked.groupBy("sig").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y"))
        .filter("lo <> hi and size > 2").groupBy("x", "y", "size").agg(F.min("sig").alias("sig")))
    return materialize(marked.join(mixed.select("sig"), "sig"), "open-members")


def _dealt(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of open groups with their bitmaps, once for each pair of blocks that they are in, runs together."""
    rank = Window.partitionBy("sig").orderBy("n", "node")
    cut = open_.join(sets.select("node", "n"), "node").withColumn(
        "blk", ((F.row_number().over(rank) - 1) / BLOCK).cast("int"))
    cut = cut.withColumn("last", F.max("blk").over(Window.partitionBy("sig")))
    dealt = (cut.withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
             .withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")))
    dealt = materialize(dealt.select("sig", "i", "j", "node", "comp", "n", "blk"), "open-groups")
    return (dealt.join(sets.select("node", "bits"), "node").repartition("sig", "i", "j")
            .sortWithinPartitions("sig", "i", "j").select("sig", "i", "j", "node", "comp", "n", "blk", "bits"))


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, node, n, comp`` (written), a row per document: its set, the set's size and its group's least node.

    ``th`` is the text's 64-bit hash; without words ``n`` is 0 and ``comp`` null.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    profile = materialize(rows.mapInPandas(_profile, "doc_id long, th long, node long, n long, seen long"), "profile")
    of_docs = profile.filter("n >= 0").select("doc_id", "th", "node", "n")
    text_of = of_docs.filter("n > 0").groupBy("node").agg(F.min("th").alias("th"))
    n_docs = of_docs.count()
    # At most 2,000 times the mean set size: the shingles that at least one in 2,000 documents holds.
    frequent = (profile.filter("n < 0").groupBy("node").agg(F.sum("seen").alias("seen"))
                .filter(F.col("seen") >= max(MANY, n_docs // 2000))).toArrow().to_pandas()
    hot = frequent["node"].to_numpy(np.int64).view(U)
    order = np.argsort(hot)
    rate = (8 * np.log2(np.maximum(frequent["seen"].to_numpy(float), 1)) / 2).clip(1, 255).astype(np.uint8)
    hot_rows = spark.sparkContext.broadcast((hot[order], rate[order]))

    signed = rows.select("text").mapInPandas(_sign(hot_rows), "sig long, node long")
    by = Window.partitionBy("sig").orderBy("node")
    # Each set once a group, however many tasks signed copies of it; groups of one set have nothing to compare.
    grouped = signed.select("sig", "node", F.first("node").over(by).alias("head"), F.lag("node").over(by).alias("prev"),
                            F.max("node").over(Window.partitionBy("sig")).alias("last"))
    members = materialize(grouped.filter("head <> last AND (prev IS NULL OR prev <> node)")
                          .select("sig", "node", "head"), "members")
    names, n_names = materialize_counted(members.select("node").distinct().join(text_of, "node"), "candidates")
    texts = rows.select("th", "text")
    sets = materialize(_sets_of(texts, names, n_names, "bits", parity_bits), "sets")
    stars = materialize(members.filter("node <> head").select(
        F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    links = _check(stars, sets, texts, names)
    comp = materialize(components(links), "components")

    # Pairs that would join what is still apart, then all allowed pairs of what stays apart.
    held = _open_groups(members, comp)
    forest = materialize(_dealt(held, sets).mapInPandas(_forest, "a long, b long, sig long").distinct(), "forest")
    links = materialize(links.unionByName(_check(forest.filter("sig IS NULL").select("a", "b"), sets, texts, names)),
                        "links")
    comp = materialize(components(links), "components")
    still = held.join(forest.select("sig").filter("sig IS NOT NULL").distinct(), "sig", "left_semi")
    crossing = _dealt(_open_groups(still, comp), sets).mapInPandas(_across, "a long, b long").distinct()
    more = _check(materialize(crossing, "crossing"), sets, texts, names)
    comp = materialize(components(links.unionByName(more)), "components")
    joined = of_docs.join(comp, "node", "left").withColumn(
        "comp", F.when(F.col("n") > 0, F.coalesce("comp", "node")))
    return materialize(joined.select("doc_id", "th", "node", "n", "comp"), "groups")


def link_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row per document.

    ``component_id`` is the smallest id reachable by links. Equal sets (exact
    copies among them) are one node. A null or wordless text has no shingles
    and is alone; under five words, the whole sequence is the one shingle. A
    null id takes part in links, but is never a ``component_id`` (null where a
    group has no other). Repeated rows come out as often as they came in; an
    empty table gives an empty result; other columns are ignored. Words,
    shingles and sets are named by 64-bit hashes.
    """
    rows = _grouped(docs, id_col, text_col)
    ids = rows.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    full = attach_by_key(rows.filter("n > 0"), ids, "comp", "_n", name="component-ids").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id.

    Groups are of texts, so texts that share an id but no link all stay. A null
    id comes after all others; of rows with the same id the one with the
    smaller text hash stays, of rows that repeat both any one. A text without
    words is linked with nothing: one row of each id stays.
    """
    rows = _grouped(docs, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "th")
    best = rows.filter("n > 0").groupBy("comp").agg(F.min(order).alias("best")).select("best.doc_id", "best.th")
    kept = best.unionByName(rows.filter("n = 0").select("doc_id", "th").distinct())
    times = rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("_times"))
    kept = kept.join(times, kept["doc_id"].eqNullSafe(times["doc_id"]) & (kept["th"] == times["th"])).select(
        kept["doc_id"].alias("_keep"), kept["th"].alias("_hash"), "_times")
    kept, n = materialize_counted(kept, "kept")
    out = docs.withColumn("_th", F.xxhash64(F.col(text_col).cast("string"))).join(
        side(kept, n, 40), docs[id_col].cast("long").eqNullSafe(F.col("_keep")) & (F.col("_th") == F.col("_hash")))
    cols = [docs[c] for c in docs.columns]
    once = out.filter("_times = 1").select(*cols)
    again = out.filter("_times > 1").dropDuplicates(["_keep", "_hash"]).select(*cols)
    return once.unionByName(again)
