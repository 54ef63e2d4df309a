"""Near-duplicate documents by circulant MinHash (op 4).

Two permutations give every signature coordinate: sigma (a hash of the shingle) breaks
up structure, and coordinate k is the smallest value that pi, circularly shifted by k, gives to
the shingles of a set.  Bands of ``ROWS`` coordinates make candidates; an exact
comparison of full shingle sets confirms links.

1. One pass over whole texts: distinct shingles (64-bit hashes of word sequences), signature, a
   128-bit fingerprint of the set.  Documents with equal sets form a class, which goes on as one.
2. Bands: classes that share a bucket are joined to the bucket's pivot (the member
   whose buckets are largest), never to each other, so a bucket of n members makes
   n - 1 pairs.  Pairs whose signatures agree in less than ``NEAR`` of the places are
   dropped; what is not connected to its pivot gets a new pivot, and what is left then is
   compared in blocks, where the members of a bucket still fall into several clusters.
3. Near pairs connect into clusters.  Two sets that are linked share many
   buckets, and being alike they are near the same pivots, so links lie inside a cluster.
4. Inside clusters full sets are compared by an inverted index: every pair of
   blocks of at most ``BLOCK`` sets is one group, so a cluster of any size is split,
   and a group puts out a spanning forest of its links, not all pairs.
5. Components of the links.

With ``BANDS`` x ``ROWS`` a pair at the limit of 0.8 shares no bucket with probability
(1 - 0.8**4)**32 < 1e-7.

Defined results: null, empty and blank texts have no shingles and are linked with nothing;
a text of fewer than ``SHINGLE`` words is one shingle; repeated rows have
equal sets and are linked; rows that repeat an id with other texts count as one document, compared by
its largest set; rows with a null id are linked with nothing, their component is null and they are
kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graph import components
from .hashing import mix, ngram_hashes, stream, word_hashes
from .storage import materialize, ship, table

SHINGLE = 4
BANDS = 32
ROWS = 4
#: Values that sigma and pi permute.
UNIVERSE = 1 << 21
#: Share of equal signature places from which a pair counts as near its pivot.
NEAR = 0.4
#: Times that members of a bucket are held against a pivot before the rest is compared in blocks.
TURNS = 2
#: Members of a block at most (about).
BLOCK = 1500
#: Shingles of a block's sets at most (one larger set is a block of its own).
BLOCK_SHINGLES = 1_500_000

_PI: dict[int, np.ndarray] = {}


def pi(places: int) -> np.ndarray:
    """The permutation, continued circularly by ``places`` values in front."""
    if places not in _PI:
        p = np.argsort(stream(UNIVERSE, 101), kind="stable").astype(np.uint32)
        _PI[places] = np.concatenate((p[-places:], p))
    return _PI[places]


def shingle_set(data: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text (A-Z as a-z)."""
    h = word_hashes(data, lower=True)
    if not len(h):
        return h
    if len(h) < n:
        return ngram_hashes(h, len(h)) ^ np.uint64(len(h))
    g = np.sort(ngram_hashes(h, n))
    return g[np.concatenate(([True], g[1:] != g[:-1]))]


def signature(shingles: np.ndarray, places: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the least of pi at (sigma(x) - k) modulo the universe, over the set."""
    p = np.lib.stride_tricks.sliding_window_view(pi(places), places)
    low = np.full(places, np.iinfo(np.uint32).max, np.uint32)
    at = (mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(UNIVERSE)).astype(np.int64)
    for s in range(0, len(at), 4096):
        np.minimum(low, p[at[s : s + 4096] + 1].min(axis=0), out=low)
    return low[::-1]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band, different for equal values in different bands."""
    bands = sig.reshape(-1, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(rows):
            key = mix(key ^ bands[:, i])
    return key.astype(np.int64)


ID_LAST = (1 << 63) - 1


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp1 and fp2 (the set's fingerprint), sig (binary) of each document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f1, f2, sigs = [], [], [], []
            for t in b.column(1):
                s = shingle_set((t.as_py() or "").encode())
                n.append(len(s))
                with np.errstate(over="ignore"):
                    f1.append(int(s.sum().astype(np.int64)) if len(s) else 0)
                    f2.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().astype(np.int64)) if len(s) else 0)
                sigs.append(signature(s).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "fp1", "fp2", "sig"])

    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(ID_LAST)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary")


def buckets(classes: DataFrame) -> DataFrame:
    """node, key: one row for each class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = [band_keys(np.frombuffer(s.as_py(), np.uint32)) for s in b.column(1)]
            node = np.repeat(b.column(0).to_numpy(), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(keys))], ["node", "key"])

    return classes.select("node", "sig").mapInArrow(run, "node long, key long")


def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal places of two signatures."""
    return pd.Series([float(np.count_nonzero(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32))) / (len(x) // 4) for x, y in zip(a, b, strict=True)], dtype=float)


def near_pairs(classes: DataFrame) -> DataFrame:
    """a, b: pairs of near classes; classes that are linked end up connected.

    ``TURNS`` times every member of a bucket is held against its pivot, and members that are connected to
    it by then leave the bucket.  The members of what is left are compared in blocks of bounded size.
    """
    agree = F.pandas_udf(agreement, "double")
    sigs = classes.select("node", "sig")
    rows = buckets(classes)
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = materialize(rows.join(shared, "key"), "near-buckets")
    support = rows.groupBy("node").agg(F.sum("n").alias("support"))
    rows = rows.drop("n").join(support, "node").withColumn("cluster", F.col("node"))
    found = None
    for turn in range(TURNS):
        pivot = rows.groupBy("key").agg(F.max_by(F.struct("node", "cluster"), F.struct("support", -F.col("node"))).alias("p")).select("key", F.col("p.node").alias("pivot"), F.col("p.cluster").alias("pivot_cluster"))
        met = materialize(rows.join(pivot, "key"), f"near-met-{turn}")
        pairs = met.filter("cluster != pivot_cluster").select("node", "pivot").distinct()
        both = pairs.join(sigs, "node").join(sigs.select(F.col("node").alias("pivot"), F.col("sig").alias("sig2")), "pivot")
        near = materialize(both.filter(agree("sig", "sig2") >= NEAR).select(F.col("node").alias("a"), F.col("pivot").alias("b")), f"near-pairs-{turn}")
        cluster = components(near if found is None else found.unionByName(near)).withColumnRenamed("root", "now")
        # an edge to its root for each node stands for all pairs found so far
        found = cluster.filter("node != now").select(F.col("node").alias("a"), F.col("now").alias("b"))
        rows = met.select("key", "node", "support", "pivot").join(cluster, "node", "left").withColumn("cluster", F.coalesce("now", "node"))
        if turn < TURNS - 1:
            top = cluster.select(F.col("node").alias("pivot"), F.col("now").alias("pivot_now"))
            rows = rows.join(top, "pivot", "left").filter(F.col("cluster") != F.coalesce("pivot_now", "pivot"))
        rows = materialize(rows.select("key", "node", "support", "cluster"), f"near-left-{turn}")
    mixed = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("cluster").alias("c1"), F.max("cluster").alias("c2")).filter("c1 != c2")
    rows = rows.join(mixed.select("key", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks")), "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = _paired(rows.join(sigs, "node"), "key", "node", "cluster", "sig")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        node, label = group["node"].to_numpy(), group["cluster"].to_numpy().copy()
        sig = np.stack([np.frombuffer(x, np.uint32) for x in group["sig"]])
        out = []
        for i in range(len(node)):
            other = np.flatnonzero(label != label[i])
            if len(other):
                other = other[(sig[other] == sig[i]).mean(axis=1) >= NEAR]
                for c in np.unique(label[other]):
                    out.append((node[i], node[other[label[other] == c][0]]))
                    label[label == c] = label[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return found.unionByName(rows.groupBy("key", "x", "y").applyInPandas(compare, "a long, b long"))


def _paired(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """``key``, x, y, ``columns``: rows with ``block`` of ``blocks``, once for every pair of blocks they are in (a single block: once)."""
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block")))
    rows = rows.select(key, "block", *columns, F.explode(others).alias("other"))
    return rows.select(key, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), *columns)


def _blocks(members: DataFrame) -> DataFrame:
    """cluster, node, block, blocks: members of a cluster in blocks of bounded size, without bringing a cluster together."""
    size = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(BLOCK)), F.ceil(F.col("s") / F.lit(BLOCK_SHINGLES)), F.lit(1)).cast("int")
    out = members.join(size.select("root", blocks.alias("blocks")), "root")
    return out.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges (i, j) that connect sets with ``100 * intersection >= percent * union``, by an inverted index."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    posting, who = flat[order], owner[order]
    start = np.concatenate(([0], np.flatnonzero(posting[1:] != posting[:-1]) + 1))
    stop = np.concatenate((start[1:], [len(posting)]))
    term = np.empty(len(flat), np.int64)
    term[order] = np.repeat(np.arange(len(start)), stop - start)
    offset = np.concatenate(([0], np.cumsum(size)))
    label = np.arange(len(sets))
    out = []
    for i in range(len(sets)):
        t = term[offset[i] : offset[i + 1]]
        s, n = start[t], stop[t] - start[t]
        at = np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(who[at], minlength=len(sets))
        linked = np.flatnonzero(100 * common >= percent * (size + size[i] - common))
        for j in np.unique(label[linked]):
            if j != label[i]:
                k = linked[label[linked] == j][0]
                out.append((i, int(k)))
                label[label == j] = label[i]
    return out


def links(docs: DataFrame, members: DataFrame, percent: int = 80) -> DataFrame:
    """a, b: a spanning forest of the links inside each cluster (members: root, node, n_shingles)."""
    placed = materialize(_blocks(members), "dup-blocks")
    wanted = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(ID_LAST)).alias("node"), F.col("text").cast("string").alias("text")).join(placed, "node")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set((t.as_py() or "").encode()).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), b.column(2), b.column(3), b.column(4), b.column(5)], ["node", "shingles", "n", "root", "block", "blocks"])

    sets = wanted.select("node", "text", "n_shingles", "root", "block", "blocks").mapInArrow(load, "node long, shingles binary, n long, root long, block int, blocks int")
    # rows that share an id but not their text: only the text of the class counts
    sets = sets.filter(F.length("shingles") == 8 * F.col("n"))
    sets = _paired(sets, "root", "node", "shingles")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        nodes = group["node"].to_numpy()
        edges = forest([np.frombuffer(s, np.uint64) for s in group["shingles"]], percent)
        return pd.DataFrame({"a": [nodes[i] for i, _ in edges], "b": [nodes[j] for _, j in edges]}, dtype="int64")

    return sets.groupBy("root", "x", "y").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    spark = docs.sparkSession
    sk = materialize(sketches(docs), "dup-sketches")
    full = sk.filter((F.col("n_shingles") > 0) & (F.col("doc_id") != ID_LAST))
    classes = materialize(full.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")), "dup-classes")
    near = near_pairs(classes)
    cluster = components(near)
    members = cluster.join(classes.select("node", "n_shingles"), "node")
    # classes share an id only where rows repeat it: the largest set stands for them
    joined = materialize(links(docs, members.groupBy("node").agg(F.min("root").alias("root"), F.max("n_shingles").alias("n_shingles"))), "dup-links")
    top = components(joined)
    named = classes.select("fp1", "fp2", "n_shingles", "node").join(top, "node", "left").select("fp1", "fp2", "n_shingles", F.coalesce("root", "node").alias("root"))
    out = sk.drop("sig").join(named, ["fp1", "fp2", "n_shingles"], "left").withColumn("root", F.when(F.col("doc_id") != ID_LAST, F.col("root")))
    doc, comp = F.nullif(F.col("doc_id"), F.lit(ID_LAST)), F.nullif(F.coalesce("root", "doc_id"), F.lit(ID_LAST))
    return out.select(doc.alias("doc_id"), "n_shingles", comp.alias("component_id"), (F.col("doc_id") == F.coalesce("root", "doc_id")).alias("kept"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays (one row of it)."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("dup_id"), "n_shingles").distinct()
    row = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(F.coalesce(F.col("text"), F.lit("")))))
    ranked = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("dup_id")), "left_semi")
    return ranked.withColumn("dup_row", row).filter("dup_row = 1 or doc_id is null").select(*docs.columns)


def op4_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"))
