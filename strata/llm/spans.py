"""Routing of repeated windows, shared by suffix-array dedup (op 7) and substring dedup (op 8).

A document is a sequence of tokens (bytes or words); a window is ``width`` consecutive tokens.
Every window has one anchor: the smallest hash among its ``gram``-token grams, the leftmost of equals.
Windows that follow each other mostly share it, so a document falls into pieces: a piece is all
consecutive windows of one anchor, some ``width + 2 * spacing`` tokens.  Equal windows have equal
anchors, hence meet in the pieces of one anchor, and only there.

1. One row a piece: hash of the anchor, hash of its content, place.  Anchors that occur once are dropped
   after a sum with map-side combining.
2. Of pieces with equal content all but the first are duplicates as a whole.
3. Anchors with several different contents (next to an edit) are compared token by token: their
   distinct contents, once each, are fetched from the texts and go to an index in blocks
   (``index`` below: a suffix order, or relative Lempel-Ziv parsing).
4. The contents of an anchor with more than ``GROUP`` of them are split by a second anchor, the
   smallest of their longer grams: each is cut into a few pieces (some eight at most, whatever
   its length), which go through the same steps.  Grams grow by half of what is left to a window
   (``finer``), until an anchor is a whole window and equal contents are all there is.
5. Spans come back to their documents by id and text.

A row is told apart by (id, hash of its text); null ids count as the largest.  Rows alike in both
are one document at one place: none is earlier than the other.  Earlier is the order (id, hash, start), the
same for pieces and for the windows in them: texts that share an id, or have none, come one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import Rolling, mix
from .storage import materialize, ship

ID_LAST = (1 << 63) - 1
#: Tokens that are cut into pieces at a time; longer documents overlap by a window less one token.
CHUNK = 1 << 20
#: Distinct contents of one anchor that are compared in one group.
GROUP = 2000
#: Tokens of contents that one index holds, unless a single group has more.
BLOCK = 1 << 20

Tokens = Callable[[bytes], np.ndarray]
#: contents in order of first occurrence -> for each the list of [start, end) token spans met earlier
Index = Callable[[list[bytes], int], list[list[tuple[int, int]]]]


def pieces(tokens: np.ndarray, width: int, gram: int, chunk: int) -> Iterator[tuple[np.ndarray, ...]]:
    """anchor, content, start, number of windows of each piece, in order; every window is in one piece."""
    w = width - gram + 1
    for s in range(0, max(len(tokens) - width + 1, 0), chunk - width + 1):
        t = tokens[s : s + chunk]
        n = len(t) - width + 1
        r = Rolling(t)
        g = r.all(gram)
        place = np.arange(len(g), dtype=np.uint64)
        key = (g >> np.uint64(20) << np.uint64(20)) | place
        full = -(-len(key) // w) * w
        k = np.full(full, np.iinfo(np.uint64).max, np.uint64)
        k[: len(key)] = key
        ahead = np.minimum.accumulate(k.reshape(-1, w), axis=1).ravel()
        back = np.minimum.accumulate(k.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(back[:n], ahead[w - 1 : w - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [n])) - 1
        with np.errstate(over="ignore"):
            content = mix(r.of(first, width) + r.of(last, width) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        yield g[at[first]].astype(np.int64), content.astype(np.int64), first + s, last - first + 1


def packed(docs: DataFrame) -> DataFrame:
    """k, t (the row's key) and its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(ID_LAST)).alias("k"), F.xxhash64(text).alias("t"), text.alias("text"))


def compressed(rows: DataFrame) -> DataFrame:
    """``packed`` rows with the text as a compressed block, for the way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(x.as_py().encode()) for x in b.column(2)], pa.binary())], ["k", "t", "body"])

    return rows.mapInArrow(run, "k long, t long, body binary")


def expand(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def piece_rows(rows: DataFrame, tokens: Tokens, width: int, gram: int) -> DataFrame:
    chunk = CHUNK  # by value, as tasks import this module anew

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks, ts = b.column(0).to_numpy(), b.column(1).to_numpy()
            held: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for i, x in enumerate(b.column(2)):
                for a, c, s, n in pieces(tokens(x.as_py().encode()), width, gram, chunk):
                    for into, v in zip(held, (a, c, np.full(len(a), ks[i]), np.full(len(a), ts[i]), s, n.astype(np.int32)), strict=True):
                        into.append(v)
            if held[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)) for h in held], ["anchor", "content", "k", "t", "start", "n"])

    return rows.mapInArrow(run, "anchor long, content long, k long, t long, start long, n int")


def finer(width: int, gram: int) -> list[int]:
    """Lengths of the grams by which hot anchors are split, one after the other; the last is a whole window."""
    out = []
    while gram < width:
        gram = width if width - gram <= 4 else (gram + width + 1) // 2
        out.append(gram)
    return out


def fetched_contents(rows: DataFrame, contents: DataFrame, cut: Callable, width: int) -> DataFrame:
    """``contents`` (anchor, content, place p) of the texts with the tokens of each as ``piece``."""
    ask = contents.groupBy("k", "t").agg(F.collect_list(F.struct("anchor", "hot", "start", "n")).alias("want"))
    texts = compressed(rows).join(ask, ["k", "t"]).dropDuplicates(["k", "t"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, t, body, want in zip(*(c.to_pylist() for c in b.columns), strict=True):
                starts = np.array([x["start"] for x in want], np.int64)
                stops = starts + np.array([x["n"] for x in want]) + width - 1
                for x, piece in zip(want, cut(expand(body), starts, stops), strict=True):
                    out.append((x["anchor"], x["hot"], k, t, x["start"], x["n"], piece))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["anchor", "hot", "k", "t", "start", "n", "piece"])

    return texts.mapInArrow(fetch, "anchor long, hot boolean, k long, t long, start long, n int, piece binary")


def compared(groups: DataFrame, index: Index, width: int) -> DataFrame:
    """k, t, start, stop of what ``index`` finds among the contents (anchor, k, t, start, piece) of each anchor."""
    block = BLOCK

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> pa.RecordBatch | None:
            held.sort(key=lambda x: (x[1], x[2], x[3]))  # order of first occurrence
            spans = index([x[4] for x in held], width)
            out = [(x[1], x[2], x[3] + s, x[3] + e) for x, own in zip(held, spans, strict=True) for s, e in own]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)], ["k", "t", "start", "stop"]) if out else None

        held: list[tuple] = []
        size, anchor = 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != anchor and size > block:  # a group stays together
                    if (r := flush(held)) is not None:
                        yield r
                    held, size = [], 0
                anchor = row[0]
                held.append(row)
                size += len(row[4])
        if held and (r := flush(held)) is not None:
            yield r

    grouped = groups.select("anchor", "k", "t", "start", "piece").repartition("anchor").sortWithinPartitions("anchor", "k", "start")
    return grouped.mapInArrow(compare, "k long, t long, start long, stop long")


def split_contents(hot: DataFrame, tokens: Tokens, cut: Callable, width: int, gram: int) -> DataFrame:
    """The pieces, by anchors of ``gram`` tokens, of the contents of hot anchors; equal windows stay in pieces of one anchor."""
    chunk = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for anchor, k, t, start, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for a, c, s, n in pieces(tokens(piece), width, gram, chunk):
                    both = mix(mix(np.full(len(a), anchor).astype(np.uint64)) ^ a.astype(np.uint64)).astype(np.int64)
                    out += zip(both.tolist(), c.tolist(), [k] * len(a), [t] * len(a), (s + start).tolist(), n.tolist(), cut(piece, s, s + n + width - 1), strict=True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), (*[pa.int64()] * 5, pa.int32(), pa.binary()), strict=True)], ["anchor", "content", "k", "t", "start", "n", "piece"])

    return hot.select("anchor", "k", "t", "start", "piece").mapInArrow(run, "anchor long, content long, k long, t long, start long, n int, piece binary")


def met_pieces(all_pieces: DataFrame) -> DataFrame:
    """The rows whose anchor occurs twice or more."""
    often = all_pieces.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    return all_pieces.join(often, "anchor")


def later_pieces(met: DataFrame, contents: DataFrame, width: int) -> DataFrame:
    """Spans of the pieces whose content has come before: duplicates as a whole."""
    again = contents.filter("c > 1").select("anchor", "content", F.col("p.k").alias("k0"), F.col("p.t").alias("t0"), F.col("p.start").alias("s0"))
    later = (F.col("k") > F.col("k0")) | ((F.col("k") == F.col("k0")) & ((F.col("t") > F.col("t0")) | ((F.col("t") == F.col("t0")) & (F.col("start") > F.col("s0")))))
    return met.join(again, ["anchor", "content"]).filter(later).select("k", "t", "start", (F.col("start") + F.col("n") + width - 1).alias("stop"))


def differing(contents: DataFrame) -> DataFrame:
    """Contents, at their first place, of the anchors that have several; ``hot`` where these are more than ``GROUP``."""
    several = contents.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1")
    return contents.join(several, "anchor").select("anchor", (F.col("m") > GROUP).alias("hot"), "p.*")


def repeated_spans(docs: DataFrame, tokens: Tokens, cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]], index: Index, width: int, gram: int, name: str) -> DataFrame:
    """k, t, start, stop: token spans of each document that are covered by windows which also start earlier.

    ``cut(text, starts, stops)`` gives the bytes of token ranges, ``index`` compares them.
    """
    ship(docs.sparkSession)
    rows = packed(docs)
    met = materialize(met_pieces(materialize(piece_rows(rows, tokens, width, gram), f"{name}-cut")), f"{name}-pieces")
    contents = materialize(met.groupBy("anchor", "content").agg(F.min(F.struct("k", "t", "start", "n")).alias("p"), F.count("*").alias("c")), f"{name}-contents")
    spans = later_pieces(met, contents, width)
    fetched = materialize(fetched_contents(rows, differing(contents), cut, width), f"{name}-fetched")
    spans = spans.unionByName(compared(fetched.filter("NOT hot"), index, width))
    for finer_gram in finer(width, gram):
        hot = fetched.filter("hot")
        if hot.isEmpty():
            break
        met = materialize(met_pieces(materialize(split_contents(hot, tokens, cut, width, finer_gram), f"{name}-split-{finer_gram}")), f"{name}-pieces-{finer_gram}")
        contents = materialize(met.groupBy("anchor", "content").agg(F.min(F.struct("k", "t", "start", "n", "piece")).alias("p"), F.count("*").alias("c")), f"{name}-contents-{finer_gram}")
        spans = spans.unionByName(later_pieces(met, contents, width))
        fetched = materialize(differing(contents), f"{name}-fetched-{finer_gram}")
        spans = spans.unionByName(compared(fetched.filter("NOT hot"), index, width))
    return spans


def merged(spans: list[dict], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered tokens among ``n``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [x["start"] for x in spans], 1)
    np.add.at(edge, [x["stop"] for x in spans], -1)
    inside = np.concatenate(([0], np.cumsum(edge)[:-1] > 0, [0])).astype(np.int8)
    d = np.diff(inside)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def with_spans(docs: DataFrame, spans: DataFrame, each: Callable, schema: str, carry: list[str] | None = None) -> DataFrame:
    """``each(text, spans)`` (a tuple of ``schema``) of every row of ``docs``, after the columns ``carry``."""
    ship(docs.sparkSession)
    own = spans.groupBy("k", "t").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    extra = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(0)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(ID_LAST)).alias("k"), F.xxhash64(text).alias("t"), text.alias("text"), extra.alias("extra"))
    kind = rows.schema["extra"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(x.as_py().encode()) for x in b.column(2)], pa.binary()), b.column(3)], ["k", "t", "body", "extra"])

    names = [c.split()[0] for c in schema.split(", ")]
    small = rows.mapInArrow(pack, f"k long, t long, body binary, extra {kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [each(expand(x.as_py()), s.as_py() or []) for x, s in zip(b.column(2), b.column(4), strict=True)]
            cols = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in names]
            arrays = [pa.array(c, pa.int64() if f.split()[1] == "long" else pa.string()) for c, f in zip(cols, schema.split(", "), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), *arrays], ["k", "extra", *names])

    joined = small.join(own, ["k", "t"], "left").select("k", "t", "body", "extra", "spans")
    return joined.mapInArrow(run, f"k long, extra {kind}, {schema}")
