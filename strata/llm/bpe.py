"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (op 6).

Merges of one pre-token are ordered by a queue with one bucket per merge rank.  A
bucket holds the linked-list positions whose pair has that rank; a two-level
bitmap says which buckets are filled, so find-first-set gives the next rank in
constant time whatever the length of the pre-token.  Entries whose pair has
changed since are stale and skipped when they come up.  A pre-token of n bytes
costs O(n) queue steps (plus the order within a bucket), where a repeated scan
for the lowest rank costs O(n^2).  The pre-tokens of a portion of texts that were
not met before go through one queue together, laid end to end.

Defined results: null and empty texts encode to no ids; repeated rows give
repeated results; other columns of the input are kept out of the way (only
``doc_id`` is carried); an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Chunks of text remembered per Python worker from one portion to the next.
CACHE_ENTRIES = 200_000
#: Pre-tokens of more bytes than this are merged alone.
LONG = 256
#: Characters of text whose unseen pre-tokens are merged together.
PORTION = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank over a two-level bitmap of ``WORD``-bit words."""

    WORD = 256

    def __init__(self, n_ranks: int):
        self.words = [0] * (n_ranks // self.WORD + 1)
        self.summary = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        b = self.buckets.get(rank)
        if b is not None:
            b += positions
            return
        self.buckets[rank] = positions
        w, bit = divmod(rank, self.WORD)
        self.words[w] |= 1 << bit
        self.summary |= 1 << w

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest filled rank, by find-first-set, and its bucket."""
        s = self.summary
        if not s:
            return None
        w = (s & -s).bit_length() - 1
        x = self.words[w]
        rank = w * self.WORD + (x & -x).bit_length() - 1
        x &= x - 1
        self.words[w] = x
        if not x:
            self.summary = s & (s - 1)
        return rank, self.buckets.pop(rank)


class Merger:
    """Merges any number of pre-tokens at once: they lie one after another in one linked list
    whose ends are cut, and share one rank queue.

    A step takes the lowest rank's bucket and merges its leftmost current pair in every
    pre-token; the others go back into the bucket, as a merge can make a pair of lower
    rank that comes first.  So each pre-token sees the order (rank, place), as if alone.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for t, r in ranks.items():
            for i in range(1, len(t)):
                x, y = ranks.get(t[:i]), ranks.get(t[i:])
                if x is not None and y is not None:
                    pairs[x << 32 | y] = r
        self.pairs = pairs
        self.keys = np.array(sorted(pairs) + [1 << 62], np.int64)
        self.found = np.array([pairs[k] for k in self.keys[:-1].tolist()] + [-1], np.int64)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.queue = RankQueue(max(ranks.values()) + 1)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, -1 for none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.found[at], -1)

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each pre-token."""
        size = np.array([len(t) for t in tokens], np.int64)
        n = int(size.sum())
        if not n:
            return [b""] * len(tokens)
        ends = np.cumsum(size)
        ids = self.single[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), size)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = size > 0
        nxt[ends[filled] - 1] = -1
        prv[(ends - size)[filled]] = -1
        due = np.full(n, -1, np.int64)  # the rank that the pair from here on has now
        at = np.flatnonzero(nxt >= 0)
        due[at] = self.rank_of(ids[at], ids[nxt[at]])
        q = self.queue
        at = at[due[at] >= 0]
        at = at[np.argsort(due[at], kind="stable")]
        for group in np.split(at, np.flatnonzero(np.diff(due[at])) + 1):
            if len(group):
                q.push(int(due[group[0]]), group.tolist())
        while (top := q.pop()) is not None:
            rank, bucket = top
            i = np.array(bucket, np.int64)
            i = i[due[i] == rank]  # the others are stale
            if not len(i):
                continue
            i.sort()
            if len(i) > 1:
                i = i[np.concatenate(([True], i[1:] != i[:-1]))]
            if len(i) > 1:
                own = owner[i]
                first = np.ones(len(i), bool)
                np.not_equal(own[1:], own[:-1], out=first[1:])
                if not first.all():
                    q.push(rank, i[~first].tolist())
                    i = i[first]
            j = nxt[i]
            k = nxt[j]
            h = prv[i]
            ids[i] = rank
            ids[j] = due[j] = due[i] = -1
            nxt[i] = k
            right, left = k >= 0, h >= 0
            ir, kr, hl, il = i[right], k[right], h[left], i[left]
            prv[kr] = ir
            where = np.concatenate((ir, hl))
            now = self.rank_of(ids[where], ids[np.concatenate((kr, il))])
            due[where] = now
            order = np.argsort(now)
            now, where = now[order], where[order].tolist()
            cut = [*(np.flatnonzero(now[1:] != now[:-1]) + 1).tolist(), len(where)]
            s = 0
            for e in cut:
                if s < e and now[s] >= 0:
                    q.push(int(now[s]), where[s:e])
                s = e
        alive = ids >= 0
        out = ids[alive].astype("<u4").tobytes()
        cut = np.concatenate(([0], np.cumsum(np.bincount(owner[alive], minlength=len(tokens))))) * 4
        return [out[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def merge_long(self, token: bytes) -> bytes:
        """One very long pre-token, position by position: the same queue and order."""
        n = len(token)
        ids = self.single[np.frombuffer(token, np.uint8)].tolist()
        nxt, prv, due = [*range(1, n), -1], list(range(-1, n - 1)), [-1] * n
        pair, q = self.pairs.get, self.queue
        for i in range(n - 1):
            if (r := pair(ids[i] << 32 | ids[i + 1])) is not None:
                due[i] = r
                q.push(r, [i])
        while (top := q.pop()) is not None:
            rank, bucket = top
            heapq.heapify(bucket)
            low = rank
            while bucket:
                i = heapq.heappop(bucket)
                if due[i] != rank:
                    continue
                j, h = nxt[i], prv[i]
                k = nxt[j]
                ids[i], ids[j], due[i], due[j], nxt[i] = rank, -1, -1, -1, k
                for a, b in ((i, k), (h, i)):
                    if a >= 0 and b >= 0:
                        r = pair(ids[a] << 32 | ids[b])
                        due[a] = -1 if r is None else r
                        if r == rank:
                            heapq.heappush(bucket, a)
                        elif r is not None:
                            q.push(r, [a])
                            low = min(low, r)
                if k >= 0:
                    prv[k] = i
                if low < rank:  # a pair of lower rank has appeared and comes first
                    if bucket:
                        q.push(rank, bucket)
                    break
        return struct.pack(f"<{sum(x >= 0 for x in ids)}I", *(x for x in ids if x >= 0))


class ByteBPE:
    """Encoder and decoder over a rank file; ids leave and enter as little-endian 32-bit integers."""

    def __init__(self, path: str, pattern: str, entries: int = CACHE_ENTRIES):
        self.ranks = load_ranks(path)
        self.vocabulary = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.vocabulary[r] = t
        self.split = regex.compile(pattern).findall
        self.merger = Merger(self.ranks)
        # a text is cut at each blank that follows a visible character: no match of the pattern crosses it
        self.glued = re.compile(r" (?<=[\s\x1c-\x1f] )").search
        self.entries = entries
        self.known: dict[str | tuple[str], bytes] = {}

    def chunks(self, text: str) -> list[str | tuple[str]]:
        """The text in pieces that no match of the pattern crosses; a string stands for itself after a blank, a tuple for its text."""
        if self.glued(text):
            return [(t,) for t in self.split(text)]
        out: list[str | tuple[str]] = text.split(" ")
        out[0] = (out[0],)
        return out

    def learn(self, new: list[str | tuple[str]]) -> None:
        """Adds the ids of chunks not remembered: split by the pattern, then merged together."""
        split, vocabulary = self.split, self.ranks
        # letters alone (of the blocks that every Unicode version has alike) are one match
        parts = [[" " + c] if c.__class__ is str and c.isalpha() and max(c) < "\u0250" else split(" " + c if c.__class__ is str else c[0]) for c in new]
        tokens = {t: t.encode() for p in parts for t in p}
        ids = {}
        rest, long = [], []
        for t, b in tokens.items():
            if b in vocabulary:
                ids[t] = struct.pack("<I", vocabulary[b])
            elif len(b) > LONG:
                ids[t] = self.merger.merge_long(b)
            else:
                rest.append(t)
                long.append(b)
        ids.update(zip(rest, self.merger.merge(long), strict=True))
        self.known.update((c, ids[p[0]] if len(p) == 1 else b"".join([ids[t] for t in p])) for c, p in zip(new, parts, strict=True))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text.  What is remembered stays below ``entries`` chunks between calls: those of the last call stay, first those met before it."""
        cut = [self.chunks(t) for t in texts]
        met = set().union(*cut)
        known = self.known
        again = [c for c in met if c in known]
        new = [c for c in met if c not in known]
        self.learn(new)
        for chunks in cut:
            yield b"".join([known[c] for c in chunks])
        if len(known) > self.entries:
            short = [c for c in again + new if len(c if c.__class__ is str else c[0]) <= LONG]
            self.known = {c: known[c] for c in short[: self.entries]}

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


def portions(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch in lists of about ``PORTION`` characters; null counts as empty."""
    held: list[str] = []
    size = 0
    for t in column:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= PORTION:
            yield held
            held, size = [], 0
    yield held


_MODELS: dict[tuple, ByteBPE] = {}


def model(path: str, pattern: str) -> ByteBPE:
    """One encoder per Python worker and vocabulary."""
    if (path, pattern) not in _MODELS:
        _MODELS[path, pattern] = ByteBPE(path, pattern)
    return _MODELS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` (binary, little-endian 32-bit) of each document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            ids = [x for texts in portions(b.column(1)) for x in bpe.encode_all(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("body")).mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``body`` (the decoded bytes) of each row of ids."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x.as_py()) for x in b.column(1)], pa.binary())], ["key", "body"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), "ids").mapInArrow(run, f"key {kind}, body binary").withColumnRenamed("key", key)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Ids are encoded, decoded again, and only their digests leave the task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path, pattern)
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for texts in portions(b.column(1)):
                for ids in bpe.encode_all(texts):
                    n.append(len(ids) // 4)
                    ids_hash.append(hashlib.sha256(ids).hexdigest())
                    text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(text_hash)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, encoded and decoded."""
    import public_tokenizers as tokenizers

    return digest(table(spark, sf_dir, "documents"), tokenizers.path(VOCABULARY), tokenizers.PATTERN)
