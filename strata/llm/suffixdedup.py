"""Removal of repeated byte strings by suffix order with match lengths sampled at run heads (op 7).

Each byte covered by a ``WIDTH``-byte string that also starts earlier goes.  ``spans`` brings
together, in blocks, the distinct contents around anchors that differ somewhere.  For a block, in order of
first occurrence, the index keeps the full suffix order, and match lengths sampled at the run heads
of the Burrows-Wheeler transform; matching statistics are streamed from the samples:

* the length of the match of a suffix with its neighbour in suffix order is worked out at run
  heads only;
* along the text it falls by one from each byte to the next, so the sampled values give all others
  (``max(sample + place) - place``);
* stretches of suffixes whose matches reach ``WIDTH`` hold equal strings; all but the earliest
  are marked.

Defined results: null and empty texts have no bytes; texts under ``WIDTH`` bytes keep all; matches
overlap and never cross documents; repeated rows with the same id and text are one document (both keep the
same bytes), under other ids the later ones go; null ids count as the largest; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import BYTE_TOKENS
from .spans import ID_LAST, merged, repeated_spans, with_spans
from .storage import materialize, table

WIDTH = 100
GRAM = 32
#: Not a byte of UTF-8, so no match passes from one content to the next.
END = b"\xff"
#: Bytes by which suffixes are ordered first; each turn doubles them.
FIRST = 5


def byte_tokens(data: bytes) -> np.ndarray:
    return BYTE_TOKENS[np.frombuffer(data, np.uint8)]


def byte_ranges(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    return [text[s:e] for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]


def ranked(keys: np.ndarray, bits: int) -> np.ndarray:
    """The dense rank of each of ``keys`` (below 2**bits).  Where key and place fit one word, words are sorted alone."""
    n = len(keys)
    low = n.bit_length()
    if bits + low > 64:
        return np.unique(keys, return_inverse=True)[1].astype(np.int64)
    words = np.sort(keys << np.uint64(low) | np.arange(n, dtype=np.uint64))
    place = (words & np.uint64((1 << low) - 1)).astype(np.int64)
    words >>= np.uint64(low)
    out = np.empty(n, np.int64)
    out[place] = np.concatenate(([0], np.cumsum(words[1:] != words[:-1])))
    return out


class RunLengthIndex:
    """Suffix order of a text, kept whole for marking, and match lengths at the run heads of its transform.

    Contents of a block differ, so no string that spans a whole one repeats, and a few doublings order all suffixes.
    """

    def __init__(self, text: bytes):
        n = len(text)
        a = np.frombuffer(text + END * FIRST, np.uint8)
        first = np.zeros(n, np.uint64)
        for i in range(FIRST):
            first = first << np.uint64(8) | a[i : i + n]
        ranks = [ranked(first, 8 * FIRST)]
        depth = FIRST
        while ranks[-1].max() < n - 1:
            r = ranks[-1]
            ahead = np.full(n, n, np.int64)  # as if the end byte went on for ever
            if depth < n:
                ahead[: n - depth] = r[depth:]
            ranks.append(ranked((r * (n + 1) + ahead).astype(np.uint64), 2 * (n + 1).bit_length()))
            depth *= 2
        order = np.empty(n, np.int64)
        order[ranks[-1]] = np.arange(n)
        bwt = a[order - 1].astype(np.int16)
        bwt[order == 0] = -1  # a run of its own
        self.order = order
        # suffix samples at run heads, each with the end of the run before
        at = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.sample, self.length = order[at], self._common(a, ranks, order[at], order[at - 1])

    @staticmethod
    def _common(a: np.ndarray, ranks: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at x and y share: by the ranks of each depth, then byte by byte."""
        n = len(ranks[0])
        out = np.zeros(len(x), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            i, j = np.minimum(x + out, n - 1), np.minimum(y + out, n - 1)
            out += np.where((x + out < n) & (y + out < n) & (ranks[level][i] == ranks[level][j]), FIRST << level, 0)
        alive = np.ones(len(x), bool)
        for _ in range(FIRST - 1):
            i, j = x + out, y + out
            alive &= (i < n) & (j < n) & (a[np.minimum(i, n)] == a[np.minimum(j, n)])
            out += alive
        return out

    def matching_statistics(self, n: int) -> np.ndarray:
        """For each place the length that its suffix shares with the one before it in order."""
        reach = np.zeros(n, np.int64)
        reach[self.sample] = self.length + self.sample
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)


def earlier_bytes(contents: list[bytes], width: int) -> list[list[tuple[int, int]]]:
    """Spans of each content that are covered by strings of ``width`` bytes which a content before (or itself, before) has."""
    text = END.join(contents) + END
    size = np.array([len(c) for c in contents])
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    index = RunLengthIndex(text)
    long_enough = index.matching_statistics(len(text))[index.order] >= width
    # a stretch: a suffix and those after it that match the one before
    cut = np.flatnonzero(~long_enough)
    low = np.minimum.reduceat(index.order, cut)
    earliest = np.repeat(low, np.diff(np.concatenate((cut, [len(text)]))))
    marked = np.zeros(len(text), bool)
    marked[index.order] = index.order != earliest
    out = []
    for s, n in zip(start.tolist(), size.tolist(), strict=True):
        at = np.flatnonzero(marked[s : s + n - width + 1])  # strings that start later reach over the end
        if not len(at):
            out.append([])
            continue
        brk = np.flatnonzero(np.diff(at) > 1)
        out.append(list(zip(at[np.concatenate(([0], brk + 1))].tolist(), (at[np.concatenate((brk, [len(at) - 1]))] + width).tolist(), strict=True)))
    return out


def kept_bytes(text: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """The bytes left, the number removed and the number of removed runs."""
    if not spans:
        return text, 0, 0
    s, e = merged(spans, len(text))
    left = b"".join(text[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(text)], strict=True))
    return left, len(text) - len(left), len(s)


def digest(text: bytes, spans: list[dict]) -> tuple[int, int, int, str]:
    left, gone, runs = kept_bytes(text, spans)
    return len(text), gone, runs, hashlib.sha256(left).hexdigest()


def repeated_bytes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """k, t, start, stop of byte spans (see ``spans``)."""
    return repeated_spans(docs, byte_tokens, byte_ranges, earlier_bytes, width, GRAM, "suffix")


def op7_run_length_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated bytes of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    spans = materialize(repeated_bytes(docs), "suffix-spans")
    out = with_spans(docs, spans, digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.nullif(F.col("k"), F.lit(ID_LAST)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
