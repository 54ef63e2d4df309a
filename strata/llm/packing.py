"""Packing by concatenation and cuts (op 12).

All documents stand one after the other; the row is cut every ``SIZE`` tokens.  Two passes give every
token its place without an order over all rows:

1. ``tokenised`` encodes each document in its input partition and writes its ids with the partition's number and the
   tokens before it *in the partition* (a running sum of the task).
2. Partition totals, one number each, are prefix-summed in ranges of ``RANGE`` partitions and over the ranges.  A document's place
   is its partition's offset plus its place there; ``pieces`` cuts it at multiples of ``SIZE``.

A piece is a boundary record: document, start in it, length, sequence, offset there.  Only the last sequence of all is
not full, so padding is less than ``SIZE`` tokens of the whole corpus (``padded``).

Pre-tokens of the tokenizer never hold white space, so texts are split at blanks and line ends and each word is encoded
once per task while it is remembered.

Defined results: null and empty texts are their end token alone; rows alike are packed each; null ids are carried;
long texts give as many pieces as they need; other columns are ignored; an empty table gives an empty result.
The order of documents is that of the input's partitions.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, ship, table

VOCABULARY = "word_bpe_49k.json"
SIZE = 4096
END = 2
#: Partitions whose totals are summed in one group.
RANGE = 4096
#: Partitions up to which their offsets are broadcast (16 MB).
PARTS = 1_000_000
#: Words a task remembers before it forgets them and starts anew.
KNOWN = 1_000_000
#: Letters beyond A-Z and signs that normal forms leave alone and that pre-tokens part as the runs of ``Encoder`` do.
LETTERS = "À-ÖØ-öø-ÿ"
SIGNS = ".,;:!?()|-"
#: What the tokenizer's file must hold for this.
RULES = ('"NFC"', '"Lowercase"', "[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+", '"ByteLevel"')
#: Characters of texts that are encoded at a time, unless one text has more.
PORTION = 500_000


class Encoder:
    """Ids of texts as bytes, ``width`` a token; words seen lately are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[str, bytes] = {}
        rules = json.loads(self.tokenizer.to_str())
        (self.runs, self.model) = (re.compile("[A-Za-z%s]+|[%s]+" % (LETTERS, SIGNS)), self.tokenizer.model)
        self.simple = re.compile("[A-Za-z%s%s]*" % (LETTERS, SIGNS)).fullmatch if all(r in json.dumps(rules) for r in RULES) else lambda w: None
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        chars = [chr(c) for c in range(256) if self.runs.match(chr(c))]
        self.spelled = {ord(c): level.pre_tokenize_str(c.lower())[0][0] for c in chars}
        self.run_ids: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        """Ids of letters, or of signs, alone."""
        if len(self.run_ids) > KNOWN // 4:
            self.run_ids = {}
        ids = b"".join([t.id.to_bytes(self.width, "little") for t in self.model.tokenize(run)])
        self.run_ids[run] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word without blanks and line ends; the library's model is asked for runs of plain letters and signs."""
        if self.simple(word):
            known = self.run_ids
            return b"".join([known.get(r) or self._run(r) for r in (r.translate(self.spelled) for r in self.runs.findall(word))])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        find = self.known.get
        lists = [t.replace("\n", " ").split(" ") for t in texts]
        found = [list(map(find, words)) for words in lists]
        new = list({w for words, ids in zip(lists, found) if None in ids for w, i in zip(words, ids) if i is None})
        fresh = {w: self._word(w) for w in new}
        for words, ids in zip(lists, found):
            if None in ids:
                ids[:] = [fresh[w] if i is None else i for w, i in zip(words, ids)]
        if len(self.known) + len(fresh) > KNOWN:
            self.known = {}
        self.known.update(fresh)
        return [b"".join(ids) for ids in found]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def portions(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null: empty) of some rows with about ``limit`` characters."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0), b.column(1)):
            text = t.as_py() or ""
            ids.append(i.as_py())
            texts.append(text)
            size += len(text)
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """part, before, doc_id, doc_tokens, ids (little-endian, 16 bits each where they fit, else 32): ids end with ``END``."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        code = encoder(path)
        end = END.to_bytes(code.width, "little")
        for ids, texts in portions(batches, PORTION):
            tokens = [t + end for t in code.encode(texts)]
            n = np.fromiter(map(len, tokens), np.int64, len(tokens)) // code.width
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), part, np.int64)),
                    pa.array(before + np.cumsum(n) - n),
                    pa.array(ids, pa.int64()),
                    pa.array(n),
                    pa.array(tokens, pa.binary()),
                ],
                ["part", "before", "doc_id", "doc_tokens", "ids"],
            )
            before += int(n.sum())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "part long, before long, doc_id long, doc_tokens long, ids binary"
    )


def offsets(tokens: DataFrame) -> DataFrame:
    """part, first: tokens of all partitions before each one."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).withColumn("range", F.floor(F.col("part") / RANGE))
    totals = totals.withColumn("in_range", F.sum("n").over(Window.partitionBy("range").orderBy("part")) - F.col("n"))
    ranges = totals.groupBy("range").agg(F.sum("n").alias("m"))
    ranges = ranges.select("range", (F.sum("m").over(Window.orderBy("range")) - F.col("m")).alias("before_range"))
    return totals.join(ranges, "range").select("part", (F.col("in_range") + F.col("before_range")).alias("first"))


def pieces(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: documents cut at every ``size`` tokens of all."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, n, first, body in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "place", "ids"))):
                wide = len(body) // n
                at = 0
                while at < n:
                    seq, off = divmod(first + at, size)
                    m = min(n - at, size - off)
                    out.append((i, at, m, np.frombuffer(body, f"<u{wide}", m, at * wide).astype("<u4").tobytes(), n, seq, off))
                    at += m
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == "ids" else pa.int64()) for k, c in zip(names, cols)], names)

    first = materialize(offsets(tokens), "offsets")
    if first.count() <= PARTS:  # two numbers a partition: a checked bound; beyond it a plain join
        first = F.broadcast(first)
    placed = tokens.join(first, "part").withColumn("place", F.col("first") + F.col("before"))
    return placed.select("doc_id", "doc_tokens", "place", "ids").mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def packed(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """Pieces of all documents with their ids."""
    return pieces(materialize(tokenised(docs, path), "tokenised"), size)


def padded(used: int, size: int = SIZE) -> int:
    """Length a sequence of ``used`` tokens is padded to: ``size``, but a power of two stays."""
    return used if used & (used - 1) == 0 else size


def op12_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all ``documents``, ids as checksums."""
    import public_tokenizers as tokenizers

    docs = table(spark, sf_dir, "documents")
    return packed(docs, tokenizers.path(VOCABULARY)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
