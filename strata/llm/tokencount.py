"""Token counts of a unigram tokenizer without building tokens (op 5).

An Aho-Corasick automaton over the vocabulary finds every piece that ends at each
character; dynamic programming carries the best score and the number of pieces of the best path.  The
tokenizer's rules for ties hold: a later candidate replaces a path only with a strictly larger score, and
candidates for a place come from the earliest start on, the single character (or the unknown)
last.  A character without a piece of its own scores ``UNKNOWN_PENALTY`` below the
least piece and counts as its UTF-8 bytes (byte fallback).

No piece holds a blank mark after another character, so paths of a text fall apart at each
blank, and counts of blank-led chunks are remembered.

Defined results: null and empty texts have no tokens; repeated rows count alike; null ids are carried;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship, table

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 300_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The normal pieces of a model file and their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


class Counter:
    """Counts of texts over a vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        bad = [p for p, _ in pieces if MARK in p.lstrip(MARK)]
        if bad:
            raise ValueError(f"pieces with a blank mark inside can't be counted by chunk: {bad[:3]}")
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.known: dict[str, int] = {}
        self.cut = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall

    def chunk(self, text: str) -> int:
        """Pieces of the best path of one chunk."""
        n = len(text)
        score = [0.0] + [None] * n
        count = [0] * (n + 1)
        matches = self.automaton.iter(text)
        at = next(matches, None)
        for i, c in enumerate(text):
            best, pieces = None, 0
            while at is not None and at[0] == i:  # the longest first: the earliest start
                size, s = at[1]
                x = score[i + 1 - size] + s
                if best is None or x > best:
                    best, pieces = x, count[i + 1 - size] + 1
                at = next(matches, None)
            if c not in self.single:
                x = score[i] + self.unknown
                if best is None or x > best:
                    best, pieces = x, count[i] + len(c.encode("utf-8", "surrogatepass"))
            score[i + 1], count[i + 1] = best, pieces
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or text[0] == " " or MARK in text:
            chunks = self.cut(MARK + text.replace(" ", MARK))
        else:
            chunks = [MARK + w for w in text.split(" ")]
        known = self.known
        total = 0
        for c in chunks:
            n = known.get(c)
            if n is None:
                n = self.chunk(c)
                if len(c) <= 64:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[c] = n
            total += n
        return total


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per Python worker and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(vocabulary(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            n = [c.count(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long")


def op5_unigram_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all ``documents``."""
    import public_tokenizers as tokenizers

    return token_counts(table(spark, sf_dir, "documents"), tokenizers.path(VOCABULARY))
