"""Removal of repeated word windows by relative Lempel-Ziv parsing (op 8).

Each word covered by a ``WIDTH``-word window that also starts earlier goes.  ``spans`` brings
together, in blocks, the distinct contents around anchors that differ somewhere.  A block's contents come in
order of first occurrence, and each is parsed greedily against the reference that
the contents before it make:

* where a window of the reference starts, the longest match from there is a factor of the content;
* factors of at least ``WIDTH`` words are duplicate spans;
* the windows that cross a factor's end are looked up one by one, as they may occur
  elsewhere in the reference, and parsing goes on behind them;
* the content's own windows then join the reference.

Defined results: null and blank texts have no words; texts under ``WIDTH`` words keep all; repeated
rows with the same id and text are one document, under other ids the later ones lose all; null ids
count as the largest; kept words are joined by one space; an empty table gives an empty result.  The stage
of the pipeline carries other columns; texts without a repeated window stay as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import word_hashes
from .spans import ID_LAST, merged, repeated_spans, with_spans
from .storage import materialize, table

WIDTH = 20
GRAM = 8


def word_tokens(data: bytes) -> np.ndarray:
    return word_hashes(data, lower=False)


def text_words(data: bytes) -> list[bytes]:
    """Words as ``hashing.word_bounds`` cuts them: bytes are split at ASCII white space alone."""
    return data.split()


def word_ranges(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    w = text_words(text)
    return [b" ".join(w[s:e]) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]


class Reference:
    """Text met so far: each window leads to a place where it starts."""

    def __init__(self, width: int):
        self.width = width
        self.texts: list[list[bytes]] = []
        self.at: dict[tuple[bytes, ...], tuple[int, int]] = {}

    def factors(self, words: list[bytes]) -> list[tuple[int, int]]:
        """[start, end) of greedy factors of at least ``width`` words; ``words`` joins the reference word by word behind the parse."""
        width, at, me = self.width, self.at, len(self.texts)
        self.texts.append(words)
        windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        out, i = [], 0
        while i < len(windows):
            found = at.get(windows[i])
            if found is None:
                at[windows[i]] = (me, i)
                i += 1
                continue
            source, j = self.texts[found[0]], found[1]
            n = width
            # within the same text the source may run into the target: it starts earlier all the same
            while i + n < len(words) and j + n < len(source) and words[i + n] == source[j + n]:
                n += 1
            out.append((i, i + n))
            i += n - width + 1  # windows across the factor's end are looked up next
        return out


def earlier_words(contents: list[bytes], width: int) -> list[list[tuple[int, int]]]:
    """Spans of each content covered by windows which a content before (or itself, before) has."""
    reference = Reference(width)
    return [reference.factors(c.split(b" ")) for c in contents]


def kept_words(text: bytes, spans: list[dict]) -> tuple[list[bytes], int]:
    """The words left and the number of all words."""
    w = text_words(text)
    if not spans:
        return w, len(w)
    s, e = merged(spans, len(w))
    left: list[bytes] = []
    for x, y in zip([0, *e.tolist()], [*s.tolist(), len(w)], strict=True):
        left += w[x:y]
    return left, len(w)


def digest(text: bytes, spans: list[dict]) -> tuple[int, int, str]:
    left, n = kept_words(text, spans)
    return n, n - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def cleaned(text: bytes, spans: list[dict]) -> tuple[str, int]:
    """The text without its repeated words, and how many words are left."""
    if not spans:
        return text.decode(), 1
    left, _ = kept_words(text, spans)
    return b" ".join(left).decode(), len(left)


def repeated_words(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """k, t, start, stop of word spans (see ``spans``)."""
    return repeated_spans(docs, word_tokens, word_ranges, earlier_words, width, GRAM, "substring")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated words go from the texts; documents of which nothing is left go."""
    spans = materialize(repeated_words(docs), "substring-spans")
    others = [c for c in docs.columns if c != "text"]
    out = with_spans(docs, spans, cleaned, "new_text string, left long", others)
    out = out.filter("left > 0").select(*[F.col("extra")[c].alias(c) for c in others], F.col("new_text").alias("text"))
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op8_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated words of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    spans = materialize(repeated_words(docs), "substring-spans")
    out = with_spans(docs, spans, digest, "n_words long, n_removed long, kept_sha256 string")
    return out.select(F.nullif(F.col("k"), F.lit(ID_LAST)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
