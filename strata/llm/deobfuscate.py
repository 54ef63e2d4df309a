"""Toxicity of texts whose words are disguised (op 10).

Noisy channel: a disguised word is a lattice of characters.  A place offers what its sign may stand for
(``0`` for o, ``@`` for a, ..), repeated characters may be one or two, and single letters
set apart by blanks or dots may be one word.  A character language model counted over all
documents (trigrams of the words that hold letters only) weighs the paths together with what each
disguise costs, and Viterbi finds the best word.  Only words that show a disguise have more than one
path; all others are restored to themselves.

The restored text is scored by a linear model over word beginnings (``PREFIXES`` letters, and whole
words), learned from labelled rows as smoothed log odds of features that are common and
one-sided enough.  Labels, language, source and id are never inputs of a score.

Defined results: null, empty and blank texts get the score of no evidence; repeated rows score alike;
null ids are treated as held out (their remainder is not defined) and other columns are ignored;
without usable labels every text gets the prior; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import materialize, ship, table

#: Signs and the letters they may stand for (fixed values of this operator).
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "_": "", "-": "", ".": "",
}
#: Log cost of reading a sign as a letter, of dropping a filler, of taking a repeat out.
SIGN_COST, FILLER_COST, REPEAT_COST = 1.5, 1.0, 0.3
PREFIXES = (4, 5, 6, 7)
#: Labelled rows that the scorer is fitted on at most (about: chosen by a hash of the id).
FIT_ROWS = 20_000
#: A feature needs this odds ratio, and this log-likelihood ratio, so that words of few rows are not taken by chance.
LEAST_ODDS, LEAST_RATIO = 12.0, 30.0
#: Log odds of a text without evidence, and the weight of a feature at most.
NO_EVIDENCE, MOST_WEIGHT = -4.0, 6.0
#: Features and words remembered per Python worker.
CACHE_ENTRIES = 200_000
LETTERS = 64
#: Trigrams that a task holds before it counts them.
COUNTED = 1_000_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<!\S)(?:\w[ .\-_]){3,}\w(?!\w)")
THRICE = re.compile(r"(.)\1\1")
EDGE = ".,;:?\"'()[]{}<>«»¡¿…"


def codes(chars: np.ndarray) -> np.ndarray:
    """Letters (code points) as numbers below ``LETTERS``: 0 for a word's edge, a-z alone, all others folded together."""
    return np.where((chars >= 97) & (chars <= 122), chars - 96, 27 + chars % (LETTERS - 27))


def trigram_counts(docs: DataFrame) -> DataFrame:
    """gram, n: character trigrams of the plain words of all texts, summed first in each task."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            for t in b.column(0):
                a = np.frombuffer((" " + (t.as_py() or "").lower() + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
                letter = ((a >= 97) & (a <= 122)) | ((a >= 0xDF) & (a != 0xF7) & (a < 0x2000))
                c = np.where(letter, codes(a), 0)
                c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]  # one edge between words
                c = np.concatenate(([0], c))
                held.append(c[:-2] * LETTERS**2 + c[1:-1] * LETTERS + c[2:])
                size += len(held[-1])
                if size >= COUNTED:  # one pass over all counts for many texts
                    total += np.bincount(np.concatenate(held), minlength=LETTERS**3)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=LETTERS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class CharacterModel:
    """Smoothed trigram log probabilities of letters."""

    def __init__(self, grams: list[tuple[int, int]]):
        n = np.zeros(LETTERS**3)
        for g, c in grams:
            n[g] = c
        n = n.reshape(LETTERS, LETTERS, LETTERS)
        pair = n.sum(axis=0)
        low = (pair + 0.5) / (pair.sum(axis=1, keepdims=True) + 0.5 * LETTERS)
        self.log = np.log((n + 20 * low[None]) / (n.sum(axis=2, keepdims=True) + 20)).tolist()

    def decode(self, shown: str) -> str:
        """The best word behind ``shown`` (lower case)."""
        log = self.log
        code = [int(x) for x in codes(np.array([ord(c) for c in shown], np.int64))]
        # state: last two letters' codes -> (score, word, last sign shown)
        best: dict[tuple[int, int, str], tuple[float, str]] = {(0, 0, ""): (0.0, "")}
        for i, c in enumerate(shown):
            nxt: dict[tuple[int, int, str], tuple[float, str]] = {}
            options = [(c, code[i], 0.0)] if c.isalpha() else [(x, ord(x) - 96, SIGN_COST) for x in SIGNS.get(c, "")]
            filler = not c.isalpha()
            for (a, b, last), (score, word) in best.items():
                steps = [(b, k, x, score + log[a][b][k] - cost, word + x) for x, k, cost in options]
                if filler:
                    steps.append((a, b, last, score - FILLER_COST - (2.0 if c.isdigit() else 0.0), word))
                if c == last or (i and shown[i - 1] == c and word):  # one of a run of the same sign
                    steps.append((a, b, last, score - REPEAT_COST, word))
                for a2, b2, l2, s2, w2 in steps:
                    key = (a2, b2, l2)
                    if key not in nxt or s2 > nxt[key][0]:
                        nxt[key] = (s2, w2)
            best = dict(sorted(nxt.items(), key=lambda x: -x[1][0])[:64])
        return max(((s + log[a][b][0], w) for (a, b, _), (s, w) in best.items()), default=(0.0, ""))[1]


def disguised(word: str) -> bool:
    """Letters with signs or digits between them, or a character three times in a row."""
    core = word.strip(EDGE)
    if core.isalpha():
        return THRICE.search(core) is not None
    return any(c.isalpha() for c in core) and any(c in SIGNS for c in core) and len(core) <= 40


class Restorer:
    """Words of a text with their disguise taken off."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known: dict[str, str] = {}

    def word(self, w: str) -> tuple[str, ...]:
        """Plain words that a written word holds, and what a disguise restores to."""
        got = (w,) if w.isalpha() else tuple(PLAIN.findall(w))
        return (*got, self.decoded(w)) if disguised(w) else got

    def decoded(self, w: str) -> str:
        got = self.known.get(w)
        if got is None:
            got = self.model.decode(w.strip(EDGE))
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            if len(w) <= 64:
                self.known[w] = got
        return got

    def words(self, text: str) -> set[str]:
        low = text.lower()
        out: set[str] = set()
        written = set(WORD.findall(low))
        for w in written:
            out.update(self.word(w))
        out.update(self.set_apart(low, written))
        return out

    def set_apart(self, low: str, written: set[str]) -> Iterator[str]:
        """Words whose letters stand alone, or between fillers, in a text (``low``) of the words ``written``."""
        alone = sum([len(w) == 1 for w in written]) > 1 or any("-" in w or "_" in w or "." in w[1:-1] for w in written if not w.isalpha())
        for m in SPACED.finditer(low) if alone else ():
            joined = re.sub(r"[ .\-_]", "", m.group())
            yield joined if joined.isalpha() else self.model.decode(joined)


def features(words: set[str]) -> set[str]:
    """Beginnings of words (marked by ``~``) and whole words."""
    words = {w for w in words if len(w) > 2}
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "~" for w in words if len(w) > n])
    return out


class Scorer:
    """Sum of the weights of the features a text shows, as a probability."""

    def __init__(self, weights: dict[str, float], bias: float, restore: Restorer):
        self.weights, self.bias, self.restore = weights, bias, restore
        #: of a written word, the plain words with a weight: most have none
        self.known: dict[str, tuple[tuple[str, float], ...]] = {}

    def of_word(self, w: str) -> float:
        get = self.weights.get
        return max([get(w, 0.0), *[get(w[:n] + "~", 0.0) for n in PREFIXES if len(w) > n]])

    def weighted(self, w: str) -> tuple[tuple[str, float], ...]:
        got = tuple((p, x) for p in self.restore.word(w) if (x := self.of_word(p)))
        if len(self.known) >= 2 * CACHE_ENTRIES:
            self.known.clear()
        if len(w) <= 64:
            self.known[w] = got
        return got

    def score(self, text: str) -> float:
        low = text.lower()
        written = set(WORD.findall(low))
        found = list(map(self.known.get, written))
        if None in found:
            found = [self.weighted(w) if x is None else x for w, x in zip(written, found)]
        shown = {p: x for plain in found if plain for p, x in plain}  # each plain word once
        shown.update((p, self.of_word(p)) for p in self.restore.set_apart(low, written))
        total = self.bias + sum(shown.values())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def feature_counts(texts: DataFrame, grams: list[tuple[int, int]]) -> DataFrame:
    """feature, toxic, clean: groups of alike rows that show a feature, by label.

    Rows whose words have the same least hash (copies mostly) are one group, so that
    the words of a text that was copied often are not taken for signs of its label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(CharacterModel(grams))
        for b in batches:
            f, g, y = [], [], []
            for t, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = restore.words(t or "")
                got = features(words)
                f += got
                g += [min((zlib.crc32(w.encode()) for w in words), default=0)] * len(got)
                y += [label] * len(got)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(g, pa.int64()), pa.array(y, pa.int64())], ["feature", "alike", "toxic"])

    rows = texts.select(F.col("text").cast("string"), F.col("toxic").cast("long")).mapInArrow(run, "feature string, alike long, toxic long")
    rows = rows.groupBy("feature", "alike").agg(F.max("toxic").alias("toxic"))
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, grams: list[tuple[int, int]]) -> tuple[dict[str, float], float]:
    """Weights of features and the bias, from at most about ``FIT_ROWS`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic")).filter("toxic in (0, 1)").filter(~held_out()).dropDuplicates(["doc_id"])
    total = known.agg(F.count("*")).first()[0]
    share = min(1.0, FIT_ROWS / max(total, 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id"), "toxic-fit")
    counts = materialize(feature_counts(rows, grams), "toxic-features")
    n = {r[0]: r[1] for r in rows.groupBy("toxic").agg(F.count("*")).collect()}
    pos, neg = float(n.get(1, 0)), float(n.get(0, 0))
    if not pos or not neg:
        return {}, NO_EVIDENCE
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    odds = ((t + 0.5) / pos) / ((c + 0.5) / neg)

    def part(k: Column, expected: Column) -> Column:
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    ratio = 2 * (part(t, (t + c) * (pos / (pos + neg))) + part(c, (t + c) * (neg / (pos + neg))))
    # what is kept is bounded by the rows fitted on
    strong = counts.filter((odds >= LEAST_ODDS) & (ratio >= LEAST_RATIO)).select("feature", F.least(F.log(odds), F.lit(MOST_WEIGHT)).alias("w")).collect()
    return {r.feature: r.w for r in strong}, NO_EVIDENCE


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    grams = [(r.gram, r.n) for r in trigram_counts(docs).collect()]  # at most LETTERS**3 rows
    weights, bias = learn(docs, labels, grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, bias, Restorer(CharacterModel(grams)))
        for b in batches:
            s = [scorer.score(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learned from ``labels``."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
