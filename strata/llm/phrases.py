"""Phrase collocations by an FM-index per shard over word ids (op 11).

1. ``shards``: each task turns its texts into shards of about ``SHARD`` bytes, one language each: the different words,
   their counts and the text as word numbers, 0 between pieces.
2. Word counts are summed over shards; words below ``LEAST`` occurrences end a phrase (no phrase that
   holds one can reach ``LEAST``).
3. For each length k from 2 on, a shard cuts its text where no frequent phrase of k - 1 words goes on, and indexes
   what is left (``Transform``: the words before every place, in the order of the words after it; one of the text
   and one of its reverse).  ``TwoWay`` holds an interval in both for each phrase and grows them by turns, a word to the left in
   the one and a word to the right in the other; phrases that are not frequent stay behind at each step.
   Counts of the phrases of k words are summed over shards.

Suffixes are sorted to k words only, which is all that phrases of k words ask for.  Every sum is exact: a phrase of k words goes by
the numbers of the frequent phrases of k - 1 words that it begins and ends with, and no shard drops one by its own count.

Frequent phrases of one length go to the tasks as arrays while they are no more than ``KNOWN`` (24 MB); beyond it each shard gets the rows
of its own phrases by joins.  ``scored`` cuts the frequent phrases, ``top_phrases`` ranks them; ``extensions`` lists the words that
follow or precede a phrase.

Defined results: null and empty texts have no words; a null lang is ``und``; rows alike count each; ids and other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, ship, table

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of the texts that a task turns into shards at a time, unless one text has more.
SHARD = 12 << 20
#: Frequent phrases of one length up to which all tasks get them as arrays of three 64-bit numbers (words: as texts).
KNOWN = 1_000_000

#: Fixed by the contract: these end a piece, blanks and tabs part words, A-Z are lower-cased.
ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- shards ----------------------------------------------------------------------------------


def numbered(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, their counts, and the texts as numbers of words from 1 on (0: a piece ends)."""
    body = b" \n ".join(t.translate(_TABLE).replace(b"\n", b" \n ") for t in texts)
    parts = pc.split_pattern(pa.array([body], pa.large_binary()).cast(pa.large_string()), " ")
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary
    is_end = pc.equal(words, "\n").to_numpy(zero_copy_only=False)
    is_word = ~is_end & ~pc.equal(words, "").to_numpy(zero_copy_only=False)
    number = np.where(is_end, 0, -1)
    number[is_word] = np.arange(1, is_word.sum() + 1)
    ids = number[coded.indices.to_numpy()]
    ids = ids[ids >= 0].astype(np.int32)
    return words.filter(pa.array(is_word)), np.bincount(ids, minlength=is_word.sum() + 1)[1:], ids


def shards(docs: DataFrame) -> DataFrame:
    """shard, lang, total, words, counts, ids (compressed 32-bit numbers)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=1).compress
        texts: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal no
            for lang, some in texts.items():
                words, counts, ids = numbered(some)
                if len(words):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([no]),
                            pa.array([lang]),
                            pa.array([int(counts.sum())]),
                            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
                            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts)),
                            pa.array([pack(ids.tobytes())], pa.binary()),
                        ],
                        ["shard", "lang", "total", "words", "counts", "ids"],
                    )
                    no += 1

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                body = text.as_buffer()
                if body is not None:
                    texts.setdefault(lang, []).append(body.to_pybytes())
                    size += len(body)
                    if size >= SHARD:
                        yield from flush()
                        texts, size = {}, 0
        yield from flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "shard long, lang string, total long, words array<string>, counts array<long>, ids binary"
    )


# --- index -----------------------------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of a text in the order of the ``depth`` words from there on (it begins anew at its end)."""
    rank, known, words = text.astype(np.int64), 1, text.astype(np.int64)
    while known < depth:  # twice the words, or one more
        step = known if 2 * known <= depth else 1
        ahead = np.roll(rank if step == known else words, -known)
        rank = rank * (int(ahead.max(initial=0)) + 1) + ahead
        known += step
        if known < depth:
            _, rank = np.unique(rank, return_inverse=True)
    return np.argsort(rank, kind="stable")


class Transform:
    """The words before each place of a text, in the order of the words from there on, and where they lead.

    A range of places is the interval of a phrase if the words from there on begin with it.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.place = suffix_order(text, depth)
        self.before = np.roll(text, 1)[self.place]
        by = np.argsort(self.before, kind="stable")
        self.to = np.empty(len(text), np.int64)
        self.to[by] = np.arange(len(text))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])

    def extend(self, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """All words before the intervals: interval, word, new start, count, how many have a smaller word before them."""
        ends = np.cumsum(n)
        owner = np.repeat(np.arange(len(lo)), n)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(lo, n)
        key = owner * (int(self.before.max(initial=0)) + 1) + self.before[place]
        by = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.diff(key[by], prepend=-1))
        first = by[at]
        of = owner[first]
        return of, self.before[place[first]], self.to[place[first]], np.diff(np.append(at, len(by))), at - (ends - n)[of]


class TwoWay:
    """Phrases of a text (0: no phrase goes on) with their intervals in the text and in its reverse."""

    def __init__(self, text: np.ndarray, longest: int):
        self.text, self.longest, self.size = text, longest, 1
        self.ahead = Transform(text, longest)
        n = np.diff(self.ahead.first)
        words = np.flatnonzero(n[1:]) + 1
        self.n = n[words]
        self.lo = self.back_lo = self.ahead.first[words]

    @cached_property
    def back(self) -> Transform:
        return Transform(self.text[::-1], self.longest)

    def left(self) -> None:
        """One word more before each phrase."""
        of, word, lo, n, smaller = self.ahead.extend(self.lo, self.n)
        self._take(word > 0, lo, self.back_lo[of] + smaller, n)

    def right(self) -> None:
        """One word more after each phrase."""
        of, word, lo, n, smaller = self.back.extend(self.back_lo, self.n)
        self._take(word > 0, self.lo[of] + smaller, lo, n)

    def _take(self, go: np.ndarray, lo: np.ndarray, back_lo: np.ndarray, n: np.ndarray) -> None:
        self.lo, self.back_lo, self.n = lo[go], back_lo[go], n[go]
        self.size += 1

    def keep(self, go: np.ndarray) -> None:
        self.lo, self.back_lo, self.n = self.lo[go], self.back_lo[go], self.n[go]

    def places(self) -> np.ndarray:
        """Where each phrase occurs once."""
        return self.ahead.place[self.lo]


# --- sums over shards ------------------------------------------------------------------------


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.int32)


class Pairs:
    """Numbers of frequent phrases by what they begin and end with."""

    def __init__(self, x: np.ndarray, y: np.ndarray, number: np.ndarray):
        by = np.lexsort((y, x))
        self.number = number[by]
        self.x, self.y = np.unique(x), np.unique(y)
        self.key = np.searchsorted(self.x, x[by]) * len(self.y) + np.searchsorted(self.y, y[by])

    def find(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The number of each (x, y); 0 where there is none or a part is 0."""
        out = np.zeros(len(x), np.int64)
        live = np.flatnonzero((x > 0) & (y > 0))
        if len(self.key) and len(live):
            i, j = (np.minimum(np.searchsorted(u, v[live]), len(u) - 1) for u, v in ((self.x, x), (self.y, y)))
            key = i * len(self.y) + j
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = (self.x[i] == x[live]) & (self.y[j] == y[live]) & (self.key[at] == key)
            out[live] = np.where(hit, self.number[at], 0)
        return out


def _ahead(x: np.ndarray, by: int = 1) -> np.ndarray:
    return np.append(x[by:], np.zeros(min(by, len(x)), x.dtype))


def phrases_at(text: np.ndarray, tables: list[Pairs]) -> list[np.ndarray]:
    """For sizes 1, 2, ...: the number of the frequent phrase that begins at each place, or 0."""
    out = [text]
    for t in tables:
        out.append(t.find(out[-1], _ahead(out[-1])))
    return out


def cut_rare(text: np.ndarray, longest: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``text`` in a frequent phrase of ``size`` words, 0 where none goes on; and their places (-1: a 0).

    ``longest`` holds the phrases of ``size`` words at each place.
    """
    starts = longest > 0
    inside, goes_on = np.zeros(len(text), bool), np.zeros(len(text), bool)
    for i in range(size):
        began = np.append(np.zeros(min(i, len(text)), bool), starts[: max(len(text) - i, 0)])
        inside |= began
        if i < size - 1:
            goes_on |= began
    if size == 1:
        goes_on = inside & _ahead(inside)
    out = np.full((len(text), 2), -1, np.int64)
    out[:, 0] = np.arange(len(text))
    keep = np.column_stack([inside, inside & ~goes_on])
    place = np.append(np.int64(-1), out[keep])
    return np.where(place < 0, 0, text[place]), place


def counted(text: np.ndarray, tables: list[Pairs]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases one word longer than the tables' longest: what they begin with, what they end with, their count in the text."""
    at = phrases_at(text, tables)
    size = len(at)
    short, place = cut_rare(text, at[-1], size)
    _, short = np.unique(short, return_inverse=True)  # small numbers; it begins with a 0, which stays the smallest
    index = TwoWay(short, size + 1)
    while index.size <= size and len(index.n):
        (index.right if index.size % 2 == 0 else index.left)()
        here = place[index.places()]
        if index.size <= size:
            index.keep(at[index.size - 1][here] > 0)
    here = place[index.places()]
    a, b = at[-1][here], _ahead(at[-1])[here]
    go = (a > 0) & (b > 0)
    return a[go], b[go], index.n[go]


class Frequent:
    """Frequent phrases of growing size: their tables, and how a shard comes to know them."""

    def __init__(self, parts: DataFrame, words: DataFrame):
        self.spark, self.parts = parts.sparkSession, parts
        self.tables = [words]  # lang, word, a, number; then x, y, a, number
        self.sent: list = [None]
        self.local: list[DataFrame | None] = [None]
        if words.count() <= KNOWN:
            langs: dict[str, tuple[list, list]] = {}
            for r in words.select("lang", "word", "number").collect():
                names, numbers = langs.setdefault(r.lang, ([], []))
                names.append(r.word)
                numbers.append(r.number)
            self.sent[0] = self.spark.sparkContext.broadcast({k: (pa.array(w, pa.string()), np.array(n, np.int64)) for k, (w, n) in langs.items()})
        else:
            placed = parts.select("shard", "lang", F.posexplode("words").alias("at", "word"))
            self.local[0] = materialize(_per_shard(placed.join(words.select("lang", "word", "number"), ["lang", "word"]), 1, "at", "number"), "known")

    def add(self, phrases: DataFrame) -> None:
        """Phrases one word longer than the last ones: x, y (numbers of what they begin and end with), a, number."""
        k = len(self.tables) + 1
        if phrases.count() <= KNOWN:
            t = phrases.select("x", "y", "number").toArrow()
            self.sent.append(self.spark.sparkContext.broadcast(Pairs(*(t.column(c).to_numpy() for c in ("x", "y", "number")))))
            self.local.append(None)
        else:
            own = self.counts().join(phrases.select("x", "y", "number"), ["x", "y"])
            self.sent.append(None)
            self.local.append(materialize(_per_shard(own, k, "x", "y", "number"), "known"))
        self.tables.append(phrases)

    def counts(self) -> DataFrame:
        """shard, x, y, n: phrases one word longer than the last ones, by what they begin and end with, in each shard."""
        ship(self.spark)
        sent, size = list(self.sent), len(self.tables)
        rows = self.parts.select("shard", "lang", "words", "ids")
        for t in self.local:
            rows = rows if t is None else rows.join(t, "shard", "left")

        def list_of(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
            x = batch.column(name)[i].values
            return np.empty(0, np.int64) if x is None else x.to_numpy(zero_copy_only=False).astype(np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    words = batch.column("words")[i].values
                    number = np.zeros(len(words) + 1, np.int64)
                    if sent[0] is None:
                        number[list_of(batch, "at1", i) + 1] = list_of(batch, "number1", i)
                    else:
                        names, numbers = sent[0].value.get(batch.column("lang")[i].as_py(), (pa.array([], pa.string()), np.empty(0, np.int64)))
                        at = pc.index_in(words, value_set=names).fill_null(-1).to_numpy()
                        number[1:] = np.where(at >= 0, np.append(numbers, 0)[at], 0)
                    tables = []
                    for k in range(2, size + 1):
                        if sent[k - 1] is not None:
                            tables.append(sent[k - 1].value)
                        else:
                            tables.append(Pairs(*(list_of(batch, f"{c}{k}", i) for c in ("x", "y", "number"))))
                    x, y, n = counted(number[_numbers(batch.column("ids")[i].as_py())], tables)
                    shard = pa.array(np.full(len(n), batch.column("shard")[i].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays([shard, pa.array(x), pa.array(y), pa.array(n)], ["shard", "x", "y", "n"])

        return rows.mapInArrow(run, "shard long, x long, y long, n long")


def _per_shard(rows: DataFrame, k: int, *names: str) -> DataFrame:
    """One row a shard: its rows' columns as lists in one order (no more than its own words, or phrases)."""
    lists = rows.groupBy("shard").agg(F.collect_list(F.struct(*names)).alias("_x"))
    return lists.select("shard", *(F.col(f"_x.{n}").alias(f"{n}{k}") for n in names))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a column ``number`` from 1 on, without gaps: rows before it in its part, and before its part."""
    df = materialize(df.withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", 33)
    sizes = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_first"))  # a row a part
    placed = df.withColumn("_part", part).join(F.broadcast(first), "_part")
    return placed.withColumn("number", F.col("_first") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1).drop("_id", "_part", "_first")


def phrase_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, size, a, n: all phrases of 1 to ``LONGEST`` words with at least ``LEAST`` occurrences, and the lang's words."""
    parts = materialize(shards(docs), "shards")
    totals = parts.groupBy("lang").agg(F.sum("total").alias("n"))
    in_shards = parts.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    words = in_shards.groupBy("lang", "word").agg(F.sum("c").alias("a")).filter(F.col("a") >= LEAST)
    words = _numbered(words, "words")

    frequent = Frequent(parts, words)
    named = words.select("number", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.lit(1).alias("size"))
    spelled = [named]
    for k in range(2, LONGEST + 1):
        sums = frequent.counts().groupBy("x", "y").agg(F.sum("n").alias("a")).filter(F.col("a") >= LEAST)
        longer = _numbered(sums, f"phrases-{k}")
        frequent.add(longer)
        begins = named.select(F.col("number").alias("x"), "lang", F.col("phrase").alias("begin"))
        ends = named.select(F.col("number").alias("y"), "last")
        longer = longer.join(begins, "x").join(ends, "y")
        named = materialize(longer.select("number", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "a", F.lit(k).alias("size")), f"named-{k}")
        spelled.append(named)
    every = reduce(lambda a, b: a.unionByName(b), spelled)
    return materialize(every.select("lang", "phrase", "size", "a").join(totals, "lang"), "phrases")


# --- phrases ---------------------------------------------------------------------------------


def _sub(words: str, start: int | str, n: int | str) -> F.Column:
    return F.expr(f"array_join(slice({words}, {start}, {n}), ' ')")


def extensions(counts: DataFrame) -> DataFrame:
    """lang, phrase, side, word, a: frequent words to the left and right of each phrase of ``phrase_counts``."""
    w = counts.filter("size > 1").withColumn("w", F.split("phrase", " "))
    left = w.select("lang", _sub("w", 2, "size - 1").alias("phrase"), F.lit("left").alias("side"), F.expr("w[0]").alias("word"), "a")
    return left.unionByName(w.select("lang", _sub("w", 1, "size - 1").alias("phrase"), F.lit("right").alias("side"), F.expr("w[size - 1]").alias("word"), "a"))


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each phrase of two words or more, by its lowest-scoring cut."""
    w = counts.filter("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = w.select("lang", "phrase", "size", "a", "n", "w", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": _sub("w", 1, "k"), "rest": _sub("w", "k + 1", "size - k")})
    f = counts.select("lang", "phrase", "a")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    # 38 digits hold the products of counts below 10 ** 16; div is exact
    score = F.expr("cast((cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as long)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")
    return cuts.groupBy("lang", "phrase", "size", "a", "n").agg(best).select("lang", "phrase", "size", "a", "m.l", "m.r", "n", "m.score")


def not_contained(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer candidate holds as often as they occur."""
    w = candidates.filter("size > 2").withColumn("w", F.split("phrase", " "))
    parts = w.select("lang", "w", "size", "a", F.explode(F.expr("sequence(2, size - 1)")).alias("k"))
    parts = parts.select("lang", "w", "a", "k", F.explode(F.expr("sequence(1, size - k + 1)")).alias("i"))
    held = parts.groupBy("lang", _sub("w", "i", "k").alias("phrase")).agg(F.max("a").alias("held"))
    return candidates.join(held, ["lang", "phrase"], "left").filter("held is null or 100 * held < 100 * a").drop("held")


def top_phrases(candidates: DataFrame, top: int = TOP) -> DataFrame:
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return candidates.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= top)


def op11_fm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of ``documents``: lang, rank, phrase, a, l, r, n, score."""
    best = top_phrases(not_contained(scored(phrase_counts(table(spark, sf_dir, "documents")))))
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(p, '[\x20\x09]+') IF x <> ''] AS w FROM d),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM w, range(1, 6) AS r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
u AS (SELECT c.*, unnest(range(1, size)) AS k FROM c),
s AS (SELECT u.lang, u.phrase, u.size, u.a, u.k, x.a AS l, y.a AS r, n.n, (1000::HUGEINT * u.a * n.n) // (x.a::HUGEINT * y.a) AS score
 FROM u JOIN n USING (lang) JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.k], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT lang, size, a, w, unnest(range(2, size)) AS k FROM c WHERE size > 2),
v AS (SELECT lang, a, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, size - k + 2)]) AS phrase FROM t),
h AS (SELECT lang, phrase, max(a) AS held FROM v GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN h USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM o
QUALIFY rank <= 2000
"""
