"""Spelling variants by finite-state composition (op 13).

The vocabulary is an acceptor A, one edit a transducer T (insert, delete or replace a character once); the pairs that
``A . T . A`` accepts are the words one edit apart.  It is composed part by part:

1. Words are counted in tasks and summed (``vocabulary``).
2. A word of length m is cut into ``BLOCKS`` blocks.  An edit falls into one of them, the rest is equal; so words meet by
   (length, block, rest).  The rest before the block leads to the *initial state* of a part, the rest after it
   out of its last one.  A word takes part by its own length and as the longer one of words
   of length m - 1, one of whose blocks is then a character longer: ``2 * BLOCKS`` rows a word, whatever the vocabulary.
3. A part has two minimal acceptors (equal right sides are one state), of the blocks of the shorter and
   of the longer words.  ``compose`` walks the pairs of states before the edit, takes each edit, and then reads
   both acceptors at the same characters.  Insertions are taken at their last possible place, so a pair comes once, in one part.
4. Each part gives a row per word that has a near one: how many, and the most frequent.  Pairs are never rows.

Parts are small whatever is frequent in the texts: their words differ in a third of their characters only.

Forms lead to words at least ``FACTOR`` times as frequent, so chains are short (27 steps for 64-bit counts); roots
follow by doubling the links, written after each round.

Defined results: null and empty texts have no words; a null id is the empty string in the seed of an altered word;
rows alike count each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import materialize, ship, table

LEAST_CHARS = 6
LEAST_COUNT = 5
FACTOR = 5
ALTERED = 199
BLOCKS = 3
#: Different words that a task counts before it hands them on.
COUNTED = 200_000
ROWS = 20_000

RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_CHARS)
LOWER = {c: c + 32 for c in range(65, 91)}


def altered(word: str, seed: int) -> str:
    """``word`` without one of its characters where ``ALTERED`` divides the checksum of id and word."""
    if seed % ALTERED:
        return word
    at = seed % len(word)
    return word[:at] + word[at + 1 :]


def document_words(doc_id: object, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text and how often they occur in it."""
    start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for w, n in Counter(RUN.findall(text.translate(LOWER))).items():
        h = zlib.crc32(w.encode(), start)
        if h % ALTERED:
            yield w, n
        elif len(w) > LEAST_CHARS:
            yield altered(w, h), n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least ``LEAST_CHARS`` characters that occur ``LEAST_COUNT`` times or more."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: dict[str, int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        counts: dict[str, int] = {}
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                text = t.as_py()
                if text:
                    for w, n in document_words(i.as_py(), text):
                        counts[w] = counts.get(w, 0) + n
                    if len(counts) >= COUNTED:
                        yield rows(counts)
                        counts = {}
        yield rows(counts)

    words = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- parts -----------------------------------------------------------------------------------


def parts(words: DataFrame) -> DataFrame:
    """length, block, left, right, longer, middle, n: a word's rows, twice for each of its blocks."""
    m = F.length("word")
    rows = []
    for longer in (0, 1):
        n = m - longer
        for j in range(BLOCKS):
            s = F.floor(n * j / BLOCKS).cast("int")
            e = F.floor(n * (j + 1) / BLOCKS).cast("int") + longer
            rows.append(
                F.struct(
                    n.alias("length"),
                    F.lit(j).alias("block"),
                    F.substr("word", F.lit(1), s).alias("left"),
                    F.substr("word", e + 1, m).alias("right"),
                    F.lit(bool(longer)).alias("longer"),
                    F.substr("word", s + 1, e - s).alias("middle"),
                )
            )
    return words.select("n", F.explode(F.array(*rows)).alias("p")).select("p.*", "n")


class Acceptor:
    """A minimal acceptor of words of one length: states with equal right sides are one."""

    def __init__(self, words: Iterable[str]):
        tree: list[dict[str, int]] = [{}]
        for w in words:
            at = 0
            for c in w:
                to = tree[at].get(c)
                if to is None:
                    to = tree[at][c] = len(tree)
                    tree.append({})
                at = to
        self.arcs: list[dict[str, int]] = [{}]  # state 0 ends every word
        known: dict[tuple, int] = {(): 0}
        state = [0] * len(tree)
        for at in range(len(tree) - 1, -1, -1):  # what follows a state came after it
            arcs = {c: state[to] for c, to in sorted(tree[at].items())}
            key = tuple(arcs.items())
            if key not in known:
                known[key] = len(self.arcs)
                self.arcs.append(arcs)
            state[at] = known[key]
        self.start = state[0]


def compose(short: Acceptor, long: Acceptor | None, last: bool) -> Iterator[tuple[str, str]]:
    """Pairs of words one edit apart: two of the shorter ones, or a shorter and a longer one.

    ``last``: the block ends the word, so that the inserted character may come after all others.
    """
    shared: dict[tuple[bool, int, int], list[str]] = {}

    def common(other: Acceptor, p: int, q: int) -> list[str]:
        """What both states accept."""
        key = (other is short, p, q)
        if key not in shared:
            read = ""
            while True:  # long ways without a fork need no stack
                a, b = short.arcs[p], other.arcs[q]
                ways = [c for c in a if c in b]
                if len(ways) != 1:
                    break
                read, p, q = read + ways[0], a[ways[0]], b[ways[0]]
            if not a and not b:
                shared[key] = [read]
            else:
                shared[key] = [read + c + s for c in ways for s in common(other, a[c], b[c])]
        return shared[key]

    # states before the edit: both acceptors have read the same characters
    todo: list[tuple[str, int, int | None]] = [("", short.start, None if long is None else long.start)]
    while todo:
        read, p, q = todo.pop()
        arcs = short.arcs[p]
        for (x, px), (y, py) in itertools.combinations(arcs.items(), 2):
            for s in common(short, px, py):
                yield read + x + s, read + y + s
        longer = {} if q is None else long.arcs[q]
        for y, qy in longer.items():
            for s in common(long, p, qy):
                if s[:1] != y and (s or last):  # else it is the same insertion one place on
                    yield read + s, read + y + s
        for x, px in arcs.items():
            todo.append((read + x, px, longer.get(x)))


def near_in_part(short: dict[str, int], long: dict[str, int], last: bool) -> dict[str, tuple[int, int, str]]:
    """Middle -> near words, n of the most frequent one (of equals the smallest), its middle."""
    found: dict[str, tuple[int, int, str]] = {}
    n = short | long  # their lengths differ, so no middle is in both

    def note(a: str, b: str) -> None:
        k, m, best = found.get(a, (0, -1, ""))
        found[a] = (k + 1, *min((m, best), (n[b], b), key=lambda x: (-x[0], x[1])))

    for u, v in compose(Acceptor(short), Acceptor(long) if long else None, last):
        note(u, v)
        note(v, u)
    return found


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: rows of each part (a word may be in several) that hold near words."""
    ship(words.sparkSession)
    names = ["word", "n_near", "best_n", "best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names
            )

        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        out: list[tuple] = []
        for (_, block, left, right), group in itertools.groupby(each(), lambda r: r[:4]):
            sides: tuple[dict[str, int], dict[str, int]] = ({}, {})
            for *_, longer, middle, n in group:
                sides[longer][middle] = n
            short, long = sides
            if not short or len(short) + len(long) < 2:
                continue
            for w, (k, n, best) in near_in_part(short, long, block == BLOCKS - 1).items():
                out.append((left + w + right, k, n, left + best + right))
            if len(out) >= ROWS:
                yield rows(out)
                out = []
        if out:
            yield rows(out)

    key = ["length", "block", "left", "right"]
    return parts(words).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "word string, n_near long, best_n long, best string")


# --- forms -----------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): links are doubled until none goes further."""
    cur = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        cur = materialize(cur.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        if cur.filter("moved").isEmpty():
            return cur.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of the words of ``docs``."""
    words = materialize(vocabulary(docs), "vocabulary")
    none = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best")]
    found = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))))
    one = (
        words.select("word", "n", *none)
        .unionByName(found)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
        .withColumn("is", F.coalesce(-F.col("b.less") >= FACTOR * F.col("n"), F.lit(False)))
        .select("word", "n", "n_near", F.when(F.col("is"), F.col("b.form")).alias("form"), F.when(F.col("is"), -F.col("b.less")).alias("form_n"))
    )
    one = materialize(one, "forms")
    return one.join(roots(one.filter(F.col("form").isNotNull())), "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all ``documents``."""
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


#: Checksums bit by bit, near words by the texts left when one character goes.
ORACLE_SQL = r"""
WITH RECURSIVE b AS (SELECT [x FOR x IN range(256)] AS i),
b1 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b), b2 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b1),
b3 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b2), b4 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b3),
b5 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b4), b6 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b5),
b7 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b6), b8 AS (SELECT [xor(x >> 1, 3988292384 * (x & 1)) FOR x IN i] AS i FROM b7),
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
d AS (SELECT w, count(*) AS c, hex(encode(concat(doc_id, ':', w))) AS x FROM o WHERE length(w) >= 6 GROUP BY doc_id, w),
e AS (SELECT w, c, [ascii(x[2 * k + 1]) - CASE WHEN x[2 * k + 1] > '9' THEN 55 ELSE 48 END FOR k IN range(len(x) // 2)] AS hi, [ascii(x[2 * k + 2]) - CASE WHEN x[2 * k + 2] > '9' THEN 55 ELSE 48 END FOR k IN range(len(x) // 2)] AS lo FROM d),
q AS (SELECT w, c, xor(list_reduce(list_prepend(4294967295, [(16 * hi[k] + lo[k])::BIGINT FOR k IN range(1, len(hi) + 1)]), LAMBDA s, y: xor(s >> 8, t[xor(s & 255, y) + 1])), 4294967295) AS h FROM e, (SELECT i AS t FROM b8)),
a AS (SELECT CASE WHEN h % 199 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, c FROM q),
v AS (SELECT word, sum(c)::BIGINT AS n FROM a WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
g AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
z AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS x FROM g),
m AS (SELECT x.word, y.word AS near, y.n AS m FROM z x JOIN z y ON x.x = y.x AND x.i = y.i AND x.word <> y.word
 UNION SELECT z.word, v.word, v.n FROM z JOIN v ON z.x = v.word UNION SELECT v.word, z.word, z.n FROM z JOIN v ON z.x = v.word),
r AS (SELECT word, count(*) AS n_near, max(m) AS m FROM m GROUP BY word),
s AS (SELECT r.word, n_near, r.m, min(near) AS form FROM r JOIN m ON m.word = r.word AND m.m = r.m GROUP BY ALL),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN form END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN s USING (word)),
l AS (SELECT word, word AS root FROM f UNION ALL SELECT l.word, f.form FROM l JOIN f ON f.word = l.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM f JOIN l USING (word) LEFT JOIN f e ON e.word = l.root WHERE e.form IS NULL
"""
