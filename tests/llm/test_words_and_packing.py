"""Phrases, packing and spelling variants against brute force, and on odd and empty tables."""

from __future__ import annotations

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import packing, phrases, variants

from .conftest import prose

tokenizers_files = pytest.importorskip("public_tokenizers")


def rows_of(docs, *more):
    return [tuple(r) for r in docs.select("doc_id", "text", *more).collect()]


# --- phrases -------------------------------------------------------------------------------


def brute_phrases(docs, least):
    """(lang, phrase) -> count of frequent phrases of 1 to 5 words; words per lang; the scored rest, by rank."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    f = {k: a for k, a in f.items() if a >= least}
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        held = [f[lang, q] for lg, q in f if lg == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * h >= 100 * a for h in held):
            continue
        cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-cut[0], -a, " ".join(p).encode(), f[lang, p[: cut[1]]], f[lang, p[cut[1] :]]))
    ranked = {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x))}
    return f, ranked


def phrase_texts():
    random.seed(4)
    words = ["in", "the", "of", "New", "york", "city", "é", "中文", "a-b", "x|y"]
    rows = [(i, " ".join(random.choices(words, [9, 9, 5, 4, 4, 3, 2, 1, 1, 1], k=random.randint(0, 30))), random.choice(["en", "fr", None])) for i in range(60)]
    rows += [(i, "In the city of new york, the city.\tNew  york\r\nthe the the the the the", "en") for i in range(5)]
    return rows + [(70, None, "en"), (71, "", None), (72, " \t. ,", "fr"), (None, "in the city", "de"), (None, "in the city", "de"), (None, "IN THE CITY!", "de")]


@pytest.mark.parametrize("known", [1_000_000, 0])
def test_phrases_match_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(phrases, "LEAST", 3)
    monkeypatch.setattr(phrases, "KNOWN", known)
    monkeypatch.setattr(phrases, "SHARD", 700)
    rows = phrase_texts()
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, lang string, n long, phrase string").repartition(3)
    f, ranked = brute_phrases([(lang, t) for _, t, lang in rows], 3)
    counts = phrases.phrase_counts(docs)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.a for r in counts.collect()} == f
    assert max(len(p) for _, p in f) == 5
    best = phrases.top_phrases(phrases.not_contained(phrases.scored(counts)))
    assert {tuple(r) for r in best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()} == ranked
    ext = {(r.lang, r.phrase, r.side, r.word): r.a for r in phrases.extensions(counts).collect()}
    assert ext["en", "york", "left", "new"] == f["en", ("new", "york")] == ext["en", "new", "right", "york"]


def test_intervals_of_both_directions():
    random.seed(7)
    text = np.array([0] + [random.choice([0, 1, 1, 2, 3]) for _ in range(500)])
    index = phrases.TwoWay(text, 4)
    for grow in (index.left, index.right, index.right):
        grow()
        s = text.tolist()
        want = Counter(tuple(s[i : i + index.size]) for i in range(len(s) - index.size + 1))
        got = {tuple(s[p : p + index.size]): n for p, n in zip(index.places(), index.n.tolist())}
        assert got == {k: n for k, n in want.items() if 0 not in k}


def test_phrases_of_odd_and_empty_tables(spark, odd, empty):
    assert phrases.phrase_counts(odd).count() == 0
    again = odd
    for _ in range(3):
        again = again.union(again)
    f, _ = brute_phrases([(lang, t) for _, t, lang in rows_of(again, "lang")], 100)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.a for r in phrases.phrase_counts(again).collect()} == f
    assert phrases.top_phrases(phrases.not_contained(phrases.scored(phrases.phrase_counts(empty)))).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [("x", "a b", 2, 10**13, 10**15), ("x", "a", 1, 10**13 + 1, 10**15), ("x", "b", 1, 10**13 + 7, 10**15)]
    df = spark.createDataFrame(rows, "lang string, phrase string, size int, a long, n long")
    r = phrases.scored(df).first()
    assert r.score == 1000 * 10**13 * 10**15 // ((10**13 + 1) * (10**13 + 7))


# --- packing -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def path():
    return tokenizers_files.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_words_have_the_librarys_ids(path, library, odd_rows):
    random.seed(1)
    signs = [" ", "\n", "\t", "a", "The", "'s", "é", "é", "7", "中", "😀", "\x1c", "<|endoftext|>", "İ", "Σ", "́", " ", "\x00", "ſ", "x" * 40, ".", "B,", "-", "|", "À", "ß", "Œ", "×"]
    texts = ["".join(random.choices(signs, k=random.randint(0, 12))) for _ in range(3000)] + [r[1] or "" for r in odd_rows]
    for known in (packing.KNOWN, 10):
        code = packing.Encoder(path)
        packing.KNOWN, old = known, packing.KNOWN
        got = [np.frombuffer(b, "<u2").tolist() for b in code.encode(texts)]
        packing.KNOWN = old
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("size", [4096, 64, 7])
def test_pieces_hold_each_token_once(spark, odd, path, library, size):
    got = packing.packed(odd.repartition(3), path, size).collect()
    whole = Counter()
    for i, t in rows_of(odd):
        whole[i, tuple(library.encode(t or "", add_special_tokens=False).ids + [packing.END])] += 1
    # pieces of one copy follow each other by place
    at = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    places = [r.sequence_id * size + r.offset for r in at]
    lengths = [r.length for r in at]
    assert places == list(np.cumsum([0] + lengths[:-1])) and all(0 < n and r.offset + n <= size for r, n in zip(at, lengths))
    found, ids = Counter(), []
    for r in at:
        assert r.start == len(ids)
        ids += struct.unpack(f"<{r.length}I", r.ids)
        if len(ids) == r.doc_tokens:
            found[r.doc_id, tuple(ids)] += 1
            ids = []
    assert found == whole and not ids


def test_packing_of_an_empty_table_and_beyond_the_broadcast(spark, odd, empty, path, monkeypatch):
    assert packing.packed(empty, path).count() == 0
    want = {tuple(r) for r in packing.packed(odd, path, 64).collect()}
    monkeypatch.setattr(packing, "PARTS", 0)
    monkeypatch.setattr(packing, "RANGE", 2)
    assert {tuple(r) for r in packing.packed(odd, path, 64).collect()} == want
    assert [packing.padded(n) for n in (1, 3, 64, 100, 4096)] == [1, 4096, 64, 4096, 4096]


def test_the_registered_packing(spark, library):
    from strata.llm.storage import table

    got = packing.op12_concatenate_and_cut(spark, "/root/testdata/sf0.001").collect()
    texts = dict(rows_of(table(spark, "/root/testdata/sf0.001", "documents")))
    total = 0
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length]))
        total += r.length
    full = Counter(r.sequence_id for r in got)
    assert len(full) == -(-total // 4096)


# --- spelling variants -----------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_variants(docs):
    n = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    return n, forms(n)


def forms(n):
    out = {}
    for w in n:
        to = [x for x in n if near(w, x)]
        best = min(to, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = (n[w], len(to), form, n[form] if form else None)
    root = {}
    for w in out:
        r = w
        while out[r][2]:
            r = out[r][2]
        root[w] = r
    return {(w, f, root[w], k, m, fn) for w, (k, m, f, fn) in out.items()}


def test_near_words_match_brute_force(spark):
    random.seed(3)
    words = {"".join(random.choices("abé", k=random.randint(6, 9))) for _ in range(700)} | {"a" * k for k in range(6, 40)} | {"ab" * k for k in range(3, 12)}
    n = {w: random.choice([5, 6, 30, 200, 1500, 9000]) for w in words}
    got = variants.near_words(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    found = defaultdict(lambda: [0, []])
    for r in got:
        found[r.word][0] += r.n_near
        found[r.word][1].append((-r.best_n, r.best))
    want = {w: [x for x in n if near(w, x)] for w in n}
    assert {w: k for w, (k, _) in found.items()} == {w: len(x) for w, x in want.items() if x}
    assert {w: min(b) for w, (_, b) in found.items()} == {w: min((-n[x], x) for x in xs) for w, xs in want.items() if xs}


def test_composition_reads_long_words(spark):
    long = "".join(random.Random(2).choices("abcdefgh", k=40_000))
    other = long[:20_000] + "z" + long[20_001:]
    more = long[:39_999] + "y" + long[39_999:]
    got = variants.near_words(spark.createDataFrame([(long, 50), (other, 7), (more, 5)], "word string, n long")).groupBy("word").agg(F.sum("n_near").alias("k"))
    assert {len(r.word): r.k for r in got.filter(F.col("word") != other).collect()} == {40_000: 2, 40_001: 1}


def test_acceptors_are_minimal():
    a = variants.Acceptor(["tap", "top", "map", "mop"])
    assert len(a.arcs) == 4  # start, after the first letter, after the vowel, end


def test_variants_of_texts(spark, odd, empty):
    random.seed(9)
    base = ["station", "stations", "statiom", "different", "diferent", "naïveté", "Recherche", "rechêrche"]
    rows = [(i, " ".join(random.choices(base, [60, 9, 1, 30, 4, 9, 40, 2], k=60)) + f" x{prose(5, i)}", "en") for i in range(40)]
    rows += [(None, "STATION Station," * 20, None), (7, None, None), (8, "", "en"), (8, "x" * 30_000, "en")]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, lang string, word string, n long")
    _, want = brute_variants([r[:2] for r in rows])
    got = variants.spelling_variants(docs.repartition(3))
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == want
    assert any(r[1] for r in want) and got.count() == len(want)
    five = odd
    for _ in range(3):
        five = five.union(five)
    assert {tuple(r) for r in variants.spelling_variants(five).select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_variants(rows_of(five))[1]
    assert variants.spelling_variants(empty).count() == 0


def test_chains_of_forms_lead_to_their_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(26)] + [("v", "w3")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w26" for w, _ in chain}
