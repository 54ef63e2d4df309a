"""The operators against brute force, and on odd and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import annsearch, bpe, deobfuscate, fixity, graph, mixing, neardup, quality, spans, substringdedup, suffixdedup, tokencount
from strata.llm.storage import table

from .conftest import SCHEMA, prose

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
tokenizers_files = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def small(spark):
    return table(spark, SMALL, "documents")


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# --- byte-level BPE ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBPE(tokenizers_files.path(bpe.VOCABULARY), tokenizers_files.PATTERN)


@pytest.fixture(scope="module")
def exact(coder):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenizers_files.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_bpe_matches_the_library(coder, exact):
    random.seed(1)
    signs = [" ", "  ", "\n", "a", "aaaa", "'s", "é", "7777", "中", "😀", " ", "\x1c", "$$", "the", "\t", "\r\n", "x" * 300, "<|endoftext|>"]
    for _ in range(400):
        t = "".join(random.choice(signs) for _ in range(random.randint(0, 25)))
        ids = coder.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == exact.encode_ordinary(t)
        assert coder.decode(ids) == t.encode()


def test_bpe_queue_is_the_same_alone_and_together(coder):
    random.seed(2)
    tokens = [bytes(random.choice(b"abcde ssth") for _ in range(random.randint(1, 60))) for _ in range(200)]
    assert coder.merger.merge(tokens) == [coder.merger.merge_long(t) for t in tokens]


def test_bpe_documents(spark, odd, empty, exact):
    path, pattern = tokenizers_files.path(bpe.VOCABULARY), tokenizers_files.PATTERN
    got = bpe.digest(odd, path, pattern).collect()
    texts = Counter((i, t or "") for i, t in rows_of(odd))
    assert len(got) == sum(texts.values())
    want = Counter()
    for (i, t), n in texts.items():
        ids = exact.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += n
    assert Counter(tuple(r) for r in got) == want
    assert bpe.digest(empty, path, pattern).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(odd, path, pattern), path, pattern).collect()
    assert Counter((r.doc_id, bytes(r.body).decode()) for r in back) == texts


# --- unigram counts ------------------------------------------------------------------------


def test_token_counts_match_the_library(spark, odd, empty):
    from tokenizers import Tokenizer, models

    path = tokenizers_files.path(tokencount.VOCABULARY)
    pieces = tokencount.vocabulary(path)
    ref = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + pieces, 0, True))

    def count(t):
        return len(ref.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0

    got = tokencount.token_counts(odd, path).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, count(t)) for i, t in rows_of(odd))
    assert tokencount.token_counts(empty, path).count() == 0


# --- near duplicates -------------------------------------------------------------------------


def brute_components(docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in docs:
        w = WORD.findall(t.translate(low))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, odd, empty, monkeypatch):
    docs = [(i, t) for i, t in rows_of(odd) if i is not None]
    for i in range(40):  # a group of copies with more and more edits
        w = prose(150, 5).split()
        for k in range(i % 7):
            w[(k * 23 + i) % 150] = f"edit{i}x{k}"
        docs.append((100 + i, " ".join(w)))
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, node long")
    want = brute_components(docs)
    for block in (1500, 7):  # clusters in one block and split over many
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = neardup.near_duplicates(df).collect()
        assert len(got) == len(docs)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert [(r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect() if r.doc_id is None] == [(None, True)]
    assert neardup.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 101), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 100: 50, 101: 50}


# --- repeated substrings ---------------------------------------------------------------------


def covered(tokens_by_id, width):
    """Per row the set of covered places; rows in order of id, null last."""
    first, out = {}, []
    order = sorted(range(len(tokens_by_id)), key=lambda n: (tokens_by_id[n][0] is None, tokens_by_id[n][0] or 0))
    marks = [set() for _ in tokens_by_id]
    for n in order:
        i, t = tokens_by_id[n]
        for s in range(len(t) - width + 1):
            key = t[s : s + width]
            at = first.setdefault(key, (i, s))
            if at != (i, s):
                marks[n].update(range(s, s + width))
    return marks or out


@pytest.mark.parametrize("group", [2000, 1])
def test_repeated_words_and_bytes(spark, odd, empty, small, tmp_path, monkeypatch, group):
    monkeypatch.setattr(spans, "GROUP", group)
    docs = odd.select("doc_id", "text", "k").unionByName(small.select((F.col("doc_id") + 1000).alias("doc_id"), F.substring("text", 1, 3000).alias("text"), F.lit("z").alias("k")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = rows_of(docs)
    words = [(i, tuple(WORD.findall(t))) for i, t in rows]
    want = Counter()
    for (i, w), gone in zip(words, covered(words, 20), strict=True):
        left = [x for n, x in enumerate(w) if n not in gone]
        want[i, len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in substringdedup.op8_relative_lempel_ziv(spark, str(tmp_path)).collect()) == want
    texts = [(i, t.encode()) for i, t in rows]
    want = Counter()
    for (i, b), gone in zip(texts, covered(texts, 100), strict=True):
        left = bytes(x for n, x in enumerate(b) if n not in gone)
        runs = sum(n - 1 not in gone for n in gone)
        want[i, len(b), len(gone), runs, hashlib.sha256(left).hexdigest()] += 1
    assert Counter(tuple(r) for r in suffixdedup.op7_run_length_suffix(spark, str(tmp_path)).collect()) == want
    assert substringdedup.repeated_words(empty).count() == 0 and suffixdedup.repeated_bytes(empty).count() == 0


def repeats_by_hand(docs):
    """What op8 and op7 give for ``docs``, as counted rows."""
    rows, words, texts = rows_of(docs), Counter(), Counter()
    cut = [(i, tuple(WORD.findall(t))) for i, t in rows]
    for (i, w), gone in zip(cut, covered(cut, 20), strict=True):
        left = " ".join(x for n, x in enumerate(w) if n not in gone)
        words[i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
    cut = [(i, t.encode()) for i, t in rows]
    for (i, b), gone in zip(cut, covered(cut, 100), strict=True):
        left = bytes(x for n, x in enumerate(b) if n not in gone)
        texts[i, len(b), len(gone), sum(n - 1 not in gone for n in gone), hashlib.sha256(left).hexdigest()] += 1
    return words, texts


def test_pieces_hold_each_window_once():
    for width, gram in ((20, 8), (100, 32)):
        for size in (0, width - 1, width, 299, 300, 301, 300 + width, 2000):
            tokens = np.random.default_rng(size).integers(0, 2**63, size, dtype=np.uint64)
            got = [np.arange(s, s + n) for _, _, starts, counts in spans.pieces(tokens, width, gram, 300) for s, n in zip(starts, counts, strict=True)]
            assert np.concatenate([np.array([], int), *got]).tolist() == list(range(max(size - width + 1, 0)))


@pytest.mark.parametrize("group", [2000, 1])
def test_texts_in_many_chunks(spark, odd, tmp_path, monkeypatch, group):
    monkeypatch.setattr(spans, "GROUP", group)
    monkeypatch.setattr(spans, "CHUNK", 300)
    odd.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    words, texts = repeats_by_hand(odd)
    assert Counter(tuple(r) for r in substringdedup.op8_relative_lempel_ziv(spark, str(tmp_path)).collect()) == words
    assert Counter(tuple(r) for r in suffixdedup.op7_run_length_suffix(spark, str(tmp_path)).collect()) == texts


@pytest.mark.parametrize("group", [2000, 1])
def test_repeats_of_texts_without_an_id(spark, odd, tmp_path, monkeypatch, group):
    monkeypatch.setattr(spans, "GROUP", group)
    header, own = prose(90, 21), [prose(50, 30 + n) for n in range(7)]
    changed = header.split()
    changed[45] = "changed"
    texts = [f"{header} {own[0]}", f"{header} {own[1]}", f"{own[2]} {header} {own[3]}", " ".join(changed) + f" {own[4]}", f"{own[5]} " + " ".join(changed), f"{header} {own[0]}"]
    rows = [(None, t) for t in texts] + [(20, f"{own[6]} {own[0]}"), (20, f"{own[6]} {own[1]}")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    keyed = sorted(docs.select("doc_id", F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[2]))

    def by_hand(tokens, width):
        first = {}
        for i, text, t in keyed:
            w, gone = tokens(text), set()
            for s in range(len(w) - width + 1):
                if first.setdefault(w[s : s + width], (i, t, s)) != (i, t, s):
                    gone.update(range(s, s + width))
            yield i, w, gone

    want = Counter((i, len(w), len(gone), hashlib.sha256(" ".join(x for n, x in enumerate(w) if n not in gone).encode()).hexdigest()) for i, w, gone in by_hand(lambda x: tuple(WORD.findall(x)), 20))
    assert Counter(tuple(r) for r in substringdedup.op8_relative_lempel_ziv(spark, str(tmp_path)).collect()) == want
    want = Counter((i, len(b), len(gone), sum(n - 1 not in gone for n in gone), hashlib.sha256(bytes(x for n, x in enumerate(b) if n not in gone)).hexdigest()) for i, b, gone in by_hand(str.encode, 100))
    assert Counter(tuple(r) for r in suffixdedup.op7_run_length_suffix(spark, str(tmp_path)).collect()) == want


def test_run_length_index(spark):
    random.seed(3)
    for _ in range(200):
        base = bytes(random.choice(b"ab") for _ in range(120))
        contents = []
        for _ in range(random.randint(1, 12)):
            c = bytearray(base[random.randint(0, 40) : random.randint(60, 120)])
            if random.random() < 0.7:
                c[random.randrange(len(c))] = 99
            contents.append(bytes(c))
        contents = list(dict.fromkeys(contents))
        seen = set()
        for c, got in zip(contents, suffixdedup.earlier_bytes(contents, 10), strict=True):
            want = set()
            for i in range(len(c) - 9):
                if c[i : i + 10] in seen:
                    want.update(range(i, i + 10))
                seen.add(c[i : i + 10])
            assert {i for s, e in got for i in range(s, e)} == want


def test_relative_lempel_ziv_factors():
    contents = [b"a b c d e f g h", b"x b c d e f y c d e f g h", b"a b c d e f g h i"]
    assert substringdedup.earlier_words(contents, 4) == [[], [(1, 6), (7, 13)], [(0, 8)]]


# --- quality ---------------------------------------------------------------------------------


def test_quality_counts(spark, odd, empty, small):
    for docs in (odd, small):
        got = {(r.doc_id, *[r[c] for c in quality.COUNTS], r.base_failed) for r in quality.judged(docs).collect()}
        want = set()
        for i, t in rows_of(docs):
            w = WORD.findall(t)
            grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
            repeated = {x for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for x in range(k, k + 5)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            n = len(w)
            want.add((i, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated), n < 10 or 100 * len(repeated) > 20 * n))
        assert got == want
    assert quality.judged(empty).count() == 0


def test_quality_rejects_outliers_only(spark):
    rows = [(i, prose(80 + i % 50, i), "en", "a") for i in range(300)] + [(1000, prose(200, 999).replace(" ", "### "), "en", "a")]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [i for i, k in got.items() if not k] == [1000]


def test_mcd_matches_numpy(spark, small):
    """The last concentration step and the distances, worked out again from the rows."""
    v = quality._pools(quality.statistics(small.select("doc_id", "lang", "source", quality.text_counts(F.col("text")).alias("c")).select("doc_id", "lang", "source", "c.*"))).cache()
    est = quality.fit(v)
    x = np.array([[r[d] / quality.SCALE for d in quality.DIMS] for r in v.select(*quality.DIMS).collect()])
    e = {r.pool: r for r in est.collect()}
    got = sorted((r.pool, r.d2) for r in quality.with_distance(v, est).select("pool", "d2").collect())
    want = []
    for r in v.collect():
        p = e[r.pool]
        low = np.array([[p[f"l{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
        y = np.linalg.solve(low, np.array([r[d] / quality.SCALE for d in quality.DIMS]) - [p[f"m{i}"] for i in range(4)])
        want.append((r.pool, float(y @ y)))
    assert len(x) == len(got)
    assert np.allclose([d for _, d in got], [d for _, d in sorted(want)])


# --- mixing ----------------------------------------------------------------------------------


def targets_by_hand(sizes, cycle=3, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % cycle + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in names}
        stopped |= over


def test_mix(spark, odd, empty, small):
    medium = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    for docs in (small, medium, odd):
        got = mixing.mix(docs).collect()
        text = Counter((i, len(WORD.findall(t))) for i, t in rows_of(docs))
        assert Counter((r.doc_id, r.size) for r in got) == text
        by = defaultdict(int)
        source = {r.doc_id: r.source for r in docs.collect()}
        for r in got:
            by[source[r.doc_id]] += r.size
        want = targets_by_hand(dict(by))
        taken = defaultdict(int)
        for r in got:
            assert r.source_size == by[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
            assert 0 <= r.copies <= 3
            taken[source[r.doc_id]] += r.copies * r.size
        if docs is small:  # ten documents a source: within half of the largest
            assert all(abs(taken[s] - want[s]) <= max(r.size for r in got if source[r.doc_id] == s) / 2 for s in want)
        if docs is medium:
            assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in want)
    assert Counter(tuple(r) for r in mixing.mix(small).collect()) == Counter(tuple(r) for r in mixing.mix(small.repartition(7)).collect())
    assert mixing.mix(empty).count() == 0


# --- nearest vectors -------------------------------------------------------------------------


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(annsearch, "CELL_ROWS", 60)
    monkeypatch.setattr(annsearch, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((8, 16))[rng.integers(0, 8, 600)] + 0.6 * rng.standard_normal((600, 16))
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    rows += [(700 + i, rows[40][1], 1) for i in range(50)]  # one very common vector
    bad = [(900, None, 1), (920, [0.0] * 16, 1), (940, [1.0, None] * 8, 1), (960, [float("nan")] * 16, 1), (980, [1.0, 2.0], 1), (None, rows[0][1], 1)]
    got = defaultdict(list)
    for r in annsearch.nearest(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ids, mat = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        s = (mat * mat[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        s[ids == q] = -np.inf
        want = np.lexsort((ids, -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        hit += len({f[1] for f in found} & set(ids[want].tolist()))
        assert all(abs(f[2] - s[np.flatnonzero(ids == f[1])[0]]) < 1e-9 for f in found)
    assert hit >= 0.9 * 20 * len(got)
    assert annsearch.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- fixity ----------------------------------------------------------------------------------


def test_fixity_finds_damage(spark):
    pages = [(i, f"http://x/{i}", "y" * (i % 700), 3) for i in range(2500)] + [(None, None, None, 3), (5, "http://x/5", "again", 3)]
    a = fixity.records(spark.createDataFrame(pages, "page_id long, url string, html string, idx int")).cache()
    b = a.withColumn("record", F.when(F.col("page_id").isin(17, 1900), F.upper("record")).otherwise(F.col("record"))).filter("page_id is null or page_id != 42")
    place = {r.page_id: (r.file_no, r.offset) for r in a.collect()}
    _, bad = fixity.audit(a, b)
    assert {(r.file_no, r.offset, r.status) for r in bad.collect()} == {(*place[17], "corrupt"), (*place[1900], "corrupt"), (*place[42], "missing")}
    assert fixity.audit(a, a)[1].count() == 0
    none = a.limit(0)
    assert fixity.audit(none, none)[1].count() == 0


def test_fixity_numbers_records_without_bodies(spark):
    pages = [(None if i % 3 else 5, f"http://x/{i % 400}", "y" * (i % 70)) for i in range(1500)] + [(-3, "u", "z"), (1007, "u", "z")]
    recs = fixity.records(spark.createDataFrame(pages, "page_id long, url string, html string"))
    at = {}
    for r in recs.collect():
        at.setdefault(r.file_no, []).append((r.offset, r.page_id is not None, r.page_id or 0, hashlib.sha256(r.record.encode()).hexdigest(), r.n_bytes))
    assert sum(map(len, at.values())) == len(pages)
    for rows in at.values():
        rows.sort()
        assert [r[1:4] for r in rows] == sorted(r[1:4] for r in rows)
        assert [r[0] for r in rows] == [sum(r[4] for r in rows[:n]) for n in range(len(rows))]
    todo, windows = [recs._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            windows += 1
            assert "record" not in node.output().mkString(" ")
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert windows


# --- toxicity --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def insults(spark):
    docs, labels = [], []
    for i in range(900):
        w = prose(60, i).translate(str.maketrans("0123456789", "abcdefghij")).split()
        if i % 3 == 0:
            for k in range(3):
                w[10 + 7 * k] = ("idiot", "stupid", "moron")[(i // 3 + k) % 3]
        docs.append((i, " ".join(w), "en", i))
        labels.append((i, int(i % 3 == 0)))
    shown = ["1d10t", "st*pid", "m0r0n", "idioooot", "s t u p i d", "i.d.i.o.t"]
    docs += [(5000 + n, prose(40, 5000 + n).translate(str.maketrans("0123456789", "abcdefghij")) + f" {w} and {w} " + "plain words", "en", n) for n, w in enumerate(shown)]
    docs += [(6000, None, None, 1), (6001, "", "en", 1), (None, "idiot stupid moron", "en", 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score long"), spark.createDataFrame(labels, "doc_id long, toxic int"), len(shown)


def test_toxicity(spark, insults):
    docs, labels, n = insults
    got = {r.doc_id: r for r in deobfuscate.toxicity(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [i for i in range(900) if got[i].held_out]
    assert held and all(got[i].predicted == (i % 3 == 0) for i in held)
    assert [got[5000 + k].predicted for k in range(n)] == [1] * n
    assert got[6000].predicted == got[6001].predicted == 0 and got[None].held_out and got[None].predicted == 1
    blank = spark.createDataFrame([], SCHEMA)
    assert deobfuscate.toxicity(blank, labels).count() == 0
    assert {r.predicted for r in deobfuscate.toxicity(docs, labels.limit(0)).collect()} == {0}
