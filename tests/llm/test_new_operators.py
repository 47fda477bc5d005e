"""Phrases, line dedup and lexical search against plain Python, on rows that hold the difficult cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelgauge.llm import lexical, line_dedup, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# Line dedup


def plain_dedup(rows, least=line_dedup.LEAST):
    keys = [[x.strip(BLANK).translate(LOWER) for x in (t or "").split("\n")] for _, t in rows]
    order = [(1 << 63) - 1 if i is None else i for i, _ in rows]
    holders = defaultdict(set)
    for at, mine in zip(order, keys):
        for key in mine:
            holders[key].add(at)
    out = []
    for (i, t), at, mine in zip(rows, order, keys):
        gone = [len(k) >= least and min(holders[k]) != at for k in mine]
        text = "\n".join(x for x, g in zip((t or "").split("\n"), gone) if not g)
        out.append((i, len(mine), sum(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got_dedup(docs, **options):
    rows = line_dedup.dedup_lines(docs, **options).collect()
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows), key=repr)


def line_rows(n=60):
    random = np.random.default_rng(3)
    pool = ["A common first Line", " a common FIRST line\t", "short", "", "nine char", "ten chars!", "Ünïcode Zeile É", "ünïcode zeile É"] + [f"line number {i} of the pool" for i in range(30)]
    rows = [(int(i), "\n".join(random.choice(pool, random.integers(1, 9)))) for i in random.permutation(n)]
    return rows + [(None, "a common first line\nonly here, no id"), (None, None), (n, ""), (n + 1, "\n\n"), (0, "a common first line\nanother text of zero"), rows[5], (n + 2, "\n".join(f"line number {i % 40} of the pool" for i in range(20_000)))]


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (8, 3)])
def test_lines(spark, batches, fanout):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n_lines int, _pos string, _h1 int").repartition(5)
    assert got_dedup(docs, batches=batches, fanout=fanout) == plain_dedup(rows)


def test_lines_of_difficult_rows(corpus, empty):
    assert got_dedup(corpus) == plain_dedup([(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()])
    assert got_dedup(empty) == []


def test_runs_are_merged_by_level(spark):
    runs = line_dedup.LineRuns(spark, 2)
    for batch in range(5):
        lines = spark.createDataFrame([(batch, 0, 0, h, h) for h in range(batch, batch + 4)], "_doc long, _of long, _pos int, _h1 long, _h2 long")
        gone = runs.add(lines)
        assert gone.count() == (3 if batch else 0)
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    held = [r["_h1"] for level in runs.levels for run in level for r in run.collect()]
    assert sorted(held) == list(range(8))
    plan = runs.new_of(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("ENSURE_REQUIREMENTS") == 1  # the runs are not shuffled
    runs.forget()


# Lexical search


def plain_search(docs, items, k=10):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            scores.append((-s, i is None, i or 0))
        best = sorted(x for x in scores if x[0] < 0)[:k]
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(best)]
    return sorted(out, key=repr)


def search_rows(n=400):
    random = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["Épée", "épée", "x-y", "漢字"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda k: " ".join(random.choice(vocabulary, k, p=share / share.sum()))
    docs = [(i, text(random.integers(1, 80))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (None, None), (n + 50, ""), (n + 51, "!!! ..."), (n + 52, text(30_000)), docs[3], docs[3]]
    items = [(i, text(random.integers(1, 30))) for i in range(25)] + [(30, docs[7][1]), (31, ""), (32, None), (33, "nowhere found"), (None, "w1 w2"), (5, "w250 w251")]
    return docs, items


@pytest.mark.parametrize("item_bytes", [1 << 20, 400])
def test_search(spark, item_bytes, monkeypatch):
    docs, items = search_rows()
    monkeypatch.setattr(lexical.blocks, "__defaults__", (3000,))
    table = spark.createDataFrame([(i, t, 1, "a") for i, t in docs], "doc_id long, text string, score int, terms string").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = lexical.search(lexical.build_index(table), asked, 10, item_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(docs, items)


def test_search_of_difficult_rows(spark, corpus, empty):
    items = spark.createDataFrame([(1, "the quick0 brown1 fox2"), (2, "one two id")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()]
    got = lexical.search(lexical.build_index(corpus), items).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(docs, [(1, "the quick0 brown1 fox2"), (2, "one two id")])
    assert lexical.search(lexical.build_index(empty), items).count() == 0
    assert lexical.search(lexical.build_index(corpus), items.limit(0)).count() == 0


def test_accumulators_are_limited():
    """Documents met only by terms that cannot reach the k-th score get no accumulator."""
    rare = (np.arange(10), np.full(10, 1000))
    common = (np.arange(1000), np.ones(1000, np.int64))
    docs, scores = lexical.term_at_a_time([rare, common], [1000, 1], 1000, 10, 0)
    assert list(docs) == list(range(10)) and set(scores) == {1001}
    docs, _ = lexical.term_at_a_time([rare, common], [1000, 1], 1000, 11, 0)
    assert len(docs) == 1000


# Phrases


def plain_phrases(rows, least=10, top=2000):
    f, size = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    around = Counter()
    for (lang, p), a in f.items():
        if len(p) == 3 and a >= least:
            for part in (p[:2], p[1:]):
                around[lang, part] = max(around[lang, part], a)
    found = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and not (len(p) == 2 and around[lang, p] and 100 * around[lang, p] >= 50 * a):
            score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, size[lang], -s) for lang, all_ in found.items() for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top]))


def phrase_rows(n=300):
    random = np.random.default_rng(8)
    vocabulary = ["the", "of", "Über", "a", "b", "c"] + [f"w{i}" for i in range(40)]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda: "".join(w + random.choice([" ", " ", " ", " ", ", ", "\n", "\t", " . "]) for w in random.choice(vocabulary, random.integers(1, 60), p=share / share.sum()))
    rows = [(text(), [None, "en", "de", "x\ty"][i % 4]) for i in range(n)]
    return rows + [("of the hot pair " * 2000, "en"), (None, "en"), ("", None), ("...", "fr"), ("a", "fr")]


def test_phrases(spark, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, l, 1, "z") for t, l in rows], "text string, lang string, n int, phrase string").repartition(4)
    for size in (1 << 20, 256):  # with 256 most words and pairs are frequent
        got = phrases.collocations(docs, bucket_words=size).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
        assert sorted(map(tuple, got)) == plain_phrases(rows)


def test_phrases_of_difficult_rows(corpus, empty):
    rows = [(r["text"], r["lang"]) for r in corpus.select("text", "lang").collect()]
    got = phrases.collocations(corpus, least=2, top=50).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 2, 50)
    assert phrases.collocations(empty).count() == 0


def test_equal_partitions_count_prefixes():
    random = np.random.default_rng(2)
    for least in (1, 3, 10):
        keys, weights = random.integers(0, 6, (500, 3)), random.integers(1, 4, 500)
        want = Counter()
        for row, weight in zip(keys.tolist(), weights.tolist()):
            for n in (1, 2, 3):
                want[tuple(row[:n])] += weight
        got = [(tuple(keys[r, :n].tolist()), w) for rows, lengths, ws in phrases.equal_partitions(keys, weights, least) for r, n, w in zip(rows, lengths, ws)]
        assert sorted(got) == sorted((k, w) for k, w in want.items() if w >= least)
    assert phrases.equal_partitions(np.zeros((0, 3), int), np.zeros(0, int), 1) == []


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000, 4_000_000_000_001, 5_000_000_000_003
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(phrases._score("a", "l", "r")).first()
    assert row[0] == 10**6 * a * a // (l * r)
