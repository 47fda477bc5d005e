"""The operators against brute force, on rows that hold the difficult cases."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelgauge.llm import language, mixing, near_dup, packing, preference, quality, sharding, token_count, token_file, top_k
from reelgauge.llm.common import ChunkEncoder, tokenizer, upper_limit

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(st.sampled_from("ab 's\n\tré1!.  'tlveÉ漢<|e>ndoftx"), max_size=60)


def ids_of(text):
    return np.array(tokenizer(WORD_BPE).encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def docs_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_statistics(corpus, empty, spark):
    labels = spark.createDataFrame([(None, None), (6, 1)], "doc_id long, quality int")
    got = quality.judged(corpus, labels).collect()

    def repeats(words):
        at = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        return len({j for i in range(len(words) - 7) if at[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)})

    want = []
    for doc_id, text in docs_of(corpus):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        want.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeats(words)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["kept"] != r["base_failed"] for r in got)  # one kind of label only: no threshold
    assert quality.judged(empty, labels).count() == 0


def test_forest_isolates():
    x = np.zeros((400, 2))
    x[:20, 0] = np.arange(5, 25)
    score = quality.grow(x, 50, 128, 1).score(x)
    assert score[:20].min() > score[20:].max()


def test_runs_of_one_word_are_junk(spark):
    random = np.random.default_rng(5)
    word = lambda: "".join(random.choice(list("abcdefghij"), random.integers(2, 9)))
    texts = [" ".join(word() for _ in range(random.integers(25, 200))) for _ in range(400)]
    texts += [" ".join(w for w in (word() for _ in range(8)) for _ in range(5)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.where("doc_id % 2 = 0").selectExpr("doc_id", "int(doc_id < 400) AS quality")
    kept = {r["doc_id"] for r in quality.judged(docs, labels).where("kept").collect()}
    assert not kept & set(range(400, 420)) and len(kept) >= 396


def test_limits_of_few_rows_reach_further():
    tail = np.random.default_rng(4).exponential(1.0, 20_000)
    one = np.ones(20_000, int)
    assert np.mean(tail > upper_limit(tail, one, 0.002)) == pytest.approx(0.002)
    few = [upper_limit(tail[i:i + 50], one[:50], 0.002) for i in range(0, 20_000, 50)]
    assert abs(np.median(few) - upper_limit(tail, one, 0.002)) < 2
    assert upper_limit(np.array([3.0, 0.0]), np.array([1, 999]), 0.002) == 0.0


@pytest.mark.parametrize("copies", [1, 40])
def test_near_duplicates(spark, corpus, empty, copies):
    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    more = []
    for i in range(60 * copies // (copies // 20 + 1)):  # near copies and looser ones
        words = base.copy()
        for at in random.choice(120, int(random.integers(1, 9)), replace=False):
            words[at] = f"x{random.integers(1 << 30)}"
        more.append((1000 + i, " ".join(words)))
    frame = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    sets = {}
    for doc_id, text in docs_of(frame):
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets if i is not None}
    find = lambda i: i if parent[i] == i else find(parent[i])
    for a in sorted(parent):
        for b in sorted(parent):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    got = near_dup.near_duplicates(frame).collect()
    assert len(got) == frame.count()
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        if r["doc_id"] is not None:
            assert (r["component_id"], r["kept"]) == (find(r["doc_id"]), find(r["doc_id"]) == r["doc_id"])
    assert near_dup.near_duplicates(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_encoders_agree_with_the_library(texts):
    import pyarrow as pa

    ids, counts = ChunkEncoder(WORD_BPE, 100).encode(pa.array(texts, pa.string()))
    want = [tokenizer(WORD_BPE).encode(x, add_special_tokens=False).ids for x in texts]
    assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == list(map(len, want))
    want = [len(tokenizer(BYTE_BPE).encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_count.counter(BYTE_BPE).counts([x.encode() for x in texts]).tolist() == want


def test_chunk_encoder_keeps_what_comes_again():
    """A full look-up table goes on with the chunks met again and asks the library for new ones only."""
    import pyarrow as pa

    random = np.random.default_rng(11)
    common = [f"{a}{b}o{c}" for a in "abcdefgh" for b in "aeiou" for c in ("", ".", "ß!")]
    encoder, library, asked = ChunkEncoder(WORD_BPE, 300), tokenizer(WORD_BPE), []
    learn = encoder.learn
    encoder.learn = lambda chunks: (asked.extend(chunks), learn(chunks))
    for turn in range(12):
        own = ["".join(random.choice(list("klmnop"), 7)) for _ in range(120)]
        texts = [" ".join(random.permutation(common + own)), None, " ".join(own[:9])]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
        assert len(encoder.known) <= 300 + 240
    assert sum(x in common for x in asked) <= 2 * len(common) and len(asked) >= 12 * 100
    encoder.limit = 0
    assert encoder.encode(pa.array(["abo."], pa.string()))[0].tolist() == library.encode("abo.", add_special_tokens=False).ids



def test_token_counts(corpus, empty):
    got = token_count.token_counts(corpus, BYTE_BPE).collect()
    want = [(i, len((t or "").encode()), len(tokenizer(BYTE_BPE).encode(t or "", add_special_tokens=False).ids)) for i, t in docs_of(corpus)]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == sorted((str(i), a, b) for i, a, b in want)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_count.token_counts(empty, BYTE_BPE).count() == 0
    long = b"a" * 5000 + b" b"  # a piece longer than several chunks
    assert token_count.counter(BYTE_BPE).counts([long]).tolist() == [len(tokenizer(BYTE_BPE).encode(long.decode(), add_special_tokens=False).ids)]


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_pack_round_trip(values):
    held = np.array(values, np.uint32)
    assert token_file.unpack(*token_file.pack(held), len(held)).tolist() == values


def test_stored_ids_cost_less_than_zlib():
    pick = np.random.default_rng(1)
    for top in (0, 255, 65_535, 65_536, 2**32 - 1):
        for n in (0, 1, 5, 1000):
            ids = pick.integers(0, top, n, endpoint=True).astype(np.uint32)
            back = token_file.expand(token_file.squeeze(ids))
            assert back.dtype == np.uint32 and back.tolist() == ids.tolist()
    docs = [np.minimum(pick.zipf(1.2, 1500), 49_000).astype(np.uint32) for _ in range(200)]

    def seconds(run):
        spent = []
        for _ in range(7):
            began = time.process_time()
            for ids in docs:
                run(ids)
            spent.append(time.process_time() - began)
        return min(spent)

    plain = seconds(lambda ids: zlib.compress(ids.astype("<u2").tobytes(), 1))
    assert seconds(token_file.squeeze) < 0.8 * plain
    stored, raw = sum(len(token_file.squeeze(x)) for x in docs), sum(2 * len(x) for x in docs)
    assert stored < 0.75 * raw


def test_token_files(corpus, empty):
    got = token_file.through_files(corpus, WORD_BPE).collect()
    got = sorted(got, key=lambda r: r["start"])
    assert [(r["doc_id"] is not None, r["doc_id"]) for r in got] == sorted((r["doc_id"] is not None, r["doc_id"] or 0) if r["doc_id"] is not None else (False, None) for r in got)
    at, want = 0, Counter((i, ids_of(t).tobytes()) for i, t in docs_of(corpus))
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    assert token_file.through_files(empty, WORD_BPE).count() == 0


def test_packing(corpus, empty):
    got = packing.packed(corpus, WORD_BPE, 256).collect()
    bins, pieces = {}, Counter()
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
        pieces[r["doc_id"], r["start"], bytes(r["ids"])] += 1
    short = 0
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
        short += 0 if at & (at - 1) == 0 else 256 - at
    total = sum(r["length"] for r in got)
    assert short <= 0.02 * total and total == sum(len(ids_of(t)) for _, t in docs_of(corpus))
    for (doc_id, start, ids), n in pieces.items():
        texts = [ids_of(t).tobytes() for i, t in docs_of(corpus) if i == doc_id]
        assert n <= sum(x[4 * start:4 * start + len(ids)] == ids for x in texts)
    assert sum(r["length"] for r in packing.sequences(packing.packed(corpus, WORD_BPE, 256)).collect()) == total
    assert packing.packed(empty, WORD_BPE).count() == 0
    assert all(sum(packing.cuts(n, 2048)) == n for n in range(2048))


def test_preference(spark):
    schema = "pair_id long, turn long, role string, text string, part string"
    chosen = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 0, "user", "q", ""), (1, 1, "assistant", "good", ""), (2, 0, None, None, ""), (None, None, "user", "x", ""), (4, 0, "assistant", "same", "")], schema)
    rejected = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "bad", ""), (None, None, "user", "x", ""), (4, 0, "assistant", "same", "")], schema)
    got = preference.preference_turns(chosen, rejected)
    rows = {(r["pair_id"], r["part"]): (r["rendered"], r["rendered"][r["loss_from"]:r["loss_to"]]) for r in got.collect()}
    assert rows == {
        (1, "prompt"): ("<|user|>\nq\n", ""), (1, "chosen"): ("<|assistant|>\ngood\n", "good\n"), (1, "rejected"): ("<|assistant|>\nbad\n", "bad\n"),
        (2, "chosen"): ("<||>\n\n", ""), (None, "prompt"): ("<|user|>\nx\n", ""), (4, "prompt"): ("<|assistant|>\nsame\n", ""),
    }
    joined = {(r["pair_id"], r["part"]): [r["text"][s["low"]:s["high"]] for s in r["loss"]] for r in preference.as_text(got).collect()}
    assert joined[1, "chosen"] == ["good\n"] and joined[1, "prompt"] == []
    assert preference.preference_turns(chosen.limit(0), rejected.limit(0)).count() == 0


def test_top_k(spark):
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(size=16)]) for i in range(700)]
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 16), (703, [float("inf")] * 16), (704, []), (705, rows[3][1]), (800, rows[100][1]), (None, [1.0] * 16)]
    frame = top_k.integer_vectors(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int"))
    held = {r["vec_id"]: r["vector"] for r in frame.collect()}
    assert set(held) == {*range(700), 704, 705, 800}
    want = []
    for q in (i for i in held if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(held[q], v)), i) for i, v in held.items() if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    got = top_k.top_k(frame.where("vec_id % 100 = 0"), frame)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert top_k.top_k(frame.limit(0), frame).count() == 0


def test_sharding(spark, corpus, empty):
    more = spark.range(2000, 8000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE repeat('x', cast(id % 50 AS int)) END AS text")
    got = sharding.sharded(corpus.select("doc_id", "text").where("length(text) < 10000 or text is null").unionByName(more)).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    null = got[got["size"] == 1]
    assert (null["text_crc32"] == zlib.crc32(b"")).all() and len(got) == 6000 + corpus.count() - 2
    assert sharding.sharded(empty).count() == 0
    assert sharding.sharded(corpus, 4, ("target",)).columns[-1] == "target"


def test_language(spark, corpus, empty):
    rows = [(i, ("der die das und ist nicht " if i % 2 else "the of and is not with ") * (1 + i % 5) + str(i), "de" if i % 2 else "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = {r["doc_id"]: r for r in language.identified(docs, model).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows if got[i]["held_out"]]) > 0.95
    odd = language.identified(corpus, model).collect()
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (0, 1, 2, 15)} == {"und"}
    assert {r["lang_pred"] for r in language.identified(corpus, language.fit(empty)).collect()} == {"und"}


def test_language_learns_from_every_document(spark, monkeypatch):
    """Many shards, against the counts of all rows; a rare language is learned although most shards
    would have none of it."""
    monkeypatch.setattr(language, "SHARD_ROWS", 40)
    monkeypatch.setattr(language, "PER_LANGUAGE", 4)
    stems = {"en": "the of and is not with".split(), "de": "der die das und ist nicht".split(), "fi": "kaikki syntyvat vapaina ihmiset".split()}
    random = np.random.default_rng(5)
    rows = [(i, " ".join(random.choice(stems[x], 4 + i % 9)), x) for i, x in enumerate(["fi" if i % 60 == 0 else "de" if i % 3 else "en" for i in range(900)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    frequency = np.zeros(language.DIMENSIONS + 1)
    for _, text, _ in learned:
        frequency[np.unique(language.grams([text.encode()])[0])] += 1
    frequency[-1] = len(learned)
    assert np.allclose(model.rarity, np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1)
    rare = np.log(frequency[-1] / np.maximum(frequency[:-1], 1)) + 1
    means = {x: [rare[language.grams([t.encode()])[0]].mean() for _, t, of in learned if of == x] for x in stems}
    assert np.allclose(model.usual, [np.mean(means[x]) for x in model.languages], atol=1e-6)
    got = {r["doc_id"]: r for r in language.identified(docs, model).collect()}
    for x in stems:
        assert np.mean([got[i]["lang_pred"] == x for i, _, of in rows if of == x and got[i]["held_out"]]) > 0.95
    again = language.fit(docs.repartition(7))
    assert np.array_equal(again.table, model.table) and np.array_equal(again.limit, model.limit) and again.temperature == model.temperature


def test_mixing(spark, corpus, empty):
    more = spark.range(3000).selectExpr("id + 5000 AS doc_id", "repeat('w ', cast(1 + id * 7919 % 90 AS int)) AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source")
    got = mixing.copies(corpus.select("doc_id", "text", "source").unionByName(more)).toPandas()
    assert got["copies"].between(0, 3).all() and len(got) == corpus.count() + 3000
    assert abs(got.groupby(got["source"].fillna("~"))["target"].first().sum() - got["size"].sum()) < 1
    sums = got[got["source"].isin(["hot", "s0", "s1"])].groupby("source").agg({"taken": "sum", "target": "first"})
    assert (abs(sums["taken"] / sums["target"] - 1) < 0.01).all()
    assert mixing.mixed(corpus).columns == corpus.columns
    assert mixing.copies(empty).count() == 0


def test_forest_decides_on_combinations(spark):
    """Rows that are a little high in several shares at once are rejected, rows as high in one stay."""
    random = np.random.default_rng(9)

    def row(i, symbols=0.0, upper=0.0, digits=0.0):
        words = 200
        chars = 1000
        return (i, words, chars, int(symbols * chars), 0, 0, 20, int((0.015 + upper) * chars + random.integers(0, 3)), int((0.03 + digits) * chars + random.integers(0, 4)), 0, int(random.integers(0, 3)))

    high = {"symbols": 0.02, "upper": 0.03, "digits": 0.04}
    rows = [row(i, **({k: v * random.random() for k, v in high.items() if k == list(high)[i % 3]} if i % 4 == 0 else {})) for i in range(1200)]
    odd = [row(5000 + i, **{k: v * 0.9 for k, v in high.items()}) for i in range(60)]
    frame = spark.createDataFrame(rows + odd, "doc_id long, " + ", ".join(f"{c} long" for c in quality._COUNTS)).withColumn("base_failed", F.lit(False))
    labels = spark.createDataFrame([(r[0], 1) for r in rows] + [(r[0], 0) for r in odd], "doc_id long, quality int")
    forest = quality.fit_forest(frame, labels)
    rated = quality.with_score(frame, forest)
    threshold = quality.calibrate(rated, labels)
    rejected = {r["doc_id"] for r in rated.where(F.col("anomaly") >= threshold).collect()}
    t = frame.toPandas()
    over = set(t["doc_id"][(quality._shares(t) > forest.limits).any(1)])
    assert len({i for i in rejected if i >= 5000}) >= 50 and len({i for i in rejected if i < 5000}) <= 3
    assert rejected != over and len({i for i in rejected if i >= 5000} - over) >= 40


def test_all_turns_of_a_conversation_are_used(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "q2"), (1, 3, "assistant", "b"), (1, 4, "user", "thanks"), (1, 4, "tool", "x"),
             (2, 0, "user", "no answer"), (3, 0, "assistant", "one"), (3, 0, "assistant", "two"), (3, None, "user", None), (None, 0, "assistant", "n")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    chosen, rejected = preference.repeated_answer_pairs(frame)
    assert chosen.distinct().count() == len(turns)
    got = preference.preference_turns(chosen, rejected).collect()
    of = lambda pair, part: sorted((r["turn"], r["rendered"]) for r in got if r["pair_id"] == pair and r["part"] == part)
    assert [t for t, _ in of(1, "prompt")] == [0, 1, 2]
    assert of(1, "chosen") == [(3, "<|assistant|>\nb\n"), (4, "<|tool|>\nx\n"), (4, "<|user|>\nthanks\n")]
    assert of(1, "rejected") == [(3, "<|assistant|>\na\n"), (4, "<|tool|>\nx\n"), (4, "<|user|>\nthanks\n")]
    assert of(2, "prompt") == [(0, "<|user|>\nno answer\n")] and not of(2, "chosen")
    assert len(of(3, "chosen")) == 3 and [r for _, r in of(3, "rejected")] == ["<|assistant|>\n\n", "<|user|>\n\n"]
    assert of(None, "rejected") == [(0, "<|assistant|>\n\n")]
    for pair in (1, 3, None):
        both = of(pair, "prompt") + of(pair, "chosen")
        assert len(both) == len({t for t in turns if t[0] == pair})


def test_long_runs_without_a_boundary():
    import base64
    import time

    machine = token_count.counter(BYTE_BPE)
    library = tokenizer(BYTE_BPE)
    random = np.random.default_rng(1)
    texts = ["a" * 5000, "ab" * 4000 + " end", "x" + base64.b64encode(random.bytes(9000)).decode().replace("/", "").replace("+", ""), "aab" * 3000 + "漢" * 2000, " " * 3000 + "a" * 513, "a" * 512, "a" * 1024, "a" * 1025]
    texts += ["".join(random.choice(list("abcde"), 6000)), "".join(random.choice(list("th"), 4000))]
    assert list(machine.counts([t.encode() for t in texts])) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    start = time.perf_counter()
    machine.counts([b"a" * 1_000_000])
    assert time.perf_counter() - start < 4


def test_components_must_settle(spark):
    from reelgauge.llm.components import components

    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in components(chain).collect()} == {0}
    with pytest.raises(RuntimeError, match="not settled"):
        components(chain, rounds=1)


def test_running_threshold_keeps_all_results():
    random = np.random.default_rng(6)
    block = random.integers(-20, 20, (300, 24))
    block[random.random(block.shape) < 0.6] = 0
    for query in random.integers(-20, 20, (20, 24)):
        scores = block @ query
        high, low = np.maximum(block.max(0), 0), np.minimum(block.min(0), 0)
        for least in (None, int(np.sort(scores)[-10]), int(np.sort(scores)[-10]) + 1, -500, 10**6):
            rows, found = top_k.max_score(query, block, high, low, least)
            want = {i: s for i, s in enumerate(scores) if least is None or s >= least}
            got = dict(zip(rows.tolist(), found.tolist()))
            assert all(got.get(i) == s for i, s in want.items()) and all(scores[i] == s for i, s in got.items())


def test_queries_traverse_a_block_together():
    random = np.random.default_rng(7)
    block = random.integers(-20, 20, (200, 21))
    block[random.random(block.shape) < 0.5] = 0
    queries = random.integers(-20, 20, (40, 21))
    scores = queries @ block.T
    least = np.sort(scores, 1)[:, -5] + random.integers(-300, 3, 40)
    least[:5], least[5] = top_k.NONE, 10**6
    query, row, found = top_k.traverse(queries, block, np.maximum(block.max(0), 0), np.minimum(block.min(0), 0), least)
    assert set(zip(query.tolist(), row.tolist(), found.tolist())) == {(q, i, s) for q, line in enumerate(scores.tolist()) for i, s in enumerate(line) if s >= least[q]}
    best = top_k.Best(40, 10)
    for part in np.array_split(np.arange(len(query)), 7):
        best.add(query[part], row[part], found[part])
    for q in range(40):
        want = sorted((-s, i) for i, s in enumerate(scores[q].tolist()) if s >= least[q])[:10]
        here = best.query == q
        assert list(zip((-best.scores[here]).tolist(), best.ids[here].tolist())) == want
        assert best.least()[q] == (-want[-1][0] if len(want) == 10 else top_k.NONE)


def test_samples_are_the_smallest_codes(spark):
    from reelgauge.llm.common import smallest

    frame = spark.range(5000).select("id", F.xxhash64("id").alias("code"))
    want = sorted((r["code"], r["id"]) for r in frame.collect())
    for n in (10, 700, 6000):
        assert [tuple(r)[::-1] for r in smallest(frame, F.col("code"), n, ["id"]).collect()] == want[:n]
