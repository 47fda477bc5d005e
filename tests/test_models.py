"""Phrases, the trained tagger and the hashed vectors."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelgauge.functions.automaton import TokenAutomaton
from reelgauge.operators import embedding, tagger
from reelgauge.operators import entities as E
from reelgauge.operators import phrases as P
from reelgauge.operators import sentiment as S

COMMENT = "video_key string, arrival_seq bigint, text string"
WORD = st.sampled_from("abc")


def plain_matches(phrases, tokens):
    out, at = [], 0
    while at < len(tokens):
        sizes = [n for n in range(len(tokens) - at, 0, -1) if tuple(tokens[at:at + n]) in phrases]
        if sizes:
            out.append((at, sizes[0], phrases[tuple(tokens[at:at + sizes[0]])]))
        at += sizes[0] if sizes else 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.lists(WORD, min_size=1, max_size=4).map(tuple), st.integers(0, 9), max_size=8), st.lists(WORD, max_size=30))
def test_automaton_finds_the_longest(phrases, tokens):
    assert TokenAutomaton((list(p), v) for p, v in phrases.items()).matches(tokens) == plain_matches(phrases, tokens)


def test_joined_phrases_agree_with_the_automaton(spark, rows):
    random = np.random.default_rng(1)
    words = ["the", "new", "york", "times", "a", "b"]
    data = [("v", i, list(random.choice(words, random.integers(0, 40)))) for i in range(60)]
    phrases = {("new", "york"): 0, ("new", "york", "times"): 1, ("york",): 2, ("times", "the", "a"): 3, ("a", "a"): 4, ("the", "new"): 5}
    frame = spark.createDataFrame(data, "video_key string, arrival_seq bigint, tokens array<string>")
    terms = spark.createDataFrame([(list(p), v) for p, v in phrases.items()], "words array<string>, value int")
    want = sorted((i, plain_matches(phrases, t)) for _, i, t in data)
    for limit in (1 << 20, 0):
        got = P.longest_matches(frame, terms, ["video_key", "arrival_seq"], limit).collect()
        assert sorted((r["arrival_seq"], [tuple(m) for m in r["matches"]]) for r in got) == want


def test_phrase_gazetteer(spark, rows):
    terms = spark.createDataFrame([("New York", "LOC"), ("new york times", "ORG"), ("York", "PER"), ("...", "NONE"), (None, "NONE"), ("york", "AAA")], "term string, type string")
    comments = spark.createDataFrame([("v", 1, "In New-York, the NEW YORK Times; york!"), ("v", 2, None), ("v", 3, "")], COMMENT)
    got = E.tag_entities(comments, E.PhraseGazetteer(terms))
    want = [("v", 1, 1, "new", "LOC"), ("v", 1, 2, "york", "LOC"), ("v", 1, 4, "new", "ORG"), ("v", 1, 5, "york", "ORG"), ("v", 1, 6, "times", "ORG"), ("v", 1, 7, "york", "AAA")]
    assert rows(got) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    tagged = E.PhraseGazetteer(terms).tag(comments, "text").collect()
    assert [(r["token"], r["ner"]) for r in tagged] == [(["In", "New", "York", "the", "NEW", "YORK", "Times", "york"], ["O", "B-LOC", "I-LOC", "O", "B-ORG", "I-ORG", "I-ORG", "B-AAA"])]
    assert E.tag_entities(comments, E.PhraseGazetteer(terms.limit(0))).count() == 0


def test_lexicon_phrases(spark, rows):
    terms = spark.createDataFrame([("can't", -1), ("not bad", 2), ("bad", -1), ("good", 1)], "term string, polarity int")
    texts = ["I can't", "not bad", "bad", "not  BAD, bad", "can", "good but bad", None, ""]
    comments = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], COMMENT)
    got = rows(S.label_sentiment(comments, S.Lexicon(terms)), "arrival_seq", "sentiment")
    assert [r[1] for r in sorted(got)] == ["negative", "positive", "negative", "positive", "neutral", "neutral", None, None]
    with pytest.raises(ValueError, match="no letter"):
        S.Lexicon(spark.createDataFrame([("!!", 1)], "term string, polarity int")).label(comments, "text")


def test_viterbi_finds_the_best_path():
    random = np.random.default_rng(0)
    tags = ["B-X", "B-Y", "I-X", "I-Y", "O"]
    rule, step_rule = tagger.allowed(tags)
    lengths = np.array([3, 0, 1, 4, 2, 4])
    emissions = random.normal(size=(int(lengths.sum()), len(tags)))
    start, step = random.normal(size=len(tags)) + rule, random.normal(size=(len(tags), len(tags))) + step_rule
    got = tagger.viterbi(emissions, lengths, start, step)
    at = 0
    for n in lengths:
        def value(path, at=at):
            return start[path[0]] + sum(emissions[at + i, t] for i, t in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
        if n:
            best = max(itertools.product(range(len(tags)), repeat=int(n)), key=value)
            assert list(best) == list(got[at:at + n])
        at += n


def test_trained_tagger_learns_names(spark, tmp_path):
    random = np.random.default_rng(3)
    name = lambda: "".join(random.choice(list("abcdefgh"), 5)).capitalize()
    plain = ["we", "saw", "it", "then", "left", "quickly", "with", "joy"]

    def sentence():
        tokens, tags = [], []
        for _ in range(random.integers(1, 5)):
            some = list(random.choice(plain, random.integers(0, 4)))
            tokens += some
            tags += ["O"] * len(some)
            if random.random() < 0.6:
                cue, kind = [("mr", "PER"), ("in", "LOC")][random.integers(2)]
                size = random.integers(1, 3)
                tokens += [cue, *(name() for _ in range(size))]
                tags += ["O", f"B-{kind}", *[f"I-{kind}"] * (size - 1)]
        return tokens, tags

    known, held = [sentence() for _ in range(600)], [sentence() for _ in range(100)]
    broken = [(["a"], ["I-PER"]), (["a", "b"], ["O"]), ([], [])]
    frame = spark.createDataFrame(known + broken, "token array<string>, ner array<string>")
    model = tagger.train_tagger(frame, epochs=3, shards=3, buckets=1 << 14)
    assert model.weights.tags == ["B-LOC", "B-PER", "I-LOC", "I-PER", "O"]
    again = tagger.train_tagger(frame.repartition(5), epochs=3, shards=3, buckets=1 << 14)
    assert np.allclose(model.weights.values, again.weights.values)
    comments = spark.createDataFrame([("v", i, " ".join(t)) for i, (t, _) in enumerate(held)] + [("v", -1, None)], COMMENT)
    got = {r["arrival_seq"]: list(zip(r["token"], r["ner"])) for r in model.tag(comments, "text").collect()}
    pairs = [(a, b) for i, (_, tags) in enumerate(held) for (_, a), b in zip(got.get(i, []), tags)]
    assert np.mean([a == b for a, b in pairs]) > 0.97
    model.save(spark, str(tmp_path / "model"))
    loaded = tagger.load_tagger(spark, str(tmp_path / "model"))
    assert np.array_equal(loaded.weights.values, model.weights.values)
    assert E.tag_entities(comments, loaded).count() == sum(t != "O" for x in got.values() for _, t in x)


def test_vectors_of_like_words_are_near(spark):
    random = np.random.default_rng(4)
    topics = [["drum", "guitar", "song", "band", "bass"], ["rocket", "orbit", "moon", "launch", "fuel"]]
    data = [("v", i, " ".join(random.choice(topics[i % 2], 12))) for i in range(200)] + [("v", 200, None), ("v", 201, "!!! ..."), ("v", 202, "unseenword")]
    frame = spark.createDataFrame(data, COMMENT)
    got = {r["arrival_seq"]: np.array(r["embedding"]) for r in embedding.sentence_embeddings(frame, size=16).collect()}
    assert all(len(v) == 16 for v in got.values()) and not got[200].any() and not got[201].any() and got[0].any()
    cosine = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    assert min(cosine(0, i) for i in range(2, 40, 2)) > max(cosine(0, i) for i in range(1, 40, 2))
    again = {r["arrival_seq"]: np.array(r["embedding"]) for r in embedding.sentence_embeddings(frame.repartition(7), size=16).collect()}
    assert all(np.array_equal(got[i], again[i]) for i in got)


def test_sums_of_signs_by_plain_loops(spark):
    texts = ["aa bb cc aa", "cc bb", "dd"]
    frame = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], COMMENT)
    buckets, size, window = 64, 8, 2
    lists = [r[0] for r in frame.orderBy("arrival_seq").select(embedding.word_buckets("text", buckets, ())).collect()]
    signs = embedding._signs(buckets, size, 7)
    want, count = np.zeros((buckets, size)), np.zeros(buckets)
    for words in lists:
        for i, w in enumerate(words):
            count[w] += 1
            want[w] += sum((signs[words[j]] for j in range(max(0, i - window), min(len(words), i + window + 1)) if j != i), np.zeros(size))
    share = count / count.sum()
    want -= count[:, None] * 2 * window * (share @ signs)
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.divide(want, norm, out=np.zeros_like(want), where=norm > 0) * (embedding.HALF / (embedding.HALF + share))[:, None]
    got = embedding.fit_embedding(frame, size=size, buckets=buckets, window=window).vectors
    assert np.allclose(got, want)


def test_decoding_ahead_changes_no_update():
    """A shard that decodes many updates ahead against one update after the other, in plain loops."""
    random = np.random.default_rng(8)
    tags, buckets = ["B-X", "I-X", "O"], 64
    shard = tagger._Shard(tags, buckets, tagger.Weights(tags, buckets).values)
    plain, later, steps = tagger.Weights(tags, buckets), np.zeros_like(shard.first), 0
    lengths = random.integers(1, 6, 8 * 300 + 3)
    gold = [np.array([2 if x else random.integers(0, 2) * 2 for x in range(n)]) for n in lengths]
    found = [np.where(g[:, None] == 2, 1, 33) + random.integers(0, 24 if i < 400 else 4, (len(g), tagger.TEMPLATES)) for i, g in enumerate(gold)]
    for i in range(0, len(lengths), 7):
        shard.add(lengths[i:i + 7], np.concatenate(found[i:i + 7]), np.concatenate(gold[i:i + 7]))
    shard.run(True)
    for i in range(0, len(lengths), 8):
        n, f, g = lengths[i:i + 8], np.concatenate(found[i:i + 8]), np.concatenate(gold[i:i + 8])
        for chosen, sign in ((g, 1.0), (plain.decode(f, n), -1.0)):
            cells = tagger._rows_of(f, n, chosen, buckets, len(tags))
            np.add.at(plain.values, cells, sign)
            np.add.at(later, cells, sign * steps)
        steps += 1
    assert shard.steps == steps and plain.values.any()
    assert np.array_equal(shard.weights.values, plain.values) and np.array_equal(shard.later, later)


def plain_path(emissions, start, step):
    score, back = start + emissions[0], []
    for row in emissions[1:]:
        ways = score[:, None] + step
        back.append(ways.argmax(0))
        score = ways.max(0) + row
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_decoding_of_doubtful_pieces_by_plain_loops(monkeypatch):
    """Long texts go in pieces and tokens that are O anyway are passed over, with the same tags."""
    random = np.random.default_rng(5)
    whole, longest, tokens = tagger._paths, [], []

    def paths(emissions, at, lengths, *rest):
        longest.append(int(lengths.max(initial=0)))
        tokens.append(int(lengths.sum()))
        return whole(emissions, at, lengths, *rest)

    monkeypatch.setattr(tagger, "_paths", paths)
    for turn in range(40):
        kinds = "XYZ"[:turn % 4]
        tags, buckets = sorted([p + x for p in ("B-", "I-") for x in kinds] + ["O"]), 64
        weights = tagger.Weights(tags, buckets)
        weights.values[:] = random.normal(size=weights.values.shape) * [0.3, 1, 5][turn % 3]
        weights.values[buckets + len(tags) - 1, -1] += [0, 3, 12, 40][turn // 10]  # O after O
        weights.values[:48, -1] += [0, 1, 4, 8][turn // 10]
        lengths = np.array([1, 0, 2, 700, 129, 128, 40, 300, 0, 5])
        found = random.integers(0, 48 if turn // 10 else 64, (int(lengths.sum()), tagger.TEMPLATES))
        found[random.random(len(found)) < 0.1] = random.integers(48, 64, tagger.TEMPLATES)
        scores = weights.values[found].sum(1)
        start, step = (weights.values[x] + y for x, y in ((buckets + len(tags), weights.start_rule), (slice(buckets, buckets + len(tags)), weights.step_rule)))
        ends = np.cumsum(lengths)
        want = [t for e, n in zip(ends, lengths) if n for t in plain_path(scores[e - n:e], start, step)]
        assert list(weights.decode(found, lengths)) == want
    assert max(longest[-3:]) < 200 and max(tokens[-3:]) < len(found) / 2


def test_codes_of_odd_tokens():
    import pyarrow as pa

    random = np.random.default_rng(6)
    letters = list("aAbBzZ019.-'_\n") + list("\u00e9\u00c9\u00df\u0130\u0131\u03a3\u03c3\u03c2\u0391\u0416\u01c5\u00bd\u00b2\u0663\u6f22\u0301\U0001f600\U0001d504\ufb01\x00\x1c")
    tokens = ["", "x", "aaa", "AAAA", "\u0391\u03a3", "a" * 70, "\u00c9" * 70, "11111a", "...."] + ["".join(random.choice(letters, random.integers(0, 9))) for _ in range(3000)]
    code = tagger._code
    want = [[code(x.lower()), code(tagger.shape(x)), code(x[-3:].lower()), code(x[:2].lower())] for x in tokens]
    for low in (0, 7):
        assert tagger._codes(pa.array(tokens, pa.string()).slice(low)).tolist() == want[low:]
    assert tagger._codes(pa.array([], pa.string())).shape == (0, 4)


def test_texts_are_tagged_once(spark):
    tags = ["B-X", "I-X", "O"]
    model = tagger.TrainedTagger(tagger.Weights(tags, 64, np.random.default_rng(1).normal(size=(tagger.BLOCK, 3))))
    texts = ["aa Bb 12 cc", "", None, " ", "dd " * 300]
    comments = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)] + [(None, None, "aa Bb 12 cc")], COMMENT)
    found = E.tag_entities(comments, model)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython|MapInArrow", plan)) == 1
    want = E.entity_mentions(model.tag(comments, "text"))
    assert found.schema == want.schema and found.count() > 0
    assert sorted(found.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_lists_are_handled_in_blocks():
    """No block of a large batch holds more than the limit, but for one longer list."""
    import pyarrow as pa

    random = np.random.default_rng(9)
    lists = [list(random.choice(list("abcx"), n)) for n in random.integers(0, 9, 200)] + [["a"] * 50, None, []]
    held = [x for (x,) in P.list_blocks([pa.array(lists, pa.list_(pa.string())).slice(3)], 0, 20)]
    assert [x for b in held for x in b.to_pylist()] == lists[3:]
    assert all(len(b.flatten()) <= 20 or len(b) == 1 for b in held) and len(held) > 30
    phrases = {("a", "b"): 0, ("a",): 1, ("b", "c", "a"): 2}
    known = pa.array(list("abc"))
    automaton = TokenAutomaton((list(p), v) for p, v in phrases.items())
    got = [[tuple(m.values()) for m in x] for b in held for x in P._found(automaton, known, b).to_pylist()]
    assert got == [plain_matches(phrases, x or []) for x in lists[3:]]


def test_vectors_do_not_depend_on_blocks(spark, monkeypatch):
    """Sums and means cut into small blocks, also inside one long text, against whole batches."""
    import pyarrow as pa

    random = np.random.default_rng(10)
    lists = [list(random.integers(0, 32, n)) for n in (5, 0, 90, 3, 1, 17, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], names=["words"])
    want = next(embedding._sums(32, 4, 3, 7)(iter([batch]))).to_pydict()
    monkeypatch.setattr(embedding, "BLOCK_WORDS", 16)
    assert next(embedding._sums(32, 4, 3, 7)(iter([batch]))).to_pydict() == want
    texts = ["aa bb cc", None, " ".join(f"w{chr(97 + i % 26)}" for i in range(70)), "aa"]
    frame = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], COMMENT)
    model = embedding.HashedEmbedding(random.normal(size=(64, 4)))
    got = {r["arrival_seq"]: np.array(r["embedding"]) for r in model.transform(frame, "text").collect()}
    for r in frame.select("arrival_seq", embedding.word_buckets("text", 64).alias("w")).collect():
        mean = model.vectors[r["w"]].mean(0) if r["w"] else np.zeros(4)
        assert np.allclose(got[r["arrival_seq"]], mean, atol=1e-6)
