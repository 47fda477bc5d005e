import pytest

FULL = "doc_id long, text string, lang string, source string, n_chars long, size long, target double, sketch string"


@pytest.fixture
def corpus(spark):
    """Documents with nulls in any column, empty and long texts, ties, repeats and clashing names."""
    words = "the quick brown fox jumps over a lazy dog while seven wizards brew potions near old stone bridges".split()
    long = " ".join(words[(i * i + i // 7) % len(words)] + str(i % 97) for i in range(30_000))
    base = [" ".join(f"{w}{i}" for w in words * 3) for i in range(6)]
    texts = [None, "", " \n\t ", "one two", long, long, *base, base[0], base[0] + " tail", "É Ünï 漢字 <|endoftext|> don't 12.5!", "!!! ???"]
    rows = [(i, t, "en" if i % 2 else None, [None, "a", "b", ""][i % 4], 1, 5, 0.5, "x") for i, t in enumerate(texts)]
    rows += [(None, "no id here at all", None, None, None, None, None, None), rows[6], rows[6]]
    return spark.createDataFrame(rows, FULL)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], FULL)
