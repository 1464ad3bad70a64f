import random

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))


def sentence(rng, n):
    return " ".join(rng.choice("ab éc Dd x,y the of idiot 12 ,,".split(" ")) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Empty, null, blank, odd, very long, repeated, nearly repeated and ordinary texts."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (3, 50, 117)]
    passage = sentence(rng, 45)
    mixed = [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(3)]
    runs = ["spam " * 100, "spam " * 60 + "egg", "a b " * 60]
    short = ["one", "one two three four", "ONE two\tthree\nfour", "Ärger Ärger", "<|endoftext|> tail"]
    return [None, "", " \n\t ", *short, base, base, base.upper(), *near, *mixed, *runs, LONG, *(sentence(rng, rng.randrange(1, 90)) for _ in range(20))]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with a null id, a repeated row, and columns named like the operators' own."""
    clash = "batch long, id long, score string, n_words string, hits string, label string, key string"
    rows = [(i, t, "en" if i % 2 else None, i, i, "s", "n", "h", "l", "k") for i, t in enumerate(texts)]
    rows += [(None, texts[8], None, None, None, None, None, None, None, None), rows[9]]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {clash}").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
