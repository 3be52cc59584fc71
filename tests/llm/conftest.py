import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, n long"


def prose(draw: random.Random, words: int) -> str:
    syllables = "the of an in er re th on ou ing ed ti or ea nd st".split()
    out = ["".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(words)]
    return " ".join(out).capitalize() + "."


@pytest.fixture(scope="session")
def odd_rows():
    """Texts with every awkward case: null, empty, blank, tiny, long, copies, near copies, repeated rows, odd characters."""
    draw = random.Random(4)
    base = [prose(draw, draw.randint(3, 400)) for _ in range(30)]
    passage = prose(draw, 120)
    texts = [None, "", " \n\t", "a", "two words", "x " * 3000, "ab" * 4000, "\x00\x1c\x85 漢字 é ß İ '<|endoftext|>'"]
    texts += base + [base[0], base[0], base[1] + " end", base[2].replace("the", "teh", 1), "n o p\n" * 40]
    texts += [f"{prose(draw, 30)}\n{passage}\n{prose(draw, 20)}" for _ in range(5)] + ["\n".join(base[3:9])] + [" ".join(base)]
    rows = [(i, t, draw.choice(["en", "fr", None, "DE-at"]), draw.choice(["a.b.fr", "b", None, ""]), None if t is None else len(t), "x", 1) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, base[4], None, None, None, None, None), (None, None, None, None, None, None, None), (7, "same id", "en", "b", 7, "y", 2)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
