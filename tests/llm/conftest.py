import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size int, node string, label int"


def passages():
    """Texts with copies, near copies, shared passages, personal data and all odd cases."""
    draw = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "ka re mi to lu za".split() for b in "n r s l m nd".split()]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base, common = text(90).split(), text(60)
    rows = []
    for _ in range(25):  # near copies of one text
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(90)] = "changed%d" % draw.randint(0, 3)
        rows.append(" ".join(copy))
    for i in range(25):  # a passage that many share, some with one letter changed
        line = common if i % 3 else common.replace("kan", "kän", 1)
        rows.append("\n".join([text(draw.randint(5, 80)), line, text(draw.randint(0, 30))]))
    rows += [text(200)] * 3 + ["kan " * 300, "a" * 700, "Ünï" * 300, "Short one", "short ONE", " \n\t", "", None]
    rows += [text(60) + " mail me.x@site.example.org or +1 (743) 555-3824, 10.0.0.300 10.0.0.3", text(55) + " 4111 1111 1111 1111"]
    return [(i, t, "en", None if i % 9 == 0 else f"src{i % 4}", len(t or ""), "x", 1, "y", 2) for i, t in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return passages()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows and ids, nothing but nulls."""
    twice = ("one two three four five six seven eight nine ten eleven twelve " * 12).strip()
    rows = [(None, twice), (5, twice), (5, twice), (5, "another text of the same id " * 20), (None, None), (None, "")]
    return spark.createDataFrame([(d, t, None, None, None, None, None, None, None) for d, t in rows], DOCS)
