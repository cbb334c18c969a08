import pytest

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
ODD_TEXTS = [
    (1, "Alpha beta GAMMA delta epsilon zeta eta theta."), (2, "alpha BETA gamma delta epsilon zeta eta theta."),
    (2, "alpha BETA gamma delta epsilon zeta eta theta."), (3, ""), (4, None), (5, " \t\n "), (6, LONG), (7, LONG + "!"),
    (8, "É é   漢字 😀 one two"), (None, "no id here"), (None, "Alpha beta gamma delta epsilon zeta eta theta."),
    (9, "two words"), (10, "TWO words"), (11, "x"), (2**53 + 1, "large id"), (-5, "negative id"),
]
#: columns that carry the names that operators use inside
CLASHING = ["norm", "key", "md5", "k", "size", "n", "src", "hash", "part", "row_no", "id", "score", "keep_id", "ids", "base"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if n % 4 == 0 else f"src{n % 3}", None, None, *[n] * len(CLASHING)) for n, (i, t) in enumerate(ODD_TEXTS)]
    names = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
