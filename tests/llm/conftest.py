import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; columns that bear them must do no harm.
CLASHING = ["fp", "size", "src", "taken", "t", "i", "key", "doc", "_text", "_at", "k1", "t1", "node", "root", "start", "row", "old", "less", "_gone"]


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture
def edge_rows():
    """Nulls, empty and very long texts, repeated rows and ids."""
    rng = random.Random(7)
    long_text = words(rng, 60_000)
    return [
        (1, None, None, "s1", None), (2, "", "en", None, 0), (3, "  \n\t ", "en", "s1", 5),
        (4, "one", "en", "s2", 3), (5, long_text, "en", "s1", len(long_text)),
        (5, long_text, "en", "s1", len(long_text)), (6, "same words here\nagain", "en", "s3", 20),
        (6, "same words here\nagain", "en", "s3", 20), (7, "same words here\nagain", None, "s2", 20),
        (None, words(rng, 80), "en", "s1", 1), (8, "ünï ĉødé \U0001f600 €\n\n\nx", "de", "s2", None),
    ]


@pytest.fixture
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS)


@pytest.fixture
def clashing_docs(edge_docs):
    """The same rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    return edge_docs.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def rows_of():
    def get(df, *cols):
        out = [tuple(r[c] for c in cols or df.columns) for r in df.collect()]
        return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(x, (list, dict)) else
                                               (False, "", str(x)) for x in r))
    return get
