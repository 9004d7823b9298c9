import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: columns whose names the operators use inside
CLASH = ["id", "t", "node", "n", "key", "d", "p", "h", "rep", "label", "name", "y", "rate", "tokens", "domain", "a", "b", "sig", "_rid", "c0", "places", "root", "_drop", "shared"]


LETTERS = str.maketrans("0123456789", "ghijklmnop")


def words(rng, n, vocabulary=2000):
    return " ".join(("w%03x" % rng.randrange(vocabulary)).translate(LETTERS) for _ in range(n))


def corpus(seed=1, n=40):
    """(doc_id, text) with copies, near copies, repeats, nulls and odd texts."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randrange(30, 200))) for i in range(n)]
    for i in range(6):  # near copies: one word changed of many
        w = rows[i][1].split()
        w[len(w) // 2] = "changed"
        rows.append((100 + i, " ".join(w)))
    passage = words(rng, 60)
    rows += [(200 + i, words(rng, 30) + "\n" + passage + "\n" + words(rng, 20)) for i in range(4)]
    rows += [(300, rows[3][1]), (301, rows[3][1].upper()), (302, ""), (303, None), (304, "one"), (305, "two words"), (306, "Two  words\n"), (307, " \t\r\n\x0b\x0c "), (308, "a b c " * 50), (309, "é ü ß 漢字 🙂 " * 30), (310, "x\xa0y z\x85 end"), (311, words(rng, 30_000, 50)), (None, rows[5][1]), (None, None), (304, "one")]
    return rows


def with_clashes(df):
    from pyspark.sql import functions as F

    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in corpus()], DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
