"""A small table of documents with every awkward case, for the operators' tests."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(60):
        out.append((i, "\n".join(" ".join(words(rng, rng.randrange(1, 90))) for _ in range(rng.randrange(1, 6))), "en" if i % 2 else "de", "s"))
    base = words(rng, 120)
    for i in range(60, 75):  # near copies
        copy = list(base)
        copy[rng.randrange(120)] = "changed"
        out.append((i, " ".join(copy), "en", "hot"))
    out += [(i, "\n".join([" ".join(base), "short line", "short line"]), "en", "hot") for i in range(75, 80)]  # equal texts
    out += [(80, None, None, None), (81, "", "en", None), (82, " \t\n  \n", None, "s"), (83, "x", "en", "s"), (84, "!!! ??? 123", "fr", "s"),
            (85, "before " + PASSAGE + " after", "en", "s"), (86, PASSAGE.upper(), "en", "s"), (87, " ".join(words(rng, 4000)), "de", "s"),
            (88, "na\u00efve \u4e2d\u6587 \U0001f642 caf\u00e9 e\u0301", "fr", "s"), (89, "a b", "en", "s"), (90, "a b c", "en", "s"),
            (None, "no id here at all", "en", "s"), (None, None, None, None), (91, "same row", "en", "s"), (91, "same row", "en", "s"),
            (91, "another text with this id", "en", "s")]
    return [(d, t, l, s, None if t is None else len(t)) for d, t, l, s in out]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, DOCS)


def clashing(spark, *names):
    """The documents with further columns of the given names."""
    from pyspark.sql import functions as F
    return frame(spark).withColumns({n: F.lit("clash") for n in names})
