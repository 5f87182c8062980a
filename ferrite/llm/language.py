"""Language identification by error-correcting output codes.

Each language has a codeword of bits.  One linear classifier for each bit,
over hashed byte n-grams, says whether the text's language has that bit set.
Decoding sums the logistic loss of the classifiers' margins against each
codeword and takes the least; a text whose two nearest codewords are about as
near is flagged as ambiguous.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table

#: Hash bins of the n-grams of each order (1 to 3 bytes).
BINS = 1 << 12
ORDERS = (1, 2, 3)
#: Bound of the labelled sample that the classifiers are fitted on, shared evenly by the languages.
SAMPLE_ROWS = 2000
#: One in so many of the sample's rows is kept from the fit, to set the margin by.
ASIDE = 5
#: The margin between the shares of the two nearest codewords below which a text is ambiguous: one in CLEAN
#: rightly told rows set aside are below it at most, and its bounds.
CLEAN, LEAST_MARGIN, MOST_MARGIN = 200, 0.02, 0.75
ROUNDS, PENALTY = 150, 1e-4
UND = "und"
_SEGMENT = 1 << 20


def profile(text: str) -> np.ndarray | None:
    """Root of the share of each hashed n-gram, orders side by side; None without letters."""
    if not any(c.isalpha() for c in text):
        return None
    data = np.frombuffer(text.lower().encode(), np.uint8)
    counts = np.zeros(len(ORDERS) * BINS)
    for at in range(0, len(data), _SEGMENT):
        part = data[max(0, at - max(ORDERS) + 1):at + _SEGMENT].astype(np.uint32)
        lead = min(at, max(ORDERS) - 1)
        for place, n in enumerate(ORDERS):
            key = np.zeros(max(0, len(part) - n + 1), np.uint32)  # the n bytes from here on
            for j in range(n):
                key = key * np.uint32(257) + part[j:len(part) - n + 1 + j]
            own = key[max(0, lead - n + 1):]  # those that end before this segment are counted already
            bins = (own * np.uint32(2654435761)) >> np.uint32(32 - BINS.bit_length() + 1)
            counts[place * BINS:(place + 1) * BINS] += np.bincount(bins, minlength=BINS)
    for place in range(len(ORDERS)):
        part = counts[place * BINS:(place + 1) * BINS]
        part /= max(1, part.sum())
    return np.sqrt(counts)


def codewords(n: int) -> np.ndarray:
    """n rows of -1/+1 bits, no two rows equal.

    Up to 7 languages: every split of them into two sides (the exhaustive
    code; its rows differ in half the bits).  More: of 50 random codes of
    10 log2(n) bits the one whose nearest rows are farthest apart.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        return np.array([(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest], float).T
    rng, best = np.random.default_rng(5), None
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        sides = np.abs(code.sum(axis=0)).max() < n
        if sides and (best is None or apart > best[0]):
            best = (apart, code)
    return best[1]


def margin(shares: np.ndarray) -> float:
    """The best share less the second (one language alone: its share)."""
    first, second = [*np.sort(shares)[::-1], 0.0][:2]
    return float(first - second)


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.code = codewords(len(languages))
        self.least_margin = LEAST_MARGIN

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Each language's share of the weight, for a profile."""
        loss = np.logaddexp(0, -self.code * (x @ self.weights + self.bias)).sum(axis=1)
        share = np.exp(loss.min() - loss)
        return share / share.sum()

    def set_margin(self, x: np.ndarray, y: np.ndarray) -> None:
        """The least margin that a text needs, from labelled rows that were not fitted on.

        Three quarters of the rows' pairs of two languages, mixed evenly, are
        below it, but at most one in ``CLEAN`` of the rows that are told rightly.
        """
        clean = [margin(s) for s, i in zip(map(self.shares, x), y) if s.argmax() == i]
        mixed = [margin(self.shares(np.sqrt((x[i] ** 2 + x[j] ** 2) / 2)))
                 for i, j in zip(range(len(y)), np.roll(np.argsort(y, kind="stable"), len(y) // 2)) if y[i] != y[j]]
        if clean and mixed:
            self.least_margin = float(np.clip(min(np.quantile(mixed, 0.75), np.sort(clean)[len(clean) // CLEAN]), LEAST_MARGIN, MOST_MARGIN))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        x = profile(text) if text and self.languages else None
        if x is None:
            return UND, 0.0, True
        shares = self.shares(x)
        best = int(shares.argmax())
        return self.languages[best], float(shares[best]), margin(shares) < self.least_margin


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled documents outside the held-out fold.

    Learns from text and lang alone; the sample is about ``sample_rows``
    documents, as many of each language as there are, chosen by a hash.  Only
    their n-gram counts come to the driver.  Without labels the model says
    ``und`` to everything.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang")
    rows = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    languages = sorted(rows)
    each = max(1, sample_rows // len(languages))
    share = F.create_map(*[x for l in languages for x in (F.lit(l), F.lit(min(1.0, each / rows[l])))])
    unit = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) / 1_000_000.0
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(ASIDE)) == 0
    chosen = labelled.filter(unit < share[F.col("lang")]).select("lang", "text", aside.alias("aside"))

    def start():
        def f(texts):
            sparse = [profile(t or "") for t in texts.to_pylist()]
            at = [np.flatnonzero(x) if x is not None else np.zeros(0, int) for x in sparse]
            return [[a.astype("<u2").tobytes() for a in at],
                    [x[a].astype("<f2").tobytes() if len(a) else b"" for x, a in zip(sparse, at)]]
        return f

    seen = append_columns(chosen, ["text"], [T.StructField("bins", T.BinaryType()), T.StructField("shares", T.BinaryType())],
                          start).select("lang", "aside", "bins", "shares").filter("length(bins) > 0").collect()
    x = np.zeros((len(seen), len(ORDERS) * BINS), np.float32)
    for i, r in enumerate(seen):
        x[i, np.frombuffer(r.bins, "<u2")] = np.frombuffer(r.shares, "<f2")
    y = np.array([languages.index(r.lang) for r in seen], int)
    code, aside = codewords(len(languages)), np.array([r.aside for r in seen], bool)
    fitted = x[~aside], y[~aside]
    weights, bias = _logistic(fitted[0], code[fitted[1]], 1 / np.maximum(1, np.bincount(fitted[1], minlength=len(languages)))[fitted[1]])
    model = Model(languages, weights, bias)
    model.set_margin(x[aside], y[aside])
    return model


def _logistic(x: np.ndarray, sides: np.ndarray, row_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression for every bit at once, by accelerated gradient steps."""
    w, b = np.zeros((x.shape[1], sides.shape[1]), np.float32), np.zeros(sides.shape[1])
    if not len(x):
        return w, b
    v, c = w.copy(), b.copy()
    row_weight = (row_weight / row_weight.sum())[:, None]
    step = 4.0 / (1 + np.einsum("ij,ij->i", x, x).max())
    for k in range(ROUNDS):
        pull = (row_weight * sides / (1 + np.exp(np.clip(sides * (x @ v + c), -30, 30)))).astype(np.float32)
        w_new = v + step * (x.T @ pull - PENALTY * v)
        b_new = c + step * pull.sum(axis=0)
        m = k / (k + 3)
        v, c = w_new + m * (w_new - w), b_new + m * (b_new - b)
        w, b = w_new, b_new
    return w, b


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous, from the whole text alone.

    A null or empty text, or one without a letter, is ``und`` with score 0
    and ambiguous.  Columns of ``docs`` with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def f(texts):
            return list(zip(*[model.predict(t) for t in texts.to_pylist()])) if len(texts) else [[], [], []]
        return f

    return append_columns(docs, ["text"], [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                                           T.StructField("ambiguous", T.BooleanType())], start)


def with_language(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` without the documents whose language is unknown or ambiguous.

    Null and empty texts and those without a letter go; repeated rows go or
    stay together; very long texts are read whole; no rows give no rows.
    """
    found = identified(docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), "text"), fit(docs))
    return found.filter("not ambiguous").select("row.*")


def op6_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a null doc_id counts as not held out and is not learnt from."""
    docs = table(spark, sf_dir, "documents")
    found = identified(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
