"""Model explanation.

Permutation importance ranks the test rows once (hash order); each
(column, repeat) permutes the ranks by its own keyed bijection, so a row's
value goes to the row of another rank by an equi join on the rank, one
column is replaced, and the metric is aggregated per (column, repeat).  Shapley-style contributions are exact for linear
scores, and for any model either exact over all coalitions (few features)
or Monte Carlo (random feature orders against background rows); all hybrids
are scored in one ``transform``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrite.functions import attach_one_row, hash_key
from ferrite.operators.evaluate import confusion
from ferrite.operators.ordered import hash_ranks
from ferrite.schema import KEY
from ferrite.session import materialize

ScoreFn = Callable[[DataFrame], DataFrame]  # adds a `score` column


# A prime below 2**31: products of two residues fit a BIGINT.
MODULUS = 2 ** 31 - 1
ROUNDS = 4


def permutation_keys(seed, *names) -> list[int]:
    """Two keys a round, from the digest of ``seed-name-...``."""
    digest = hashlib.sha256("-".join(str(x) for x in (seed, *names)).encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) % MODULUS for i in range(2 * ROUNDS)]


def with_permuted_rank(df: DataFrame, rank: str, n: str, keys: str, out: str) -> DataFrame:
    """Add ``out``: a keyed permutation of the ranks 0..n-1, computed row by row.

    A Feistel network on pairs (x div a, x mod a) with a = ceil(sqrt(n)) is a
    bijection of 0..a*a-1, which holds fewer than 2 sqrt(n) + 2 numbers beyond
    n-1.  A rank that lands on one of these goes through the network again until
    it is below n, after that many steps at most: the numbers beyond n-1 on one
    cycle.  So nothing is sorted or exchanged to permute.
    """
    side, total = F.col("_side"), F.col(n)

    def step(left: Column, right: Column, k: Column) -> Column:
        return (left + (right + k["a"]) % MODULUS * ((right + k["b"]) % MODULUS) % MODULUS) % side

    def network(x: Column) -> Column:
        halves = F.struct(F.call_function("div", x, side).alias("l"), (x % side).alias("r"))
        done = F.aggregate(F.col(keys), halves, lambda s, k: F.struct(
            s["r"].alias("l"), step(s["l"], s["r"], k).alias("r")))
        return done["l"] * side + done["r"]

    # the first passage in generated code, round by round; few ranks need another
    once = df.withColumn("_side", F.ceil(F.sqrt(total.cast("double"))))
    once = once.withColumn("_left", F.call_function("div", F.col(rank), side)).withColumn("_right", F.col(rank) % side)
    for i in range(ROUNDS):
        mixed = step(F.col("_left"), F.col("_right"), F.col(keys)[i])
        once = once.withColumns({"_left": F.col("_right"), "_right": mixed})
    once = once.withColumn("_once", F.col("_left") * side + F.col("_right")).drop("_left", "_right")
    beyond = F.sequence(F.lit(1).cast("bigint"), side * side - total)
    again = F.aggregate(beyond, F.col("_once"), lambda x, _: F.when(x < total, x).otherwise(network(x)))
    return once.withColumn(out, F.when(F.col("_once") < total, F.col("_once")).otherwise(again)).drop("_side", "_once")


def permuted_rows(df: DataFrame, cols: Sequence[str], repeats: int = 10, seed=42,
                  key: str = KEY) -> DataFrame:
    """Rows of ``df`` once per (column, repeat) with that column permuted.

    The rows are ranked and written once.  Each (column, repeat) has its own
    ``with_permuted_rank`` of the ranks, so a row knows where its values go:
    what is exchanged for each copy is a rank, a value and the pair's numbers.
    Output: all columns of ``df`` plus ``perm_column`` and ``perm_repeat``.
    """
    ranked = hash_ranks(df.withColumn("_h", hash_key(seed, key, "base")), [], "_h", key, rank_col="_rank")
    ranked = materialize(ranked.drop("_h").withColumn("_rank", F.col("_rank") - 1), "ranked")
    n_rows = ranked.agg(F.count(F.lit(1)).alias("_n"))
    grid = F.array(*[F.struct(
        F.lit(i).cast("short").alias("_c"), F.lit(r).cast("short").alias("_r"),
        F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                  for a, b in zip(k[::2], k[1::2])]).alias("_keys"))
        for i, c in enumerate(cols) for r in range(repeats) for k in [permutation_keys(seed, c, r)]])
    values = F.array(*[F.col(c).cast("double") for c in cols])
    donors = attach_one_row(ranked.select("_rank", values.alias("_v")), n_rows).select("*", F.inline(grid))
    donors = with_permuted_rank(donors, "_rank", "_n", "_keys", "_to").select(
        F.col("_to").alias("_rank"), "_c", "_r", F.element_at("_v", F.col("_c") + 1).alias("_new"))
    # never a broadcast: Spark's size estimate does not see that each row became many
    out = ranked.hint("merge").join(donors, "_rank")
    repl = [F.when(F.col("_c") == i, F.col("_new")).otherwise(F.col(c).cast("double")).alias(c)
            for i, c in enumerate(cols)]
    keep = [c for c in df.columns if c not in cols]
    names = F.array(*[F.lit(c) for c in cols])
    return out.select(*keep, *repl, F.element_at(names, F.col("_c") + 1).alias("perm_column"),
                      F.col("_r").cast("int").alias("perm_repeat"))


def permutation_importance(df: DataFrame, cols: Sequence[str], score_fn: ScoreFn,
                           threshold: float = 0.5, repeats: int = 10, seed=42,
                           key: str = KEY, label: str = "y") -> DataFrame:
    """F1 drop per permuted column; mean and population std over repeats.

    The rows feed the baseline and the ranks, so they are written once to the
    checkpoint folder instead of being re-derived by each.
    """
    df = materialize(df)
    base = confusion(score_fn(df), threshold, (), label, "score").select(F.col("f1").alias("_base_f1"))
    perm = score_fn(permuted_rows(df, cols, repeats, seed, key))
    f1s = confusion(perm, threshold, ["perm_column", "perm_repeat"], label, "score")
    drops = attach_one_row(f1s, base).select(
        F.col("perm_column").alias("feature"), (F.col("_base_f1") - F.col("f1")).alias("drop"))
    return drops.groupBy("feature").agg(
        F.round(F.avg("drop"), 6).alias("importance_mean"),
        F.round(F.stddev_pop("drop"), 6).alias("importance_std"))


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n largest mean importances (distributed top-k)."""
    return importance.orderBy(F.col("importance_mean").desc(), F.col("feature").asc()).limit(n)


def linear_contributions(rows: DataFrame, background: DataFrame, coefficients: dict[str, float],
                         key: str = KEY) -> DataFrame:
    """I4 (linear): phi_j = coef_j * (x_j - mean_j(background)), long form."""
    cols = list(coefficients)
    means = background.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    m = means.select(*[F.col(c).alias(f"_mu_{c}") for c in cols])
    j = attach_one_row(rows, m)
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                        (F.lit(float(w)) * (F.col(c).cast("double") - F.col(f"_mu_{c}"))).alias("phi"))
               for c, w in coefficients.items()]
    out = j.select(key, F.explode(F.array(*entries)).alias("e")).select(key, "e.*")
    return out.select(key, "feature", F.round("value", 6).alias("value"), F.round("phi", 6).alias("phi"))


def contribution_summary(contrib: DataFrame) -> DataFrame:
    """Mean |phi| per feature and the direction corr(value, phi), null where either is constant.

    ``F.corr`` divides by zero there, an error in ANSI mode.
    """
    both = F.col("value").isNotNull() & F.col("phi").isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, F.col("value")))) * F.sqrt(F.var_pop(F.when(both, F.col("phi"))))
    return contrib.groupBy("feature").agg(
        F.round(F.avg(F.abs("phi")), 6).alias("mean_abs_phi"),
        F.round(F.covar_pop("value", "phi") / F.nullif(spread, F.lit(0.0)), 6).alias("direction"))


def shapley_sampling(rows: DataFrame, background: DataFrame, cols: Sequence[str],
                     score_fn: ScoreFn, n_draws: int = 10, seed=42, key: str = KEY,
                     bg_key: str = KEY) -> DataFrame:
    """I4 (any model): Monte Carlo Shapley values.

    Each explained row draws ``n_draws`` background rows (uniformly, with
    replacement, by hashed rank - an equi join, no pairing of tables) and,
    per draw, a random feature order from ``md5(row-draw-feature)``.  Hybrid
    ``p`` takes the first ``p`` features of that order from the row and the
    rest from the background row; all (p+1) hybrids are scored in one pass
    and consecutive differences are the feature's marginal contribution.
    Per row, ``sum(phi) = f(x) - base_value`` with ``base_value`` the mean
    score of its drawn background rows.  Cost: rows x draws x (p+1).
    """
    cols = list(cols)
    p = len(cols)
    bg = hash_ranks(background.select(F.col(bg_key).alias("_bg"), *[F.col(c).alias(f"_z_{c}") for c in cols])
                    .withColumn("_hb", hash_key(seed, "_bg", "bg")), [], "_hb", "_bg", rank_col="_br")
    n_bg = bg.agg(F.count(F.lit(1)).alias("_nb"))
    draws = attach_one_row(rows.select(key, *cols), n_bg).withColumn(
        "_d", F.explode(F.sequence(F.lit(1), F.lit(n_draws))))
    hd = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.col("_d").cast("string"), F.lit(str(seed))))
    draws = draws.withColumn("_br", F.pmod(F.conv(F.substring(hd, 1, 12), 16, 10).cast("bigint"),
                                           F.col("_nb")) + 1)
    pairs = draws.join(bg.drop("_hb"), "_br")
    orders = F.array(*[F.struct(
        F.md5(F.concat_ws("-", F.col(key).cast("string"), F.col("_d").cast("string"), F.lit(str(seed)),
                          F.lit(c))).alias("h"), F.lit(c).alias("c")) for c in cols])
    pairs = pairs.withColumn("_order", F.transform(F.array_sort(orders), lambda s: s["c"]))
    hyb = pairs.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(p))))
    pos = {c: F.array_position(F.col("_order"), F.lit(c)) for c in cols}
    hyb = hyb.select(key, "_d", "_order", "_p", *[
        F.when(pos[c] <= F.col("_p"), F.col(c)).otherwise(F.col(f"_z_{c}")).alias(c) for c in cols])
    scored = score_fn(hyb)
    w = Window.partitionBy(key, "_d").orderBy("_p")  # p+1 rows per (row, draw)
    d = scored.select(key, "_d", "_order", "_p", "score",
                      (F.col("score") - F.lag("score").over(w)).alias("_delta"))
    base = d.where(F.col("_p") == 0).groupBy(key).agg(F.avg("score").alias("base_value"))
    d = d.where(F.col("_p") > 0).select(
        key, F.element_at(F.col("_order"), F.col("_p").cast("int")).alias("feature"), "_delta")
    phi = d.groupBy(key, "feature").agg(F.avg("_delta").alias("phi"))
    return phi.join(base, key)


def shapley_exact(rows: DataFrame, background: DataFrame, cols: Sequence[str], score_fn: ScoreFn,
                  seed=42, key: str = KEY, bg_key: str = KEY) -> DataFrame:
    """I4 (any model): exact Shapley values over the lattice of coalitions.

    A coalition's worth is the mean score of the row with the features outside
    the coalition taken from each background row.  Every explained row meets
    every background row (by rank, an equi join) in all 2**p coalitions, and a
    score adds ``(s-1)! (p-s)! / p!`` times itself to the features inside a
    coalition of s and ``-s! (p-s-1)! / p!`` times to those outside, so one
    combined aggregate of p sums a row gives all values.  Cost: rows x
    background x 2**p scores, which is why ``background`` is a stated sample
    and p is at most 16.  Per row ``sum(phi) = f(x) - base_value`` with
    ``base_value`` the mean score of the background.  No row for an empty
    background; null features are passed to the score as they are.
    """
    cols = list(cols)
    p = len(cols)
    if not 1 <= p <= 16:
        raise ValueError(f"shapley_exact takes 1 to 16 features, not {p}")
    bg = hash_ranks(background.select(F.col(bg_key).alias("_bg"), *[F.col(c).alias(f"_z_{c}") for c in cols])
                    .withColumn("_hb", hash_key(seed, "_bg", "bg")), [], "_hb", "_bg", rank_col="_br").drop("_hb", "_bg")
    n_bg = bg.agg(F.count(F.lit(1)).alias("_nb"))
    met = attach_one_row(rows.select(key, *cols), n_bg).where(F.col("_nb") > 0)
    met = met.withColumn("_br", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_nb")))).join(bg, "_br")
    met = met.withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit(2 ** p - 1))))
    inside = [F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0 for i in range(p)]
    hybrids = met.select(key, "_mask", *[F.when(x, F.col(c)).otherwise(F.col(f"_z_{c}")).alias(c)
                                         for x, c in zip(inside, cols)])
    weights = F.array(*[F.lit(math.factorial(s) * math.factorial(p - s - 1) / math.factorial(p)) for s in range(p)])
    size = F.bit_count("_mask")
    signed = [F.when(x, F.element_at(weights, size)).otherwise(-F.element_at(weights, size + 1)) for x in inside]
    empty = F.col("_mask") == 0
    sums = score_fn(hybrids).groupBy(key).agg(
        F.avg(F.when(empty, F.col("score"))).alias("base_value"), F.count_if(empty).alias("_nb"),
        *[F.sum(F.col("score") * w).alias(f"_phi{i}") for i, w in enumerate(signed)])
    values = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"_phi{i}") / F.col("_nb")).alias("phi"))
                       for i, c in enumerate(cols)])
    return sums.select(key, F.inline(values), "base_value")
