
import pytest
from pyspark.sql import functions as F

from ferrite.operators import explain as X
from ferrite.operators import resample as R
from ferrite.operators import splits as S
from ferrite.queries import REGISTRY
from ferrite.schema import KEY, NUMERIC_FEATURES, TARGET
from ferrite.sources import readings
from ferrite.sources.readings import fixed_score
from tests.conftest import SF_MED, SF_SMALL


@pytest.fixture(scope="module")
def keyed(spark):
    return readings(spark, SF_MED).select(KEY, TARGET).cache()


def test_split_disjoint_complete_stratified(keyed):
    s = S.stratified_split(keyed)
    assert s.count() == keyed.count() and s.select(KEY).distinct().count() == keyed.count()
    n = keyed.count()
    assert s.where("split = 'test'").count() == -(-n * 2 // 10)
    rates = {r["split"]: r["rate"] for r in s.groupBy("split").agg(F.avg(TARGET).alias("rate")).collect()}
    assert abs(rates["train"] - rates["test"]) < 0.002


def test_ranks_are_a_permutation(keyed):
    r = S.ranked(keyed, TARGET, 42)
    per = r.groupBy(TARGET).agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                                F.count(F.lit(1)).alias("n"), F.countDistinct("rank").alias("d")).collect()
    for row in per:
        assert row["lo"] == 1 and row["hi"] == row["n"] == row["d"]


def test_folds_balanced_per_class(keyed):
    f = S.fold_assignment(keyed, 5)
    sizes = f.groupBy(TARGET, "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in sizes if r[TARGET] == y]
        assert len(c) == 5 and max(c) - min(c) <= 1


def test_over_and_under_sampling_balance(keyed):
    over = R.oversample(keyed).groupBy(TARGET).count().collect()
    assert len({r["count"] for r in over}) == 1
    under = R.undersample(keyed).groupBy(TARGET).count().collect()
    assert len({r["count"] for r in under}) == 1


def test_unused_column_has_zero_importance(spark):
    r = readings(spark, SF_SMALL).withColumnRenamed(TARGET, "y")
    imp = X.permutation_importance(r, NUMERIC_FEATURES, lambda d: d.withColumn("score", fixed_score()),
                                   0.5, 3, 42)
    got = {x["feature"]: x["importance_mean"] for x in imp.collect()}
    for c in ("rpm", "pressure_level", "current_phase_avg", "ambient_temp"):
        assert got[c] == 0.0


def test_permutation_moves_values_only_within_column(spark):
    r = readings(spark, SF_SMALL).select(KEY, "rpm", "ambient_temp")
    p = X.permuted_rows(r, ["rpm"], 2, 42).where("perm_column = 'rpm'")
    for rep in (0, 1):
        a = sorted(x["rpm"] or -1 for x in p.where(F.col("perm_repeat") == rep).collect())
        b = sorted(x["rpm"] or -1 for x in r.collect())
        assert a == b


def test_shapley_efficiency(spark):
    r = readings(spark, SF_SMALL).select(KEY, "temperature_motor", "vibration_rms", "hours_since_maintenance")
    cols = ["temperature_motor", "vibration_rms", "hours_since_maintenance"]

    def f(df):
        return df.withColumn("score", F.coalesce("temperature_motor", F.lit(62.0)) * 0.5
                             + F.coalesce("vibration_rms", F.lit(2.0)) * F.col("hours_since_maintenance") / 100)

    rows, bg = S.hash_sample(r, 5, 1), S.hash_sample(r, 40, 2)
    out = X.shapley_sampling(rows, bg, cols, f, n_draws=6)
    phi = out.groupBy(KEY).agg(F.sum("phi").alias("s"), F.first("base_value").alias("b"))
    fx = f(rows).select(KEY, F.col("score").alias("fx"))
    got = phi.join(fx, KEY).collect()
    assert len(got) == 5
    for row in got:
        assert row["s"] == pytest.approx(row["fx"] - row["b"], abs=1e-9)


def test_stream_equals_batch(spark):
    b = REGISTRY["batch_score"](spark, SF_SMALL)
    s = REGISTRY["stream_score"](spark, SF_SMALL)
    assert sorted(b.collect()) == sorted(s.collect())


def test_models_learn_better_than_naive(spark):
    from ferrite.operators import evaluate as E
    for kind in ("lr_score", "gbt_score"):
        sc = REGISTRY[kind](spark, SF_MED)
        assert E.confusion(sc, 0.5).first()["f1"] > 0.6


@pytest.mark.parametrize("fn", ["knn", "knn_points"])
def test_knn_matches_brute_force(spark, fn):
    import numpy as np

    from ferrite.operators import neighbors
    rng = np.random.default_rng(3)
    pts = np.round(rng.normal(size=(300, 4)), 1)  # coarse values: many distance ties
    if fn == "knn_points":
        pts[:100] = pts[0]  # a hot group: a third of all points identical
        pts[100:103] = pts[100]  # a small duplicate group (fewer copies than k)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(pts)], "id LONG, x ARRAY<DOUBLE>")
    got = {}
    rows = getattr(neighbors, fn)(df, "id", "x", 5).collect()
    assert len({(r["id"], r["nn_key"]) for r in rows}) == len(rows) == 300 * 5
    assert all(r["id"] != r["nn_key"] for r in rows)
    for r in rows:
        got.setdefault(r["id"], []).append((r["nn_rank"], r["dist"]))
    assert len(got) == 300
    for i in range(300):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1))
        d[i] = np.inf
        mine = [dist for _, dist in sorted(got[i])]
        assert np.allclose(np.sort(d)[:5], mine, atol=1e-9)


def test_knn_tree_leaves_bounded_when_projections_coincide(spark):
    """A third of the points share their two widest coordinates: the tree
    still cuts them into leaves of at most leaf_size, and k-NN stays exact."""
    import numpy as np

    from pyspark.sql import functions as F

    from ferrite.operators import neighbors
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(240, 3)) * [10.0, 10.0, 1.0]
    pts[:80, :2] = 0.0
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(pts)], "id LONG, x ARRAY<DOUBLE>")
    leaves, nodes, _ = neighbors.kd_tree(df.select(F.col("id").alias("_k"), F.col("x").alias("_v")), 3, 12)
    assert leaves.count() == 240
    assert nodes.where("_leaf").agg(F.max("_n")).first()[0] <= 12
    rows = neighbors.knn(df, "id", "x", 5, leaf_size=12).collect()
    got = {}
    for r in rows:
        got.setdefault(r["id"], []).append((r["nn_rank"], r["dist"]))
    for i in range(240):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1))
        d[i] = np.inf
        assert np.allclose(np.sort(d)[:5], [x for _, x in sorted(got[i])], atol=1e-9)


def test_smote_rows_lie_between_parents_and_balance(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rows = [(i, 1 if i % 4 == 0 else 0, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "reading_id LONG, failure_within_24h INT, f ARRAY<DOUBLE>")
    df = df.select("reading_id", "failure_within_24h", array_to_vector("f").alias("features"))
    out = R.smote(df, seed=1)
    counts = {r[TARGET]: r["count"] for r in out.groupBy(TARGET).count().collect()}
    assert counts[0] == counts[1] == 150
    mino = [r[2] for r in rows if r[1] == 1]
    lo = [min(v[j] for v in mino) for j in range(3)]
    hi = [max(v[j] for v in mino) for j in range(3)]
    for r in out.where("reading_id < 0").select(vector_to_array("features").alias("x")).collect():
        assert all(lo[j] - 1e-12 <= r["x"][j] <= hi[j] + 1e-12 for j in range(3))


@pytest.mark.parametrize("majority, minority", [(50, 40), (40, 40), (40, 50), (20, 6), (30, 6)])
def test_smote_sizes(spark, majority, minority):
    """The minority grows to the majority's size whatever their ratio, and never shrinks."""
    from pyspark.ml.functions import array_to_vector
    rows = [(i, int(i < minority), [float(i % 7), float(i % 5), float(i)]) for i in range(majority + minority)]
    df = spark.createDataFrame(rows, "reading_id LONG, failure_within_24h INT, f ARRAY<DOUBLE>")
    df = df.select("reading_id", "failure_within_24h", array_to_vector("f").alias("features"))
    out = R.smote(df, seed=1).collect()
    assert sum(r[TARGET] == 1 for r in out) == max(minority, majority)
    assert sum(r[TARGET] == 0 for r in out) == majority
    assert len({r[KEY] for r in out}) == len(out)


def test_smote_needs_more_than_k_minority_rows(spark):
    from pyspark.ml.functions import array_to_vector
    rows = [(i, int(i < 4), [float(i), 1.0]) for i in range(24)]
    df = spark.createDataFrame(rows, "reading_id LONG, failure_within_24h INT, f ARRAY<DOUBLE>")
    df = df.select("reading_id", "failure_within_24h", array_to_vector("f").alias("features"))
    with pytest.raises(Exception, match="k=5"):
        R.smote(df, seed=1).collect()


def test_quantiles_and_areas_do_not_need_exchange_reuse(spark):
    """Exact answers over 10^6 distinct values with and without reused exchanges."""
    from pyspark.sql import functions as F

    from ferrite.operators import evaluate as E
    from ferrite.operators.ordered import exact_quantiles
    n = 1_000_003
    df = spark.range(n).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("v"))
    # score i/n is positive where i is a multiple of 3: both areas follow from counts
    sc = df.select((F.col("v") / n).alias("score"), (F.col("v") % 3 == 0).cast("int").alias("y"))
    got = []
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            q = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75]).first()
            got.append((q["q_0"], q["q_1"], q["q_2"], *E.auc_ap(sc).first()))
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
    assert got[0] == got[1]
    assert got[0][:3] == ((n - 1) / 4, (n - 1) / 2, 3 * (n - 1) / 4)
    positives = [i for i in range(n) if i % 3 == 0]
    below = sum(p - r for r, p in enumerate(positives))  # negatives with a smaller score
    assert got[0][3] == pytest.approx(below / len(positives) / (n - len(positives)), abs=1e-6)


def test_scenario_scoring_matches_batch(spark):
    from ferrite.queries import _scoring_model
    from ferrite.sources.files import load_pipeline
    from ferrite.streaming.scoring import score_readings, score_scenario
    model = load_pipeline(_scoring_model(spark, SF_SMALL))
    r = readings(spark, SF_SMALL).where("reading_id = 5")
    row = r.first().asDict()
    one = score_scenario(spark, model, 0.5, **{k: v for k, v in row.items()
                                              if k not in ("reading_id", "machine_id", "ts")}).first()
    batch = score_readings(model, r, 0.5).first()
    assert one["probability_failure"] == batch["probability_failure"]
    assert one["tier"] == batch["tier"] and one["decision"] == batch["decision"]


def test_gbt_early_stopping_keeps_fewer_trees(spark):
    df = REGISTRY["gbt_early_stopping"](spark, SF_MED)
    n_trees = df.first()["n_trees"]
    assert 1 <= n_trees < 300
