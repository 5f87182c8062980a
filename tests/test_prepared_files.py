"""The prepared rows can be read by as many tasks as there are cores, however few row groups the input has."""

from ferrite.plans.preparation import run_preprocessing
from ferrite.session import fresh_dir
from ferrite.sources import readings


def test_fits_read_the_training_rows_with_all_cores(spark):
    from conftest import SF_SMALL
    p = run_preprocessing(readings(spark, SF_SMALL).coalesce(1), fresh_dir(spark, "prepared-files"))
    train = p.part("train")
    assert train.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert (train.count(), p.part("test").count()) == (800, 200)
