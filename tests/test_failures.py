"""Tasks that fail half-way and are tried again change no result."""

from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from lastro import operators, plans, sources
from lastro.names import CPF, Layers
from lastro.plans.silver import parsed_values, validity_rules
from lastro.sources.sample import bronze_sample

SF = "/root/testdata/sf0.01"


def failing_once(df, marks):
    """The same rows, but each task's first attempt dies after some of them
    and leaves a mark."""
    marks = str(marks)

    def work(batches):
        for number, batch in enumerate(batches):
            yield batch
            if number == 1 and TaskContext.get().attemptNumber() == 0:
                open(f"{marks}/{TaskContext.get().taskAttemptId()}", "w").close()
                raise RuntimeError("lost on purpose")
    return df.mapInArrow(work, df.schema)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_report_counts_a_repeated_task_once(spark, small_batches, tmp_path):
    bronze = bronze_sample(spark, SF)
    where = Layers("lost_b", "lost_s", "lost_g")
    report = plans.save_silver(failing_once(bronze.repartition(4), tmp_path), where)
    assert report.get == operators.quality_profile(
        bronze, parsed_values(), validity_rules(bronze)).first().asDict()
    assert bag(sources.scan(spark, where.silver)) == bag(plans.refine(bronze))
    assert len(list(tmp_path.iterdir())) == 4


def test_products_and_duplicates_survive(spark, small_batches, tmp_path):
    bronze = sources.stage(bronze_sample(spark, SF).repartition(4), "bronze")
    lossy = failing_once(bronze, tmp_path)
    assert bag(plans.risk_monitor(plans.refine(lossy))) == bag(
        plans.risk_monitor(plans.refine(bronze)))
    for hot_keys in (100, 100_000):
        assert bag(operators.duplicates(lossy, CPF, hot_keys=hot_keys)) == bag(
            operators.duplicates(bronze, CPF))
    assert lossy.agg(F.count("*")).first()[0] == 15000
    assert list(tmp_path.iterdir())
