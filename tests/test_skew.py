"""A key holding a third of all rows: joins are split by AQE, results stay whole."""

import contextlib

import pytest
from pyspark.sql import functions as F

from laketide.operators import model, privacy
from conftest import rows


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def _facts(spark, n=30000):
    # fact_id, dim_id: dim 0 holds a third of all rows
    return spark.range(n).select(
        F.col("id").alias("fact_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("dim_id"),
        (F.col("id") % 7).alias("v"))


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["fact", "suppress"])
def test_hot_key_join_is_split(spark, how):
    with conf(spark, **SKEW):
        facts = _facts(spark)
        if how == "fact":
            dims = model.build_dimension(spark.range(1000).select(F.col("id").alias("k"),
                                                                  F.lit("x").alias("name")),
                                         ["k"], ["name"])
            out = model.build_fact(facts, [model.DimRef(dims, ["dim_id"], ["k"], "dim_key")],
                                   drop_natural=False)
        else:
            out = privacy.suppress_small_cells(facts, ["dim_id"], 31)
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text, text[:3000]
        n = out.count()
    if how == "fact":
        assert n == 30000
        assert out.where(F.col("dim_key") == model.UNKNOWN_KEY).count() == 0
    else:
        # dim 0 (10,000 rows) and dims 1..999 (about 20 rows each, below 31) are judged exactly
        want = facts.groupBy("dim_id").count().where("count >= 31").agg(F.sum("count")).first()[0]
        assert n == want
