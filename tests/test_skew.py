"""Hot-group detection and shared-folder materialization."""

from pyspark.sql import functions as F

from stratum.operators import skew
from stratum.session import materialize, shared_root
from tests.conftest import rows


def test_largest_group_finds_a_hot_key(spark):
    df = spark.range(30000).select((F.col("id") % 1000).alias("k")).union(
        spark.range(20000).select(F.lit(7).cast("long").alias("k")))
    est = skew.largest_group(df, ["k"])
    assert est >= 20030                       # sketch counts never undercount the hot key
    assert skew.needs_split(df, ["k"], threshold=10000)
    assert not skew.needs_split(df, ["k"], threshold=10**6)
    assert skew.needs_split(df, ["k"], threshold=0)


def test_materialize_writes_under_shared_root(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("x"))
    m = materialize(df, "t")
    assert rows(m) == rows(df)
    assert shared_root(spark).rstrip("/").split(":")[-1] in m.inputFiles()[0]
