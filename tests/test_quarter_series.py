"""quarter_series: the work is spread over tasks, the rows stay those of the walk."""

import datetime as dt

from pyspark.sql import functions as F

from roundbook.functions import quarters as Q
from roundbook.operators import funding as FD
from roundbook.plans.checks import plan_text

AS_OF = dt.date(2002, 1, 1)


def test_quarter_series_of_one_partition_is_made_by_many_tasks(spark, tmpdir_path):
    orgs = spark.range(200_000).selectExpr("cast(id as string) org_uuid", "date'1995-01-01' + cast(id % 900 as int) founded_on")
    orgs.coalesce(1).write.mode("overwrite").parquet(tmpdir_path)
    df = FD.quarter_series(spark.read.parquet(tmpdir_path), AS_OF)
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() >= 2
    assert "lambda" not in plan_text(df)


def test_quarter_series_rows_are_those_of_the_walk(spark):
    """Null and repeated ids, no date, dates at the ends of months and past the last."""
    days = [None, "1899-12-31", "1900-01-01", "1995-03-31", "1995-04-01", "2001-12-31", "2002-01-01", "2002-01-02", "2010-05-05", "0001-01-01"]
    rows = [(u, d and dt.date.fromisoformat(d)) for i, d in enumerate(days) for u in (f"o{i}", f"o{i}", None)]
    orgs = spark.createDataFrame(rows, "org_uuid string, founded_on date")
    walk = F.explode(Q.quarter_series(Q.founded_or_default("founded_on"), F.lit(AS_OF))).alias("quarter")
    want, got = orgs.select("org_uuid", walk), FD.quarter_series(orgs, AS_OF)
    assert got.columns == want.columns
    assert got.groupBy("org_uuid", "quarter").count().exceptAll(want.groupBy("org_uuid", "quarter").count()).isEmpty()
    assert got.count() == want.count() > 1000
