"""Ordered operators where one group holds a third of all rows, with awkward values."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from roundbook.operators import funding as FD
from roundbook.operators.ordering import cut_points, group_positions, ordered_concat, with_bucket
from roundbook.plans.checks import plan_text


def skewed_rows(n=6000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randrange(400)}"
        rows.append((g, rnd.randrange(50), i, f"t{i}"))
    return rows


SPLITS = [None, 100, 3]  # one bucket; a few of the hot group; many of every group


def key_of():
    return F.struct((-F.col("a")).alias("na"), F.col("u").alias("u"))


@pytest.mark.parametrize("split", SPLITS)
def test_ordered_concat_hot_group(spark, split):
    rows = skewed_rows() + [(None, 1, -1, "no group"), ("empty", 1, -2, None), ("some", 1, -3, None), ("some", 1, -2, "x")]
    df = spark.createDataFrame(rows, "g string, a int, u int, t string")
    got = {r["g"]: r["s"] for r in ordered_concat(df, ["g"], key_of(), "t", ",", "s", split=split).collect()}
    want = {}
    for g in {r[0] for r in rows} - {None}:
        texts = [r[3] for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])) if r[3] is not None]
        want[g] = ",".join(texts) if texts else None
    assert got == want


@pytest.mark.parametrize("split", SPLITS)
def test_group_positions_equal_row_number(spark, split):
    rows = [(g if i % 5 else None, a, u, float("nan") if i % 7 == 0 else 1.5, 9007199254740993 if i % 2 else None) for i, (g, a, u, _) in enumerate(skewed_rows())]
    df = spark.createDataFrame(rows, "g string, a int, u int, d double, big long")
    order = [F.col("a").desc(), F.col("u").asc()]
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    got = group_positions(df, ["g"], order, key_of(), split=split)
    assert got.columns == ref.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, ref.collect()))


def test_cut_points_follow_the_data(spark):
    """A round whose investors all start with "Supplier#" and a company with all rounds
    in one year: no bucket holds much more than its share."""
    n, split = 20_000, 1000
    inv = spark.range(n).selectExpr("'hot' round_uuid", "concat('Supplier#', lpad(cast(id * 7919 % 20011 as string), 9, '0')) investor_name",
                                    "cast(null as boolean) is_lead", "cast(id as decimal(20,2)) amount_usd")
    rounds = spark.range(n).selectExpr("'hot' org_uuid", "cast(id as string) round_uuid", "date_add(date'2020-01-01', cast(id % 90 as int)) announced_on", "cast(null as date) closed_on")
    for df, group, key in ((inv, "round_uuid", FD.investor_key()), (rounds, "org_uuid", FD.listing_key())):
        assert cut_points(df, [group], key) is None  # 20,000 rows are no large group by default
        buckets = with_bucket(df, [group], key, cut_points(df, [group], key, split)).groupBy("_b").count().collect()
        assert len(buckets) >= 15 and max(r["count"] for r in buckets) <= 3 * split
        bounds = with_bucket(df, [group], key, cut_points(df, [group], key, split)).groupBy("_b").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).orderBy("_b").collect()
        assert all(a["hi"] < b["lo"] for a, b in zip(bounds, bounds[1:]))  # the buckets' order is the keys' order


def test_rows_are_shuffled_once(spark):
    """Numbering a split group: the join with the offsets takes the rows as the window left them."""
    df = spark.createDataFrame([("hot" if i % 3 else None, i % 50, i, "t") for i in range(2000)], "g string, a int, u int, t string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = group_positions(df, ["g"], [F.col("a").desc(), F.col("u").asc()], key_of(), split=50)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan_text(got, "simple")
        assert "Python" not in text and "Pandas" not in text
        # exchanges that carry the rows' own text column
        exchanges = [x for x in plan_text(got, "formatted").split("\n\n") if "Exchange" in x.split("\n")[0]]
        assert len([x for x in exchanges if " t#" in x and "_b#" in x]) == 1
        assert got.agg(F.countDistinct("g", "pos"), F.max("pos")).first()[1] == 1333
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_groups_need_no_buckets(spark):
    df = spark.createDataFrame(skewed_rows(600), "g string, a int, u int, t string")
    text = plan_text(group_positions(df, ["g"], [F.col("a").desc(), F.col("u").asc()], key_of()), "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
