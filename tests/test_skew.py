"""A hot user: a third of the raw ratings reassigned to one user. Ratings are
unique per (user, item), so after de-duplication that user rates (nearly) the
whole catalogue - the largest group the data allows. The time split stays
exact and the user's rows are numbered across several range partitions."""

import itertools
import math
import random
import re
import statistics
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import functions as F

from paths import SF01
from sparkrec.operators import similarity as sim_ops
from sparkrec.operators.ranking import _sorted_with_position
from sparkrec.operators.split import RATING_COLS, label_split
from sparkrec.plans import datasets


@contextmanager
def settings_of(spark, conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _hot_ratings(spark):
    r = datasets.load(spark, SF01, "r1").ratings
    hot = F.when(F.col("rating_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    r = r.withColumn("user_id", hot.cast("bigint"))
    # one rating per (user, item): keep the newest, as the rating views do
    latest = r.groupBy("user_id", "item_id").agg(F.max(F.struct("ts", "rating_id", "rating")).alias("m"))
    return latest.select(F.col("m.rating_id").alias("rating_id"), "user_id", "item_id",
                         F.col("m.rating").alias("rating"), F.col("m.ts").alias("ts"))


def test_hot_user_split_is_exact(spark):
    r = _hot_ratings(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # partitions smaller than the hot user
    try:
        got = label_split(r).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    pdf = r.toPandas().sort_values(["user_id", "ts", "rating_id"], ascending=[True, False, False])
    pdf["rn"] = pdf.groupby("user_id").cumcount() + 1
    pdf["n"] = pdf.groupby("user_id")["rating_id"].transform("size")
    pdf = pdf[pdf["n"] >= 5]
    pdf["is_test"] = pdf["rn"] <= (pdf["n"] * 0.2).astype(int).clip(lower=1)
    m = got.merge(pdf, on="rating_id", suffixes=("", "_e"))
    assert len(m) == len(got) == len(pdf)
    assert (m["is_test"] == m["is_test_e"]).all()
    n_items = r.select("item_id").distinct().count()
    assert (pdf["user_id"] == 0).sum() >= 0.9 * n_items


def test_hot_user_spans_partitions(spark):
    r = _hot_ratings(spark).select(*RATING_COLS)
    keyed = _sorted_with_position(r, [F.col("user_id"), F.col("ts").desc(), F.col("rating_id").desc()], 64)
    parts = keyed.filter("user_id = 0").select("_sr_pid").distinct().count()
    assert parts >= 2


def _hot_pairs(spark):
    """One user with a third of all ratings, and one item that nearly all like."""
    rng = random.Random(5)
    rows = [(0, i, rng.choice([1.0, 3.5, 4.0, 5.0])) for i in range(400)]
    rows += [(u, i, rng.choice([2.0, 4.0, 4.5])) for u in range(1, 81) for i in {7, *rng.sample(range(400), 9)}]
    return rows, spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_pairs_of_a_hot_user_are_many_keys(spark):
    rows, train = _hot_pairs(spark)
    seed = train.select("item_id").distinct()
    by_user = defaultdict(list)
    for u, i, r in rows:
        by_user[u].append((i, r))
    parts = defaultdict(list)
    for own in by_user.values():
        for (i, r), (j, q) in itertools.combinations(sorted(own), 2):
            parts[i, j].append((r, q))
    want = {k: (len(p), sum(r * q for r, q in p) / math.sqrt(sum(r * r for r, _ in p)) / math.sqrt(sum(q * q for _, q in p)))
            for k, p in parts.items() if len(p) >= 2}
    for block in (16, 512):
        got = {(r[0], r[1]): (r[2], r[3]) for r in sim_ops.item_similarities(train, seed, min_common=2, block=block).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) <= 5.1e-5 for k in want)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with settings_of(spark, conf):
        tasks = [r["count"] for r in sim_ops._met(train, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 400 * 399 // 2 + sum(len(v) * (len(v) - 1) // 2 for u, v in by_user.items() if u)
    assert len(tasks) == 8 and max(tasks) <= 5 * statistics.median(tasks)


def test_cf_is_not_dealt_by_source_alone(spark):
    rows, train = _hot_pairs(spark)
    sims = sim_ops.item_similarities(train, train.select("item_id").distinct(), min_common=2)
    items = train.select("item_id", F.lit("t").alias("title")).distinct()
    strings = items.select("item_id", F.lit("g").alias("genres"))
    with settings_of(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        one, many = (sim_ops.cf_recommendations(train, sims, items, strings, salts=n) for n in (1, 16))
        assert sorted(one.collect()) == sorted(many.collect()) and many.count() > 100
        assert not re.search(r"hashpartitioning\(src#\d+L?, \d+\)", many._jdf.queryExecution().toString())
        a, b = (sim_ops.cf_predicted_rating(train, sims, salts=n).collect() for n in (1, 16))
        assert sorted(a) == sorted(b) and a
