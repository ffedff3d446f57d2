"""The distributed rank helpers against pandas, including one hot group
holding a third of all rows."""

import pandas as pd
from pyspark.sql import functions as F

from sparkrec.operators.ranking import global_rank, rank_within_groups, top_n_per


def test_rank_within_groups_hot_group(spark):
    n = 3000
    pdf = pd.DataFrame({"g": [0 if i % 3 == 0 else i % 17 + 1 for i in range(n)],
                        "ts": [(i * 7919) % 1000 for i in range(n)], "id": range(n)})
    df = spark.createDataFrame(pdf)
    got = rank_within_groups(df, ["g"], [F.col("ts").desc(), F.col("id").desc()], "rn", "n",
                             num_partitions=8).toPandas()
    exp = pdf.sort_values(["g", "ts", "id"], ascending=[True, False, False])
    exp["rn"] = exp.groupby("g").cumcount() + 1
    m = got.merge(exp, on="id", suffixes=("", "_e"))
    assert len(m) == n and (m["rn"] == m["rn_e"]).all()
    assert (m["n"] == m.groupby("g")["id"].transform("size")).all()


def test_global_rank(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 37) % 5000).alias("k"))
    got = global_rank(df, [F.col("k").desc()], "r", num_partitions=7).toPandas()
    assert (got["r"] == 5000 - got["k"]).all()


def test_top_n_per(spark):
    df = spark.createDataFrame([(1, 5.0, 1), (1, 5.0, 2), (1, 4.0, 3), (2, 1.0, 4)],
                               "u int, s double, item int")
    got = top_n_per(df, ["u"], [F.col("s").desc(), F.col("item")], 2).toPandas()
    assert sorted(zip(got.u, got["rank"], got.item)) == [(1, 1, 1), (1, 2, 2), (2, 1, 4)]
