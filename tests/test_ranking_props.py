"""Property tests for the distributed numbering and the split rank join."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkrec.operators.ranking import join_on_rank, rank_within_groups

rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), min_size=1, max_size=300)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows, parts=st.integers(1, 9))
def test_rank_within_groups_matches_pandas(spark, data, parts):
    pdf = pd.DataFrame(data, columns=["g", "ts"])
    pdf["id"] = range(len(pdf))  # unique tie-break, as the helper requires
    got = rank_within_groups(spark.createDataFrame(pdf), ["g"],
                             [F.col("ts").desc(), F.col("id").asc()], "rn", "n",
                             num_partitions=parts).toPandas()
    exp = pdf.sort_values(["g", "ts", "id"], ascending=[True, False, True])
    exp["rn_e"] = exp.groupby("g").cumcount() + 1
    m = got.merge(exp[["id", "rn_e"]], on="id")
    assert len(m) == len(pdf) and (m["rn"] == m["rn_e"]).all()
    assert (m["n"] == m.groupby("g")["id"].transform("size")).all()


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(budgets=st.lists(st.integers(1, 30), min_size=1, max_size=40), low=st.integers(1, 12))
def test_join_on_rank_equals_plain_join(spark, budgets, low):
    cand = spark.createDataFrame([(u, b) for u, b in enumerate(budgets)], "user_id long, l long") \
        .select("user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("l"))).alias("r"))
    ranked = spark.range(1, 26).select(F.col("id").alias("r"), (F.col("id") * 7).alias("item_id"))
    got = sorted(map(tuple, join_on_rank(cand, ranked, [], "r", low)
                     .select("user_id", "r", "item_id").collect()))
    exp = sorted(map(tuple, cand.join(ranked, "r").select("user_id", "r", "item_id").collect()))
    assert got == exp
