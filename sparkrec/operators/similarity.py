"""Item-item collaborative filtering.

Similarities are cosine over common raters. Pairs come from a self-join of
the (seed-restricted) ratings on user_id, so only item pairs that share a
rater are ever formed - never a cross join of items. Per user the join emits
at most s*(s-1)/2 pairs for s seed items rated. The ratings of a user with many
are dealt into blocks by a hash of the item, and the join's key is (user, block of
the first item, block of the second): such a user's pairs become many keys of
at most BLOCK x BLOCK pairs or so, and go to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import LIKED_RATING, round_half_up
from sparkrec.operators.ranking import top_n_per
from sparkrec.session import materialize, spread


#: Ratings of one user that are met with each other under one key of the join, about.
BLOCK = 512
#: Keys over which the likers of one source item are dealt in the CF join.
SALTS = 16
#: Pairs of items up to which each task holds the sums of all pairs before they are sent.
FEW_PAIRS = 1_000_000
#: Pairs of ratings that one task adds up, about, where the pairs of items are more.
PAIRS_PER_TASK = 2_000_000
#: Raters of an item beyond which its partners are dealt over several keys.
MANY_RATERS = 100_000


def _met(ratings: DataFrame, block: int) -> DataFrame:
    """Pairs of ratings of one user, each once: user_id, a and b (rating and further
    columns as structs), by a two-dimensional block join.

    A user's n blocks meet as (i, j) with i <= j: a rating of block k goes to the keys
    (k, j) as the first and to (i, k) as the second of a pair, n + 1 copies in all.
    Users with up to `block` ratings have one block and one copy on each side. The
    table of users beyond has at most #ratings / block rows."""
    many = (ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
            .select("user_id", F.ceil(F.col("_n") / block).cast("int").alias("_blocks")))
    r = ratings.join(many, "user_id", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    r = r.withColumn("_own", F.pmod(F.xxhash64("item_id"), F.col("_blocks")).cast("int"))
    row = F.struct(*[c for c in ratings.columns if c != "user_id"])
    a = r.select("user_id", F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("_j"), row.alias("a"))
    b = r.select("user_id", F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"), F.col("_own").alias("_j"), row.alias("b"))
    met = a.join(b, ["user_id", "_i", "_j"])
    # within a block both orders of a pair meet, and each rating itself
    return met.filter((F.col("_i") < F.col("_j")) | (F.col("a.item_id") < F.col("b.item_id"))).select("user_id", "a", "b")


def _cosine_parts(ratings: DataFrame, order: str, block: int, n_items: int) -> DataFrame:
    """Common raters, dot product and squared lengths of every pair of items with a
    common rater; item_id_1 is the one that comes first by the column `order`."""
    if n_items * (n_items - 1) // 2 > FEW_PAIRS:
        return _packed_parts(ratings, order, block)
    met = _met(ratings, block)
    swap = F.col(f"a.{order}") > F.col(f"b.{order}")
    pair = met.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("x"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("y"))
    return (pair.groupBy(F.col("x.item_id").alias("item_id_1"), F.col("y.item_id").alias("item_id_2"))
            .agg(F.count(F.lit(1)).alias("common_users"),
                 F.sum(F.col("x.rating") * F.col("y.rating")).alias("_dot"),
                 F.sum(F.col("x.rating") * F.col("x.rating")).alias("_s1"),
                 F.sum(F.col("y.rating") * F.col("y.rating")).alias("_s2")))


def _packed_parts(ratings: DataFrame, order: str, block: int) -> DataFrame:
    """`_cosine_parts` where most pairs of items have few common raters, so that sums
    before the shuffle would save nothing: a rating is sent to its item's task as one
    row, with the arrays of what its user rated of the items that come later.

    A user's ratings beyond `block` are met a block at a time, and the partners of an
    item with more than MANY_RATERS raters are dealt by a hash over several keys."""
    r = materialize(ratings, "seed_ratings")
    per_user = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    pairs = per_user.agg(F.sum(F.col("_n") * (F.col("_n") - 1))).first()[0] or 0
    many = per_user.filter(F.col("_n") > block).select("user_id", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    hot = (r.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > MANY_RATERS)
           .select("item_id", F.ceil(F.col("_n") / MANY_RATERS).cast("int").alias("_keys")))
    r = (r.withColumn("_o", F.col(order)).select("user_id", "item_id", "rating", "_o").join(many, "user_id", "left")
         .withColumn("_blocks", F.coalesce("_blocks", F.lit(1))))
    lists = r.groupBy("user_id", F.pmod(F.xxhash64("item_id"), F.col("_blocks")).cast("int").alias("_block")).agg(
        F.collect_list(F.struct("_o", "item_id", "rating")).alias("_list"))
    each = (r.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .join(F.broadcast(hot), "item_id", "left")  # #ratings / MANY_RATERS rows at most
            .withColumn("_keys", F.coalesce("_keys", F.lit(1)))
            .withColumn("_key", F.explode(F.sequence(F.lit(0), F.col("_keys") - 1))))
    met = each.join(lists, ["user_id", "_block"]).select(
        "item_id", "rating", "_key", "_keys", F.filter("_list", lambda x: x["_o"] > F.col("_o")).alias("_later"))
    met = met.withColumn("_later", F.when(F.col("_keys") == 1, F.col("_later")).otherwise(
        F.filter("_later", lambda x: F.pmod(F.xxhash64(x["item_id"]), F.col("_keys")) == F.col("_key"))))
    met = met.filter(F.size("_later") > 0).select(
        F.col("item_id").alias("item_id_1"), "_key", F.col("rating").alias("_x"),
        F.transform("_later", lambda x: x["item_id"]).alias("item_id_2"), F.transform("_later", lambda x: x["rating"]).alias("_y"))
    pair = spread(met, pairs // 2, "item_id_1", "_key", per_task=PAIRS_PER_TASK).select(
        "item_id_1", "_key", "_x", F.inline(F.arrays_zip("item_id_2", "_y")))
    return (pair.groupBy("item_id_1", "_key", "item_id_2")
            .agg(F.count(F.lit(1)).alias("common_users"), F.sum(F.col("_x") * F.col("_y")).alias("_dot"),
                 F.sum(F.col("_x") * F.col("_x")).alias("_s1"), F.sum(F.col("_y") * F.col("_y")).alias("_s2"))
            .drop("_key"))


def _cosine(dot: str = "_dot", s1: str = "_s1", s2: str = "_s2") -> Column:
    return F.col(dot) / (F.sqrt(F.col(s1)) * F.sqrt(F.col(s2)))


def _seed_ratings(train: DataFrame, seed: DataFrame, min_common: int, extra: list[str] | None = None) -> DataFrame:
    """Ratings of the seed items that have `min_common` raters at all: no pair of
    another item can have so many in common, so it is never formed."""
    cols = ["item_id"] + (extra or [])
    # the seed may be the whole catalogue, so its size decides the join, not a hint
    r = train.select("user_id", "item_id", "rating").join(seed.select(*cols), "item_id")
    enough = r.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_common)
    return r.join(enough.select("item_id"), "item_id", "left_semi")


def pair_similarity(train: DataFrame, pairs: DataFrame, min_common: int = 20) -> DataFrame:
    """cosine over the common raters of each given (item_id_1, item_id_2);
    unrounded; 0 when a magnitude is 0; no row below `min_common`."""
    r = train.select("user_id", "item_id", "rating")
    a = pairs.select("item_id_1", "item_id_2").join(
        r.withColumnRenamed("item_id", "item_id_1").withColumnRenamed("rating", "_ra"), "item_id_1")
    j = a.join(r.withColumnRenamed("item_id", "item_id_2").withColumnRenamed("rating", "_rb"),
               ["item_id_2", "user_id"])
    g = (j.groupBy("item_id_1", "item_id_2")
          .agg(F.count(F.lit(1)).alias("common_users"),
               F.sum(F.col("_ra") * F.col("_rb")).alias("_dot"),
               F.sum(F.col("_ra") * F.col("_ra")).alias("_s1"),
               F.sum(F.col("_rb") * F.col("_rb")).alias("_s2"))
          .filter(F.col("common_users") >= min_common))
    sim = F.when((F.col("_s1") > 0) & (F.col("_s2") > 0), _cosine()).otherwise(F.lit(0.0))
    return g.select("item_id_1", "item_id_2", "common_users", sim.alias("similarity"))


def pair_similarity_batch(train: DataFrame, seed: DataFrame, min_common: int = 20, block: int = BLOCK) -> DataFrame:
    """F1 batch form: every pair (i, j) of the seed list with i before j in list
    order (`seed_rank`), so item_id_1 is the more rated item - computed from the
    rater self-join, not by enumerating all pairs."""
    g = _cosine_parts(_seed_ratings(train, seed, min_common, ["seed_rank"]), "seed_rank", block, seed.count())
    g = g.filter(F.col("common_users") >= min_common)
    sim = F.when((F.col("_s1") > 0) & (F.col("_s2") > 0), _cosine()).otherwise(F.lit(0.0))
    return g.select("item_id_1", "item_id_2", "common_users", sim.alias("similarity"))


def item_similarities(train: DataFrame, seed: DataFrame, min_common: int = 20, block: int = BLOCK) -> DataFrame:
    """all seed pairs item_id_1 < item_id_2 with >= min_common common
    raters: common_users and cosine rounded to 4 places."""
    g = _cosine_parts(_seed_ratings(train, seed, min_common), "item_id", block, seed.count())
    g = g.filter((F.col("common_users") >= min_common) & (F.col("_s1") > 0) & (F.col("_s2") > 0))
    return g.select("item_id_1", "item_id_2", "common_users",
                    round_half_up(_cosine(), 4).alias("similarity_score"))


def similarity_summary(sims: DataFrame, seed: DataFrame) -> DataFrame:
    """seed items, possible pairs n(n-1)/2, pairs found, coverage %, and
    mean / median / min / max of the score and of common_users."""
    n_items = seed.agg(F.count(F.lit(1))).scalar()
    score_dec = F.col("similarity_score").cast("decimal(6,4)")
    s = sims.agg(
        F.count(F.lit(1)).alias("pairs_found"),
        F.try_divide(F.sum(score_dec).cast("double"), F.count(F.lit(1))).alias("score_mean"),
        F.median("similarity_score").alias("score_median"),
        F.min("similarity_score").alias("score_min"),
        F.max("similarity_score").alias("score_max"),
        F.try_divide(F.sum("common_users").cast("double"), F.count(F.lit(1))).alias("common_mean"),
        F.median(F.col("common_users").cast("double")).alias("common_median"),
        F.min("common_users").alias("common_min"),
        F.max("common_users").alias("common_max"))
    possible = (n_items * (n_items - 1) / 2).cast("bigint")
    return s.select(n_items.alias("items"), possible.alias("possible_pairs"), "*").withColumn(
        "coverage_pct", F.try_divide(F.col("pairs_found"), F.col("possible_pairs")) * F.lit(100.0))


def symmetric_edges(sims: DataFrame) -> DataFrame:
    """Both directions of each stored pair as (src, dst, similarity_score,
    common_users): turns the original's OR-join into an equi-join. One pass
    over the pairs (explode of the two orientations), not a union of two scans."""
    both = F.array(F.struct(F.col("item_id_1").alias("src"), F.col("item_id_2").alias("dst")),
                   F.struct(F.col("item_id_2").alias("src"), F.col("item_id_1").alias("dst")))
    return (sims.select(F.explode(both).alias("_e"), "similarity_score", "common_users")
            .select("_e.src", "_e.dst", "similarity_score", "common_users"))


def similar_items(sims: DataFrame, items: DataFrame, genre_strings: DataFrame,
                  item_ids: DataFrame | None = None, n: int = 10) -> DataFrame:
    """for each item (all by default) its n most similar items, with title,
    genre string, score and common raters."""
    e = symmetric_edges(sims)
    if item_ids is not None:
        e = e.join(item_ids.select(F.col("item_id").alias("src")), "src", "left_semi")
    top = top_n_per(e, ["src"], [F.col("similarity_score").desc(), F.col("dst").asc()], n)
    return (top.join(items.select(F.col("item_id").alias("dst"), "title"), "dst")
            .join(genre_strings.withColumnRenamed("item_id", "dst"), "dst", "left")
            .select(F.col("src").alias("item_id"), "rank", F.col("dst").alias("similar_item_id"),
                    "title", "genres", "similarity_score", "common_users"))


def _liked_edges(train: DataFrame, sims: DataFrame, users: DataFrame | None,
                 min_rating: float, salts: int) -> DataFrame:
    """(user, src, dst, score, rating) for every liked source item and each of its
    neighbours, and a row of each rated item as `dst` with `_rated` 1 and no source;
    dealt by user and target.

    The likers of a source are dealt over `salts` keys, and its neighbours given to
    each of them, so that a source which very many like goes to many tasks. A rating
    becomes as many rows as its item has neighbours, so the tasks that add them up
    are as many as these rows need, which are counted per item before."""
    r = train.select("user_id", "item_id", "rating")
    if users is not None:
        r = r.join(users.select("user_id"), "user_id", "left_semi")
    liked = r.filter(F.col("rating") >= min_rating).select(
        "user_id", F.col("item_id").alias("src"), "rating", F.pmod(F.xxhash64("user_id"), F.lit(salts)).alias("salt"))
    edges = symmetric_edges(sims)
    likers = liked.groupBy("src").agg(F.count(F.lit(1)).alias("_likers"))
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_neighbours"))
    rows = likers.join(degrees, "src").agg(F.sum(F.col("_likers") * F.col("_neighbours"))).first()[0] or 0
    salted = edges.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    cand = liked.join(salted, ["src", "salt"]).select(
        "user_id", "dst", "src", "similarity_score", "rating", F.lit(0).alias("_rated"))
    # a null never equals a rated item
    rated = r.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(
        "user_id", F.col("item_id").alias("dst"), F.lit(None).cast(edges.schema["src"].dataType).alias("src"),
        F.lit(None).cast("double").alias("similarity_score"), F.lit(None).cast("double").alias("rating"), F.lit(1).alias("_rated"))
    return spread(cand.unionByName(rated), rows + r.count(), "user_id", "dst")


def cf_pool(train: DataFrame, sims: DataFrame, users: DataFrame | None = None, n: int = 10,
            min_rating: float = LIKED_RATING, salts: int = SALTS) -> DataFrame:
    """F5 without the item's details: user_id, rank, item_id, recommendation_score,
    based_on_count, based_on_items."""
    cand = _liked_edges(train, sims, users, min_rating, salts)
    prod = F.col("similarity_score").cast("decimal(6,4)") * F.col("rating").cast("decimal(3,1)")
    agg = cand.groupBy("user_id", "dst").agg(
        F.sum(prod).alias("_exact"),
        F.count(F.lit(1)).alias("based_on_count"),
        F.array_join(F.array_sort(F.collect_list(F.col("src").cast("string"))), ",")
         .alias("based_on_items"),
        F.max("_rated").alias("_rated"))
    agg = agg.filter(F.col("_rated") == 0).withColumnRenamed("dst", "item_id")
    top = top_n_per(agg, ["user_id"], [F.col("_exact").desc(), F.col("item_id").asc()], n)
    score = F.round(F.col("_exact") * F.lit(0.2).cast("decimal(2,1)"), 4).cast("double")
    return top.select("user_id", "rank", "item_id", score.alias("recommendation_score"), "based_on_count", "based_on_items")


def cf_recommendations(train: DataFrame, sims: DataFrame, items: DataFrame,
                       genre_strings: DataFrame, users: DataFrame | None = None,
                       n: int = 10, min_rating: float = LIKED_RATING, salts: int = SALTS) -> DataFrame:
    """score(user, item) = sum over liked sources of similarity * rating / 5.

    The sum is taken in decimals (4-place scores times half-star ratings), so
    it is exact and order-free; the output is rounded to 4 places, the order
    uses the exact value. (user, source, target) is unique - a user likes an
    item once and a pair is stored once - so the distinct count and set of
    sources are a plain count and list (one aggregation level)."""
    return (cf_pool(train, sims, users, n, min_rating, salts).join(items.select("item_id", "title"), "item_id")
            .join(genre_strings, "item_id", "left")
            .select("user_id", "rank", "item_id", "title", "genres",
                    "recommendation_score", "based_on_count", "based_on_items"))


def cf_predicted_rating(train: DataFrame, sims: DataFrame, users: DataFrame | None = None,
                        n: int = 10, min_rating: float = LIKED_RATING,
                        min_sources: int = 2, salts: int = SALTS) -> DataFrame:
    """F6 (documented variant): predicted = sum(rating * sim) / sum(sim) over
    liked sources, with at least `min_sources` sources."""
    cand = _liked_edges(train, sims, users, min_rating, salts)
    sim = F.col("similarity_score").cast("decimal(6,4)")
    agg = (cand.groupBy("user_id", "dst")
           .agg(F.sum(sim * F.col("rating").cast("decimal(3,1)")).alias("_num"),
                F.sum(sim).alias("_den"), F.count(F.lit(1)).alias("source_count"), F.max("_rated").alias("_rated"))
           .filter((F.col("source_count") >= min_sources) & (F.col("_rated") == 0)).withColumnRenamed("dst", "item_id")
           .withColumn("predicted_rating",
                       F.try_divide(F.col("_num").cast("double"), F.col("_den").cast("double"))))
    top = top_n_per(agg, ["user_id"], [F.col("predicted_rating").desc(), F.col("item_id").asc()], n)
    return top.select("user_id", "rank", "item_id", "predicted_rating", "source_count")
