import math

from pyspark.sql import functions as F

from featurelake.operators import features
from conftest import tx_rows

AS_OF = "2024-01-11 00:00:00"


def _prepared(spark):
    rows = [("t1", "U1", "P1", "10.00", 4, "2024-01-01 00:00:00"),
            ("t2", "U1", "P2", "0.0", 2, "2024-01-05T12:00:00.000000+00:00"),
            ("t3", "U1", "P1", None, 5, "2024-01-10 00:00:00"),
            ("t4", "U2", "P1", "20.00", 3, "2024-01-09 00:00:00")]
    df = tx_rows(spark, rows)
    return df.withColumn("amount", F.col("amount").cast("double")).withColumn("rating", F.col("rating").cast("double"))


def test_user_features_by_hand(spark):
    u = {r.user_id: r for r in features.user_features(_prepared(spark), as_of=AS_OF).collect()}
    a = u["U1"]
    assert a.user_total_interactions == 3
    assert math.isclose(a.user_avg_rating, 11 / 3)
    assert a.user_total_spent == 10.0 and a.user_avg_spent == 5.0
    assert math.isclose(a.user_rating_std, math.sqrt(((4 - 11/3)**2 + (2 - 11/3)**2 + (5 - 11/3)**2) / 2))
    assert a.user_unique_products == 2
    assert a.user_tenure_days == 10 and a.user_recency_days == 1
    assert math.isclose(a.user_activity_rate, 3 / 11)
    exp = (11 / 3) * 0.4 + math.log1p(3) * 0.3 + (5 - 1 / 6) * 0.3
    assert math.isclose(a.user_engagement_score, exp)
    assert u["U2"].user_rating_std == 0.0          # single row: null -> 0


def test_item_features_by_hand(spark):
    i = {r.product_id: r for r in features.item_features(_prepared(spark), as_of=AS_OF).collect()}
    p1 = i["P1"]
    assert p1.item_popularity_score == 3 and p1.item_unique_users == 2
    assert p1.item_total_revenue == 30.0
    assert p1.item_avg_price == 15.0               # mean of amounts > 0
    assert i["P2"].item_avg_price == 0.0           # only a 0.0 amount -> null -> 0
    assert math.isclose(p1.item_quality_score, 4 * 0.5 + math.log1p(3) * 0.3 + (2 / 3) * 0.2)


def test_interaction_counts_sum_to_user_totals(spark):
    p = _prepared(spark)
    x = features.interaction_features(p, as_of=AS_OF).groupBy("user_id").agg(F.sum("interaction_count").alias("s"))
    u = features.user_features(p, as_of=AS_OF).select("user_id", "user_total_interactions")
    assert x.join(u, "user_id").filter(F.col("s") != F.col("user_total_interactions")).count() == 0
    r = {(r.user_id, r.product_id): r for r in features.interaction_features(p, as_of=AS_OF).collect()}
    assert r[("U1", "P1")].interaction_span_days == 9
