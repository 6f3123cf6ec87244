"""Truncated-SVD recommender.

The user x item matrix A is never materialised densely: it lives as sparse
cells ``(user_id, product_id, rating)``, or as sparse vectors (``matrix``).
``svd`` fits the factors, ``topk`` searches them.  The model is stored as
tables (item factors V, singular values, user scores) and predictions are dot
products over joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurelake.functions import to_double
from featurelake.operators.matrix import positions, sparse_columns, sparse_rows
from featurelake.operators.svd import NotConverged, SVDModel, fit_svd
from featurelake.operators.topk import pruned_share, recommend, search
from featurelake.schemas import RELEVANCE_THRESHOLD, TOP_K
from featurelake.sources.lake import new_version, newest_version

__all__ = [
    "NotConverged", "SVDModel", "dot", "explained_variance", "fit_svd", "item_index", "load_model", "observed_cells",
    "precision_recall_at_k", "predict", "project_users", "pruned_share", "rating_cells", "recommend", "save_model",
    "scored_cells", "search", "sparse_columns", "sparse_rows", "split", "user_item_matrix",
]


# -- R1 / R2 / R7: cells and the matrix --------------------------------------

def rating_cells(df: DataFrame, user: str = "user_id", item: str = "product_id",
                 rating: str = "rating") -> DataFrame:
    """Mean rating per (user, item); null keys and ratings that are not
    numbers dropped."""
    return (df.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
              .groupBy(F.col(user).alias("user_id"), F.col(item).alias("product_id"))
              .agg(F.avg(to_double(rating)).alias("rating"))
              .filter(F.col("rating").isNotNull()))


def observed_cells(cells: DataFrame) -> DataFrame:
    """Cells that count as observed (value > 0; a 0 equals "unseen")."""
    return cells.filter(F.col("rating") > 0)


def user_item_matrix(cells: DataFrame, items: list[str]) -> DataFrame:
    """R2: the wide matrix for the listed items (a column each), 0 where a
    user has no cell.  The cells themselves are the form for whole catalogs."""
    wide = cells.filter(F.col("product_id").isin(items)).groupBy("user_id").pivot("product_id", items).agg(F.first("rating"))
    return cells.select("user_id").distinct().join(wide, "user_id", "left").na.fill(0.0)


def split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
          key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by the first 52 bits of the MD5 of the
    row key (stable under recomputation and repartitioning, unlike a random
    draw, and the same in any engine)."""
    cols = key or df.columns
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return df.filter(draw >= test_fraction), df.filter(draw < test_fraction)


# -- R2: sparse form, R4 / R5: fitting, R11: top-K -- see matrix, svd, topk

def item_index(cells: DataFrame) -> DataFrame:
    """Dense 0-based item index in product_id order (distributed positions)."""
    return positions(cells, "product_id", "item_idx")


def project_users(cells: DataFrame, item_factors: DataFrame, k: int) -> DataFrame:
    """U·Σ = A·V per user, as cell ⋈ V then a sum per (user, component).

    Exploding to (user, component) keeps every group small (a hot user is
    split over its components and partially aggregated map-side)."""
    parts = (cells.join(item_factors.select("product_id", "v"), "product_id")
                  .select("user_id", F.posexplode("v").alias("c", "vc"), "rating")
                  .groupBy("user_id", "c").agg(F.sum(F.col("rating") * F.col("vc")).alias("x")))
    return (parts.groupBy("user_id")
                 .agg(F.array_sort(F.collect_list(F.struct("c", "x"))).alias("_p"))
                 .select("user_id", F.transform("_p", lambda p: p["x"]).alias("u")))


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, z: acc + z)


# -- R6: predictions ------------------------------------------------------------

def predict(pairs: DataFrame, model: SVDModel) -> DataFrame:
    """Predicted score for given (user_id, product_id) pairs."""
    return (pairs.join(model.user_scores, "user_id")
                 .join(model.item_factors.select("product_id", "v"), "product_id")
                 .withColumn("prediction", dot(F.col("u"), F.col("v")))
                 .drop("u", "v"))


def scored_cells(cells: DataFrame, model: SVDModel) -> DataFrame:
    """R7 + R6: observed cells with their reconstruction (actual, prediction)."""
    return predict(observed_cells(cells), model).withColumnRenamed("rating", "actual")


# -- R10: explained variance ------------------------------------------------------

def explained_variance(cells: DataFrame, model: SVDModel) -> DataFrame:
    """Per component, population variance over all users of the user
    scores, divided by the summed population variance of the item columns
    (zeros included: computed from the sparse cells with n = users)."""
    m = float(model.n_users)
    col_var = (cells.groupBy("product_id")
                    .agg(F.sum(F.col("rating") ** 2).alias("s2"), F.sum("rating").alias("s1"))
                    .select(F.sum(F.col("s2") / m - (F.col("s1") / m) ** 2).alias("total")))
    total = col_var.scalar()
    comp = (model.user_scores.select(F.posexplode("u").alias("component", "x"))
                 .groupBy("component")
                 .agg(F.sum(F.col("x") ** 2).alias("s2"), F.sum("x").alias("s1"))
                 .select(F.col("component").cast("long").alias("component"),
                         (F.col("s2") / m - (F.col("s1") / m) ** 2).alias("variance")))
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    out = comp.select("component", (F.col("variance") / total).alias("explained_variance_ratio"))
    # the window runs over k rows (one per component), not over the data
    return out.withColumn("cumulative_ratio", F.sum("explained_variance_ratio").over(w))


# -- R12-R14: precision and recall at K ---------------------------------------

def precision_recall_at_k(cells: DataFrame, topk: DataFrame, k: int = TOP_K,
                          threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    """precision@k = mean over all users of hits / k; recall@k =
    mean over users with ≥ 1 relevant item of hits / relevant."""
    relevant = cells.filter(F.col("rating") >= threshold).select("user_id", "product_id")
    hits = (topk.select("user_id", "product_id").join(relevant, ["user_id", "product_id"], "left_semi")
                .groupBy("user_id").agg(F.count(F.lit(1)).alias("hits")))
    n_rel = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    per_user = (cells.select("user_id").distinct()
                     .join(hits, "user_id", "left").join(n_rel, "user_id", "left")
                     .na.fill(0, ["hits", "n_relevant"]))
    return per_user.agg(
        F.avg(F.col("hits") / F.lit(float(k))).alias(f"precision_at_{k}"),
        F.avg(F.when(F.col("n_relevant") > 0, F.col("hits") / F.col("n_relevant"))).alias(f"recall_at_{k}"),
    )


# -- R22: persistence ----------------------------------------------------------

def save_model(model: SVDModel, path: str) -> str:
    """A new version of the model; ``shape`` is written last and makes it
    current, so loading and saving under one path is safe."""
    spark = model.item_factors.sparkSession
    version = new_version()
    base = f"{path.rstrip('/')}"
    model.item_factors.write.parquet(f"{base}/item_factors/version={version}")
    model.user_scores.write.parquet(f"{base}/user_scores/version={version}")
    meta = [(i, float(s)) for i, s in enumerate(model.singular_values)]
    spark.createDataFrame(meta, "component long, singular_value double").write.parquet(f"{base}/singular_values/version={version}")
    spark.createDataFrame([(model.n_users, model.n_items)], "n_users long, n_items long").write.parquet(f"{base}/shape/version={version}")
    return version


def load_model(spark: SparkSession, path: str) -> SVDModel:
    current = newest_version(spark, f"{path.rstrip('/')}/shape")
    if current is None:
        raise FileNotFoundError(f"no complete model under {path}")
    version = current.rsplit("/", 1)[1]

    def part(name: str) -> DataFrame:
        return spark.read.parquet(f"{path.rstrip('/')}/{name}/{version}")

    sv = [r[1] for r in part("singular_values").orderBy("component").collect()]
    shape = part("shape").first()
    return SVDModel(part("item_factors"), part("user_scores"), sv, int(shape[0]), int(shape[1]))
