"""Registered queries: each runs an operator of the engine over the driver's
tables (through the fixture views) and returns a DataFrame; most have a DuckDB
oracle in ``ORACLE``.  Outputs go through ``portable`` (doubles rounded to 6
places, timestamps as text) so two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featurelake.functions import portable
from featurelake.operators import cleaning, features, merge
from featurelake.plans import oracle as O
from featurelake.sources import fixtures

AS_OF = "2024-02-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- shared inputs ----------------------------------------------------------

def materialize(df: DataFrame) -> DataFrame:
    """A derived input that a query scans more than once, written to the
    shared scratch folder."""
    from featurelake.session import fresh_dir, freed_shuffles
    path = fresh_dir(df.sparkSession, "input")
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def combined(spark: SparkSession, sf_dir: str, id_mode: str = "key") -> DataFrame:
    """Batch + stream.  Stream ids default to the stable ``STREAM_<event_id>``
    (no global order); ``stream_interactions`` checks the rank form."""
    return merge.combine(fixtures.interactions_raw(spark, sf_dir),
                         fixtures.speed_snapshot(spark, sf_dir), id_mode=id_mode)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.prepare(combined(spark, sf_dir))


# -- features ---------------------------------------------------------------

@register("user_features", O.with_base(
    f"SELECT {O.portable_select(O.USER_FEATURE_COLS)} FROM user_feat", O.USER_FEATURES_CTE))
def q_user_features(spark, sf_dir):
    return portable(features.user_features(prepared(spark, sf_dir), as_of=AS_OF))


@register("item_features", O.with_base(
    f"SELECT {O.portable_select(O.ITEM_FEATURE_COLS)} FROM item_feat", O.ITEM_FEATURES_CTE))
def q_item_features(spark, sf_dir):
    return portable(features.item_features(prepared(spark, sf_dir), as_of=AS_OF))


@register("interaction_features", O.with_base(
    f"SELECT {O.portable_select(O.INTERACTION_FEATURE_COLS)} FROM inter_feat",
    O.INTERACTION_FEATURES_CTE))
def q_interaction_features(spark, sf_dir):
    return portable(features.interaction_features(prepared(spark, sf_dir), as_of=AS_OF))


def _state(spark, sf_dir):
    """The pair state of all prepared rows, merged from three batches."""
    from pyspark.sql import functions as F
    from featurelake.operators import feature_state
    from featurelake.session import fresh_dir
    rows = materialize(prepared(spark, sf_dir).withColumn("_batch", F.pmod(F.xxhash64("transaction_id"), F.lit(3))))
    path = fresh_dir(spark, "pair-state")
    for b in range(3):
        state = feature_state.update_state(spark, path, rows.filter(F.col("_batch") == b).drop("_batch"))
    return state


@register("user_features_merged", O.with_base(
    f"SELECT {O.portable_select(O.USER_FEATURE_COLS)} FROM user_feat", O.USER_FEATURES_CTE))
def q_user_features_merged(spark, sf_dir):
    """U1-U12 from the mergeable state, fed batch by batch."""
    from featurelake.operators import feature_state
    return portable(feature_state.user_features(_state(spark, sf_dir), as_of=AS_OF))


@register("item_features_merged", O.with_base(
    f"SELECT {O.portable_select(O.ITEM_FEATURE_COLS)} FROM item_feat", O.ITEM_FEATURES_CTE))
def q_item_features_merged(spark, sf_dir):
    from featurelake.operators import feature_state
    return portable(feature_state.item_features(_state(spark, sf_dir), as_of=AS_OF))


@register("interaction_features_merged", O.with_base(
    f"SELECT {O.portable_select(O.INTERACTION_FEATURE_COLS)} FROM inter_feat",
    O.INTERACTION_FEATURES_CTE))
def q_interaction_features_merged(spark, sf_dir):
    from featurelake.operators import feature_state
    return portable(feature_state.interaction_features(_state(spark, sf_dir), as_of=AS_OF))


# -- sources, speed layer, merge, cleaning ------------------------------------

@register("landed_transactions", O.q(f"SELECT {O.portable_select(O.COMBINED_COLS)} FROM raw_tx"))
def q_landed_transactions(spark, sf_dir):
    """S2 -> S4 -> S1: land the raw feed twice as CSV snapshots; only the
    newest snapshot is read back (so rows are not doubled)."""
    import datetime as dt
    from featurelake.session import fresh_dir
    from featurelake.sources import lake
    root = fresh_dir(spark, "lake")
    raw = fixtures.interactions_raw(spark, sf_dir)
    lake.land_raw(raw, root, "internal", "transactions", dt.datetime(2024, 1, 1, 12, 0, 0))
    lake.land_raw(raw, root, "internal", "transactions", dt.datetime(2024, 1, 2, 12, 0, 0))
    return lake.latest_snapshot(spark, root, "internal", "transactions")


@register("landed_products", O.LANDED_PRODUCTS_SQL)
def q_landed_products(spark, sf_dir):
    """S3: the product catalog as JSON, landed as it came, the newest
    snapshot read back with inferred columns."""
    import datetime as dt
    from featurelake.session import fresh_dir
    from featurelake.sources import lake
    root = fresh_dir(spark, "lake")
    fixtures.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size").write.json(f"{root}/feed")
    products = lake.read_products(spark, f"{root}/feed")
    lake.land_raw(products.limit(1), root, "api", "products", dt.datetime(2024, 1, 1), fmt="json")
    lake.land_raw(products, root, "api", "products", dt.datetime(2024, 1, 2), fmt="json")
    return lake.latest_snapshot(spark, root, "api", "products", reader=lambda path: lake.read_products(spark, path)).select(
        "p_partkey", "p_name", "p_brand", "p_size")


@register("dq_missing_column", O.DQ_MISSING_COLUMN_SQL)
def q_dq_missing_column(spark, sf_dir):
    """V4: a feed that lacks a required column and has one of its own."""
    from pyspark.sql import functions as F
    from featurelake.operators import quality
    feed = combined(spark, sf_dir).drop("rating").withColumn("channel", F.lit("web"))
    return quality.validate(feed).groupBy("column", "check").agg(F.count(F.lit(1)).alias("failures"))


@register("speed_table", O.SPEED_TABLE_SQL)
def q_speed_table(spark, sf_dir):
    """Event lines (three files) streamed into the speed table."""
    from featurelake.sources import lake
    root = _ingested(spark, sf_dir)
    return lake.read_speed(spark, f"{root}/clicks").select("event_id", "user_id", "product_id", "action", "ts")


def _ingested(spark, sf_dir, lines=None):
    """A speed table filled by the stream from three files of event lines."""
    from featurelake.session import fresh_dir
    from featurelake.streaming import speed_layer
    root = fresh_dir(spark, "speed")
    lines = fixtures.event_lines(spark, sf_dir) if lines is None else lines
    lines.repartition(3).write.text(f"{root}/incoming")
    speed_layer.ingest_folder(spark, f"{root}/incoming", f"{root}/clicks", f"{root}/dead", f"{root}/_checkpoint")
    return root


@register("arrival_numbers", O.ARRIVAL_NUMBERS_SQL)
def q_arrival_numbers(spark, sf_dir):
    """S8 over the streamed table: the feed comes in two waves with a
    compaction after the first; every event has one number, none is missing,
    and the numbers of the first wave are still the same in the end."""
    from pyspark.sql import functions as F
    from featurelake.session import fresh_dir
    from featurelake.sources import lake
    from featurelake.streaming import compaction, speed_layer
    root = fresh_dir(spark, "speed")
    n = F.get_json_object("value", "$.event_id").cast("long")
    lines = fixtures.event_lines(spark, sf_dir)

    def wave(rows, files):
        rows.repartition(files).write.mode("append").text(f"{root}/incoming")
        speed_layer.ingest_folder(spark, f"{root}/incoming", f"{root}/clicks", f"{root}/dead", f"{root}/_checkpoint", 1)

    wave(lines.filter(n % 2 == 0), 3)
    compaction.compact(spark, f"{root}/clicks", fan=2)
    first = materialize(lake.read_arrivals(spark, f"{root}/clicks").select("event_id", F.col("arrival_number").alias("before")))
    wave(lines.filter(n % 2 == 1), 2)
    compaction.compact(spark, f"{root}/clicks", fan=2)
    rows = lake.read_arrivals(spark, f"{root}/clicks").join(first, "event_id", "left")
    return rows.select("arrival_number", (F.col("event_id").cast("long") % 2).alias("wave"),
                       F.coalesce(F.col("before") == F.col("arrival_number"), F.lit(True)).alias("unchanged"))


@register("dead_letters", O.DEAD_LETTERS_SQL)
def q_dead_letters(spark, sf_dir):
    """Lines that are no events (cut short, with text after the object,
    without a required key), as the stream stores them."""
    from featurelake.streaming import speed_layer
    root = _ingested(spark, sf_dir, fixtures.faulty_event_lines(spark, sf_dir))
    return speed_layer.read_dead_letters(spark, f"{root}/dead").select("value", "reason")


@register("latest_events", O.LATEST_EVENTS_SQL)
def q_latest_events(spark, sf_dir):
    """The ten events that arrived last; the feed arrives by event id."""
    from featurelake.streaming import speed_layer
    return speed_layer.latest_events(fixtures.arrivals(spark, sf_dir), 10).select("event_id", "user_id", "product_id", "action", "ts")


@register("event_count", O.EVENT_COUNT_SQL)
def q_event_count(spark, sf_dir):
    from featurelake.streaming import speed_layer
    return speed_layer.event_count(fixtures.speed_snapshot(spark, sf_dir))


@register("stream_interactions", O.q(f"SELECT {O.portable_select(O.COMBINED_COLS)} FROM stream_rows"))
def q_stream_interactions(spark, sf_dir):
    return merge.stream_interactions(fixtures.speed_snapshot(spark, sf_dir), id_mode="rank")


@register("combined_interactions", O.q(f"SELECT {O.portable_select(O.COMBINED_COLS)} FROM combined"))
def q_combined(spark, sf_dir):
    return combined(spark, sf_dir)


@register("prepared_interactions", O.q(f"SELECT {O.portable_select(O.PREPARED_COLS)} FROM prepared"))
def q_prepared(spark, sf_dir):
    return portable(prepared(spark, sf_dir))


# -- data quality ---------------------------------------------------------------

@register("dq_metrics", O.DQ_METRICS_SQL)
def q_dq_metrics(spark, sf_dir):
    from featurelake.operators import quality
    return quality.dq_metrics(combined(spark, sf_dir))


@register("dq_missing_by_column", O.DQ_MISSING_SQL)
def q_dq_missing(spark, sf_dir):
    from featurelake.operators import quality
    return quality.missing_by_column(combined(spark, sf_dir))


@register("dq_failures", O.DQ_FAILURES_SQL)
def q_dq_failures(spark, sf_dir):
    from featurelake.operators import quality
    return quality.validate(combined(spark, sf_dir))


@register("dq_summary", O.DQ_SUMMARY_SQL)
def q_dq_summary(spark, sf_dir):
    from featurelake.operators import quality
    summary, _ = quality.dq_report(combined(spark, sf_dir))
    return summary


@register("csv_contract_failures", O.CSV_CONTRACT_SQL)
def q_csv_contract_failures(spark, sf_dir):
    """S1 + V4-V8: files with another column order, quoted commas and quotes
    and an extra column, read by header name; failures of both contracts."""
    from pyspark.sql import functions as F
    from featurelake.operators import quality
    from featurelake.session import fresh_dir
    from featurelake.sources import lake
    root = fresh_dir(spark, "feed")
    raw = fixtures.interactions_raw(spark, sf_dir).withColumn(
        "product_id", F.concat(F.lit('P "'), F.col("product_id"), F.lit('", x')))
    odd = F.substring_index("transaction_id", "-", -1).cast("int") % 2 == 1
    dialect = {"header": "true", "quote": '"', "escape": '"'}
    raw.filter(odd).write.options(**dialect).csv(f"{root}/a")
    raw.filter(~odd).select("product_id", "timestamp", "user_id", "rating", F.lit("web").alias("channel"), "transaction_id", "amount") \
       .write.options(**dialect).csv(f"{root}/b")
    df = lake.read_transactions(spark, f"{root}/*")
    checks = quality.validate(df, quality.EXTENDED_CONTRACT).groupBy("column", "check").agg(F.count(F.lit(1)).alias("failures"))
    cells = df.agg(F.count("channel").alias("n"), F.countDistinct("product_id").alias("p"))
    return checks.unionByName(cells.select(F.lit("channel").alias("column"), F.lit("filled").alias("check"), F.col("n").alias("failures"))).unionByName(
        cells.select(F.lit("product_id").alias("column"), F.lit("distinct").alias("check"), F.col("p").alias("failures")))


@register("mixed_timestamps", O.q(f"SELECT transaction_id, timestamp, {O.ts_text(O.parsed_ts('timestamp'))} AS ts FROM combined"))
def q_mixed_timestamps(spark, sf_dir):
    """Every timestamp text of both layers, parsed."""
    return portable(cleaning.parse_ts(combined(spark, sf_dir), into="ts").select("transaction_id", "timestamp", "ts"))


# -- exploratory summaries --------------------------------------------------

@register("rating_distribution", O.RATING_DIST_SQL)
def q_rating_distribution(spark, sf_dir):
    from featurelake.operators import summaries
    return portable(summaries.rating_distribution(prepared(spark, sf_dir)))


@register("top_items", O.TOP_ITEMS_SQL)
def q_top_items(spark, sf_dir):
    from featurelake.operators import summaries
    return summaries.top_items(prepared(spark, sf_dir), 10)


# -- feature store ----------------------------------------------------------

def _stamped(df):
    from featurelake.operators import store
    return store.stamp(df, as_of=AS_OF)


def _feature_tables(spark, sf_dir):
    p = materialize(prepared(spark, sf_dir))
    return (features.user_features(p, as_of=AS_OF), features.item_features(p, as_of=AS_OF),
            features.interaction_features(p, as_of=AS_OF))


@register("feature_store_users", O.q(
    f"SELECT {O.portable_select(O.USER_FEATURE_COLS)}, {O.STAMP_SQL} AS updated_at, "
    f"'v1.0_combined' AS version FROM user_feat", O.USER_FEATURES_CTE))
def q_feature_store_users(spark, sf_dir):
    """Write a new store version of all three tables, read users back."""
    from featurelake.operators import store
    from featurelake.session import fresh_dir
    root = fresh_dir(spark, "store")
    u, i, x = _feature_tables(spark, sf_dir)
    store.update_feature_store(root, u, i, x, as_of=AS_OF)
    return portable(store.read_table(spark, root, "user_features"))


@register("fetch_features_batch", O.q(
    f"SELECT {O.portable_select(O.USER_FEATURE_COLS)} FROM "
    "(SELECT k.user_id, uf.* EXCLUDE (user_id) FROM "
    "(SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id FROM customer) k "
    "LEFT JOIN user_feat uf ON k.user_id = uf.user_id) j", O.USER_FEATURES_CTE))
def q_fetch_features_batch(spark, sf_dir):
    """F4 (batch form): features of every customer, null for unseen ones."""
    from pyspark.sql import functions as F
    from featurelake.operators import store
    keys = fixtures.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_id"))
    users = features.user_features(prepared(spark, sf_dir), as_of=AS_OF)
    return portable(store.fetch_many(users, keys, "user"))


@register("point_lookup", O.q(
    f"SELECT {O.portable_select(O.USER_FEATURE_COLS)} FROM user_feat WHERE user_id = (SELECT min(user_id) FROM user_feat)", O.USER_FEATURES_CTE))
def q_point_lookup(spark, sf_dir):
    """F4 (point form): one user's row from the key-sorted store."""
    from pyspark.sql import functions as F
    from featurelake.operators import store
    from featurelake.session import fresh_dir
    root = fresh_dir(spark, "store")
    p = materialize(prepared(spark, sf_dir))
    store.update_feature_store(root, features.user_features(p, as_of=AS_OF), features.item_features(p, as_of=AS_OF), as_of=AS_OF)
    key = store.read_table(spark, root, "user_features").agg(F.min("user_id")).first()[0]
    return portable(store.fetch_features(spark, root, key, "user").drop("updated_at", "version"))


def _cols_text(cols):
    return ",".join([c for c, _ in cols] + ["updated_at", "version"])


@register("store_summary", O.q(
    f"SELECT 'user_features' AS \"table\", count(*) AS rows, '{_cols_text(O.USER_FEATURE_COLS)}' AS columns FROM user_feat "
    f"UNION ALL SELECT 'item_features', count(*), '{_cols_text(O.ITEM_FEATURE_COLS)}' FROM item_feat "
    f"UNION ALL SELECT 'interaction_features', count(*), '{_cols_text(O.INTERACTION_FEATURE_COLS)}' FROM inter_feat",
    O.USER_FEATURES_CTE, O.ITEM_FEATURES_CTE, O.INTERACTION_FEATURES_CTE))
def q_store_summary(spark, sf_dir):
    """rows and columns of each stamped table."""
    from pyspark.sql import functions as F
    from featurelake.operators import store
    u, i, x = _feature_tables(spark, sf_dir)
    parts = [store.store_summary(_stamped(df), name)
             for name, df in (("user_features", u), ("item_features", i), ("interaction_features", x))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("table", "rows", F.array_join("columns", ",").alias("columns"))


@register("sample_user_features", O.q(
    f"SELECT {O.portable_select([('user_id', 's'), ('user_total_interactions', 'i'), ('user_avg_rating', 'd'), ('user_engagement_score', 'd')])} "
    "FROM user_feat ORDER BY user_id LIMIT 5", O.USER_FEATURES_CTE))
def q_sample_user_features(spark, sf_dir):
    """first five users' headline features."""
    from featurelake.operators import store
    u = features.user_features(prepared(spark, sf_dir), as_of=AS_OF)
    return portable(store.sample_features(
        u, ["user_id", "user_total_interactions", "user_avg_rating", "user_engagement_score"], 5, "user_id"))


@register("user_statistics", O.q(
    f"SELECT {O.round6('avg(user_engagement_score)')} AS avg_engagement_score, "
    "(SELECT user_id FROM user_feat ORDER BY user_total_interactions DESC, user_id LIMIT 1) AS most_active_user, "
    "max(user_total_interactions) AS most_active_count, "
    f"{O.round6('avg(user_avg_rating)')} AS avg_user_rating FROM user_feat", O.USER_FEATURES_CTE))
def q_user_statistics(spark, sf_dir):
    from featurelake.operators import store
    return portable(store.user_statistics(features.user_features(prepared(spark, sf_dir), as_of=AS_OF)))


@register("item_statistics", O.q(
    f"SELECT {O.round6('avg(item_quality_score)')} AS avg_quality_score, "
    "(SELECT product_id FROM item_feat ORDER BY item_popularity_score DESC, product_id LIMIT 1) AS most_popular_item, "
    "max(item_popularity_score) AS most_popular_count, "
    f"{O.round6('avg(item_avg_rating)')} AS avg_item_rating FROM item_feat", O.ITEM_FEATURES_CTE))
def q_item_statistics(spark, sf_dir):
    from featurelake.operators import store
    return portable(store.item_statistics(features.item_features(prepared(spark, sf_dir), as_of=AS_OF)))


@register("interaction_statistics", O.q(
    "SELECT count(*) AS unique_pairs, "
    f"{O.round6('avg(interaction_count)')} AS avg_interactions_per_pair, "
    "(SELECT user_id FROM inter_feat ORDER BY interaction_count DESC, user_id, product_id LIMIT 1) AS top_pair_user, "
    "(SELECT product_id FROM inter_feat ORDER BY interaction_count DESC, user_id, product_id LIMIT 1) AS top_pair_product, "
    "max(interaction_count) AS top_pair_count FROM inter_feat", O.INTERACTION_FEATURES_CTE))
def q_interaction_statistics(spark, sf_dir):
    from featurelake.operators import store
    return portable(store.interaction_statistics(
        features.interaction_features(prepared(spark, sf_dir), as_of=AS_OF)))


@register("version_check", O.q(
    f"SELECT 'v1.0_combined' AS versions, max({O.STAMP_SQL}) AS last_updated FROM user_feat", O.USER_FEATURES_CTE))
def q_version_check(spark, sf_dir):
    from featurelake.operators import store
    return store.version_check(_stamped(features.user_features(prepared(spark, sf_dir), as_of=AS_OF)))


# -- lineage ----------------------------------------------------------------

@register("lineage_fingerprint", O.LINEAGE_SQL)
def q_lineage_fingerprint(spark, sf_dir):
    """L1: order-free content fingerprint of the combined raw table."""
    from featurelake.operators import lineage
    return lineage.fingerprint(combined(spark, sf_dir))


@register("lineage_record", O.LINEAGE_RECORD_SQL)
def q_lineage_record(spark, sf_dir):
    """L2 + L3: a step's record, read back from the lineage table."""
    from pyspark.sql import functions as F
    from featurelake.operators import lineage
    from featurelake.session import fresh_dir
    root = fresh_dir(spark, "lineage")
    raw, both = fixtures.interactions_raw(spark, sf_dir), combined(spark, sf_dir)
    lineage.track_lineage(spark, root, "merge", raw, both, lineage.lineage_params(both))
    return lineage.read_lineage(spark, root).select(
        "step", "input_hash", "output_hash", F.col("parameters")["data_source"].alias("data_source"),
        F.col("parameters")["includes_streaming"].alias("includes_streaming"))


# -- recommender -------------------------------------------------------------------

BRANDS = [f"Brand#{i}{j}" for i in range(1, 6) for j in range(1, 6)]


def interaction_cells(spark, sf_dir):
    """R1 over the uncleaned combined interactions."""
    from featurelake.operators import recommend
    return materialize(recommend.rating_cells(combined(spark, sf_dir)))


def brand_cells(spark, sf_dir):
    """R1 over both layers with the part's brand as item: few items, for the
    wide matrix.  Products without a part have no brand."""
    from featurelake.operators import recommend
    return materialize(recommend.rating_cells(fixtures.by_brand(spark, sf_dir, combined(spark, sf_dir))))


def item_mean_model(cells):
    """A rank-2 model that SQL can follow: an item's mean observed rating, and
    a term that favours or disfavours often rated items by the user's number
    modulo 3.  Rankings differ between users; scoring, top-K and evaluation
    take the code paths of the SVD model."""
    from pyspark.sql import functions as F
    from featurelake.functions import round_half_up
    from featurelake.operators import recommend
    obs = recommend.observed_cells(cells)
    means = obs.groupBy("product_id").agg(round_half_up(F.avg("rating")).alias("m"), (F.count(F.lit(1)) / 64.0).alias("p"))
    items = materialize(recommend.item_index(cells).join(means, "product_id").select("product_id", "item_idx", F.array("m", "p").alias("v")))
    taste = (F.substring("user_id", 2, 18).cast("long") % 3 - 1).cast("double")
    users = materialize(cells.select("user_id").distinct().select("user_id", F.array(F.lit(1.0), taste).alias("u")))
    return recommend.SVDModel(items, users, [1.0, 1.0], users.count(), items.count())


def baseline_pairs(spark, sf_dir):
    from featurelake.operators import recommend
    cells = interaction_cells(spark, sf_dir)
    return materialize(recommend.scored_cells(cells, item_mean_model(cells)))


@register("rating_cells", O.CELLS_SQL)
def q_rating_cells(spark, sf_dir):
    from featurelake.operators import recommend
    return portable(recommend.rating_cells(combined(spark, sf_dir)))


@register("observed_cells", O.OBSERVED_SQL)
def q_observed_cells(spark, sf_dir):
    from featurelake.operators import recommend
    return portable(recommend.observed_cells(recommend.rating_cells(combined(spark, sf_dir))))


@register("user_item_matrix", O.MATRIX_SQL)
def q_user_item_matrix(spark, sf_dir):
    from featurelake.operators import recommend
    return portable(recommend.user_item_matrix(brand_cells(spark, sf_dir), BRANDS))


@register("user_vectors", O.USER_VECTORS_SQL)
def q_user_vectors(spark, sf_dir):
    """R2 for the whole catalog: sparse user vectors over all products and
    both layers, taken apart again into (user, position, rating)."""
    from featurelake.operators import matrix, recommend
    cells = interaction_cells(spark, sf_dir)
    vectors = materialize(matrix.sparse_rows(cells, recommend.item_index(cells), 1024))
    return portable(matrix.cells_of(vectors, "user_id"))


@register("item_vectors", O.ITEM_VECTORS_SQL)
def q_item_vectors(spark, sf_dir):
    """R2 transposed: per product and segment of users the length of the
    vector, its first and last position, and the ratings' sum."""
    from pyspark.sql import functions as F
    from featurelake.operators import matrix
    cells = interaction_cells(spark, sf_dir)
    vectors = matrix.sparse_columns(cells, matrix.positions(cells, "user_id", "user_idx"), 1024)
    return portable(vectors.select(
        "product_id", "segment", F.size("indices").cast("long").alias("n"), F.element_at("indices", 1).alias("first"),
        F.element_at("indices", -1).alias("last"), F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("total")))


@register("train_test_split", O.SPLIT_SQL)
def q_train_test_split(spark, sf_dir):
    """Sizes of the reproducible 80/20 split of the combined interactions."""
    from pyspark.sql import functions as F
    from featurelake.operators import recommend
    train, test = recommend.split(combined(spark, sf_dir), 0.2, 42)
    return train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        "train_rows", test.select(F.count(F.lit(1))).scalar().alias("test_rows"))


def _svd(spark, sf_dir):
    """12 components over the combined interactions, real products."""
    from featurelake.operators import recommend
    cells = interaction_cells(spark, sf_dir)
    return cells, recommend.fit_svd(cells, 12)


@register("svd_full_rank", O.SVD_FULL_RANK_SQL)
def q_svd_full_rank(spark, sf_dir):
    """R4-R10 where SQL knows the answer: with as many components as brands
    the singular values carry all of the squared ratings, the error is zero
    and the explained shares add up to one."""
    from pyspark.sql import functions as F
    from featurelake.operators import evaluate, recommend
    cells = brand_cells(spark, sf_dir)
    model = recommend.fit_svd(cells, len(BRANDS))
    err = evaluate.error_metrics(recommend.scored_cells(cells, model))
    share = recommend.explained_variance(cells, model).agg(F.sum("explained_variance_ratio")).scalar()
    return portable(err.select(
        F.lit(float(sum(x * x for x in model.singular_values))).alias("squared_singular_values"), "rmse", "mae",
        share.alias("explained_variance")), 5)


@register("svd_residuals", O.SVD_RESIDUALS_SQL)
def q_svd_residuals(spark, sf_dir):
    """R4 with the production settings on the combined interactions: per
    component the residual of A'A v = s^2 v relative to s^2, worked out anew
    by joins, and the length of v."""
    from pyspark.sql import functions as F
    from featurelake.operators import recommend
    cells, model = _svd(spark, sf_dir)
    parts = range(model.k)
    again = recommend.project_users(cells, model.item_factors, model.k).withColumnRenamed("u", "y")
    back = cells.join(again, "user_id").groupBy("product_id").agg(*[F.sum(F.col("rating") * F.col("y")[c]).alias(f"w{c}") for c in parts])
    s2 = [x * x for x in model.singular_values]
    both = model.item_factors.join(back, "product_id")
    sums = both.agg(*[F.sum(F.pow(F.col(f"w{c}") - F.lit(s2[c]) * F.col("v")[c], 2)).alias(f"r{c}") for c in parts],
                    *[F.sum(F.pow(F.col("v")[c], 2)).alias(f"n{c}") for c in parts])
    rows = F.explode(F.array(*[F.struct(F.lit(c).cast("long").alias("component"), (F.sqrt(f"r{c}") / F.lit(s2[c])).alias("residual"),
                                        F.col(f"n{c}").alias("norm")) for c in parts])).alias("row")
    return portable(sums.select(rows).select("row.*"), 6)


@register("svd_metrics")
def q_svd_metrics(spark, sf_dir):
    """12-component fit, in-sample RMSE / MAE, explained variance,
    precision and recall at 5 (no SQL form: the fit is iterative)."""
    from pyspark.sql import functions as F
    from featurelake.operators import evaluate, recommend
    cells, model = _svd(spark, sf_dir)
    err = evaluate.error_metrics(recommend.scored_cells(cells, model))
    ev = recommend.explained_variance(cells, model).agg(F.sum("explained_variance_ratio")).scalar()
    pr = recommend.precision_recall_at_k(cells, recommend.recommend(model, 5), 5, 3.5)
    return err.select(F.lit(model.k).cast("long").alias("n_components"), "rmse", "mae",
                      ev.alias("explained_variance"),
                      pr.select("precision_at_5").scalar().alias("precision_at_5"),
                      pr.select("recall_at_5").scalar().alias("recall_at_5"))


@register("svd_explained_variance")
def q_svd_explained_variance(spark, sf_dir):
    from featurelake.operators import recommend
    cells, model = _svd(spark, sf_dir)
    return recommend.explained_variance(cells, model)


@register("svd_top_k")
def q_svd_top_k(spark, sf_dir):
    """Top-5 products per user from the SVD reconstruction."""
    from featurelake.operators import recommend
    _, model = _svd(spark, sf_dir)
    return recommend.recommend(model, 5)


@register("baseline_error_metrics", O.BASE_ERROR_SQL)
def q_baseline_error(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.error_metrics(baseline_pairs(spark, sf_dir)))


@register("baseline_top_k", O.BASE_TOPK_SQL)
def q_baseline_top_k(spark, sf_dir):
    from featurelake.operators import recommend
    cells = interaction_cells(spark, sf_dir)
    return portable(recommend.recommend(item_mean_model(cells), 5))


@register("baseline_precision_recall", O.BASE_PR_SQL)
def q_baseline_pr(spark, sf_dir):
    from featurelake.operators import recommend
    cells = interaction_cells(spark, sf_dir)
    topk = recommend.recommend(item_mean_model(cells), 5)
    return portable(recommend.precision_recall_at_k(cells, topk, 5, 3.5))


@register("baseline_mae_by_rating", O.BASE_MAE_BY_RATING_SQL)
def q_baseline_mae_by_rating(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.mae_by_rating(baseline_pairs(spark, sf_dir)))


@register("baseline_residual_histogram", O.BASE_RESID_SQL)
def q_baseline_residual_histogram(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.residual_histogram(baseline_pairs(spark, sf_dir), 25))


@register("baseline_shared_histogram", O.BASE_SHARED_SQL)
def q_baseline_shared_histogram(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.shared_histogram(baseline_pairs(spark, sf_dir), 15))


@register("baseline_hexbin", O.BASE_HEXBIN_SQL)
def q_baseline_hexbin(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.hexbin_density(baseline_pairs(spark, sf_dir), 15))


@register("baseline_kde", O.BASE_KDE_SQL)
def q_baseline_kde(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.kde(baseline_pairs(spark, sf_dir)))


@register("matrix_sample", O.MATRIX_SAMPLE_SQL)
def q_matrix_sample(spark, sf_dir):
    from featurelake.operators import evaluate
    return portable(evaluate.matrix_sample(interaction_cells(spark, sf_dir), 15))


@register("baseline_explained_variance", O.BASE_EXPLAINED_SQL)
def q_baseline_explained_variance(spark, sf_dir):
    """R10 over a fixed model: ratio and running sum per component."""
    from featurelake.operators import recommend
    cells = interaction_cells(spark, sf_dir)
    return portable(recommend.explained_variance(cells, item_mean_model(cells)))


@register("saved_model", O.SAVED_MODEL_SQL)
def q_saved_model(spark, sf_dir):
    """A model saved twice under one path and loaded again."""
    from pyspark.sql import functions as F
    from featurelake.operators import recommend
    from featurelake.session import fresh_dir
    path = fresh_dir(spark, "model")
    recommend.save_model(item_mean_model(interaction_cells(spark, sf_dir)), path)
    recommend.save_model(recommend.load_model(spark, path), path)
    model = recommend.load_model(spark, path)
    return portable(model.item_factors.select("product_id", "item_idx", F.col("v")[0].alias("m"), F.col("v")[1].alias("p"),
                                              F.lit(model.n_users).cast("long").alias("n_users"), F.lit(model.n_items).cast("long").alias("n_items")))


@register("run_log", O.RUN_LOG_SQL)
def q_run_log(spark, sf_dir):
    """Two runs logged under one path and read back."""
    from pyspark.sql import functions as F
    from featurelake.operators import evaluate
    from featurelake.session import fresh_dir
    path = fresh_dir(spark, "runs")
    err = evaluate.error_metrics(baseline_pairs(spark, sf_dir)).first()
    for k in (5, 10):
        evaluate.log_run(spark, path, {"k": k, "model": "item mean"}, {"RMSE": err["rmse"], "MAE": err["mae"]}, run_id=f"run-{k}")
    return portable(spark.read.parquet(path).select("run_id", "tag", F.col("params")["k"].alias("k"), F.col("params")["model"].alias("model"),
                                                    F.col("metrics")["RMSE"].alias("rmse"), F.col("metrics")["MAE"].alias("mae")))


# -- whole job ---------------------------------------------------------------------

@register("svd_evaluation")
def q_svd_evaluation(spark, sf_dir):
    """R15-R19 on the SVD predictions, as one long table."""
    from pyspark.sql import functions as F
    from featurelake.operators import evaluate, recommend
    cells, model = _svd(spark, sf_dir)
    pairs = materialize(recommend.scored_cells(cells, model))

    def rows(name, df, key, value):
        return df.select(F.lit(name).alias("summary"), F.concat_ws(":", *[F.col(k).cast("string") for k in key]).alias("key"),
                         F.col(value).cast("double").alias("value"))

    out = rows("mae_by_rating", evaluate.mae_by_rating(pairs), ["rating"], "mae")
    for part in (rows("residual_histogram", evaluate.residual_histogram(pairs, 25), ["bin"], "count"),
                 rows("shared_histogram", evaluate.shared_histogram(pairs, 15), ["series", "bin"], "count"),
                 rows("hexbin", evaluate.hexbin_density(pairs, 15), ["lattice", "ix", "iy"], "count"),
                 rows("kde", evaluate.kde(pairs), ["series", "point"], "density")):
        out = out.unionByName(part)
    return out


@register("lambda_job", O.LAMBDA_JOB_SQL)
def q_lambda_job(spark, sf_dir):
    """O1-O2: land the batch feed (CSV), the click lines and the product
    catalog (from the driver tables), run every stage, return the stage log."""
    from pyspark.sql import functions as F
    from featurelake.plans.lambda_job import JobConfig, run_lambda_job
    from featurelake.session import fresh_dir
    root = fresh_dir(spark, "job")
    fixtures.interactions_raw(spark, sf_dir).write.option("header", True).csv(f"{root}/landing/transactions")
    fixtures.event_lines(spark, sf_dir).write.text(f"{root}/landing/events")
    fixtures.table(spark, sf_dir, "part").write.json(f"{root}/landing/products")
    conf = JobConfig(lake=f"{root}/lake", transactions_path=f"{root}/landing/transactions",
                     events_folder=f"{root}/landing/events", products_path=f"{root}/landing/products",
                     products_multi_line=False, as_of=AS_OF)
    log = run_lambda_job(spark, conf)
    return log.filter(F.col("status") == "complete").select("stage", "status", "rows_out")
