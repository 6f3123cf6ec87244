"""featurelake — a Spark-native recommendation-data engine.

Batch transactions and a click-event stream are merged into one interaction
table, checked against a data-quality contract, cleaned, turned into user /
item / user-item features (a versioned feature store with lineage), and used
to fit and evaluate a truncated-SVD recommender.  Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL expressions.
"""

from featurelake.session import build_session, scratch_root  # noqa: F401

__all__ = ["build_session", "scratch_root"]
