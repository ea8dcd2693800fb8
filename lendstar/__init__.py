"""lendstar: Spark-native lending-data pipelines.

Raw loan deliveries -> cleansed, deduplicated, typed tables -> change
detection and idempotent upserts with stable surrogate keys -> star schema and
portfolio marts; plus monthly auto-loan profit estimates.
"""

__version__ = "0.1.0"
