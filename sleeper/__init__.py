"""sleeper: find well-reviewed, little-seen items in a large catalogue, on Spark.

Layout
------
functions/   Column -> Column helpers (ids from HTML, price parsing, labels, scores)
sources/     readers: landed payloads, Bronze JSONL, Silver Parquet, driver tables
sinks/       writers: JSONL landing, Parquet, run metadata, JDBC, score history
operators/   DataFrame -> DataFrame steps (data quality, dedup, scoring, candidates,
             funnel, insights, upsert, ordering)
plans/       composite jobs (extract, bronze->silver, silver->gold, publish) and the
             adapters that shape the driver tables into catalogue snapshots
streaming/   incremental Bronze->Silver->Gold with Structured Streaming
"""

from sleeper.config import Profile, ScoreParams  # noqa: F401

__all__ = ["Profile", "ScoreParams"]
