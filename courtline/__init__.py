"""courtline: batch analytics of sports game logs on Spark.

Reads landed Parquet extracts of player game logs, players and teams,
conforms them to a typed contract, splits them at the first game of the
current season, merges them by key into a year-partitioned fact table, and
builds the report tables of a dashboard. Everything is a DataFrame plan.
"""

__version__ = "0.1.0"
