"""spanlake: month-interval analytics on Spark DataFrames.

Snapshots and contribution periods are ingested from CSV, reduced to the latest snapshot per
person, scoped, cleaned, split into valid rows and rejects, and reported month by month.
"""
