"""spendlens: attribute public spending to places with lazy Spark DataFrame plans.

Sub-packages
------------
functions   column expressions (fiscal years, R-style text, code lists, money)
operators   DataFrame -> DataFrame operators (joins, dedup, filters, spreading,
            spatial join, geocode cascade, quality checks, delivery tables)
sources     readers and writers for the registry, crosswalk, places, boundary
            GeoJSON, yearly transaction shards, snapshots and code lists
plans       the end-to-end pipeline, the synthetic views over the test tables
            and the registered query catalogue
streaming   Structured Streaming form of the incremental geocode-cache update
"""

__version__ = "0.1.0"
