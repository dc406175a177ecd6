"""geoweather: weather-station and ZIP-code analytics as Spark DataFrame jobs.

Layout
------
functions/  column expressions (haversine, damage text, date parts, casts, file years)
sources/    readers with explicit schemas (observations, stations, gazetteer, storms, lake)
operators/  DataFrame -> DataFrame transforms (nearest stations, daily metrics, coverage,
            storm normalisation, replacement queries, preview)
plans/      actions: table replacement, partitioned export, audited job entry points
streaming/  file-triggered incremental storm ingest
"""

__version__ = "0.1.0"
