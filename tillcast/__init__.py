"""tillcast: daily cash-demand forecasting for a fleet of cash machines, on Spark.

Layout
------
functions/  column expressions (coercion, calendar, holiday rules, post-processing)
sources/    readers, schema checks, sinks and the test-data views
operators/  DataFrame -> DataFrame steps (holiday dimension, joins, panel windows,
            dataset building, report shaping, distributed ordinals)
plans/      end-to-end plans (features, forecast) and the query catalog
streaming/  incremental ingest of transaction parts with Structured Streaming
"""

from tillcast.config import ForecastConfig, PRESETS, preset

__all__ = ["ForecastConfig", "PRESETS", "preset"]
