"""roadrisk: Spark-native analytics for point incidents on city road networks.

Layout:
  functions/  native Column expressions (projection, hex grid, distances,
              severity, Gi*/Mann-Kendall, colours)
  sources/    fixture adapters, JSON ingest, table store, JSON export sinks
  operators/  DataFrame -> DataFrame operators (clean, proximity, hot spots,
              density, heatmap, roads, corridors, rollups)
  plans/      the bronze -> silver -> gold chain and the query registry
  streaming/  incremental (file-stream) ingest into the bronze table
"""

__version__ = "0.1.0"
