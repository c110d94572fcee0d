"""Daily market-data tables on Spark: changes, last levels, rebuilt prices, keyed upkeep."""
