"""Sales analytics on Spark: quality gate, star schema, KPIs, segments and forecasts."""
