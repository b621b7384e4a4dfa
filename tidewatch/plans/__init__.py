"""End-to-end plans: the query catalog, feature store, models, monitoring."""
