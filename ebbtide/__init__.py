"""Customer-behaviour analytics on Spark: events, point-in-time features, labels, models, monitoring."""
