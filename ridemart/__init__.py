"""ridemart: incremental, deduplicated, geo-binned trip marts on Spark."""
