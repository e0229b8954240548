"""freshhaul: Spark-native analytics for perishable-freight telemetry."""
