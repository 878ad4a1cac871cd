"""Property-listing analytics on Spark: cleaning, features, firewall, models, monitoring."""
