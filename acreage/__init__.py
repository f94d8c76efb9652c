"""Sales, investor and comparables analytics as lazy Spark DataFrame operators."""
