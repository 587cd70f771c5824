"""Jobs that put operators and Spark ML together."""
