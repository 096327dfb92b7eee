"""Two-stage detection with Spark ML."""
