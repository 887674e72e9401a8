"""``spark-submit`` entry points."""
