"""Component dictionary on Spark: parse, merge, convert, check and publish."""
