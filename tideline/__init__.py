"""Change-data processing on Spark: raw change rows in, ordered change events out."""
