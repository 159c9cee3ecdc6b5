"""Change-data-capture landing on Spark: DataFrame in, change tables out."""
