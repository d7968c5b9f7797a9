"""Market-data analytics on Spark: price bars in, indicators and answers out.

Every operator is a plain function from DataFrame to DataFrame, so it composes
with ``DataFrame.transform`` and leaves planning to Spark.
"""
