"""retailflow: a Spark-native retail medallion pipeline.

Bronze ingests raw customer, product, order and geography files (CSV,
parquet, JSON) incrementally; silver cleans and joins them into a
customer dimension, a product dimension and an order fact table; gold
computes the business tables. Every step is a plain DataFrame -> DataFrame
function on stock Apache Spark, so the same code runs in batch and in
Structured Streaming.
"""

__all__ = ["config", "schemas"]
