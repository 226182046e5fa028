"""Daily market data analytics written as Spark DataFrame operators."""
