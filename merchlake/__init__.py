"""Online-shop analytics on Spark: staging, star schema, marts and analyses."""
