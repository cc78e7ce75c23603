"""Retail analytics on Spark: composable DataFrame-to-DataFrame operators."""
