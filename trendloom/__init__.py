"""Trending-media analytics as composable Spark DataFrame operators."""
