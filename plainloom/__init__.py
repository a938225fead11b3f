"""Composable DataFrame-to-DataFrame analytics on Spark."""
