"""Spark jobs that turn large document collections into ranked, explainable digests."""
