"""Name-history analytics on Spark: page parsing, validity chains, checks, comparison and overlays."""
