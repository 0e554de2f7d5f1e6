"""Whole jobs: the warehouse build, the declared checks and the query registry."""
