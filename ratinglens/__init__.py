"""ratinglens — periodic player-rating history analytics on Spark.

A lambda-style library: a batch layer that joins a player dimension with a
monthly ratings fact and materialises keyed views, a Structured Streaming
speed layer that keeps the latest submitted rating and a submission counter
per player, and serving functions that merge both and return lookups and
chart-ready series — all as lazy DataFrames built from built-in operators.
"""

from ratinglens.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
