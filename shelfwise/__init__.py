"""shelfwise: Spark-native lending analytics.

Reusable DataFrame operators (joins, aggregations, windows, set operations,
top-k), a catalogue of named lending reports, data-quality checks, set-based
change jobs and Structured Streaming jobs. Everything is expressed with the
DataFrame API so Catalyst and AQE pick the physical plan.
"""

from shelfwise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
