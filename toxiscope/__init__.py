"""toxiscope: multi-label comment moderation as plain Spark DataFrame / Spark ML jobs.

Every public function takes and returns DataFrames (or fitted Spark ML models).
Nothing here creates a SparkSession or sets the master; the caller owns the session.
"""

from toxiscope.schema import COMMENT_SCHEMA, DRIVER_LABELS, LABELS

__all__ = ["COMMENT_SCHEMA", "DRIVER_LABELS", "LABELS"]
__version__ = "0.1.0"
