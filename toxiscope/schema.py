"""Column names and schemas shared by the whole package."""

from pyspark.sql import types as T

# The six label columns of the labelled-comment table, in the
# order the reference uses them.
LABELS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]

# The two real labels available in the driver tables (documents + labels).
DRIVER_LABELS = ["toxic", "low_quality"]

TEXT_COL = "clean_comment"

COMMENT_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType(), True), T.StructField(TEXT_COL, T.StringType(), True)]
    + [T.StructField(name, T.IntegerType(), True) for name in LABELS]
)

METRICS_SCHEMA = "label string, class int, metric string, value double"
