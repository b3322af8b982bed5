"""Table layouts shared by the operators."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


WARC_RECORD = T.StructType([
    T.StructField("warc_file", T.StringType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("warc_id", T.StringType()),
    T.StructField("warc_date", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])

# Records and damaged places of an archive.
WARC_STATUS = T.StructType(WARC_RECORD.fields + [T.StructField("status", T.StringType()), T.StructField("offset", T.LongType())])

EXTRACTED = _strings(
    "url", "title", "snippet", "language", "warc_id",
    "content_type", "server", "warc_date", "meta_description",
)

CLASSIFIED = T.StructType(EXTRACTED.fields + [T.StructField("category", T.StringType())])

# Columns a table must have before it can be labelled.
LABELLING_INPUT = ["url", "title", "snippet", "language", "meta_description"]

# Columns that may not be NULL in a cleaned table.
REQUIRED_TEXT = ["url", "title", "snippet", "language", "warc_id", "meta_description"]

# Columns dropped by the cleaning step.
TECHNICAL_COLUMNS = ["content_type", "server"]

VISIT = T.StructType([
    T.StructField("tab_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("status", T.StringType()),
])
