"""URL and title features, splits and samples."""

from pyspark.sql import DataFrame, functions as F

from pagelens.functions import text as tx, url as u


def with_url_features(df: DataFrame, url: str = "url") -> DataFrame:
    c = F.col(url)
    return df.withColumns({
        "url_length": F.char_length(c), "domain": u.domain(c), "path_depth": u.path_depth(c),
        "query_count": u.query_count(c), "url_digit_count": tx.digit_count(c),
        "url_special_count": tx.punctuation_count(c)})


def with_title_features(df: DataFrame, title: str = "title") -> DataFrame:
    c = F.col(title)
    return df.withColumns({
        "title_length": F.char_length(c), "title_word_count": tx.word_count(c),
        "title_avg_word_len": tx.average_word_length(c),
        "title_punctuation_count": tx.punctuation_count(c), "title_digit_count": tx.digit_count(c)})


def with_features(df: DataFrame) -> DataFrame:
    return with_title_features(with_url_features(df))


def with_split(df: DataFrame, key: str = "url", validation_share: float = 0.1, seed: int = 1) -> DataFrame:
    """Add ``split``: 'validation' for a share of the keys, else 'train'; the same key always falls on
    the same side, whatever the partitioning."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10)
    limit = int(validation_share * 2**32)
    return df.withColumn("split", F.when(bucket.cast("bigint") < limit, "validation").otherwise("train"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))
