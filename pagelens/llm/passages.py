"""Removing repeated passages: units of text are hashed, and only the first occurrence of each is kept."""

from pyspark.sql import functions as F

from pagelens.llm.encoding import struct_of, with_types

# A unit ends with a run of sentence ends or line ends, or with the text; so units cover the whole text.
UNIT = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
BLANKS = r"[\x20\x09-\x0D]+"


def keyed(docs, id_column, text_column, carried=()):
    """doc_id, text_hash and text: the first two tell rows apart, and rank them."""
    text = docs[text_column].cast("string")
    return docs.select(docs[id_column].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"), *struct_of(docs, carried))


def units(rows, min_words):
    """Units with at least ``min_words`` words: doc_id, text_hash, start, stop (code points), digest.

    A unit is normalised to its words in lower case with single blanks; the digest has 128 bits.
    """
    def run(batches):
        import hashlib
        import re
        import pyarrow as pa
        unit, blanks = re.compile(UNIT).finditer, re.compile(BLANKS).sub
        types = ["int64", "int64", "int32", "int32", "binary"]
        names = ["doc_id", "text_hash", "start", "stop", "digest"]
        for batch in batches:
            columns = [[], [], [], [], []]
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for found in unit(text.as_py() or ""):
                    words = blanks(" ", found.group().lower()).strip(" ")
                    if words.count(" ") + 1 >= min_words:
                        row = (doc, key, found.start(), found.end(), hashlib.blake2b(words.encode(), digest_size=16).digest())
                        for column, value in zip(columns, row):
                            column.append(value)
                if len(columns[0]) >= 20000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                    columns = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return rows.mapInArrow(run, "doc_id long, text_hash long, start int, stop int, digest binary")


def repeated_spans(docs, min_words=5, id_column="doc_id", text_column="text"):
    """Every unit that is not the first of its kind: doc_id, text_hash, start, stop.

    Occurrences rank by document id (NULL first), then text hash, then place. Counts and first
    occurrences are combined in each task before they are shuffled, so a very common unit costs one row
    per task there; the units of such groups stay rows.
    """
    found = units(keyed(docs, id_column, text_column), min_words)
    place = F.struct("doc_id", "text_hash", "start")
    repeats = found.groupBy("digest").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    return found.join(repeats.select("digest", "_first"), "digest").filter(~place.eqNullSafe(F.col("_first"))).select(
        "doc_id", "text_hash", "start", "stop")


def drop_repeats(docs, min_words=5, id_column="doc_id", text_column="text", carried=()):
    """Documents without repeated units, and where the rest came from.

    Columns: doc_id, text (what is left), n_removed (units), removed and kept (arrays of start and stop in
    code points of the original text, neighbours merged). A document of which nothing is left keeps its
    row with an empty text. NULL texts stay NULL and empty ones empty. Rows that agree in id and text
    have equal places and keep equal texts. An empty table gives an empty result. Columns that are
    ``carried`` come along in a struct of that name.
    """
    names = ["carried"] if carried else []

    def cut(batches):
        import pyarrow as pa
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts, counts, removed, kept = [], [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    gone, left, end = [], [], 0
                    for s in sorted(spans or (), key=lambda s: s["start"]):
                        if gone and gone[-1]["stop"] == s["start"]:
                            gone[-1]["stop"] = s["stop"]
                        else:
                            gone.append(dict(s))
                    for s in [*gone, {"start": len(text or ""), "stop": 0}]:
                        if s["start"] > end:
                            left.append({"start": end, "stop": s["start"]})
                        end = s["stop"]
                    texts.append(text if text is None else "".join(text[s["start"]:s["stop"]] for s in left))
                    counts.append(len(spans or ()))
                    removed.append(gone)
                    kept.append(left)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, "string"), pa.array(counts, "int64"),
                                                  pa.array(removed, span), pa.array(kept, span), *part.columns[3:]],
                                                 ["doc_id", "text", "n_removed", "removed", "kept", *names])

    rows = keyed(docs, id_column, text_column, carried)
    spans = repeated_spans(docs, min_words, id_column, text_column)
    # One list per document, no longer than its text; equal rows give equal spans, which count once.
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    both = rows.join(spans, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["text_hash"] == F.col("_hash")), "left")
    span = "array<struct<start:int,stop:int>>"
    return both.select("doc_id", "text", "spans", *names).mapInArrow(
        cut, with_types(rows, f"doc_id long, text string, n_removed long, removed {span}, kept {span}", *names))
