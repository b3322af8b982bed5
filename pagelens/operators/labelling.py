"""Label prompts, labellers, validation and cleaning of labels."""

import random
import time

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagelens.functions import text as tx
from pagelens.functions.stages import let
from pagelens.labels import LABELS, MAX_LABELS_PER_PAGE, UNCATEGORIZED
from pagelens.operators import ranking

# Fixed value: rows of a labelling batch.
BATCH_ROWS = 500

PROMPT = (
    "Choose one to three topics for this web page, best first, from: {labels}.\n"
    "Use Uncategorized only if no other topic fits. Answer with the topic names joined by commas.\n"
    "URL: {url}\nTitle: {title}\nSnippet: {snippet}\nLanguage: {language}\nDescription: {meta_description}\n"
)


def prompt(template: str = PROMPT, labels=LABELS) -> Column:
    """Fill a template with page columns; ``{labels}`` is the label list, NULL is filled in as ''."""
    pieces, rest = [], template.replace("{labels}", ", ".join(labels))
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), F.coalesce(F.col(name), F.lit(""))]
    return F.concat(*pieces, F.lit(rest))


def split_labels(category: Column) -> Column:
    """'A, B,C' -> ['A', 'B', 'C']."""
    return F.transform(F.split(category, ","), tx.strip)


def is_valid(category: Column, labels=LABELS) -> Column:
    """One to three known labels, comma-separated; repeats are allowed, case counts."""
    found = split_labels(category)
    return F.coalesce((F.size(found) <= MAX_LABELS_PER_PAGE) & F.forall(found, lambda x: x.isin(list(labels))),
                      F.lit(False))


def clean_label_list(found: Column) -> Column:
    """Drop 'Uncategorized' next to any other label."""
    others = F.array_remove(found, UNCATEGORIZED)
    return (F.when(~F.array_contains(found, UNCATEGORIZED), found)
            .when(F.size(others) > 0, others).otherwise(F.array(F.lit(UNCATEGORIZED))))


def clean_labels(category: Column) -> Column:
    return clean_label_list(split_labels(category))


def parse_bracketed(category: Column) -> Column:
    """'[A, B]' -> ['A', 'B']; NULL -> []."""
    return F.coalesce(split_labels(F.btrim(category, F.lit("[]"))), F.array().cast("array<string>"))


def multi_hot(found: Column, labels=LABELS) -> Column:
    """Array of 1.0 / 0.0, one per label in index order."""
    return F.array(*[F.when(F.array_contains(found, name), 1.0).otherwise(0.0) for name in labels])


def pending(pages: DataFrame, done: DataFrame, key: str, target: int | None = None, batch: int = BATCH_ROWS,
            order: str | None = None) -> DataFrame:
    """Rows still to label: their key is not in ``done``; in the order of a numeric column (by default the
    key), numbered in batches from 0, and only until the target is reached, if there is one.

    The key is unique; rows that tie in the order follow by key.
    """
    todo = ranking.with_row_numbers(pages.join(done.select(key), key, "left_anti"), order or key, ties=[key])
    if target is not None:
        todo = todo.filter(F.col("row_no") <= F.lit(target) - done.agg(F.count("*").alias("n")).scalar())
    return todo.withColumn("batch_no", F.floor((F.col("row_no") - 1) / batch).cast("int")).drop("row_no")


def is_valid_answer(answer, labels=LABELS) -> bool:
    """The rule of ``is_valid`` for one answer of a labeller."""
    found = [x.strip() for x in answer.split(",")] if isinstance(answer, str) else [None]
    return len(found) <= MAX_LABELS_PER_PAGE and set(found) <= set(labels)


def with_retries(label_batch, attempts: int = 5, wait: float = 4.0, longest: float = 60.0, sleep=time.sleep,
                 valid=is_valid_answer):
    """Wrap a labeller call: a failing batch is tried again with growing pauses, and so are the rows whose
    answers are not valid. If the batch still fails, each of its rows is asked for alone once more, so a
    row that always fails stays the only one without an answer."""
    def call(frame):
        answers, left, pause, failed = [None] * len(frame), list(range(len(frame))), wait, False
        for attempt in range(1, attempts + 1):
            try:
                found, failed = label_batch(frame.iloc[left]), False
            except Exception:
                failed = True
            else:
                for i, answer in zip(left, found):
                    answers[i] = answer
                left = [i for i in left if not valid(answers[i])]
            if not left or attempt == attempts:
                break
            sleep(pause * (1 + 0.1 * random.random()))
            pause = min(2 * pause, longest)
        for i in left if failed else []:
            try:
                answers[i] = list(label_batch(frame.iloc[[i]]))[0]
            except Exception:
                pass
        return answers
    return call


def label_pages(pages: DataFrame, label_batch, parallelism: int | None = None, **retry) -> DataFrame:
    """Add ``category`` by calling ``label_batch(pandas frame) -> list of texts`` in every task.

    A row that keeps failing gets NULL; ``parallelism`` sets how many tasks call the
    labeller at the same time.
    """
    if parallelism:
        pages = pages.repartition(parallelism)
    schema = T.StructType(pages.schema.fields + [T.StructField("category", T.StringType())])
    call = with_retries(label_batch, **retry)

    def run(frames):
        for frame in frames:
            yield frame.assign(category=call(frame))

    return pages.mapInPandas(run, schema)


def successful(labelled: DataFrame) -> DataFrame:
    """Rows whose label text is valid."""
    return labelled.filter(is_valid(F.col("category")))


def keyword_labels(keywords: dict[str, str], columns=("url", "title")) -> Column:
    """The answer of ``keyword_labeller`` as a column, for labels that need no service."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    found = let(text, lambda t: F.array(*[F.when(F.contains(t, F.lit(word)), F.lit(label)) for word, label in keywords.items()]))
    first = F.slice(F.array_distinct(F.filter(found, lambda x: x.isNotNull())), 1, MAX_LABELS_PER_PAGE)
    return let(first, lambda x: F.when(F.size(x) > 0, F.array_join(x, ",")).otherwise(UNCATEGORIZED))


def keyword_labeller(keywords: dict[str, str], columns=("url", "title")):
    """A local labeller: the labels of the keywords found in the columns, in keyword order, at most three."""
    def label_batch(frame):
        texts = frame[list(columns)].fillna("").agg(" ".join, axis=1)
        answers = []
        for text in texts:
            found = list(dict.fromkeys(label for word, label in keywords.items() if word in text))
            answers.append(",".join(found[:MAX_LABELS_PER_PAGE]) or UNCATEGORIZED)
        return answers
    return label_batch
