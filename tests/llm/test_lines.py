"""Line deduplication against plain Python on small tables with odd rows."""

import collections
import random

from pagelens.llm import lines

SCHEMA = "doc_id long, text string, place int, t1 long, h1 long, n long, line string, dropped string, id long"
UPPER = str.maketrans(lines.UPPER, lines.LOWER)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 7, 1, 2, 3, "x", "y", 5) for i, t in rows], SCHEMA).repartition(parts)


def expected(rows, min_documents=3, min_chars=20):
    def key(line):
        return line.strip(lines.BLANKS).translate(UPPER)

    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    keepers = {k: max(h, key=lambda i: (i is not None, i or 0)) for k, h in holders.items() if len(h) >= min_documents}
    out = collections.Counter()
    for doc, text in rows:
        parts = (text or "").split("\n")
        gone = [i for i, line in enumerate(parts) if key(line) in keepers and keepers[key(line)] != doc]
        kept = "\n".join(line for i, line in enumerate(parts) if i not in set(gone))
        out[doc, kept, len(parts), len(gone), tuple(gone)] += 1
    return out


def found(spark, rows, **parameters):
    result = lines.drop_common_lines(table(spark, rows), **parameters).collect()
    return collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, tuple(r.dropped)) for r in result)


COMMON = "This line of text is in very many documents"
ODD = [None, "", "\n", "\n\n\n", " " * 40, COMMON, f"  {COMMON.upper()}\t\r\n{COMMON}", f"\x0b{COMMON}\x0c\n", "ÀÉ ünï an ACCENTED Line, long enough",
       "Àé ünï an accented line, long enough", "àé ünï an accented line, long enough", "x" * 19, "x" * 20, "X" * 20 + " ", " " + "x" * 20,
       " wide blanks stay at the ends of keys ", "wide blanks stay at the ends of keys", "x" * 20 + "\n" + "y" * 100_000]


def test_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(3, COMMON), (3, COMMON), (3, f"{COMMON}\nmore"), (None, COMMON), (None, COMMON), (None, f"a\n{COMMON}"), (17, "x" * 20)]
    assert found(spark, rows) == expected(rows)


def test_random_lines(spark):
    r = random.Random(2)
    pool = ["".join(r.choices("aB cDé", k=r.randint(15, 30))) for _ in range(30)]
    rows = [(r.choice([None, *range(40)]), "\n".join(r.choices(pool, k=r.randint(0, 12)))) for _ in range(80)]
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows, min_documents=6, min_chars=25) == expected(rows, 6, 25)


def test_line_of_nearly_all_documents(spark):
    """More documents than COMMON have a line, so it goes the way of common lines; others go the other way."""
    rows = [(i, f"{COMMON}\nthis line is shared by three documents, group {i // 3}\nown {i}") for i in range(2 * lines.COMMON)]
    assert found(spark, rows) == expected(rows)


def test_only_two_documents_or_one_id(spark):
    rows = [(1, COMMON), (1, f"{COMMON}\n{COMMON}"), (2, COMMON), (5, "other")]
    assert found(spark, rows) == expected(rows)
    assert sum(r.n_dropped for r in lines.drop_common_lines(table(spark, rows)).collect()) == 0


def test_empty_table(spark):
    assert lines.drop_common_lines(table(spark, [(1, "a")]).limit(0)).collect() == []
