"""CSV in byte ranges: the rows do not depend on where a file is cut."""

import csv
import random

import pytest

from pagelens.sources import csvparts, tables

SCHEMA = "i int, t string, x double"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(6)
    pieces = ['"', '""', "\n", "\r\n", ",", " ", "a", "bc", "é", "中", '"\n"', '",\n"']
    return [(i, "".join(r.choices(pieces, k=r.randint(0, 30))), r.choice([0.5, None, -1e9])) for i in range(300)]


def ordered(found):
    return sorted(((r.i, r.t, r.x) for r in found), key=lambda r: r[0])


@pytest.mark.parametrize("chunk", [1, 7, 100, 5000, 1 << 20])
def test_rows_do_not_depend_on_the_ranges(spark, tmp_path, rows, chunk):
    some = rows if chunk >= 100 else rows[:12]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
        writer.writerow(["i", "t", "x"])
        for i, t, x in some:
            writer.writerow([i, t, "" if x is None else x])
    found = csvparts.read_csv_parts(spark, str(tmp_path / "a.csv"), SCHEMA, chunk_bytes=chunk).collect()
    assert [(i, t or "", x) for i, t, x in ordered(found)] == some


def test_what_spark_writes_is_read_back(spark, tmp_path, rows):
    plain = [(i, t.replace("\r", ""), x) for i, t, x in rows]  # Spark's writer makes one kind of line end of all.
    tables.write_csv(spark.createDataFrame(plain, SCHEMA).repartition(3), str(tmp_path / "t"))
    found = csvparts.read_csv_parts(spark, str(tmp_path / "t"), SCHEMA, chunk_bytes=300).collect()
    assert [(i, t or "", x) for i, t, x in ordered(found)] == plain


def test_bad_rows_blank_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('i,t,x\n1,"a",0.5\n\nz,b,1.0\n3,c\n4,,\n5,"",2,7\n6,"last",1e3')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("i,t,x\n")
    found = csvparts.read_csv_parts(spark, str(tmp_path), SCHEMA, chunk_bytes=10, bad_rows="bad").collect()
    good = sorted((r.i, r.t, r.x) for r in found if r.bad is None)
    assert good == [(1, "a", 0.5), (4, None, None), (6, "last", 1000.0)]
    assert sorted(r.bad for r in found if r.bad is not None) == ["3,c", "5,,2,7", "z,b,1.0"]
    assert [(r.t, r.x) for r in found if r.bad == "z,b,1.0"] == [("b", 1.0)]


def test_every_task_writes_a_file_of_its_own(spark, tmp_path, monkeypatch):
    """Not all documents through one task."""
    from checks import queries
    docs = [(i, None if i == 3 else f'a "{i}",\nb', "en") for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "shared_folder", lambda *_: str(tmp_path / "csv"))
    monkeypatch.setattr(queries.w, "table", lambda s, d, name, *columns: s.read.parquet(f"{d}/{name}.parquet").select(*columns).repartition(4))
    found = queries.s12_read_csv_in_parts(spark, str(tmp_path)).collect()
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 4
    assert sorted(r.doc_id for r in found) == list(range(40)) and all(r.good for r in found)
