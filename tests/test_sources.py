import gzip

import pytest
from pyspark.sql import functions as F

from pagelens import schemas
from pagelens.operators import clean, ranking
from pagelens.sources import paths, tables, warc


def record(kind, url, block, length=None, **extra):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Target-URI: " + url, b"WARC-Record-ID: <urn:" + url + b">",
            b"WARC-Date: 2024-01-01T00:00:00Z", b"Content-Length: " + str(len(block) if length is None else length).encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.fixture
def warc_folder(tmp_path):
    body = b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n<p>WARC/1.0\r\nWARC-Type: response\r\n\xff</p>"
    records = [record(b"warcinfo", b"i", b"x: y"), record(b"request", b"http://a/", b"GET /"), record(b"response", b"http://a/", body),
               record(b"metadata", b"http://a/", b"m"), record(b"response", b"http://b/", b"second"), record(b"response", b"http://c/", b"")]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "two.warc").write_bytes(b"".join(records[:3]))
    broken = gzip.compress(records[2]) + gzip.compress(records[4])[:-20]
    (tmp_path / "three.warc.gz").write_bytes(broken)
    (tmp_path / "four.warc").write_bytes(record(b"response", b"http://d/", b"too short", length=500))
    return str(tmp_path), body


def test_read_warc(spark, warc_folder):
    folder, body = warc_folder
    got = warc.read_warc(spark, folder + "/one.warc.gz").orderBy("record_no").collect()
    assert [(r.record_no, r.url) for r in got] == [(1, "http://a/"), (2, "http://b/"), (3, "http://c/")]
    assert bytes(got[0].payload) == body and got[0].warc_id == "<urn:http://a/>"
    assert warc.read_warc(spark, folder).select("warc_file").distinct().count() == 4
    assert warc.read_warc(spark, folder + "/*.warc").count() == 2
    assert warc.read_warc(spark, folder + "/two.warc," + folder + "/one.warc.gz").count() == 4
    assert warc.read_warc(spark, folder + "/one.warc.gz", max_records_per_file=2).count() == 2


def test_broken_files_keep_what_is_readable(spark, warc_folder):
    folder, body = warc_folder
    assert [r.url for r in warc.read_warc(spark, folder + "/three.warc.gz").collect()][:1] == ["http://a/"]
    assert bytes(warc.read_warc(spark, folder + "/four.warc").first().payload).startswith(b"too short")


def test_read_listed_files(spark, warc_folder):
    folder, _ = warc_folder
    listed = spark.createDataFrame([(folder + "/one.warc.gz",), ("file://" + folder + "/two.warc",)], "path string")
    assert warc.read_warc_files(listed).count() == 4
    assert warc.read_warc_files(listed, 1).count() == 2
    assert warc.read_warc_files(listed).schema == schemas.WARC_RECORD


def test_path_lists(spark, tmp_path):
    (tmp_path / "p.txt").write_text(" b.warc \n\n   \na.warc\n")
    with gzip.open(tmp_path / "p.gz", "wt") as out:
        out.write("x/1\nx/2\nx/3\n")
    plain = paths.read_path_list(spark, str(tmp_path / "p.txt"))
    assert [r.path for r in plain.orderBy("line_no").collect()] == ["b.warc", "a.warc"]
    assert paths.first_paths(plain, 1).first().path == "b.warc"
    based = paths.read_path_list(spark, str(tmp_path / "p.gz"), "https://h/")
    assert [r.path for r in paths.first_paths(based, 2).collect()] == ["https://h/x/1", "https://h/x/2"]
    sample = {r.path for r in paths.sample_paths(based, 2, seed=5).collect()}
    assert len(sample) == 2 and sample == {r.path for r in paths.sample_paths(based.repartition(3), 2, seed=5).collect()}
    assert paths.sample_paths(based, 10).count() == 3
    assert {r.path for r in paths.not_processed(based, based.limit(1)).collect()} == {"https://h/x/2", "https://h/x/3"}


def test_parquet_and_csv(spark, tmp_path):
    a, b = spark.createDataFrame([(1, 'x, "y"\nz')], "i int, t string"), spark.createDataFrame([(2, None)], "i int, t string")
    out = str(tmp_path / "t")
    tables.write_parquet(a, out)
    tables.append_parquet(b, out)
    assert tables.read_parquet(spark, out).count() == 2
    tables.write_parquet(b, out)
    assert [r.i for r in tables.read_parquet(spark, out, ["i"]).collect()] == [2]
    tables.write_csv(a, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c"), "i int, t string").collect() == a.collect()


def test_required_columns(spark):
    df = spark.range(1)
    assert tables.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="title.*url"):
        tables.require_columns(df, ["url", "title", "id"])


def test_row_numbers_and_first_rows(spark):
    df = spark.range(0, 3000, 3).select((F.col("id") * 7919 % 10007).alias("k"), (F.col("id") % 3).alias("g")).repartition(5)
    got = sorted((r.k, r.row_no) for r in ranking.with_row_numbers(df, "k").collect())
    assert [n for _, n in got] == list(range(1, 1001))
    keys = sorted(r.k for r in df.collect())
    assert sorted(r.k for r in ranking.first_rows(df, 37, "k").collect()) == keys[:37]


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_running_totals_do_not_depend_on_the_ranges(spark, depth):
    df = spark.range(400).select((F.col("id") % 90).cast("double").alias("x"), F.col("id").alias("tie"), (F.col("id") % 4).alias("g"),
                                 (F.col("id") % 5).alias("n"))
    got = ranking.with_running_totals(df, "x", {"t": "n"}, ["g"], descending=True, ties=["tie"], depth=depth).collect()
    for g in range(4):
        total = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: (-r.x, r.tie)):
            total += r.n
            assert r.t == total


def test_exact_quantiles(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    data = [(g, float(round(x, 1))) for g in ("a", "b") for x in rng.gamma(2, 5, 301 if g == "a" else 4)]
    counted = spark.createDataFrame(data, "g string, value double").groupBy("g", "value").agg(F.count("*").alias("n"))
    for r in ranking.exact_quantiles(counted, ["g"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect():
        want = np.quantile([x for g, x in data if g == r.g], [0.0, 0.25, 0.5, 0.9, 1.0])
        assert np.allclose([r.q0, r.q1, r.q2, r.q3, r.q4], want)


def test_cleaning(rows):
    # Row 2 loses by URL, so its record id does not knock out row 3.
    data = [(1, "u1", "w1"), (2, "u1", "w2"), (3, "u2", "w2"), (4, "u3", "w1"), (5, "u4", None), (6, "", "w6")]
    df = rows(data, "n int, url string, warc_id string")
    assert sorted(r.n for r in clean.keep_first(df, "url", "n").collect()) == [1, 3, 4, 5, 6]
    once = clean.deduplicated(clean.drop_nulls(df, ["url", "warc_id"]), "n")
    assert sorted(r.n for r in once.collect()) == [1, 3, 6]
    assert clean.deduplicated(once, "n").count() == 3
    assert {r.column: r.n_null for r in clean.null_counts(df).collect()} == {"n": 0, "url": 0, "warc_id": 1}
    assert [r.n for r in clean.tail(df, 2, "n").collect()] == [6, 5]
    union = clean.appended(df, rows([(9, "x")], "n int, extra string"))
    assert union.columns == ["n", "url", "warc_id", "extra"] and union.count() == 7
