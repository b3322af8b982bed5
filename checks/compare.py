"""Run queries against their oracles: python -m checks.compare [folder] [name ...]"""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cores=8):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("pagelens")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def main(folder="/root/testdata/sf0.01", *names):
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    spark = session()
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    bad = []
    for name, run in QUERIES.items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            df = run(spark, folder)
            rows = df.collect()
            spent = time.time() - start
            if name not in ORACLES:
                print(f"rows {name} {len(rows)} {spent:.1f}s", flush=True)
                continue
            start = time.time()
            result = con.execute(ORACLES[name])
            columns = [c[0] for c in result.description]
            types = {c[0]: str(c[1]) for c in result.description}
            expected = result.fetchall()
            duck = time.time() - start
            same_columns = sorted(columns) == sorted(df.columns)
            got, want = normal(rows, df.columns), normal(expected, columns)
            ok = same_columns and got == want
            types = sorted((c, t, dict(df.dtypes).get(c)) for c, t in types.items())
            print(f"{'ok  ' if ok else 'BAD '} {name} {len(rows)} {spent:.1f}s duckdb {duck:.1f}s "
                  + " ".join(f"{c}:{a}/{b}" for c, a, b in types), flush=True)
            if not ok:
                bad.append(name)
                print("   ", len(got), len(want), sorted(df.columns), sorted(columns))
                differing = [(a, b) for a, b in zip(got, want) if a != b][:2]
                print("   ", str(differing)[:1500], flush=True)
        except Exception as error:
            bad.append(name)
            print(f"ERR  {name}: {str(error)[:700]}", flush=True)
    print("not equal:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
