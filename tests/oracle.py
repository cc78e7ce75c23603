"""Compare registered queries with their SQL statements: names, types and exact values.

    python tests/oracle.py /root/testdata/sf0.01 [key-prefix ...]
"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def database(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql):
    """A list of differences; empty when the results agree."""
    cursor = con.execute(sql)
    want_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    names = sorted(want_types)
    position = [list(want_types).index(n) for n in names]
    want = sorted((tuple(r[i] for i in position) for r in cursor.fetchall()), key=_key)
    got_types = dict(df.dtypes)
    problems = []
    if sorted(got_types) != names:
        return [f"columns {sorted(got_types)} against {names}"]
    for name in names:
        if got_types[name] != want_types[name]:
            problems.append(f"type of {name}: {got_types[name]} against {want_types[name]}")
    got = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    differing = 0
    for a, b in zip(got, want):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            differing += 1
            if differing == 1:
                problems.append(
                    "first difference: "
                    + str([(n, x, y) for n, x, y in zip(names, a, b) if x != y])
                )
    if differing:
        problems.append(f"{differing} rows differ")
    return problems


def main():
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from pyspark.sql import SparkSession

    import registry

    folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for key, plan in registry.QUERIES.items():
        if prefixes and not key.startswith(prefixes):
            continue
        started = time.time()
        try:
            df = plan(spark, folder)
            if key in registry.ORACLES:
                problems = compare(df, con, registry.ORACLES[key])
            else:
                problems = [] if df.count() else ["no rows"]
            rows = f"{len(con.execute(registry.ORACLES[key]).fetchall())} rows" if (
                key in registry.ORACLES
            ) else ""
        except Exception as error:  # report and go on with the next query
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        seconds = time.time() - started
        print(f"{'ok  ' if not problems else 'FAIL'} {key} {seconds:.2f}s {rows}", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
        bad += bool(problems)
    print(f"{bad} failing of {len(registry.QUERIES)} registered")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
