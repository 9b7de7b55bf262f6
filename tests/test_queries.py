"""Every registered query of the library against its SQL, on the smallest tables."""

import duckdb
import pytest

from parityline.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def canon(rows):
    made = [tuple(round(float(v), 6) if isinstance(v, float) else None if v is None else str(v) for v in r) for r in rows]
    return sorted(made, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = canon(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    cur = db.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = canon(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_partitioning_does_not_matter(spark):
    df = catalogue.queries()["compare_orders"](spark, SF)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        again = catalogue.queries()["compare_orders"](spark, SF)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_id_windows_cover_the_table(spark, sf):
    path = f"/root/testdata/{sf}"
    keys = sorted(r[0] for r in spark.read.parquet(f"{path}/orders.parquet").select("o_orderkey").collect())
    rows = catalogue.queries()["assign_id_window_all"](spark, path).collect()
    assert sorted(r["o_orderkey"] for r in rows) == keys
    assert all(r["id_from"] <= r["o_orderkey"] < r["id_to"] == r["id_from"] + 700 and (r["id_from"] - keys[0]) % 700 == 0 for r in rows)
    assert sorted(r["o_orderkey"] for r in catalogue.queries()["scan_id_window_all"](spark, path).collect()) == keys


def test_repeated_keys_are_found_once(spark):
    """compare_tables itself, on keys that come several times."""
    from parityline.operators.compare import compare_tables

    a = spark.createDataFrame([("1", 5), ("1", 7), ("2", 1), ("2", 1)], "id string, v int")
    b = spark.createDataFrame([("1", 5), ("1", 6), ("2", 3), ("2", 2)], "id string, v int")
    assert [(r["pk"], r["source_value"], r["target_value"]) for r in compare_tables(a, b, "id").collect()] == [("2", "1", "2")]


def test_window_grid_covers_the_events(spark):
    rows = catalogue.queries()["window_grid_all"](spark, SF).orderBy("window_from").collect()
    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("min(CAST(ts AS timestamp_ntz)) lo", "max(CAST(ts AS timestamp_ntz)) hi").first()
    assert rows[0]["window_from"] == events["lo"] and rows[-1]["window_from"] <= events["hi"] < rows[-1]["window_to"]
    assert all(a["window_to"] == b["window_from"] for a, b in zip(rows, rows[1:], strict=False))


def xxhash64_of_long(x, seed=42):
    """Spark's xxhash64 of one long, in plain Python."""
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    top = (1 << 64) - 1

    def turned(v, n):
        return ((v << n) | (v >> (64 - n))) & top

    h = (seed + p5 + 8) & top
    h ^= turned((x & top) * p2 & top, 31) * p1 & top
    h = (turned(h, 27) * p1 + p4) & top
    h = (h ^ (h >> 33)) * p2 & top
    h = (h ^ (h >> 29)) * p3 & top
    h ^= h >> 32
    return h - (1 << 64) if h >> 63 else h


def test_shard_of_every_row(spark):
    from parityline.sources.scans import scan_hash_shards

    orders = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("CAST(o_orderkey AS bigint) AS k")
    rows = scan_hash_shards(orders, "k", 8).collect()
    assert len(rows) == orders.count()
    assert all(r["shard"] == xxhash64_of_long(r["k"]) % 8 for r in rows)
