"""Queries and their DuckDB equivalents on odd inputs that the test tables lack."""

import duckdb
import pytest

from millrace.plans import catalog


@pytest.fixture
def both(spark, tmp_path):
    def run(name, **tables):
        con = duckdb.connect()
        for t, df in tables.items():
            df.coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
        df = catalog.QUERIES[name](spark, str(tmp_path))
        return sorted(map(tuple, df.collect()), key=str), sorted(con.execute(f"select {', '.join(df.columns)} from ({catalog.ORACLES[name]})").fetchall(), key=str)

    return run


def test_caption_fix_capitals_of_several_letters_and_vertical_tabs(spark, both):
    texts = ["ßheit the", "ŉ the", "ﬁne the", "\x0b the\x0b\x0bx  y\x0b", "\x0b the", "ᾳ the", "éa the,", "", ",", None]
    docs = spark.createDataFrame([(i, t, "s", "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    found, wanted = both("caption_fix", documents=docs)
    assert found == wanted
    assert [r[2] for r in found][:3] == [10, 6, 8]


def test_clustering_comparison_ties_are_not_left_to_chance(spark, both):
    # 3 n + 1 rows a segment: both qualities are the same mean, whatever the order of the sum
    rows = [(i, i % 25, ((i * 7919) % 1_000_003) / 100.0 - 999.99, "ABC"[i % 3]) for i in range(3 * 40_000)]
    customer = spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").repartition(7)
    found, wanted = both("clustering_comparison", customer=customer)
    assert found == wanted and {r[3] for r in found} == {"both have trade-offs"}


def test_parsed_names_keep_long_numbers(spark, both):
    ids = [0, 1, 2, 9_999, 10_000, 10_002, 99_999, 100_000, 999_999, 1_000_000, 1_000_002, 5_999_999, 6_000_000, 123_456_789]
    events = spark.createDataFrame([(i, i % 7, 1.5) for i in ids], "event_id long, user_id long, value double")
    found, wanted = both("parsed_names", events=events)
    assert found == wanted and {r[3] for r in found} >= {1_000_002, 100_000}


def test_resolution_buckets_round_halves_as_the_equivalent_does(spark, both):
    prices = [1024.5, 1023.5, 2048.5, 512.5, 511.5, 640.5, 320.5, 1280.5, 900.5, 901.5, 1040.5, 1000.0]
    part = spark.createDataFrame([(f"b{i}", w, p) for i, p in enumerate(prices) for w in range(1, 52)] + [("edge", 11, 930.5)], "p_brand string, p_size int, p_retailprice double")
    found, wanted = both("resolution_buckets", part=part)
    assert found == wanted
