"""Tables that change in one step, whoever else writes or fails."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from salesflow.operators import star as ST
from salesflow.plans import jobs
from salesflow.sources import sinks
from salesflow.sources import testtables as TT
from salesflow.sources.readers import read_table
from salesflow.sources.versions import KEPT, Outdated, VersionedTable


def values(df):
    return sorted(r[0] for r in df.collect())


def broken(spark, n):
    """Rows whose last one cannot be computed."""
    return spark.range(n).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error("no more")).cast("long").alias("id"))


def test_a_broken_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="no more"):
        sinks.replace_table(broken(spark, 50), path)
    assert VersionedTable(spark, path).read() is None
    sinks.replace_table(spark.range(3), path)
    for _ in range(2):
        with pytest.raises(Exception, match="no more"):
            sinks.replace_table(broken(spark, 50), path)
        assert values(read_table(spark, path)) == [0, 1, 2]
    sinks.replace_table(spark.range(5, 7), path)
    assert values(read_table(spark, path)) == [5, 6]
    assert sum(f.startswith("rows-") for f in os.listdir(path)) == 2  # nothing is left of what failed


def test_a_table_is_replaced_by_what_was_made_of_it(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(4), path)
    for _ in range(3):
        sinks.replace_table(read_table(spark, path).select((F.col("id") + 1).alias("id")), path)
    assert values(read_table(spark, path)) == [3, 4, 5, 6]


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    old = read_table(spark, path)
    sinks.replace_table(spark.range(9), path)
    assert (old.count(), read_table(spark, path).count()) == (3, 9)


def test_old_versions_go(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(1, KEPT + 5):
        table.replace(spark.range(n))
    assert len(table.versions()) == KEPT and table.read().count() == KEPT + 4
    assert sum(f.startswith("rows-") for f in os.listdir(tmp_path / "t")) == KEPT


def test_partitioned_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(6).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    assert read_table(spark, path).where("k = 1").agg(F.sum("id")).first()[0] == 9


def test_added_rows_are_merged_after_some_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("salesflow.sources.versions.FOLDERS", 3)
    table = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(8):
        table.add(lambda now, i=i: spark.range(i, i + 1))
        assert values(table.read()) == list(range(i + 1))
        assert len(table.folders(table.versions()[-1])) <= 4
    before = table.versions()
    table.add(lambda now: spark.range(0))
    assert table.versions() == before  # nothing to add, nothing written


def test_a_number_is_given_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(1))
    with pytest.raises(Outdated):
        table._commit(["elsewhere"], 1)
    assert table.folders(1) != ["elsewhere"]
    assert not [n for n in os.listdir(tmp_path / "t" / "_versions") if n.startswith(".") and "crc" not in n]


def test_two_loaders_give_each_name_one_id(spark, tmp_path):
    """Both see the same table first; the slower one finds its version taken and looks again."""
    table = lambda: VersionedTable(spark, str(tmp_path / "dim"))
    names = lambda a, b: spark.range(a, b).select(F.concat(F.lit("shop "), "id").alias("retailer_name"))
    asked = []

    def load(cut):
        mine = table()
        mine.add(lambda now: asked.append(cut) or ST.new_members("retailer", names(*cut), now))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, [(0, 300), (200, 500), (100, 400), (0, 500)]))
    rows = table().read().collect()
    assert sorted(r.retailer_name for r in rows) == sorted(f"shop {i}" for i in range(500))
    assert len({r.retailer_id for r in rows}) == 500
    assert len(asked) > 4  # some had to look again


def test_a_second_load_keeps_the_ids(spark, small, tmp_path):
    records = TT.sales_feed(spark, small)
    first = jobs.load_star(spark, records.where("region <> 'ASIA'"), str(tmp_path))
    ids = {d: {tuple(r) for r in getattr(first, d).collect()} for d in ST.NATURAL_KEYS}
    second = jobs.load_star(spark, records, str(tmp_path))
    for d, known in ids.items():
        assert known <= {tuple(r) for r in getattr(second, d).collect()}
    assert second.fact.count() == records.count() and second.region.count() == 5
    assert second.fact.where("region_id is null or produit_id is null or retailer_id is null").count() == 0
