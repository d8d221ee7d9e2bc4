"""Versions, conservation, paged sources, rejected lines and range rules: what must hold, and what must fail."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from canvass.operators import contracts, lookup
from canvass.sources import files, paged, versions


def test_versions_replace_one_another(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    assert versions.current(spark, target) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, target)
    first = versions.publish(spark.range(3), target)
    old = spark.read.parquet(first)
    versions.publish(spark.range(5), target, partition_by=None)
    assert versions.read(spark, target).count() == 5 and old.count() == 3  # who reads the old version reads on
    assert len(versions.prune(spark, target, keep=1)) == 1 and versions.read(spark, target).count() == 5
    assert [n for n, _ in versions.pointed(spark, target)] == [2]
    with pytest.raises(ValueError):
        versions.prune(spark, target, keep=0)


def test_a_crash_at_any_step_leaves_the_old_version(spark, tmp_path, monkeypatch):
    target = f"file://{tmp_path}/t"
    versions.publish(spark.range(3), target)

    def dies(*_):
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed|DIVIDE"):  # while it writes
        versions.publish(spark.range(5).select((F.lit(1) / (F.col("id") - 4)).alias("id"), F.when(F.col("id") == 4, F.raise_error(F.lit("killed"))).alias("x")), target)
    assert versions.read(spark, target).count() == 3
    with pytest.raises(RuntimeError):  # when it is checked
        versions.publish(spark.range(5), target, check=dies)
    assert versions.read(spark, target).count() == 3
    with monkeypatch.context() as m:  # before the pointer
        m.setattr(versions, "_point", dies)
        with pytest.raises(RuntimeError):
            versions.publish(spark.range(5), target)
    assert versions.read(spark, target).count() == 3
    Path(tmp_path / "t" / "pointers" / "0000000002").write_text("")  # while the pointer is written
    assert versions.read(spark, target).count() == 3
    Path(tmp_path / "t" / "pointers" / "0000000003").write_text("half-a-na")
    assert versions.read(spark, target).count() == 3
    versions.publish(spark.range(7), target)
    assert versions.read(spark, target).count() == 7 and versions.pointed(spark, target)[-1][0] == 4


def test_two_writers_do_not_share_a_pointer(spark, tmp_path, monkeypatch):
    target = f"file://{tmp_path}/t"
    versions.publish(spark.range(1), target)
    names = versions._names
    monkeypatch.setattr(versions, "_names", lambda s, f: [] if f.endswith("pointers") else names(s, f))  # both see no pointer
    number = versions._point(spark, target, "other")
    monkeypatch.undo()
    assert number == 2 and len(versions.pointed(spark, target)) == 2


def rows(spark, n=1000):
    return spark.range(n).select("id", F.when(F.col("id") % 10 == 9, None).otherwise(F.col("id") % 3).alias("g"))


def test_conservation_is_counted_by_the_job_that_writes(spark, tmp_path):
    kept = versions.Conserved("g", [0, 1, 2])
    written = versions.publish(kept.after(kept.before(rows(spark)).join(spark.range(1000).withColumn("v", F.col("id") * 2), "id")), f"file://{tmp_path}/t", check=lambda folder: kept.require(spark.read.parquet(folder)))
    assert kept.counts() == [(0, 300, 300), (1, 300, 300), (2, 300, 300), ("(others)", 100, 100)] and written


def test_a_lost_group_fails_and_is_not_published(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    versions.publish(rows(spark), target)
    kept = versions.Conserved("g", [0, 1, 2])
    lossy = kept.after(kept.before(rows(spark)).where("g <> 1"))
    with pytest.raises(contracts.ContractError, match=r"\(1, 300, 0\)"):
        versions.publish(lossy, target, check=lambda folder: kept.require(spark.read.parquet(folder)))
    assert versions.read(spark, target).count() == 1000
    with pytest.raises(ValueError):
        versions.Conserved("g", list(range(versions.MOST_GROUPS + 1)))


def test_a_group_that_is_gone_is_reported(spark):
    before = spark.createDataFrame([("a", 2), ("b", 3), (None, 1)], "g string, before long")
    after = spark.createDataFrame([("a", 2), ("c", 1), (None, 1)], "g string, after long")
    got = {r["g"]: (r["before"], r["after"], r["conserved"]) for r in contracts.conservation(before, after, "g").collect()}
    assert got == {"a": (2, 2, True), "b": (3, 0, False), "c": (0, 1, False), None: (1, 1, True)}


def write_pages(spark, folder, ids, size=10):
    spark.createDataFrame([(i, f"n{i}", i // size) for i in ids], "id long, name string, page long").repartition("page").write.partitionBy("page").json(folder)


def test_pages_are_read_whole(spark, tmp_path):
    folder = f"file://{tmp_path}/p"
    write_pages(spark, folder, range(95))
    got = paged.scan(spark, folder, "canvass.sources.paged:folder_page", 95, 10)
    assert got.rdd.getNumPartitions() == 10 and got.count() == 95
    read = got.select(F.get_json_object("record", "$.id").cast("long").alias("id"), "place")
    assert paged.require_complete(read, "id", spark.range(95)).where("id <> place").count() == 0
    assert paged.scan(spark, folder, "canvass.sources.paged:folder_page", 0, 10).count() == 0


def test_a_short_page_a_repeated_id_and_a_missing_batch_fail(spark, tmp_path):
    folder = f"file://{tmp_path}/p"
    write_pages(spark, folder, [i for i in range(100) if i != 55])
    with pytest.raises(Exception, match="page at offset 50 .* has 9 records instead of 10"):
        paged.scan(spark, folder, "canvass.sources.paged:folder_page", 100, 10).count()
    found = spark.createDataFrame([(i,) for i in [*range(50), 54, 54]], "id long")
    with pytest.raises(contracts.ContractError, match="more than once"):
        paged.require_complete(found, "id", spark.range(100))
    with pytest.raises(contracts.ContractError, match="missing"):
        paged.require_complete(spark.range(90), "id", spark.range(100))
    records = f"file://{tmp_path}/ids"
    write_pages(spark, records, range(300), 100)
    assert paged.fetched(spark.range(300), "id", records, "canvass.sources.paged:folder_ids", 7).count() == 300
    with pytest.raises(Exception, match="ids missing"):
        paged.fetched(spark.range(301), "id", records, "canvass.sources.paged:folder_ids", 7).count()


def test_rejected_lines_are_named_and_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("key,name\n1,one\n\n2\n3,three\n4,four,more\n   \n5,\"fi,ve\"\n")
    (tmp_path / "b.csv").write_text("key,name\n" + "".join(f"{i}\n" for i in range(20, 27)))
    got, rejected = files.csv_checked(spark, str(tmp_path), ["key", "name"])
    assert sorted((r["key"], r["name"]) for r in got.collect()) == [("1", "one"), ("3", "three"), ("5", "fi,ve")]
    assert [r["line"] for r in rejected.orderBy("file", "offset").collect()] == ["2", "4,four,more", *map(str, range(20, 27))]
    with pytest.raises(contracts.ContractError) as error:
        files.require_clean(rejected)
    assert "a.csv: '2'; a.csv: '4,four,more'; b.csv: '20'; b.csv: '21'; b.csv: '22'" in str(error.value) and "23" not in str(error.value)
    files.require_clean(rejected.limit(0))


RULES = "k string, low long, high long, target string"


def test_range_rules_against_plain_search(spark):
    rng = random.Random(1)
    rules, at = [], -5000
    while at < 5000:
        wide = rng.choice([0, 0, 1, 7, 100, 900])
        rules.append((rng.choice("ab"), at, at + wide, f"r{at}"))
        at += wide + rng.choice([1, 1, 3, 50])
    rules.append(("c", 5, 4, "empty"))
    facts = [(i, rng.choice(["a", "b", "c", None]), rng.randrange(-6000, 6000)) for i in range(3000)] + [(5000, "a", None)]
    got = {r["uid"]: r["target"] for r in lookup.range_lookup(spark.createDataFrame(facts, "uid long, k string, v long"), "uid", "v", spark.createDataFrame(rules, RULES), ["k"], "low", "high", "target").collect()}
    for uid, k, v in facts:
        want = [t for own, low, high, t in rules if own == k and v is not None and low <= v <= high]
        assert got[uid] == (want[0] if want else None)
    assert len(got) == len(facts)


def test_two_rules_that_hold_a_value_fail(spark):
    facts = spark.createDataFrame([(1, "a", 5)], "uid long, k string, v long")
    with pytest.raises(contracts.ContractError, match="more than one rule"):
        lookup.range_lookup(facts, "uid", "v", spark.createDataFrame([("a", 0, 9, "x"), ("a", 5, 5, "y")], RULES), ["k"], "low", "high", "target")
    got = lookup.range_lookup(facts, "uid", "v", spark.createDataFrame([], RULES), ["k"], "low", "high", "target")
    assert got.collect()[0]["target"] is None


def test_a_key_with_a_hundred_thousand_rules_is_linear(spark):
    rules = spark.range(100_000).select(F.lit("a").alias("k"), (F.col("id") * 10).alias("low"), (F.col("id") * 10 + F.col("id") % 9).alias("high"), F.col("id").cast("string").alias("target"))
    facts = spark.range(100_000).select(F.col("id").alias("uid"), F.lit("a").alias("k"), (F.col("id") * 7919 % 1_000_000).alias("v"))
    got = lookup.range_lookup(facts, "uid", "v", rules, ["k"], "low", "high", "target")
    hit = got.where(F.col("target").isNotNull())
    assert got.count() == 100_000 and hit.where("cast(target as long) <> floor(v / 10)").count() == 0
    assert hit.count() == facts.where("v % 10 <= floor(v / 10) % 9").count()


def few_pages(address, ids):
    assert len({i // 100 for i in ids}) <= 2, "a batch asks for ids of many pages"
    return [{"id": i} for i in ids]


def test_a_batch_asks_for_neighbours(spark):
    shuffled = spark.range(3000).orderBy(F.xxhash64("id"))
    assert paged.fetched(shuffled, "id", "", "tests.test_releases:few_pages", 50).count() == 3000
