"""Merges by partition: the rows of the whole-table merge, one week's files, one pass over the source."""

import random

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import merge
from reelhouse.operators.partition_merge import PartitionedTable, tagged_merge
from reelhouse.plans import weekly_load

REV = "film_id bigint, revenue_qc bigint, data_source string, cumulatif_qc_to_date bigint, rank int, weekend_id int"
WEEKS = (202401, 202402, 202403)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def revenue_rows(seed, weeks=WEEKS, n=40):
    rnd = random.Random(seed)
    keys = sorted({(rnd.randrange(30), rnd.choice(weeks)) for _ in range(n)})
    return [(f, rnd.randrange(1000), rnd.choice(["cinoche", "estimate"]), rnd.choice([None, 5, 9]), rnd.choice([None, 1]), w) for f, w in keys]


@pytest.fixture
def table(spark, tmp_path):
    out = PartitionedTable(spark, str(tmp_path / "revenues"), "weekend_id")
    out.create(spark.createDataFrame(revenue_rows(1), REV))
    return out


@pytest.mark.parametrize("insert", [True, False])
def test_one_tagged_union_gives_the_rows_of_the_merge(spark, insert):
    odd = [(None, 1, "estimate", None, None, 202401), (None, 1, "estimate", None, None, 202401), (99, 7, None, None, None, None)]
    repeated = [(50, 1, "estimate", None, 1, 202401), (50, 2, "estimate", None, 2, 202401)]
    target = spark.createDataFrame(revenue_rows(1) + odd + repeated, REV)
    source = spark.createDataFrame(revenue_rows(2) + [(50, 3, "estimate", 8, None, 202401), (None, 4, "estimate", 1, 1, 202402)], REV).drop("rank")
    rules, guard = merge.estimate_rules(target), F.expr(merge.STILL_ESTIMATED)
    whole = (merge.merge if insert else merge.update)(target, source, merge.REVENUE_KEY, rules, guard)
    assert rows(tagged_merge(target, source, merge.REVENUE_KEY, rules, guard, insert)) == rows(whole)


def test_a_week_reads_and_rewrites_its_own_files(spark, table):
    files = {f for f in table.read().inputFiles()}
    week = spark.createDataFrame(revenue_rows(3, weeks=[202402]), REV)
    others = table.read().where("weekend_id <> 202402")
    before = rows(others)
    expected = rows(merge.merge_published(table.read(), week))
    source, rules = merge.published_merge(table.read(), week)
    scan = table.slice([202402])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(weekend_id" in plan and "202402" in plan.split("PartitionFilters")[1].split("]")[0]
    assert all("weekend_id=202402" in r[0] for r in scan.select(F.input_file_name()).distinct().collect()) and scan.count()
    table.merge(source, merge.REVENUE_KEY, rules)
    assert rows(table.read()) == expected
    after = set(table.read().inputFiles())
    assert {f for f in files if "=202402" not in f} == {f for f in after if "=202402" not in f}
    assert not {f for f in files if "=202402" in f} & after
    assert rows(table.read().where("weekend_id <> 202402")) == before
    table.merge(source, merge.REVENUE_KEY, rules)
    assert rows(table.read()) == expected  # again: nothing changes


def test_the_source_is_evaluated_once(spark, table):
    seen = spark.sparkContext.accumulator(0)
    week = spark.createDataFrame(revenue_rows(4, weeks=[202401, 202404]), REV)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    weekly_load.load_estimates_into(table, week.mapInPandas(counted, REV))
    assert seen.value == week.count()
    assert table.read().where("weekend_id = 202404").count() == week.where("weekend_id = 202404").count()


def test_empty_source_and_computed_partition(spark, tmp_path):
    bucket = PartitionedTable(spark, str(tmp_path / "b"), "bucket", lambda r: F.pmod(F.col("id"), F.lit(3)).cast("int"))
    bucket.create(spark.createDataFrame([(n, None) for n in range(9)], "id bigint, screen_id bigint"))
    old = bucket.read().inputFiles()
    bucket.merge(spark.createDataFrame([], "id bigint, screen_id bigint"), ["id"], {"screen_id": merge.prefer_target})
    assert sorted(bucket.read().inputFiles()) == sorted(old)
    bucket.merge(spark.createDataFrame([(1, 5), (4, 6), (22, 7)], "id bigint, screen_id bigint"), ["id"], {"screen_id": merge.prefer_target})
    assert {r.id: r.screen_id for r in bucket.read().collect()} == {**dict.fromkeys(range(9)), 1: 5, 4: 6, 22: 7}
