"""Stratified sample and folds: sizes, allocation, independence from partitioning."""
import pytest
from pyspark.sql import functions as F

from stratlab.operators import sampling as S


@pytest.fixture
def tiny_strata(spark):
    rows = []
    for s, n in [(1, 1), (2, 2), (3, 9), (4, 1000)]:
        rows += [(s * 10_000 + i, s) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, stratum int")


def test_allocation_sizes():
    q = S.allocate([(1, 1), (2, 2), (3, 9), (4, 1000)], 0.10)
    assert sum(q.values()) == 101            # floor(0.1 * 1012)
    assert q[4] == 100 and q[3] == 1


def test_sample_exact_size(spark, tiny_strata):
    out = S.stratified_sample(tiny_strata, ["id"], "stratum", 0.10)
    got = {r.stratum: r.n for r in out.filter("in_sample").groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == 101
    assert out.count() == tiny_strata.count()


def test_sample_same_under_repartition(spark, tiny_strata):
    a = {r.id for r in S.stratified_sample(tiny_strata.repartition(1), ["id"], "stratum", 0.1).filter("in_sample").collect()}
    b = {r.id for r in S.stratified_sample(tiny_strata.repartition(13), ["id"], "stratum", 0.1).filter("in_sample").collect()}
    assert a == b


def test_folds_balanced(spark, tiny_strata):
    f = S.stratified_folds(tiny_strata, ["id"], "stratum", k=10, inner="inner")
    sizes = [r.n for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1012
    per = f.groupBy("stratum", "fold").agg(F.count("*").alias("n")).groupBy("stratum").agg(
        (F.max("n") - F.min("n")).alias("spread"), F.sum("n").alias("tot")).collect()
    for r in per:
        assert r.spread <= 1 or r.tot < 10
    # inner folds: each outer training part is again balanced
    rows = f.select("fold", F.posexplode("inner").alias("outer", "inner_fold")).filter("inner_fold is not null")
    for r in rows.groupBy("outer").agg(F.countDistinct("inner_fold").alias("k")).collect():
        assert r.k == 10
    inner_sizes = rows.groupBy("outer", "inner_fold").count().groupBy("outer").agg(
        (F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in inner_sizes)


def test_hot_stratum_bucketing(spark):
    """One stratum with most rows: ranks are still exact (small buckets forced)."""
    rows = [(i, 1 if i < 3000 else 2) for i in range(3100)]
    df = spark.createDataFrame(rows, "id bigint, stratum int")
    old = S.TARGET_BUCKET_ROWS
    S.TARGET_BUCKET_ROWS = 4
    try:
        f = S.stratified_folds(df, ["id"], "stratum", k=10)
        s = S.stratified_sample(df, ["id"], "stratum", 0.1)
    finally:
        S.TARGET_BUCKET_ROWS = old
    sizes = sorted(r[1] for r in f.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 1
    assert s.filter("in_sample").count() == 310


def test_inner_fold_cells_match_inner_array(spark):
    rows = [(i, i % 3) for i in range(537)]
    df = spark.createDataFrame(rows, "id bigint, stratum int")
    f = S.stratified_folds(df, ["id"], "stratum", k=10, inner="inner", position="pos").collect()
    for r in f:
        b, c = r.pos % 10, (r.pos // 10) % 10
        assert r.fold == b
        assert [S.inner_fold_of_cell(b, c, j) for j in range(10)] == list(r.inner)


def test_null_stratum_is_kept(spark):
    rows = [(i, None if i % 4 == 0 else i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, stratum int")
    f = S.stratified_folds(df, ["id"], "stratum", k=10)
    assert f.count() == 400
    sizes = [r[1] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    s = S.stratified_sample(df, ["id"], "stratum", 0.1)
    assert s.count() == 400 and s.filter("in_sample").count() == 40
    assert s.filter("in_sample and stratum is null").count() == 10


def test_folds_deal_the_rows_out_once(spark):
    """Without broadcasts the rows cross one exchange, shared by the offsets join and the ranks."""
    df = spark.createDataFrame([(i, i % 3 if i % 7 else None) for i in range(300)], "id long, s int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = S.stratified_folds(df, ["id"], "s", k=5, inner="inner", position="p")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(_k#") == 2   # the rows, and the table of offsets
    assert sorted(r.p for r in rows) == list(range(300)) and all(r.fold == r.p % 5 for r in rows)
    assert {sum(1 for r in rows if r.fold == f) for f in range(5)} == {60}
