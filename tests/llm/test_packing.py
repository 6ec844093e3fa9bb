import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=120))
def test_bins_hold_everything(sizes):
    bins = packing.best_two_fit(np.array(sizes, np.int64), 50)
    assert sorted(x for b in bins for x in b) == sorted(sizes)
    assert all(sum(b) <= 50 for b in bins)
    if bins:
        assert len(bins) <= 1.3 * sum(sizes) / 50 + 1 + len([s for s in sizes if s > 25])


def test_two_replace_the_smallest():
    # greedy gives 60+30 with 10 left; 30 gives way to 25+15
    assert sorted(packing.best_two_fit(np.array([60, 30, 25, 15]), 100)[0]) == [15, 25, 60]


def test_pair_of_equal_sizes_needs_two():
    pool = packing._Sizes(np.bincount([5, 4], minlength=11))
    assert pool.best_two(10) == (9, 5, 4)
    pool.give(5)
    assert pool.best_two(10) == (10, 5, 5)
    assert packing._Sizes(np.bincount([7], minlength=11)).best_two(10) == (0, 0, 0)


LIMIT = "granularity string, max_tokens long, overlap_tokens long"
ITEM = "item_id long, granularity string, seq long, text string, tokens long, ingested_at long"


def items_of(spark, rows):
    df = spark.createDataFrame(rows, ITEM)
    for clash in ("size", "capacity", "container", "free", "number", "grp", "piece", "_row", "chars", "n_rows"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.mark.parametrize("group", [7, 20_000])
def test_pack(spark, group):
    rows = [(k, "file", k, "x" * (4 * n + k % 4), n if k % 5 else None, 1) for k, n in enumerate([3, 10, 0, 25, 9, 1, 10, 7, 2, 33] * 4)]
    rows += [rows[3], (rows[3][0], "file", 3, rows[3][3], rows[3][4], 2), (None, "file", 1, "x", 1, 1), (99, None, 1, "xxxxx", None, 1), (98, "other", 1, None, None, 1), (97, "file", 1, "", -5, 1)]
    limits = spark.createDataFrame([("file", 10, 0), ("none", 0, 0)], LIMIT)
    got = packing.pack(items_of(spark, rows), limits, group).toPandas()
    own = got[got.granularity == "file"]
    sizes = {k: n for k, n in enumerate([3, 10, 0, 25, 9, 1, 10, 7, 2, 33] * 4)} | {97: 0}
    assert own.groupby("item_id").tokens.sum().to_dict() == sizes
    assert (own.groupby("container").tokens.sum() + own.groupby("container").unused.max() == 10).all()
    for k, part in own.sort_values("piece").groupby("item_id"):
        assert len(part) == max(1, -(-sizes[k] // 10)) == part.n_pieces.iloc[0]
        assert part.start_char.iloc[0] == 0 and (part.start_char.iloc[1:].to_numpy() == part.end_char.iloc[:-1].to_numpy()).all()
        assert (part.tokens <= 10).all()
    assert set(got[got.granularity != "file"].item_id) == {98, 99} and got[got.granularity != "file"].container.isna().all()


def test_reports_and_empty(spark):
    limits = spark.createDataFrame([("file", 10, 0)], LIMIT)
    df = items_of(spark, [(k, "file", k, "x" * 20, 5, 1) for k in range(10)])
    report = packing.fill_report(df, limits).first()
    assert (report.n_containers, report.least_containers, report.unused) == (5, 5, 0)
    assert packing.pack(df.limit(0), limits).count() == 0
    assert packing.pack(df, limits.limit(0)).where("container is null").count() == 10


def test_many_groups_waste_no_more_than_one(spark):
    limits = spark.createDataFrame([("file", 100, 0)], LIMIT)
    df = items_of(spark, [(k, "file", k, "x", (k * 7919) % 83 + 1, 1) for k in range(3000)])
    report = packing.pack(df, limits, 500).groupBy("container").agg(F.sum("tokens").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"), F.max("t").alias("most")).first()
    assert report.most <= 100 and report.n <= -(-report.t // 100) + 1
