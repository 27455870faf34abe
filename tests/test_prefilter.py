import pytest
from pyspark.sql import functions as F

from burstline.operators.prefilter import filter_words, split_likely


@pytest.mark.parametrize("words", [1, 7, 512, 1 << 16])
def test_no_listed_key_is_turned_away(spark, words):
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("u"), "id").alias("k"))
    rows = spark.range(3000).select("id", F.concat(F.lit("u"), "id").alias("k"))
    filtered = filter_words(listed, "k", words)
    assert filtered.count() <= words
    likely, others = split_likely(rows, filtered, "k", words)
    likely, others = ({r.id for r in side.collect()} for side in (likely, others))
    assert not likely & others and len(likely | others) == 3000
    assert set(range(0, 3000, 3)) <= likely
    if words >= 512:  # from 32 bits a key on few others pass
        assert len(likely) < 1000 + (200 if words == 512 else 3)


def test_nulls_and_empty_lists(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "")], "id int, k string")
    listed = spark.createDataFrame([(None,), ("",)], "k string")
    likely, others = split_likely(rows, filter_words(listed, "k"), "k")
    assert [r.id for r in likely.collect()] == [3]
    assert sorted(r.id for r in others.collect()) == [1, 2]
    likely, others = split_likely(rows, filter_words(listed.limit(0), "k"), "k")
    assert likely.count() == 0 and others.count() == 3 and others.columns == ["id", "k"]


def test_the_bound_is_checked(spark):
    with pytest.raises(ValueError):
        filter_words(spark.range(3), "id", 1 << 21)
