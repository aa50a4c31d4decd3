import glob

from pyspark.sql import functions as F

from riskloom.sources.scratch import finished, materialise, scratch_root, working_table


def tables(spark):
    return set(glob.glob(f"{scratch_root(spark)}/riskloom/*"))


def test_finished_keeps_only_the_result(spark):
    before = tables(spark)

    def build():
        first = materialise(spark.range(10), "first")
        inner = finished(lambda: materialise(first.select((F.col("id") * 2).alias("x")), "deep").filter("x > 4"), "inner")
        with working_table(inner, "work") as held:
            assert held.count() == 7
        return inner.agg(F.sum("x").alias("s"))

    out = finished(build)
    assert out.first()["s"] == sum(range(6, 20, 2))
    left = tables(spark) - before
    assert len(left) == 1 and "result-" in left.pop()


def test_working_table_goes_on_failure(spark):
    before = tables(spark)
    try:
        with working_table(spark.range(3)):
            raise KeyError
    except KeyError:
        pass
    assert tables(spark) == before
