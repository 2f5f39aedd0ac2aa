from datetime import datetime

from pagewright.session import settled


def test_settled_rows_alike_with_few_and_many_repeats(spark, tmp_path):
    day = lambda n: datetime(2025, 1, n)
    rows = [(i, day(1), f"t{i}") for i in range(50)] + [(3, day(2), "new"), (4, None, "old"), (None, day(1), "x"), (None, day(3), "y"), (7, day(1), "t7")]
    spark.createDataFrame(rows, "id bigint, at timestamp, text string").repartition(3).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    few, many = (sorted(map(tuple, settled(t, ["id"], "at", small).collect()), key=str) for small in (100, 0))
    assert few == many and len(few) == 51 and t.columns == settled(t, ["id"]).columns
    got = {r[0]: r[2] for r in few}
    assert got[3] == "new" and got[4] == "t4" and got[None] == "y"
    assert settled(t.limit(0), ["id"], "at").count() == 0
