from pyspark.sql import functions as F

from lorekeel.llm.batches import drawn


def test_draws_of_any_share(spark):
    ids = spark.range(20_000)
    assert ids.where(drawn("id", 1.0)).count() == 20_000 and ids.where(drawn("id", 0.0)).count() == 0
    assert abs(ids.where(drawn("id", 0.1)).count() - 2000) < 200
    assert ids.where(drawn("id", F.lit(3.0))).count() == 20_000 and abs(ids.where(drawn("id", F.lit(0.1))).count() - 2000) < 200
    # far below 2^-20: shares are told apart in steps of 2^-62
    least = ids.select(F.min(F.pmod(F.xxhash64("id"), F.lit(1 << 62))).alias("x")).first()["x"]
    assert ids.where(drawn("id", (least + 1024) / 2**62)).count() == 1 and least / 2**62 < 2**-11
    assert spark.range(1).where(F.lit(1 << 30) < F.lit(int(1e-9 * (1 << 62)))).count() == 1
