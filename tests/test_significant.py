"""Numbers in the gate's reasons against C's printf."""

import random

from pyspark.sql import functions as F

from lumenset.operators import gate


def test_halves_round_to_even(spark):
    rnd = random.Random(2)
    values = [2372.5, 2373.5, -2372.5, 64405.0, 0.12335, 0.00012345, 0.34565, 0.0, 9999.5, 5e-324, None]
    values += [rnd.randrange(200_000) / rnd.choice([2, 4, 8]) for _ in range(2000)] + [round(rnd.random(), 5) for _ in range(2000)]
    got = [r.s for r in spark.createDataFrame([(v,) for v in values], "v double").select(gate.significant(F.col("v")).alias("s")).collect()]
    assert got == [None if v is None else f"{v:.4g}" for v in values]
    assert got[:4] == ["2372", "2374", "-2372", "6.44e+04"]
