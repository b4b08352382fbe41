"""Stacking goes through its rows several times but makes them once."""

import random

from panelforge.operators import learn


def test_stacked_makes_its_rows_once(spark):
    r, made = random.Random(3), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(i, float(r.gauss(0, 3)), float(r.gauss(1, 2)), float(r.gauss(0, 5))) for i in range(200)]
    schema = "id long, p double, q double, target double"
    both, _ = learn.stacked(spark.createDataFrame(rows, schema).mapInArrow(counted, schema), ["p", "q"], "target")
    assert both.count() == 200 and both.filter("stacked is null").count() == 0
    assert made.value == 200
