import pytest
from pyspark.sql import functions as F

from papyra.operators.quality import OutOfBounds, audited_hand_off, chunk_measures, chunk_quality, enrichment_audit, enrichment_measures

CHUNKS = [("a", "one"), ("a", "three"), (None, "x"), ("b", None)]


def chunks(spark, rows=CHUNKS):
    return spark.createDataFrame(rows, "cord_uid string, chunk_text string")


def test_write_gives_the_figures_of_a_scan(spark):
    """Behind a shuffle, with rows in several tasks."""
    df = chunks(spark, CHUNKS * 50).repartition(7, "chunk_text")
    table, figures = audited_hand_off(df, "t", chunk_measures(4))
    assert figures == chunk_quality(table, 4).first().asDict()
    assert figures == {"chunks": 200, "null_ids": 50, "null_chunks": 50, "too_long": 50, "longest": 5}
    assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))


def test_rows_are_made_once(spark):
    """What makes the rows runs once per row: written and measured in one pass."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    audited_hand_off(chunks(spark, CHUNKS * 25).mapInArrow(run, "cord_uid string, chunk_text string"), "t", chunk_measures(4))
    assert made.value == 100


@pytest.mark.parametrize("bounds, said", [
    ({"null_ids": (0, 0)}, "null_ids is 1, allowed 0 to 0"),
    ({"chunks": (5, None)}, "chunks is 4, allowed 5 to None"),
    ({"longest": (None, 4), "too_long": (0, 1)}, "longest is 5, allowed None to 4"),
])
def test_figures_outside_their_bounds_stop_the_run(spark, bounds, said):
    with pytest.raises(OutOfBounds, match=said) as stopped:
        audited_hand_off(chunks(spark), "t", chunk_measures(4), bounds)
    assert stopped.value.figures["chunks"] == 4 and ";" not in str(stopped.value)


def test_bounds_that_hold(spark):
    table, figures = audited_hand_off(chunks(spark), "t", chunk_measures(4), {"chunks": (4, 4), "too_long": (None, 1), "longest": (5, None)})
    assert table.count() == figures["chunks"] == 4


def test_no_rows(spark):
    table, figures = audited_hand_off(chunks(spark, []), "t", chunk_measures(4))
    assert table.count() == 0 and figures == {"chunks": 0, "null_ids": 0, "null_chunks": 0, "too_long": 0, "longest": None}
    with pytest.raises(OutOfBounds, match="longest is None"):
        audited_hand_off(chunks(spark, []), "t", chunk_measures(4), {"longest": (1, 4)})


def test_rates_of_no_rows_and_of_some(spark):
    df = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "Rank int, paper_br int")
    for rows in (df, df.limit(0)):
        table, figures = audited_hand_off(rows, "t", enrichment_measures())
        assert figures == enrichment_audit(rows).first().asDict()
