from papyra.llm import decontaminate


def test_one_changed_word_in_the_second_half(spark):
    """32 words: 23 of 28 shingles are held, but only 7 of 12 of the second half's."""
    item = [f"item{i}" for i in range(32)]
    edited = item[:24] + ["changed"] + item[25:]
    share = (28 - 5) / 28
    text = lambda words: " ".join([f"before{i}" for i in range(90)] + words + [f"after{i}" for i in range(90)])
    docs = spark.createDataFrame([(1, text(edited)), (2, text(item)), (3, text(item[:24]))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert share >= 0.8 and set(rows) == {1, 2} and rows[1].answer_overlap < 0.8
    assert [r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()] == [3]
