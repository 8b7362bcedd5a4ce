from tramline.llm import decontamination


def test_a_hash_goes_to_the_classes_whose_threshold_it_does_not_exceed(spark):
    hashes = spark.createDataFrame([(1, -50), (1, 10), (2, 11), (3, 900), (4, 901)], "doc_id long, h long")
    got = decontamination.dealt(hashes, [(0, 900), (4, 10)])
    assert sorted(map(tuple, got.collect())) == [(1, -50, 0), (1, -50, 4), (1, 10, 0), (1, 10, 4), (2, 11, 0), (3, 900, 0)]
    assert decontamination.dealt(hashes, []).collect() == []


def test_documents_meet_items_by_class_and_hash(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    calls, plain = [], decontamination.dealt
    decontamination.dealt = lambda *a: calls.append(a) or plain(*a)
    try:
        decontamination.contained_items(docs, items)
    finally:
        decontamination.dealt = plain
    assert [c for c, _ in calls[0][1]] == [1]
