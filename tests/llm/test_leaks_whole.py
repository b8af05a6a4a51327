"""Benchmark items with values of other lengths, in other case, and without a usable window."""

from strandloom.llm import decontaminate


def _found(spark, docs, items):
    d = decontaminate.with_row(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.find_leaks(d, b).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id) for r in rows}


def test_values_of_other_lengths(spark):
    item = "how many trains leave for Paris before noon on a weekday morning"
    trip = "a runner covers 5 km along the river and then 3 kg of fruit in 20 min more"
    docs = [item.replace("Paris", "New York City"), trip.replace("5 km", "7km").replace("3 kg", "40kg").replace("20 min", "9min"), "nothing of that is said here at all"]
    assert _found(spark, docs, [item, trip]) == {(0, 0), (1, 1)}


def test_case_of_names(spark):
    item = "they say Anna met Otto near Bern while Emil left Rome with Ida and Kurt saw Lena go"
    assert _found(spark, [item.lower(), item.upper(), item], [item]) == {(0, 0), (1, 0), (2, 0)}


def test_items_without_a_window(spark):
    items = ["Who directed Star Wars Episode Five", "1 2 3 5 8 13 21", "too short", ""]
    docs = ["Well: who directed Star Wars Episode Five? Nobody knows.", "so 1, 2, 3, 5, 8, 13, 21 it is", "it was Too short.", "too long and short, 1 2 3 5 8 13", None]
    assert _found(spark, docs, items) == {(0, 0), (1, 1), (2, 2)}
