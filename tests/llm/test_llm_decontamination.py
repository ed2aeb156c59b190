import pytest

from goldseam.llm import decontamination as dec

ITEMS = [(0, "yesterday my friend Eve bought 3 apples and 4 pounds of pears for 3 cents in the old town market hall."), (1, "Short text!"), (2, None), (3, "Short text!"), (4, "")]
TEXTS = [
    (1, "Yesterday my friend Anna bought 12 apples and 5 kg of pears for 12 dollars in the old town market hall."),
    (2, "So. YESTERDAY my friend Bob bought 7,5 apples and 9 lbs of pears for 7,5 euros in the old town - market hall. And so on."),
    (3, "Yesterday my friend Bob bought 7 apples and 9 lbs of pears for 8 euros in the old town market hall."),
    (4, None), (5, ""), (6, "short text"), (6, "short text"), (None, "x"), (7, "a short text in more words than one window of eight"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, "h", 1) for r in TEXTS], "doc_id bigint, text string, hash string, n int")


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id int, text string, doc_id int")


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_other_numbers_names_and_units(docs, items, rows):
    found = {(r.doc_id, r.item_id) for r in dec.contamination(docs, items, broadcast_rows=rows).collect()}
    # In the third text the item's repeated value has two values.
    assert found == {(1, 0), (2, 0), (6, 1), (6, 3)}


def test_rows_that_stay(docs, items):
    kept = dec.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 4, 5, 7]


def test_a_hot_window_in_the_shuffled_way(spark, items):
    docs = spark.createDataFrame([(k, TEXTS[0][1] + f" tail {k}") for k in range(1_500)], "doc_id bigint, text string")
    for rows in (1_000_000, 0):
        assert dec.contamination(docs, items, broadcast_rows=rows).count() == 1_500


def test_odd_rows(odd, none, items):
    assert dec.contamination(odd, items).count() == 0
    assert dec.contamination(none, items).count() == 0
    assert dec.contamination(odd, items.where("item_id < 0")).count() == 0
    assert dec.decontaminate(odd, items).count() == 10


def test_no_python_on_the_executors(documents, items, plan):
    text = plan(dec.contamination(documents, items)) + plan(dec.decontaminate(documents, items))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_short_items_inside_longer_documents(spark, rows):
    items = spark.createDataFrame([(0, "What is 12 times 7?"), (1, "Name the capital of France"), (2, "add 4 and 4")], "item_id int, text string")
    texts = ["So we asked: what is 31 times 6? Nobody of us knew that.", "what is 3 times 4", "What is it, times 7", "now add 5 and 5 to all of the other ones", "now add 5 and 6 to all of the other ones"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {(r.doc_id, r.item_id) for r in dec.contamination(docs, items, broadcast_rows=rows, short_items=True).collect()}
    assert found == {(0, 0), (1, 0), (3, 2)}


def test_rows_that_share_an_id_or_lack_one_are_judged_by_their_text(spark, items):
    clean = "Nothing of the kind is written in this text of a few more words."
    rows = [(None, TEXTS[0][1]), (None, clean), (None, TEXTS[1][1]), (None, None), (8, TEXTS[0][1]), (8, clean)]
    kept = dec.decontaminate(spark.createDataFrame(rows, "doc_id bigint, text string"), items)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(None, clean), (None, None), (8, clean)], key=str)
