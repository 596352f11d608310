"""Items quoted with slots that do not all agree."""

from tallyline.llm import decontamination

FRONT = "the boy had 12 red marbles in the old wooden box under his bed at home"
BACK = "then the girl next door took 12 of these away to the big school near town"
ITEM = f"{FRONT} before any of them knew about it {BACK}"


def test_inconsistent_slots(spark):
    sums = "if you add 3 small apples to 5 large apples in the basket how many are there"
    benchmark = spark.createDataFrame([(1, ITEM), (2, sums)], "item_id long, text string")
    texts = [
        (1, f"so {FRONT} before any of them knew about it {BACK.replace('12', '31')}"),  # verbatim but for one number
        (2, sums.replace("3", "4").replace("5", "4")),  # two values became one
        (3, f"{FRONT.replace('12', '7')} while none of us heard of this {BACK.replace('12', '8')}"),  # two runs of one alignment
        (4, "if you had 3 small pears and 5 large pears in the basket how many were there"),
    ]
    found = decontamination.matches(decontamination.keyed(spark.createDataFrame(texts, "doc_id long, text string")), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2), (3, 1)}


def test_one_value_for_two_within_a_run(spark):
    item = "so Anna met Bert while Anna saw Carl and Anna told Bert that Anna left"
    mixed = item.replace("Anna", "Dora", 1).replace("Anna", "Emma", 1).replace("Anna", "Fay", 1)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert not decontamination.matches(decontamination.keyed(spark.createDataFrame([(1, mixed)], "doc_id long, text string")), benchmark).count()
