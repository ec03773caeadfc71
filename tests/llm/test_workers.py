from unittest.mock import MagicMock

from matchloom.llm import page_overlap, workers


def test_kept_once_until_dropped():
    made = []
    workers.drop_kept()
    for _ in range(2):
        assert workers.kept("large", lambda: made.append(1) or "it") == "it"
    assert made == [1]
    workers.drop_kept()
    workers.kept("large", lambda: made.append(1))
    assert made == [1, 1]
    workers.drop_kept()


def test_overlap_tasks_drop_what_stages_before_them_kept(spark):
    rows = MagicMock()
    page_overlap.page_sets(rows, 5, MagicMock())
    measure = rows.groupBy.return_value.agg.return_value.mapInArrow.call_args[0][0]
    workers.kept("tokenizer", object)
    assert list(measure(iter([]))) == [] and not workers.KEPT
