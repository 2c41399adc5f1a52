import pyarrow as pa

from sparkwarden.llm import workers


def test_one_object_is_kept_and_other_tasks_drop_it():
    made = []
    make = lambda: made.append(1) or {}
    first = workers.kept("a", "x", make)
    assert workers.kept("a", "x", make) is first and len(made) == 1
    assert workers.kept("b", "x", make) is not first and len(workers._KEPT) == 1
    assert list(workers.lean(lambda batches: (b.slice(1) for b in batches))(iter([pa.record_batch({"n": [1, 2]})])))[0].num_rows == 1
    assert not workers._KEPT
