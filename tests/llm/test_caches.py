import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import caches
from gaugeline.llm.quality import context_sums
from gaugeline.llm.sketch_dedup import SetIndex, sketch_documents
from gaugeline.llm.subword import encoder


class Task:
    """Stands for a frame; runs the function it is given in this process, as a task would."""

    def select(self, *columns):
        return self

    def mapInArrow(self, work, kinds):
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c"])], names=["doc_id", "text"])
        self.out = list(work(iter([batch.select(["text"]) if "bucket" in kinds else batch])))
        raise StopIteration


@pytest.mark.parametrize("stage", [sketch_documents, context_sums])
def test_other_stages_do_not_hold_the_encoder(spark, stage):
    assert encoder() is encoder() and list(caches._kept) == [("pieces", None)]
    task = Task()
    with pytest.raises(StopIteration):
        stage(task)
    assert task.out and not caches._kept


def test_one_kind_of_work_is_kept():
    assert caches.kept("a", list) is caches.kept("a", list)
    assert caches.kept("b", dict) == {} and list(caches._kept) == ["b"]
    caches.forget()
    assert not caches._kept


def test_a_set_meets_a_chunk_in_bounded_memory():
    chance = np.random.default_rng(3)
    large = np.unique(chance.integers(0, 2**63, 20_000).astype(np.uint64))
    some = [large[: 20_000 - 10 * k] for k in range(256)] + [large[:9], large[10_000:]]
    index = SetIndex(list(range(len(some))), some)
    want = [k for k, x in enumerate(some) if 100 * len(np.intersect1d(x, large)) >= 80 * len(np.union1d(x, large))]
    tracemalloc.start()
    try:
        assert index.similar(large, 80) == want
        assert index.similar(np.array([1], np.uint64), 80) == []
        assert tracemalloc.get_traced_memory()[1] < 48 << 20
    finally:
        tracemalloc.stop()
    assert 0 < len(want) < len(some)
