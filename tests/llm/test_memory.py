"""What Python workers hold: texts of a block at a time, and nothing of a task that has ended."""

import gc
import weakref

import public_tokenizers
import pyarrow as pa
from recordlens.llm import packing, transducer

BPE = public_tokenizers.path("byte_bpe_50k.json")


class Watched:
    """A batch that notes how many rows are asked for as Python texts at once."""

    def __init__(self, batch, asked):
        self.batch, self.asked, self.num_rows = batch, asked, batch.num_rows

    def slice(self, at, rows):
        return Watched(self.batch.slice(at, rows), self.asked)

    def column(self, k):
        self.asked.append(self.num_rows)
        return self.batch.column(k)


def test_blocks_make_texts_of_a_block_only():
    rows = [(i if i % 7 else None, None if i % 5 == 0 else "x" * (i % 40)) for i in range(3000)]
    whole = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["i", "t"])
    asked = []
    blocks = list(transducer.in_blocks([Watched(whole, asked)] * 2, rows=512))
    assert [(i, t) for b in blocks for i, t in b] == [(i, t or "") for i, t in rows] * 2
    assert max(map(len, blocks)) == 512 and max(asked) <= 512


def test_packing_frees_the_tables_before_it_gives_memory_back(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "three")], "doc_id long, text string")
    made, alive = [], []
    monkeypatch.setattr(packing, "learned", lambda *a: None)
    real = packing.transducer
    monkeypatch.setattr(packing, "transducer", lambda *a: made.append(weakref.ref(m := real(*a))) or m)
    monkeypatch.setattr(packing, "give_back", lambda: (gc.collect(), alive.append(made[-1]() is not None)))
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    taken = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
    packing.pack(docs, BPE, keep=False)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["one two", None, "three"])], names=["doc_id", "text"])
    assert sum(b.num_rows for b in taken[0](iter([batch]))) >= 3
    assert alive == [False]
