"""What workers hold in the quality classifier and for ids."""

import public_tokenizers
import pyarrow as pa

from recordlens.llm import quality, transducer

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_few_texts_stand_as_strings_at_once(monkeypatch):
    asked = []

    class Watched:
        def __init__(self, column):
            self.column = column

        def __len__(self):
            return len(self.column)

        def slice(self, at, rows):
            asked.append(len(part := self.column.slice(at, rows)))
            return part

    rows = [(f"text {i}", "en", None, i) for i in range(3 * quality.ROWS + 5)]
    columns = [Watched(pa.array(c)) for c in zip(*rows)]
    assert list(quality._cells(*columns)) == rows
    assert max(asked) <= quality.ROWS


def test_ids_need_no_states():
    transducer.forget(BPE)
    machine = transducer.transducer(BPE, None, False)
    texts = ["one two's\n three", "", "où 日本 <|endoftext|>"]
    assert [x.tolist() for x in machine.encode(texts)] == [list(e.ids) for e in machine.library.encode_batch(texts, add_special_tokens=False)]
    assert not hasattr(machine, "states") and not hasattr(machine, "begins")
    assert transducer.transducer(BPE).counts(texts) == [len(x) for x in machine.encode(texts)]
    transducer.forget(BPE)
