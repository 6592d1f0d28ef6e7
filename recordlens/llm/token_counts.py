"""Token counts of whole texts by a compiled tokenizer."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import reach_package
from recordlens.llm.transducer import in_blocks, transducer


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, without special tokens added.

    A byte-level BPE file (.json) is compiled into a transducer, each worker for
    itself; other .json files go to the tokenizers library and .model files to
    sentencepiece, text by text. Rows are counted where they lie: no shuffle.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated
    rows are counted one by one; an empty table gives no rows; other columns are ignored.
    """

    reach_package(docs.sparkSession)

    def run(batches):
        if tokenizer.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
            count = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            count = transducer(tokenizer).counts
        for block in in_blocks(batches):
            texts = [t for _, t in block]
            tokens = count(texts)
            cols = [
                pa.array([i for i, _ in block], pa.int64()),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
