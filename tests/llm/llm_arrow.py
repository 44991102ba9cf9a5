"""Arrow batches for functions that run inside tasks."""

import pyarrow as pa


def batch_of(texts):
    return pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
