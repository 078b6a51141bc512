"""Operators for preparing language-model training text."""

from collections.abc import Callable, Iterator

import pyarrow as pa

BATCH_ROWS = 2_000
OverBatches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def in_pieces(function: OverBatches) -> OverBatches:
    """``function`` over batches of at most ``BATCH_ROWS`` rows: texts may be long.

    Spark bounds a batch by its bytes; this bounds what is worked out of one at once.
    The session's batch size is left as it is.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield batch.slice(at, BATCH_ROWS)

    return lambda batches: function(pieces(batches))
