"""Pieces that several corpus operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ASCII white space of the contracts, as a Java/RE2 character class body.
BLANKS = "\\x20\\x09-\\x0D"
#: Rows, and about the bytes, that a kernel is given at once.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """*body* of *value*, which is evaluated once however often *body* uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(column: str = "text") -> Column:
    """The text, with null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def _sizes(column):
    """Bytes of each value of a string or binary column; none for other columns."""
    import numpy as np
    import pyarrow as pa

    width = {pa.string(): np.int32, pa.binary(): np.int32, pa.large_string(): np.int64, pa.large_binary(): np.int64}.get(column.type)
    if width is None or not len(column):
        return None
    return np.diff(np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64))


def sliced(batches: Iterator, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator:
    """The batches in slices, without a copy, of at most *rows* rows, and of few enough that their texts have at most *size* bytes unless it is one."""
    import numpy as np

    for batch in batches:
        held = [s for s in map(_sizes, batch.columns) if s is not None]
        ends = np.cumsum(sum(held)) if held else np.zeros(batch.num_rows, np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = min(max(int(np.searchsorted(ends, before + size, side="right")), start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def map_arrow(df: DataFrame, kernel: Callable[[Iterator], Iterator], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` whose kernel is given slices of at most *rows* rows and about 8 MB of texts.

    Spark's own batches end at ``spark.sql.execution.arrow.maxBytesPerBatch``
    (64 MB) or 10,000 rows; no setting of the session is touched.
    """

    def small(batches):
        return kernel(sliced(batches, rows))

    return df.mapInArrow(small, schema)


def per_process(key: tuple, make: Callable):
    """What *make* returns, made once in each Python process.

    Held outside this package's modules, whose globals travel with each job.
    """
    held = sys.__dict__.setdefault("_ascenta_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


class WordTable(dict):
    """Numbers words as they are met; *describe* gives the values kept for each new word.

    ``numbers(words)`` is then a dictionary lookup a word, and the values are
    numpy columns to index. ``trim`` empties the table once it holds *most* words, so
    its memory is bounded; call it between batches only, as numbers change.
    """

    def __init__(self, describe: Callable[[bytes], tuple[int, ...]], width: int, most: int = 200_000):
        import numpy as np

        self.describe, self.most = describe, most
        self.held = np.zeros((width, 1024), dtype=np.uint64)

    def __missing__(self, word):
        import numpy as np

        self[word] = n = len(self)
        if n == self.held.shape[1]:
            self.held = np.concatenate([self.held, np.zeros_like(self.held)], axis=1)
        self.held[:, n] = self.describe(word)
        return n

    def numbers(self, words: list):
        import numpy as np

        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def columns(self):
        """One unsigned 64-bit column for each value of the words so far."""
        return self.held

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def mixed(x):
    """A bijective mix of unsigned 64-bit numbers (the finalizer of splitmix64), elementwise."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column, null as empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]
