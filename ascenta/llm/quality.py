"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordTable, map_arrow, mixed, per_process, texts_of

_RUNS = ((re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"))


@dataclass(frozen=True)
class Settings:
    """What fixes a model: hashing, the leader's rates and penalties, and the bound on training rows."""

    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 3
    scale: float = 8.0
    #: At most this many labelled documents train the model, those with the smallest hashed ids.
    train_rows: int = 6000


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0; a null id never is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _describe(word: bytes) -> tuple[int, int]:
    import xxhash

    shape = word
    for pattern, mark in _RUNS:
        shape = pattern.sub(mark, shape)
    return xxhash.xxh3_64_intdigest(word.lower()), xxhash.xxh3_64_intdigest(shape, 1)


def _tokens(text: bytes, table: WordTable):
    return table.numbers(text.split())


def ngram_slots(text: bytes, table: WordTable, bits: int):
    """Hashed slots of a text's word n-grams, one array for each view.

    Views: words; word pairs; shapes (case, digits, marks) of words; shape pairs;
    and whether a word repeats the word before it.
    """
    import numpy as np

    n = _tokens(text, table)
    if not len(n):
        return []
    word, shape = (c[n] for c in table.columns())
    shift = np.uint64(64 - bits)
    slot = lambda x, view: (mixed(x + np.uint64(view)) >> shift).astype(np.int64)
    views = [slot(word, 1), slot(shape, 2)]
    if len(n) > 1:
        pair = lambda x: x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:]
        views += [slot(pair(word), 3), slot(pair(shape), 4), slot((n[1:] == n[:-1]).astype(np.uint64), 5)]
    return views


def _sparse(views, scale: float):
    """Slots and values of a text: in each view, the share of each slot times *scale*."""
    import numpy as np

    if not views:
        return np.zeros(0, np.int64), np.zeros(0)
    slots = np.concatenate(views)
    weights = np.concatenate([np.full(len(v), scale / len(v)) for v in views])
    found, where = np.unique(slots, return_inverse=True)
    return found, np.bincount(where, weights, len(found))


def train(examples, settings: Settings):
    """Weights after FTRL-proximal updates over *examples*: (slots, values, label); the last weight is the bias."""
    import numpy as np

    size = 1 << settings.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * settings.l1) / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)
        return np.where(np.abs(z[at]) <= settings.l1, 0.0, w)

    for _ in range(settings.epochs):
        for slots, values, label in examples:
            at, x = np.append(slots, size), np.append(values, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += g * g
    return weights(np.arange(size + 1)).astype("<f4")


def train_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> bytes:  # noqa: B008
    """Weights of a model of *label_col* (0 or 1), as packed 32-bit floats.

    Trains on whole texts of at most ``settings.train_rows`` labelled documents
    that aren't held out, taken by hashed id, in that order: the bound makes one
    task's memory and time independent of the table. A document with several
    labels counts with its largest. Rows without a text, id or valid label don't train;
    with nothing to train on the weights are all zero, so every score is 0.5.
    """
    own = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("double").alias("label"))
    own = own.where(~held_out(id_col)).withColumn("key", F.xxhash64(id_col)).orderBy("key", id_col).limit(settings.train_rows)
    # The limit bounds the chosen rows, so their ids may be sent to every task.
    chosen = docs.select(id_col, text_col).where(F.col(text_col).isNotNull()).join(F.broadcast(own), id_col)

    def features(batches):
        import pyarrow as pa

        table = WordTable(_describe, 2)
        for batch in batches:
            rows = [_sparse(ngram_slots(t, table, settings.bits), settings.scale) for t in texts_of(batch.column(2))]
            table.trim()
            slots, values = (pa.array([r[k].astype(kind).tobytes() for r in rows], pa.binary()) for k, kind in enumerate(("<u4", "<f4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), slots, values], ["key", "label", "slots", "values"])

    def fit(batches):
        import numpy as np
        import pyarrow as pa

        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        examples = [(np.frombuffer(s, "<u4").astype(np.int64), np.frombuffer(v, "<f4").astype(float), y) for _, y, s, v in rows]
        yield pa.RecordBatch.from_arrays([pa.array([train(examples, settings).tobytes()], pa.binary())], ["weights"])

    sparse = map_arrow(chosen.select("key", "label", text_col), features, "key long, label double, slots binary, values binary")
    return bytes(map_arrow(sparse.repartition(1), fit, "weights binary").first()[0])


def score_quality(docs: DataFrame, weights: bytes, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:  # noqa: B008
    """One row per input row: *id_col*, held_out, score and predicted (1 from *threshold* up).

    The score is the logistic of the sparse dot product of the whole text's hashed
    n-grams with the weights. Null and empty texts have no n-grams and get the
    bias alone. Only id and text are read; the id is no input of the score.
    """
    kind = docs.schema[id_col].dataType
    held = docs.sparkSession.sparkContext.broadcast(weights)  # 4 bytes for each of 2^bits slots
    key = ("quality", hash(weights))

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        w = per_process(key, lambda: np.frombuffer(held.value, "<f4").astype(float))
        table = WordTable(_describe, 2)
        for batch in batches:
            dots = [sum(w[v].mean() for v in ngram_slots(t, table, settings.bits)) for t in texts_of(batch.column(2))]
            table.trim()
            scores = 1 / (1 + np.exp(-np.clip(settings.scale * np.array(dots) + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    out = map_arrow(docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")), kernel, f"id {kind.simpleString()}, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast(T.IntegerType()).alias("predicted"))
