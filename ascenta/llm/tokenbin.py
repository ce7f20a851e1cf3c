"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length coding."""

from __future__ import annotations

import itertools
import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_path
from .common import map_arrow, per_process, texts_of

#: Token ids of documents in one block of a file, about.
BLOCK_TOKENS = 1 << 18


@dataclass(frozen=True)
class TokenFiles:
    """Where an encoded corpus lies: blocks as Parquet rows, and the id of each rank."""

    path: str
    ranks: bytes


def encode_ranks(ranks) -> tuple[bytes, bytes]:
    """Control and data bytes of small non-negative numbers.

    Each number takes 1 to 4 little-endian bytes; the control bytes hold the
    length less one of four numbers each, lowest bits first.
    """
    import numpy as np

    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    length = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = length - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    keep = np.arange(4) < length[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def _tables():
    """For each control byte, the lengths of its four numbers."""
    import numpy as np

    byte = np.arange(256)
    return np.stack([(byte >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.uint8)


def decode_ranks(control: bytes, data: bytes, count: int):
    """The numbers that :func:`encode_ranks` coded, by table lookup of each control byte."""
    import numpy as np

    if not count:
        return np.zeros(0, np.uint32)
    lengths = per_process(("lengths",), _tables)[np.frombuffer(control, np.uint8)].reshape(-1)[:count].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = raw[starts]
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        out[more] |= raw[starts[more] + k] << np.uint32(8 * k)
    return out


def _tokenizer(path: str):
    """The tokenizer as its file sets it."""

    def make():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs in parallel
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return per_process(("tokenizer", path), make)


#: Words of letters alone that no normalisation joins, parts or turns into marks.
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_kinds():
    """For each byte: 0 blank, 1 ASCII small letter or digit, 2 ASCII mark other than the apostrophe, 3 any other."""
    import numpy as np

    kinds = np.full(256, 3, np.uint8)
    for kind, held in enumerate((b" \t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz0123456789", b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")):
        kinds[list(held)] = kind
    return kinds


def _words(texts: list[bytes]):
    """All words of lower-case texts in order, as an Arrow array, and how many each text has.

    Words are parted at blanks, and before marks at the end of a word after an ASCII letter or digit, which the splitter
    parts from it; the apostrophe is not among them.
    """
    import numpy as np
    import pyarrow as pa

    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)  # a blank before and after each
    kind = per_process(("byte kinds",), _byte_kinds)[data]
    held, mark = kind != 0, kind == 2
    begins = np.zeros(len(data), bool)
    begins[1:] = held[1:] & ~held[:-1]
    edges = np.flatnonzero(mark[1:] != mark[:-1]) + 1  # first of each run of marks and what follows it, in turn
    first, after = edges[0::2], edges[1::2]
    begins[first[(kind[first - 1] == 1) & (kind[after] == 0)]] = True
    starts = np.flatnonzero(begins)
    letters = data[held]
    offsets = np.append(np.flatnonzero(begins[held]), len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


class _TokenTable(dict):
    """The ids of words, by the words' bytes.

    The tokenizer's normaliser and splitter drop white space and look at nothing
    across it, so a text's ids are those of its words in order, marks at a word's
    end being a word of their own. A batch's words are numbered by Arrow, each distinct one is looked up
    once, and each that is new goes through the library once. Texts that hold the string of an added
    token, which the library looks for before it parts words, go through it whole.
    Beyond *most* words the table is emptied.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        import numpy as np

        self.own, self.most = _tokenizer(path), most
        vocabulary = self.own.get_vocab()
        self.kind = np.dtype("<u2" if self.own.get_vocab_size() <= 1 << 16 else "<u4")
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # Compared in lower case: a text whose string differs from a token's in case alone goes whole as well.
        self.added = [a.content.lower().encode() for a in self.own.get_added_tokens_decoder().values()]
        self._empty()

    def _empty(self) -> None:
        import numpy as np

        self.clear()
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0
        self.place = np.zeros((2, 1 << 14), np.int64)  # start and length of each word's ids

    def _add(self, words: list[bytes], lengths, ids) -> None:
        import numpy as np

        first, end = len(self), len(self) + len(words)
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.place.shape[1] < end:
            self.place = np.concatenate([self.place, np.zeros_like(self.place)], axis=1)
        self.place[:, first:end] = self.used + np.cumsum(lengths) - lengths, lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.update(zip(words, range(first, end), strict=True))

    def _learn(self, words: list[bytes]) -> None:
        """Ids of new words from the library."""
        import numpy as np

        texts = [w.decode() for w in words]
        plain = np.array([_PLAIN(t) is not None for t in texts], bool)
        if plain.any():  # in one text: each is one word to the splitter, and its last id says so
            ids = np.array(self.own.encode_batch_fast([" ".join(itertools.compress(texts, plain))], add_special_tokens=False)[0].ids, np.int64)
            lengths = np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)
            self._add(list(itertools.compress(words, plain)), lengths, ids)
        rest = list(itertools.compress(texts, ~plain))
        if rest:
            each = [e.ids for e in self.own.encode_batch_fast(rest, add_special_tokens=False)]
            self._add(list(itertools.compress(words, ~plain)), np.array([len(i) for i in each]), np.fromiter(itertools.chain.from_iterable(each), np.int64))

    def encode(self, texts: list[bytes]):
        """All ids of the texts, and how many each has."""
        import numpy as np

        if len(self) > self.most:
            self._empty()
        # The normaliser lower-cases; of ASCII letters that needs no context.
        low = [t.lower() for t in texts]
        whole = {i for i, t in enumerate(low) if any(a in t for a in self.added)}
        words, held = _words([b"" if i in whole else t for i, t in enumerate(low)])
        coded = words.dictionary_encode()  # so each distinct word is looked up once
        own = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.get, own, itertools.repeat(-1)), np.int64, len(own))
        new = np.flatnonzero(numbers < 0).tolist()
        if new:
            self._learn([own[i] for i in new])
            numbers[new] = [self[own[i]] for i in new]
        starts, lengths = self.place[:, numbers[coded.indices.to_numpy()]]
        ends = np.cumsum(lengths)
        ids = self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]
        counts = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(held)])])
        if not whole:
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in whole:
            parts[i] = np.array(self.own.encode(texts[i].decode(), add_special_tokens=False).ids, self.kind)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def tokenize(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of id and token_ids, packed little-endian 16-bit where the vocabulary allows, else 32-bit.

    The ids are those the library gives for each whole text with its file's
    settings; the string of an added token in a text is that token. Null text
    counts as empty and has the end id alone; an empty table gives no rows. Each task ends with one
    more row, whose counts (null in all others) are how often it met each id, packed 64-bit.
    """
    kind = df.schema[id_col].dataType.simpleString()
    vocabulary = _tokenizer(tokenizer_path).get_vocab_size()
    narrow, size = vocabulary <= 1 << 16, max(vocabulary, end_id + 1)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        wide = np.dtype("<u2" if narrow else "<u4")
        total = np.zeros(size, np.int64)
        table = per_process(("tokens", tokenizer_path), lambda: _TokenTable(tokenizer_path))
        for batch in batches:
            ids, counts = table.encode(texts_of(batch.column(1)))
            ends = np.cumsum(counts)
            with_end = np.insert(ids, ends, end_id).astype(wide)
            offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * wide.itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(with_end.tobytes())])
            total += np.bincount(with_end, minlength=size)
            id_type = batch.column(0).type
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.nulls(len(counts), pa.binary())], ["id", "token_ids", "counts"])
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([total.tobytes()])], ["id", "token_ids", "counts"])

    # Many rows at once, as a word is looked up once a batch; 8 MB of texts bound it.
    return map_arrow(df.select(id_col, text_col), kernel, f"id {kind}, token_ids binary, counts binary", rows=4096)


def _counts(rows: DataFrame, size: int):
    """How often each id occurs, from the tasks' counts."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.frombuffer(packed, np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["token", "n"])

    import numpy as np

    summed = map_arrow(rows, kernel, "token int, n long", rows=16).groupBy("token").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    out = np.zeros(size, np.int64)
    for token, n in summed:
        out[token] = n
    return out


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> TokenFiles:
    """Encode every text and write the ids under *path*, in ascending order of id.

    Texts are tokenized once, with *end_id* after each, and staged. A count of all
    ids ranks them, the most frequent first, so common ids take one byte. The
    staged rows are dealt to *shards* by ranges of the id (null ids first; rows of
    equal id by a hash of their ids, then by their ids) and each shard becomes
    blocks of about 262,144 ids: the documents' ids and lengths, the control
    bytes and the data bytes. Both steps are written by Spark's committer, so lost
    executors leave no half file. A text longer than a block has a block of its own.
    """
    import numpy as np

    spark = df.sparkSession
    vocabulary = _tokenizer(tokenizer_path).get_vocab_size()
    size, wide = max(end_id + 1, vocabulary), np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    kind = df.schema[id_col].dataType
    tokenize(df, tokenizer_path, end_id, id_col, text_col).write.option("compression", "zstd").parquet(f"{path}/staged")
    fields = [T.StructField("id", kind), T.StructField("token_ids", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    rows = spark.read.schema(T.StructType(fields)).parquet(f"{path}/staged")
    counts = _counts(rows.where("counts IS NOT NULL").select("counts"), size)
    staged = rows.where("counts IS NULL").select("id", "token_ids")
    order = np.lexsort((np.arange(size), -counts))  # the id of each rank
    rank_of = np.empty(size, np.uint32)
    rank_of[order] = np.arange(size)
    ranks = spark.sparkContext.broadcast(rank_of.tobytes())  # 4 bytes for each id of the vocabulary
    limit = BLOCK_TOKENS * wide.itemsize

    def kernel(batches):
        import pyarrow as pa

        rank = np.frombuffer(ranks.value, np.uint32)
        first, ids, parts, held, shard, id_type = 0, [], [], 0, 0, None

        def block():
            tokens = np.concatenate([np.frombuffer(p, wide) for p in parts])
            control, data = encode_ranks(rank[tokens])
            lengths = np.array([len(p) // wide.itemsize for p in parts], "<i8")
            columns = [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([lengths.tobytes()]), pa.array([len(tokens)], pa.int64()), pa.array([control]), pa.array([data])]
            return len(tokens), pa.RecordBatch.from_arrays(columns, ["shard", "first", "ids", "lengths", "n_tokens", "control", "data"])

        for batch in batches:
            id_type = batch.column(0).type
            for i, p, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and held + len(p) > limit:
                    count, out = block()
                    yield out
                    first, ids, parts, held = first + count, [], [], 0
                shard = own
                ids.append(i)
                parts.append(p)
                held += len(p)
        if ids:
            yield block()[1]

    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_by = [F.col("id").asc_nulls_first(), F.xxhash64("token_ids")]
    # Range partitions are in order of id, so the partition's number is the shard.
    dealt = staged.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by, "token_ids").withColumn("shard", F.spark_partition_id())
    coded = map_arrow(dealt, kernel, f"shard int, first long, ids array<{kind.simpleString()}>, lengths binary, n_tokens long, control binary, data binary")
    coded.write.option("compression", "none").parquet(f"{path}/blocks")
    return TokenFiles(path, order.astype("<u4").tobytes())


def read_tokens(spark: SparkSession, files: TokenFiles, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start (ids of all documents before it), n_tokens and token_ids (packed 32-bit)."""
    blocks = spark.read.parquet(f"{files.path}/blocks")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    # One row for each shard, whose number is a parameter of the writer: it may be broadcast.
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("all"))
    earlier = F.coalesce(F.sum("all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = blocks.join(F.broadcast(shards.select("shard", earlier.alias("earlier"))), "shard").withColumn("first", F.col("first") + F.col("earlier"))
    ranks = spark.sparkContext.broadcast(files.ranks)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        of_rank = np.frombuffer(ranks.value, "<u4")
        for batch in batches:
            id_type = batch.column(1).type.value_type
            for first, ids, lengths, count, control, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = of_rank[decode_ranks(control, data, count)].astype("<u4")
                n = np.frombuffer(lengths, "<i8")
                ends = np.cumsum(n)
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype("<i4").tobytes()), pa.py_buffer(tokens.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(first + ends - n, pa.int64()), pa.array(n, pa.int64()), packed], ["id", "start", "n_tokens", "token_ids"])

    out = map_arrow(placed.select("first", "ids", "lengths", "n_tokens", "control", "data"), kernel, f"id {kind}, start long, n_tokens long, token_ids binary", rows=16)
    return out.withColumnRenamed("id", id_col)


def encode_corpus(df: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Write the ids of *df* to new files in the shared folder and read them back: *id_col*, start, n_tokens and token_ids.

    Null and empty texts have the end id alone; null ids come first; of rows of
    equal id, the order is that of a hash of their ids, so rows that repeat both
    id and text are interchangeable; very long texts have a block of their own; an empty
    table gives an empty result. Only id and text are read. The files are
    written when this is called, and stay until ``storage.release``.
    """
    spark = df.sparkSession
    return read_tokens(spark, write_tokens(df, new_path(spark, "tokens"), tokenizer_path, end_id, id_col, text_col, shards), id_col)
