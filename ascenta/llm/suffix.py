"""Suffix-array dedup: a distributed, common-prefix-aware merge sort of sampled suffixes.

Every window of ``length`` bytes is assigned to the least-hashed of the 24-byte
strings in it (its anchor), which depends on the window's bytes alone. So equal
windows have equal anchors at equal offsets, and only suffixes at anchors, about
2.6 % of all, take part in the sort. Those whose anchor occurs once are dropped;
the rest are cut to the bytes of their windows, sorted in runs, front-coded and
merged by loser trees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize
from .common import map_arrow, mixed, texts_of, whole_text

#: Bytes of an anchor.
GRAM = 24
#: Bytes handled at once when anchors are sought; longer texts go in pieces that overlap by a window.
PIECE = 1 << 20
#: Anchors, and suffixes, of one sorted run.
RUN_ANCHORS, RUN_SUFFIXES = 400_000, 60_000
#: One of so many documents is looked at for frequent anchors, which windows avoid where they can.
SAMPLE, FREQUENT, MOST_FREQUENT = 64, 32, 200_000
_M = 0x9E3779B97F4A7C15


def _window_hashes(data, length: int):
    """64-bit hashes of all strings of *length* bytes in *data*, by doubling."""
    import numpy as np

    table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_M))
    level, size, out, done = table[data], 1, None, 0
    while True:
        if length & size:
            if out is None:
                out, done = level, size
            else:  # the part so far, then the next size bytes
                n = len(data) - done - size + 1
                out = mixed(out[:n] * np.uint64(_M) + level[done : done + n])
                done += size
        if done == length:
            return out
        n = len(level) - size
        level = level[:n] * np.uint64(_M + 2 * size) + level[size:]
        size *= 2


def _least(keys, width: int):
    """The least of each *width* neighbours."""
    import numpy as np

    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[: len(keys) - size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def anchors(data, starts, ends, length: int, frequent=None):
    """Anchors of the texts data[starts:ends]: text, first and last window start, anchor's offset in data, and hash.

    Windows with the same anchor in a row are one row. Anchors in *frequent*
    (sorted hashes) are taken only by windows that hold no other.
    """
    import numpy as np

    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    grams = mixed(_window_hashes(data, GRAM))
    rank = grams >> np.uint64(1)
    if frequent is not None and len(frequent):
        maybe = np.zeros(1 << 20, bool)
        maybe[frequent >> np.uint64(44)] = True
        hits = np.flatnonzero(maybe[grams >> np.uint64(44)])
        at = np.searchsorted(frequent, grams[hits])
        hits = hits[frequent[np.minimum(at, len(frequent) - 1)] == grams[hits]]
        rank[hits] |= np.uint64(1 << 63)
    keys = (rank & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(rank), dtype=np.uint64)
    anchor = (_least(keys, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(len(anchor), np.int32)
    long = ends - starts >= length
    which = np.flatnonzero(long)
    if not len(which):
        return none, none, none, none, none.astype(np.uint64)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, starts[which], which.astype(np.int32) + 1)
    np.add.at(edge, ends[which] - length + 1, -(which.astype(np.int32) + 1))
    valid = np.cumsum(edge)[: len(anchor)]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
    real = valid[first] > 0
    first, last = first[real], last[real]
    at = anchor[first]
    return valid[first].astype(np.int64) - 1, first, last, at, grams[at]


def _pieces(texts: list[bytes], length: int):
    """Groups of (text number, offset, bytes) of about PIECE bytes; long texts in overlapping parts."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            part = t[at : at + PIECE + length - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _found(docs, texts: list[bytes], length: int, frequent=None):
    """Anchors of texts as columns: document, context's start and length, anchor's offset in it, hash."""
    import numpy as np

    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        sizes = np.array([len(p) for _, _, p in group], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        text, first, last, at, gram = anchors(data, starts, ends, length, frequent)
        offset = np.array([o for _, o, _ in group], np.int64) - starts
        doc = docs[np.array([i for i, _, _ in group], np.int64)]
        yield doc[text], (first + offset[text]).astype(np.int64), (last - first + length).astype(np.int64), (at - first).astype(np.int64), gram


_ENTRY = [("doc", "<i8"), ("start", "<u4"), ("size", "<u2"), ("left", "<u1"), ("gram", "<u8")]
_SPAN = [("doc", "<i8"), ("start", "<u4"), ("end", "<u4")]


def _packed(array) -> bytes:
    """A structured array column by column, compressed."""
    import numpy as np
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(array[n]).tobytes() for n in array.dtype.names))


def _unpacked(blob: bytes, kind):
    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    dtype = np.dtype(kind)
    out = np.empty(len(raw) // dtype.itemsize, dtype)
    at = 0
    for n in dtype.names:
        size = dtype[n].itemsize * len(out)
        out[n] = np.frombuffer(raw, dtype[n], len(out), at)
        at += size
    return out


def _labels(spark: SparkSession, parts: int) -> list[int]:
    """A label for each partition that Spark's hash partitioning sends there, so that every one gets its share."""
    sent = spark.range(64 * parts + 64).select(F.col("id").cast("int").alias("label")).withColumn("part", F.pmod(F.hash("label"), F.lit(parts)))
    found = {r.part: r.label for r in sent.groupBy("part").agg(F.min("label").alias("label")).collect()}  # one row a partition
    return [found.get(p, -1 - p) for p in range(parts)]


def _place(docs, labels):
    """The label of each document's partition."""
    import numpy as np

    return np.array(labels)[(mixed(docs.astype(np.int64).view(np.uint64) + np.uint64(_M)) % np.uint64(len(labels))).astype(np.int64)]


def _gram_place(grams, labels):
    """The label of each anchor's partition."""
    import numpy as np

    return np.array(labels)[(grams % np.uint64(len(labels))).astype(np.int64)]


def _dealt(array, place):
    """(partition, part of the array) for each partition with rows."""
    import numpy as np

    if not len(place):
        return
    by = np.argsort(place, kind="stable")
    array, place = array[by], place[by]
    cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    for a, b in zip(cuts, [*cuts[1:], len(place)], strict=True):
        yield int(place[a]), array[a:b]


_ROW = "part int, kind int, doc long, blob binary"


def _batch(rows):
    import pyarrow as pa

    part, kind, doc, blob = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(doc, pa.int64()), pa.array(blob, pa.binary())], ["part", "kind", "doc", "blob"])


def _flush(rows, size: int = 8 << 20):
    """Batches of rows with about *size* bytes."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += len(r[3])
        if total >= size:
            yield _batch(held)
            held, total = [], 0
    if held:
        yield _batch(held)


def _grouped(batches):
    """(part, iterator of (kind, doc, blob)) for rows that arrive sorted by part, kind and doc; each iterator must be used up."""
    import itertools

    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    for part, group in itertools.groupby(rows(), key=lambda r: r[0]):
        yield part, (r[1:] for r in group)


class SuffixRun:
    """A sorted run of suffixes, front-coded: the bytes each shares with the one before are left out."""

    #: The anchor's hash comes first, then the bytes from the anchor on, those before it, the nearest first, and how many of the latter and the former there are.
    GRAM_BYTES = 8
    EXTRA = GRAM_BYTES + 2

    @staticmethod
    def encode(keys, lengths, spans) -> bytes:
        """*keys*: sorted rows of bytes, zero-padded; *lengths*; *spans*: document and start of each."""
        import numpy as np
        import zstandard

        shared = np.zeros(len(keys), np.int64)
        if len(keys) > 1:
            differs = keys[1:] != keys[:-1]
            first = np.where(differs.any(axis=1), differs.argmax(axis=1), keys.shape[1])
            shared[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
        column = np.arange(keys.shape[1])
        tails = keys[(column >= shared[:, None]) & (column < lengths[:, None])]
        raw = np.uint32(len(keys)).tobytes() + shared.astype("<u2").tobytes() + lengths.astype("<u2").tobytes() + spans["doc"].tobytes() + spans["start"].tobytes() + tails.tobytes()
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @staticmethod
    def decode(blob: bytes):
        """(shared bytes, suffix, document, start) of each suffix, in order."""
        import numpy as np
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        at = 4
        columns = []
        for kind in ("<u2", "<u2", "<i8", "<u4"):
            columns.append(np.frombuffer(raw, kind, n, at).tolist())
            at += np.dtype(kind).itemsize * n
        last = b""
        for shared, length, doc, start in zip(*columns, strict=True):
            last = last[:shared] + raw[at : at + length - shared]
            at += length - shared
            yield shared, last, doc, start


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes *a* and *b* share, of which *at* are known."""
    n = min(len(a), len(b))
    while at < n and a[at : at + 16] == b[at : at + 16]:
        at += 16
    at = min(at, n)
    while at < n and a[at] == b[at]:
        at += 1
    return at


def merge_runs(runs):
    """(shared bytes with the one before, suffix, document, start) over all sorted runs, in order.

    A loser tree whose entries know what they share with the last suffix put out:
    of two, the one that shares more comes first, with no byte looked at; only
    equals are compared, from the first unknown byte on, and the loser keeps what it
    shares with the winner.
    """
    heads = [next(r, None) for r in runs]
    size = 1
    while size < max(1, len(runs)):
        size *= 2
    heads += [None] * (size - len(runs))
    known = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        s, t = x[1], y[1]
        n = _common(s, t, known[a])
        if n < len(s) and n < len(t):
            first = s[n] < t[n]
        elif len(s) != len(t):
            first = len(s) < len(t)
        else:
            first = x[2:] <= y[2:]
        known[b if first else a] = n
        return (a, b) if first else (b, a)

    winners = [0] * (2 * size)
    winners[size:] = range(size)
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1]
    while heads[top] is not None:
        head = heads[top]
        yield known[top], head[1], head[2], head[3]
        heads[top] = new = next(runs[top], None)
        known[top] = new[0] if new else 0
        node = (size + top) >> 1
        while node:
            other = losers[node]
            if (new := heads[top]) is not None and known[top] > known[other] or heads[other] is None:
                pass
            else:
                top, losers[node] = play(top, other)
            node >>= 1


def _repeated_windows(items, length: int):
    """Spans (document, start, end) of the windows in *items* that an earlier one equals.

    *items*: (suffix, document, start, bytes shared with the item before) in the
    merged order. A window with *o* bytes before its anchor equals another where the
    two share ``length - o`` bytes from the anchor on and *o* bytes before it. The
    first is so where no item between them in the merged order shares less with
    its neighbour; for the second, the bytes before the anchor are sorted in the
    same way. So equality is decided by prefix lengths of compared bytes, by no hash.
    """
    import numpy as np

    n, gram = len(items), SuffixRun.GRAM_BYTES
    right, left = (np.array([s[-k] for s, *_ in items], np.int64) for k in (1, 2))
    doc, base = (np.array([x[k] for x in items], np.int64) for k in (1, 2))
    from_anchor = np.array([x[3] for x in items], np.int64) - gram
    from_anchor[0] = -1
    group = np.cumsum(from_anchor < 0)
    # Bytes before the anchor, the nearest first, behind the group's number.
    width = max(1, int(left.max())) + 4
    rows = np.frombuffer(b"".join([s[gram + r : -2].ljust(width - 4, b"\0") for (s, *_), r in zip(items, right.tolist(), strict=True)]), np.uint8).reshape(n, width - 4)
    rows = np.ascontiguousarray(np.concatenate([group.astype(">u4").view(np.uint8).reshape(n, 4), rows], axis=1))
    order = np.argsort(rows.view(f"S{width}").reshape(-1), kind="stable")
    differs = rows[order[1:]] != rows[order[:-1]]
    before_anchor = np.concatenate([[-1], np.where(differs.any(axis=1), differs.argmax(axis=1), width) - 4])
    place = np.empty(n, np.int64)
    place[np.lexsort((base + left, doc))] = np.arange(n)
    again = np.zeros((n, length - GRAM + 3), np.int8)  # a column for each o, and one on either side
    for o in range(length - GRAM + 1):
        some = np.flatnonzero((left >= o) & (right >= length - o))
        if len(some) < 2:
            continue
        behind = np.empty(n, np.int64)
        behind[order] = np.cumsum(before_anchor < o)
        key = np.cumsum(from_anchor < length - o)[some] * (n + 1) + behind[some]
        by = np.argsort(key * n + place[some])  # of equal windows the earliest comes first
        same = np.flatnonzero(key[by[1:]] == key[by[:-1]]) + 1
        again[some[by[same]], o + 1] = 1
    edge = np.diff(again, axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    out = np.empty(len(row), _SPAN)
    out["doc"] = doc[row]
    out["start"], out["end"] = base[row] + left[row] - (last - 1), base[row] + left[row] - first + length
    return out


def _exchange(rows: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by their label, in an order that their bytes fix: a task that runs again must cut the same runs."""
    return rows.repartition(parts, "part").sortWithinPartitions("part", "kind", "doc", "blob")


def _mark(df: DataFrame, length: int, labels: list[int]) -> DataFrame:
    """Repeated spans of *df* (doc: unique long, text), dealt by document: rows of kind 0."""
    spark = df.sparkSession

    def sampled(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for found in _found(np.array(batch.column(0).to_pylist(), np.int64), texts_of(batch.column(1)), length):
                yield pa.RecordBatch.from_arrays([pa.array(found[4].view(np.int64))], ["gram"])

    some = map_arrow(df.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0), sampled, "gram long")
    top = some.groupBy("gram").count().where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "gram").limit(MOST_FREQUENT)
    frequent = spark.sparkContext.broadcast([r[0] for r in top.select("gram").collect()])  # bounded by MOST_FREQUENT

    def often():
        import numpy as np

        return np.sort(np.array(frequent.value, np.int64).view(np.uint64))

    def seek(batches):
        """Anchors in runs sorted by hash, dealt by it; those known to be frequent need no partner and are dealt by document."""
        import numpy as np

        known = often()

        def run(held):
            entries = np.empty(sum(len(x[0]) for x in held), _ENTRY)
            for k, name in enumerate(("doc", "start", "size", "left", "gram")):
                entries[name] = np.concatenate([x[k] for x in held])
            entries = entries[np.argsort(entries["gram"], kind="stable")]
            sure = np.zeros(len(entries), bool)
            if len(known):
                at = np.minimum(np.searchsorted(known, entries["gram"]), len(known) - 1)
                sure = known[at] == entries["gram"]
            for kind, some in ((0, entries[sure]), (1, entries[~sure])):
                place = _place(some["doc"], labels) if kind == 0 else _gram_place(some["gram"], labels)
                for part, those in _dealt(some, place):
                    yield part, kind, None, _packed(those)

        held, size = [], 0
        for batch in batches:
            for found in _found(np.array(batch.column(0).to_pylist(), np.int64), texts_of(batch.column(1)), length, known):
                held.append(found)
                size += len(found[0])
                if size >= RUN_ANCHORS:
                    yield from _flush(run(held))
                    held, size = [], 0
        if size:
            yield from _flush(run(held))

    def pair(batches):
        """Of the anchors of one hash range, those that occur again, dealt by document."""
        import numpy as np

        for _, rows in _grouped(batches):
            singles = []
            for kind, _, blob in rows:
                if kind == 0:
                    sure = _unpacked(blob, _ENTRY)
                    yield from _flush((part, 0, None, _packed(those)) for part, those in _dealt(sure, _place(sure["doc"], labels)))
                else:
                    singles.append(_unpacked(blob, _ENTRY))
            if singles:
                entries = np.concatenate(singles)
                entries = entries[np.argsort(entries["gram"], kind="stable")]
                same = np.concatenate([[False], entries["gram"][1:] == entries["gram"][:-1]])
                entries = entries[same | np.concatenate([same[1:], [False]])]
                yield from _flush((part, 0, None, _packed(those)) for part, those in _dealt(entries, _place(entries["doc"], labels)))

    def cut(batches):
        """Suffixes at anchors that occur again, in sorted front-coded runs dealt by hash; equal ones become spans here."""
        import numpy as np
        import zstandard

        def run(held):
            most = max(int(e["size"].max()) for e, _ in held)
            width = SuffixRun.EXTRA + most
            keys, spans = [], []
            for entries, text in held:
                data = np.frombuffer(text, np.uint8)
                left, right = entries["left"].astype(np.int64), entries["size"].astype(np.int64) - entries["left"]
                anchor = entries["start"].astype(np.int64) + left
                column = np.arange(most)
                at = np.where(column < right[:, None], anchor[:, None] + column, anchor[:, None] - 1 - (column - right[:, None]))
                key = np.zeros((len(entries), width), np.uint8)
                key[:, : SuffixRun.GRAM_BYTES] = entries["gram"].astype(">u8").view(np.uint8).reshape(-1, 8)
                key[:, SuffixRun.GRAM_BYTES : -2] = np.where(column < entries["size"][:, None], data[np.clip(at, 0, len(data) - 1)], 0)
                end = entries["size"].astype(np.int64) + SuffixRun.GRAM_BYTES
                each = np.arange(len(entries))
                key[each, end], key[each, end + 1] = left, right  # the last byte is never 0, so padding sorts as no bytes
                keys.append(key)
                spans.append(entries)
            keys, spans = np.ascontiguousarray(np.concatenate(keys)), np.concatenate(spans)
            order = np.lexsort((spans["start"], spans["doc"]))
            keys, spans = keys[order], spans[order]
            order = np.argsort(keys.view(f"S{width}").reshape(-1), kind="stable")
            keys, spans = keys[order], spans[order]
            lengths = spans["size"].astype(np.int64) + SuffixRun.EXTRA
            again = np.concatenate([[False], (keys[1:] == keys[:-1]).all(axis=1)])
            gone = np.empty(int(again.sum()), _SPAN)
            gone["doc"], gone["start"], gone["end"] = spans["doc"][again], spans["start"][again], spans["start"][again] + spans["size"][again]
            for part, those in _dealt(gone, _place(gone["doc"], labels)):
                yield part, 0, None, _packed(those)
            keys, spans, lengths = keys[~again], spans[~again], lengths[~again]
            place = _gram_place(spans["gram"], labels)
            for part, those in _dealt(np.arange(len(keys)), place):
                yield part, 1, None, SuffixRun.encode(keys[those], lengths[those], spans[those])

        held, size, unzip = [], 0, zstandard.ZstdDecompressor()
        for _, rows in _grouped(batches):
            hits = []
            entries = None
            for kind, doc, blob in rows:
                if kind == 0:
                    hits.append(_unpacked(blob, _ENTRY))
                    continue
                if entries is None:
                    entries = np.concatenate(hits) if hits else np.zeros(0, _ENTRY)
                    entries = entries[np.argsort(entries["doc"], kind="stable")]
                a, b = np.searchsorted(entries["doc"], [doc, doc + 1])
                if a == b:
                    continue
                text = unzip.decompress(blob)
                for k in range(a, b, RUN_SUFFIXES):
                    held.append((entries[k : min(b, k + RUN_SUFFIXES)], text))
                    size += len(held[-1][0])
                    if size >= RUN_SUFFIXES:
                        yield from _flush(run(held))
                        held, size = [], 0
        if size:
            yield from _flush(run(held))

    def merge(batches):
        """Merged runs: equal suffixes become spans; of those that share an anchor, the shared bytes tell which windows are equal."""
        import numpy as np

        def spans(rows):
            runs = []
            for kind, _, blob in rows:
                if kind == 0:
                    yield _unpacked(blob, _SPAN)
                else:
                    runs.append(SuffixRun.decode(blob))
            equal, items, group, last = [], [], [], None
            for shared, suffix, doc, start in merge_runs(runs):
                if last is not None and shared == len(suffix) == len(last[0]):
                    if (doc, start) < (last[1], last[2]):
                        (doc, start), gone = (last[1], last[2]), (doc, start)
                        last = (suffix, *gone, last[3])
                        group[-1] = last
                    equal.append((doc, start, start + len(suffix) - SuffixRun.EXTRA))
                else:
                    if shared < SuffixRun.GRAM_BYTES and group:
                        if len(group) > 1:
                            items += [(*group[0][:3], 0), *group[1:]]
                            if len(items) >= RUN_SUFFIXES:
                                yield _repeated_windows(items, length)
                                items = []
                        group = []
                    last = (suffix, doc, start, shared)
                    group.append(last)
                if len(equal) >= 1 << 18:
                    yield np.array(equal, _SPAN)
                    equal = []
            if len(group) > 1:
                items += [(*group[0][:3], 0), *group[1:]]
            if items:
                yield _repeated_windows(items, length)
            if equal:
                yield np.array(equal, _SPAN)

        for _, rows in _grouped(batches):
            for found in spans(rows):
                yield from _flush((part, 0, None, _packed(those)) for part, those in _dealt(found, _place(found["doc"], labels)))

    def exchange(rows: DataFrame) -> DataFrame:
        return _exchange(rows, len(labels))

    runs = map_arrow(df, seek, _ROW)
    hits = map_arrow(exchange(runs), pair, _ROW)
    suffixes = map_arrow(exchange(hits.unionByName(_texts(df, labels))), cut, _ROW)
    return map_arrow(exchange(suffixes), merge, _ROW)


def _texts(df: DataFrame, labels: list[int]) -> DataFrame:
    """Compressed texts dealt by document: rows of kind 1."""

    def kernel(batches):
        import numpy as np
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            place = _place(np.array(docs, np.int64), labels).tolist()
            yield _batch([(p, 1, d, zip_.compress(t)) for p, d, t in zip(place, docs, texts_of(batch.column(1)), strict=True)])

    return map_arrow(df, kernel, _ROW)


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, parts: int | None = None) -> DataFrame:
    """One row per input row: *id_col*, n_bytes, spans (start, end of each maximal removed run) and kept (remaining bytes).

    Texts are UTF-8 bytes, null counts as empty. A byte is removed if it is covered
    by a string of *length* bytes that also starts earlier: in a document with a
    smaller id, or earlier in the same one, overlapping itself or not. Strings are
    judged on the input and never cross documents.

    Null ids come last; rows of equal id are ordered by a hash of their text, and
    rows that repeat id and text are one document, each with the same answer.
    Other columns are not read; an empty table gives an empty result. No stage
    holds more of a text than the text itself, and equal suffixes become one in the first
    task and at every merge, so passages that many documents share don't gather. *parts*
    (by default Spark's number of shuffle partitions) should grow with the input.
    """
    if not 2 * GRAM <= length <= 255:
        raise ValueError(f"length must be {2 * GRAM} to 255 bytes")
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    plain = kind.simpleString() in ("bigint", "int", "smallint", "tinyint") and not rows.groupBy("id").count().where("count > 1 OR id IS NULL").limit(1).count()
    if plain:
        docs = rows.select(F.col("id").cast("long").alias("doc"), "text")
        return _apply(docs, length, parts).withColumn("doc", F.col("doc").cast(kind)).withColumnRenamed("doc", id_col)
    # Numbers in order of id stand for ids that repeat or are null.
    marked = materialize(rows.select("id", "text", F.sha2("text", 256).alias("mark")), "texts")
    order = [F.col("id").asc_nulls_last(), F.col("mark")]
    ordered = marked.select("id", "mark").distinct().repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbers = materialize(ordered.withColumn("doc", F.monotonically_increasing_id()), "numbers").withColumnsRenamed({"id": "n_id", "mark": "n_mark"})
    same = marked["id"].eqNullSafe(numbers["n_id"]) & (marked["mark"] == numbers["n_mark"])
    named = materialize(marked.join(numbers, same).select("id", "doc", "text"), "named")
    found = _apply(named.dropDuplicates(["doc"]).select("doc", "text"), length, parts)
    return named.select("id", "doc").join(found, "doc").drop("doc").withColumnRenamed("id", id_col)


def _apply(docs: DataFrame, length: int, parts: int) -> DataFrame:
    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard

        unzip = zstandard.ZstdDecompressor()
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def batch(rows):
            doc, size, spans, kept = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(size, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())], ["doc", "n_bytes", "spans", "kept"])

        for _, rows in _grouped(batches):
            gone, all_, out, size = [], None, [], 0
            for kind, doc, blob in rows:
                if kind == 0:
                    gone.append(_unpacked(blob, _SPAN))
                    continue
                if all_ is None:
                    all_ = np.concatenate(gone) if gone else np.zeros(0, _SPAN)
                    all_ = all_[np.lexsort((all_["start"], all_["doc"]))]
                text = unzip.decompress(blob)
                a, b = np.searchsorted(all_["doc"], [doc, doc + 1])
                starts, ends = all_["start"][a:b].astype(np.int64), np.maximum.accumulate(all_["end"][a:b].astype(np.int64))
                new = np.concatenate([[True], starts[1:] > ends[:-1]])[: len(starts)]
                starts, ends = starts[new], ends[np.concatenate([new[1:], [True]])[: len(ends)]]
                cuts = [0, *np.stack([starts, ends], axis=1).reshape(-1).tolist(), len(text)]
                kept = b"".join(text[cuts[i] : cuts[i + 1]] for i in range(0, len(cuts), 2))
                out.append((doc, len(text), [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], kept))
                size += len(kept)
                if size >= 8 << 20 or len(out) >= 1000:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

    labels = _labels(docs.sparkSession, parts)
    marked = _mark(docs, length, labels).unionByName(_texts(docs, labels))
    return map_arrow(_exchange(marked, parts), kernel, "doc long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
