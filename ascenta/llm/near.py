"""Near-duplicate detection: SuperMinHash, banding, verification on full sets and union-find grouping."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected
from ..storage import materialize
from .common import WordTable, map_arrow, mixed, texts_of, whole_text


@dataclass(frozen=True)
class Similarity:
    """Sets of *words*-word shingles link from a Jaccard similarity of *percent* hundredths.

    The signature has *bands* bands of *rows* ranks. By default they are chosen so
    that a pair at the threshold shares no band in fewer than one of a million cases.
    """

    words: int = 5
    percent: int = 80
    rows: int = 0
    bands: int = 0

    def __post_init__(self):
        if not self.rows:
            t, most = self.percent / 100, 192
            fits = [r for r in range(1, 17) if (1 - t**r) ** (most // r) < 1e-6]
            object.__setattr__(self, "rows", max(fits, default=1))
            object.__setattr__(self, "bands", most // self.rows)

    @property
    def size(self) -> int:
        return self.rows * self.bands

    @property
    def least_equal(self) -> int:
        """Equal ranks that a linked pair has, but for a chance of about 1e-9 (six deviations)."""
        t = self.percent / 100
        return math.floor(self.size * t - 6 * math.sqrt(self.size * t * (1 - t)))


#: Block of one comparing task: shingles and sets at most; beyond it a cluster is cut into blocks.
BLOCK_SHINGLES, BLOCK_SETS = 4_000_000, 16_384
#: Sets of a cut cluster that every block holds, about.
PIVOTS = 32


def _describe(word: bytes) -> tuple[int]:
    import xxhash

    return (xxhash.xxh3_64_intdigest(word),)


def shingle_set(text: bytes, table: WordTable, words: int):
    """Sorted 64-bit hashes of the distinct shingles of a text, A-Z lower-cased.

    A text of fewer words is one shingle; one without words has none.
    """
    import numpy as np

    n = table.numbers(text.lower().split())
    if not len(n):
        return np.zeros(0, np.uint64)
    w = table.columns()[0][n]
    k = min(words, len(w))
    s = mixed(w[: len(w) - k + 1] + np.uint64(k))
    for i in range(1, k):
        s = mixed(s * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i])
    return np.unique(s)


def super_minhash(shingles, size: int):
    """SuperMinHash signature: for each of *size* places the least rank over all elements.

    Each element walks a random permutation of the places, seeded by the element
    (a Fisher-Yates shuffle done one step at a time); its rank at the place of step j
    is j plus a random fraction, so an element's ranks are spread evenly. All
    elements take step j together, and no further step is taken once every place
    holds a rank that a later step cannot beat. Ranks are packed as j * 2**53 + fraction.
    """
    import numpy as np

    out = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    walk = None
    rows = np.arange(len(shingles))
    for j in range(size):
        fraction = mixed(shingles + np.uint64(2 * j + 1)) >> np.uint64(11)
        pick = (mixed(shingles ^ np.uint64(0xA5A5A5A5 + 2 * j)) % np.uint64(size - j)).astype(np.int64) + j
        if j == 0:
            place = pick
        else:
            if walk is None:  # the swap of step 0, now that a second step is needed
                walk = np.tile(np.arange(size, dtype=np.uint16), (len(shingles), 1))
                walk[rows, first] = 0
                walk[:, 0] = first
            place = walk[rows, pick].astype(np.int64)
            walk[rows, pick] = walk[:, j]
            walk[:, j] = place
        if j == 0:
            first = pick
        np.minimum.at(out, place, (np.uint64(j) << np.uint64(53)) | fraction)
        if out.max() < np.uint64(j + 1) << np.uint64(53):
            break
    return out


def band_keys(signature, like: Similarity):
    """One 64-bit key for each band of the signature."""
    import numpy as np

    ranks = signature.reshape(like.bands, like.rows)
    key = mixed(np.arange(like.bands, dtype=np.uint64) + np.uint64(77))
    for r in range(like.rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + ranks[:, r])
    return key.view(np.int64)


def _sketches(df: DataFrame, id_col: str, text_col: str, like: Similarity) -> DataFrame:
    """Each row's set size and digest, band keys and signature cut to bytes."""
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    source = source.withColumns({"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()})

    def kernel(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        table = WordTable(_describe, 1)
        for batch in batches:
            sizes, digests, keys, signatures = [], [], [], []
            for text in texts_of(batch.column(1)):
                own = shingle_set(text, table, like.words)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                ranks = super_minhash(own, like.size) if len(own) else None
                keys.append(None if ranks is None else band_keys(ranks, like).tolist())
                signatures.append(None if ranks is None else (mixed(ranks) >> np.uint64(56)).astype(np.uint8).tobytes())
            table.trim()
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "row", "n", "digest", "keys", "signature"])

    return map_arrow(source, kernel, f"id {kind}, mark long, row long, n long, digest binary, keys array<long>, signature binary")


def link_block(sets: list, signatures, like: Similarity, skip=None) -> list[int]:
    """The component of each set of a block: the index of its first member.

    Union-find over verified links. Sets are taken up one after another; each is
    compared with all sets that are not in its component yet: by size, then by
    equal signature bytes, then exactly on the full sets. A set that joined a component
    is taken up next, so the components are those of all links while large groups
    cost few comparisons. *skip* names the group of each set; sets of one group count as linked.
    """
    import numpy as np

    n = len(sets)
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(i, j):
        i, j = find(i), find(j)
        parent[max(i, j)] = min(i, j)

    groups: dict = {}
    for i, g in enumerate(skip or []):
        union(i, groups.setdefault(g, i))
    sizes = np.array([len(s) for s in sets], np.int64)
    waiting = np.ones(n, bool)
    queue: list[int] = []
    for start in range(n):
        if not waiting[start]:
            continue
        queue = [start]
        waiting[start] = False
        while queue:
            i = queue.pop()
            rest = np.flatnonzero(waiting)
            if not len(rest):
                break
            small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
            rest = rest[100 * small >= like.percent * large]
            rest = rest[(signatures[rest] == signatures[i]).sum(axis=1) >= like.least_equal]
            for at in range(0, len(rest), 512):
                part = rest[at : at + 512]
                flat = np.concatenate([sets[j] for j in part])
                where = np.searchsorted(sets[i], flat)
                where[where == sizes[i]] = 0
                starts = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
                common = np.add.reduceat((sets[i][where] == flat).astype(np.int64), starts)
                for j in part[100 * common >= like.percent * (sizes[part] + sizes[i] - common)]:
                    union(i, int(j))
                    waiting[j] = False
                    queue.append(int(j))
    return [find(i) for i in range(n)]


def _compare(df: DataFrame, members: DataFrame, id_col: str, text_col: str, like: Similarity) -> DataFrame:
    """Verified links (a, b) within each (cluster, block) of *members*: each set and the least of its component there.

    *members*: id, mark, cls, cluster, block, signature, and the group whose sets count as linked already.
    """
    docs = df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    wanted = members.withColumnsRenamed({"id": "m_id", "mark": "m_mark"})
    joined = docs.join(wanted, docs["id"].eqNullSafe(wanted["m_id"]) & (docs["mark"] == wanted["m_mark"]))
    dealt = joined.select("cluster", "block", "cls", "known", "signature", "text").repartition("cluster", "block").sortWithinPartitions("cluster", "block", "cls")

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        table = WordTable(_describe, 1)

        def solved(held):
            ids, known, signatures, sets = zip(*held, strict=True)
            roots = link_block(list(sets), np.array([np.frombuffer(s, np.uint8) for s in signatures]), like, known)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([ids[r] for r in roots], pa.int64())], ["a", "b"])

        key, held = None, []
        for batch in batches:
            cluster, block, cls, known, signature, _ = (c.to_pylist() if k < 5 else None for k, c in enumerate(batch.columns))
            for k, text in enumerate(texts_of(batch.column(5))):
                if key != (cluster[k], block[k]):
                    if len(held) > 1:
                        yield solved(held)
                    key, held = (cluster[k], block[k]), []
                if not held or held[-1][0] != cls[k]:  # a repeated row has its set here already
                    held.append((cls[k], known[k], signature[k], shingle_set(text, table, like.words)))
            table.trim()
        if len(held) > 1:
            yield solved(held)

    return map_arrow(dealt, kernel, "a long, b long")


def near_duplicates(df: DataFrame, like: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text", block: tuple[int, int] = (BLOCK_SHINGLES, BLOCK_SETS)) -> DataFrame:  # noqa: B008
    """One row per input row: *id_col*, n_shingles, component_id, kept, first and text_mark (a hash of the text).

    Documents link when their shingle sets' Jaccard similarity is at least
    ``like.percent`` hundredths; component_id is the smallest id that links reach
    (null ids come last), kept whether the id is that one. Of the rows of a
    component, first marks one: the first row read of the smallest id.

    1. Each text is sketched once. Equal sets are one class from here on.
    2. Classes that share a band of the signature fall into one cluster.
    3. Each cluster's full sets meet in one task, which verifies links and groups
       them by union-find. A cluster beyond *block* (shingles, sets) is cut: first
       each block with some sets that all blocks hold, then, of what is still apart,
       the sets whose buckets hold several groups, block against block. So no task
       holds more than two blocks, and no candidate is dropped.

    Null and empty texts and texts without words have no shingles, link with
    nothing and are their own component. Repeated rows are one class. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = materialize(_sketches(df, id_col, text_col, like), "sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "mark"))
    classes = rows.where("n > 0").groupBy("digest", "n").agg(least.alias("least"), F.first("keys").alias("keys"), F.first("signature").alias("signature"), F.count("*").alias("copies"))
    classes = materialize(classes.select("digest", "n", "copies", F.col("least.row").alias("cls"), F.col("least.id").alias("id"), F.col("least.mark").alias("mark"), "keys", "signature"), "classes")
    places = classes.select("cls", F.explode("keys").alias("key"))
    buckets = places.groupBy("key").agg(F.count("*").alias("size"), F.min("cls").alias("pivot")).where("size > 1").select("key", "pivot")
    stars = places.join(buckets, "key").select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
    clusters = connected(stars).withColumnsRenamed({"node": "cls", "root": "cluster"})
    members = classes.drop("keys", "digest", "copies").join(clusters, "cls")
    weights = members.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("shingles") / block[0]), F.ceil(F.col("sets") / block[1])).cast("int")
    members = materialize(members.join(weights.select("cluster", "sets", blocks.alias("blocks")), "cluster"), "members")
    spread = F.xxhash64("cls")
    small = members.where("blocks = 1").withColumn("block", F.lit(0))
    own = members.where("blocks > 1").withColumn("block", F.pmod(spread, "blocks").cast("int"))
    pivot = F.pmod(F.xxhash64("cls", F.lit(1)), F.greatest(F.lit(1), F.expr(f"sets div {PIVOTS}"))) == 0
    shared = own.where(pivot).drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = small.unionByName(own).unionByName(shared).distinct().withColumn("known", F.col("cls"))
    links = materialize(_compare(df, dealt, id_col, text_col, like), "links")
    if members.where("blocks > 1").limit(1).count():
        links = links.unionByName(_rest(df, members, places, links, block, id_col, text_col, like))
        groups = connected(links)
    else:
        groups = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    named = classes.select("digest", "n", "copies", "cls", "id").join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    names = named.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "cls")).alias("least"))
    found = materialize(named.join(names, "root").select("digest", F.col("n").alias("n_shingles"), "copies", F.col("least.id").alias("component_id"), F.col("least.cls").alias("first_row")), "found")
    with_words = _answered(rows.where("n > 0").select("id", "mark", "row", "digest", F.col("n").alias("n_shingles")), found)
    with_words = with_words.select("id", "mark", "n_shingles", "component_id", (F.col("row") == F.col("first_row")).alias("first"))
    without = rows.where("n = 0").select("id", "mark", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(True).alias("first"))
    out = with_words.unionByName(without)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "first", F.col("mark").alias("text_mark"))


#: A set that this share of all rows repeat is hot: at most HOT_SHARE sets are.
HOT_SHARE = 1000


def _answered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """*rows* with what was *found* for their set. Sets that very many rows repeat are sent to the rows, so that no task gets all their copies."""
    total = found.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
    placed = found.withColumn("hot", F.col("copies") * HOT_SHARE >= total).drop("copies")
    key = ["digest", "n_shingles"]
    hot = F.broadcast(placed.where("hot").drop("hot"))  # at most HOT_SHARE rows, since their copies sum to no more than the total
    cold = rows.join(F.broadcast(placed.where("hot").select(*key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(placed.where("NOT hot").drop("hot"), key))


def _rest(df: DataFrame, members: DataFrame, places: DataFrame, links: DataFrame, block: tuple[int, int], id_col: str, text_col: str, like: Similarity) -> DataFrame:
    """Links between the groups that are still apart in cut clusters.

    Only sets in a bucket that holds several groups can link across groups; these
    buckets are compared, each in one task where it fits, else block against block,
    every pair of a bucket's blocks in one task. A set goes to as many tasks as it has such buckets.
    """
    cut = members.where("blocks > 1")
    groups = connected(links).withColumnsRenamed({"node": "cls", "root": "known"})
    grouped = materialize(cut.join(groups, "cls", "left").withColumn("known", F.coalesce("known", "cls")), "grouped")
    at = places.join(grouped.select("cls", "known", "n"), "cls")
    apart = at.groupBy("key").agg(F.min("known").alias("one"), F.max("known").alias("other"), F.sum("n").alias("shingles"), F.count("*").alias("sets")).where("one <> other")
    parts = F.greatest(F.ceil(F.col("shingles") / block[0]), F.ceil(F.col("sets") / block[1])).cast("int").alias("parts")
    open_ = at.select("key", "cls").join(apart.select("key", parts), "key")
    numbered = grouped.drop("cluster").join(open_, "cls").withColumn("part", F.pmod(F.xxhash64("cls", F.lit(2)), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = numbered.withColumnRenamed("key", "cluster").withColumn("other", other).withColumn("block", F.least("part", "other") * F.col("parts") + F.greatest("part", "other"))
    return _compare(df, pairs, id_col, text_col, like)


def drop_near_duplicates(df: DataFrame, like: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """The rows of *df* of which :func:`near_duplicates` marks the first of a component, with all their columns.

    Of rows that repeat id and text, one stays.
    """
    first = near_duplicates(df, like, id_col, text_col).where("first").select(F.col(id_col).alias("__kept"), F.col("text_mark").alias("__same")).distinct()
    rows = df.withColumn("__mark", F.xxhash64(whole_text(text_col)))
    same = rows[id_col].eqNullSafe(first["__kept"]) & (rows["__mark"] == first["__same"])
    return rows.join(first, same, "left_semi").dropDuplicates([id_col, "__mark"]).drop("__mark")
