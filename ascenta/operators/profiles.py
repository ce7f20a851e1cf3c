"""From candidates to elevation profiles, and profiles joined along runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

NODATA = -9999.0
#: Metres of a pixel.
RESOLUTION = 2
#: Metres by which a sample may lie outside a clip window.
CLIP_TOLERANCE = 1e-6
#: Tiles along a side of a block, and along a side of the box of a line that is read in its block.
BLOCK_TILES, REACH_TILES = 16, 48
#: Samples that a kernel makes at once, and those of one group of lines, about, at least and at most.
CHUNK_SAMPLES, LEAST_SAMPLES, MOST_SAMPLES = 1 << 18, 1 << 20, 1 << 26


def _packed(values, ends, kind):
    """Flat values as an Arrow list column; *ends* are where each list ends."""
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values, kind))


def _line_samples(x, y, step: float):
    """Number of parts, length, and x and y of the samples of one line, whose last distance is the length itself."""
    import numpy as np

    run = np.concatenate([[0.0], np.cumsum(np.hypot(np.diff(x), np.diff(y)))])
    parts = max(1, int(np.ceil(run[-1] / step)))
    d = run[-1] * np.arange(parts + 1) / parts
    d[-1] = run[-1]
    return parts, run[-1], np.interp(d, run, x), np.interp(d, run, y)


def _lines_in(batch, at: int):
    """Row, x and y of each line of a batch that has a vertex; the lists are column *at* and the next."""
    import numpy as np

    (x, a), (y, b) = ((c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in (batch.column(at), batch.column(at + 1)))
    for row in np.flatnonzero(np.diff(a)).tolist():
        yield row, x[a[row] : a[row + 1]], y[b[row] : b[row + 1]]


def _samples_in(batch, at: int, step: float):
    """The samples of a batch's lines, about CHUNK_SAMPLES at a time and each line whole: rows, parts, lengths, and x and y of all."""
    import numpy as np

    rows, parts, lengths, xs, ys, held = [], [], [], [], [], 0
    for row, x, y in _lines_in(batch, at):
        n, m, sx, sy = _line_samples(x, y, step)
        rows.append(row)
        parts.append(n)
        lengths.append(m)
        xs.append(sx)
        ys.append(sy)
        held += n + 1
        if held >= CHUNK_SAMPLES:
            yield np.array(rows), np.array(parts), np.array(lengths), np.concatenate(xs), np.concatenate(ys)
            rows, parts, lengths, xs, ys, held = [], [], [], [], [], 0
    if rows:
        yield np.array(rows), np.array(parts), np.array(lengths), np.concatenate(xs), np.concatenate(ys)


def _kinds(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def resampled(lines: DataFrame, keys: list[str], step: float) -> DataFrame:
    """The samples that :func:`sampled` makes of lines (keys, x, y), one row (keys, parts, length, x, y) a line; nothing is exchanged."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for rows, parts, lengths, x, y in _samples_in(batch, len(keys), step):
                at, ends = pa.array(rows), np.cumsum(parts + 1)
                columns = [*(batch.column(i).take(at) for i in range(len(keys))), pa.array(parts, pa.int32()), pa.array(lengths, pa.float64()), _packed(x, ends, pa.float64()), _packed(y, ends, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keys, "parts", "length", "x", "y"])

    return lines.select(*keys, "x", "y").mapInArrow(kernel, f"{_kinds(lines, keys)}, parts int, length double, x array<double>, y array<double>")


def sampled(lines: DataFrame, keys: list[str], step: float, tile_px: int) -> DataFrame:
    """Samples of lines (keys, x, y) at equal distances of at most *step*, both ends included, in pieces that lie in one tile.

    A line of length L is cut into max(1, ceil(L / step)) parts; sample k lies at L k / parts.
    A piece (keys, parts, length, first, tx, ty, x, y) holds the neighbouring samples
    from number *first* whose lower left pixel is in tile (tx, ty). One pass over the
    vertices and samples of each line; lines of no vertex give no piece.
    """
    kinds = ", ".join(f"`{k}` {lines.schema[k].dataType.simpleString()}" for k in keys)

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            own, parts, length, first, tx, ty, xs, ys, ends = [], [], [], [], [], [], [], [], []
            total = 0
            for row, (x, y) in enumerate(zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist(), strict=True)):
                if not x:
                    continue
                n, m, sx, sy = _line_samples(np.array(x), np.array(y), step)
                px, py = (np.floor(v / RESOLUTION - 0.5).astype(np.int64) // tile_px for v in (sx, sy))
                cut = np.flatnonzero(np.concatenate([[True], (px[1:] != px[:-1]) | (py[1:] != py[:-1])]))
                own += [row] * len(cut)
                parts += [n] * len(cut)
                length += [m] * len(cut)
                first.append(cut)
                tx.append(px[cut])
                ty.append(py[cut])
                ends.append(total + np.append(cut[1:], len(sx)))
                total += len(sx)
                xs.append(sx)
                ys.append(sy)
            if own:
                ends_ = np.concatenate(ends)
                at = pa.array(own)
                columns = [*(batch.column(i).take(at) for i in range(len(keys))), pa.array(parts, pa.int32()), pa.array(length, pa.float64()), pa.array(np.concatenate(first), pa.int32()),
                           pa.array(np.concatenate(tx)), pa.array(np.concatenate(ty)), _packed(np.concatenate(xs), ends_, pa.float64()), _packed(np.concatenate(ys), ends_, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keys, "parts", "length", "first", "tx", "ty", "x", "y"])

    return lines.select(*keys, "x", "y").mapInArrow(kernel, f"{kinds}, parts int, length double, first int, tx long, ty long, x array<double>, y array<double>")


def _with_edges(tiles: DataFrame, tile_px: int) -> DataFrame:
    """Tiles (tx, ty, data), and for the neighbours to the left, below, and both, the edge of each that borders on them: side 0 to 3."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for tx, ty, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                z = np.frombuffer(data, "<f4").reshape(tile_px, tile_px)
                rows += [(tx, ty, 0, data), (tx - 1, ty, 1, z[:, 0].tobytes()), (tx, ty - 1, 2, z[0].tobytes()), (tx - 1, ty - 1, 3, z[0, :1].tobytes())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["tx", "ty", "side", "data"])

    return tiles.select("tx", "ty", "data").mapInArrow(kernel, "tx long, ty long, side int, data binary")


def bilinear(pieces: DataFrame, keys: list[str], tiles: DataFrame, tile_px: int) -> DataFrame:
    """*pieces* of :func:`sampled` with z instead of x and y: null where any of the four neighbouring pixels has no terrain.

    Pixels are numbered from the origin, pixel 0 covering 0 to 2 m; values hold
    at centres. A tile (tx, ty, data) is *tile_px* squared little-endian 32-bit floats, row after row from the
    south; no terrain is a missing tile, the nodata value, exactly 0, or nan. Tiles and
    pieces are dealt by tile, with a pixel's width of the neighbours' edges, so the one exchange
    holds samples and tiles but no pixels, and a task holds one tile at a time and streams the pieces.
    Several rows of one tile, as from files that share it, fill each other's nans.
    """
    kinds = ", ".join(f"`{k}` {pieces.schema[k].dataType.simpleString()}" for k in keys)
    none = lambda c: F.lit(None).cast(pieces.schema[c].dataType).alias(c)
    edged = _with_edges(tiles, tile_px)
    both = pieces.select("tx", "ty", F.lit(9).alias("side"), F.lit(None).cast("binary").alias("data"), *keys, "parts", "length", "first", "x", "y").unionByName(
        edged.select("tx", "ty", "side", "data", *(none(c) for c in (*keys, "parts", "length", "first", "x", "y")))
    )
    dealt = both.repartition("tx", "ty").sortWithinPartitions("tx", "ty", "side")

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        at, held, base = None, np.full((tile_px + 1, tile_px + 1), np.nan), 0
        for batch in batches:
            side = batch.column(2).to_numpy()
            tx, ty = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            reads = np.flatnonzero(side == 9)
            x, y = batch.column(-2), batch.column(-1)
            z_parts, bad_parts, ends = [], [], []
            total = 0
            for i in range(batch.num_rows):
                if at != (tx[i], ty[i]):
                    at = (tx[i], ty[i])
                    held[:] = np.nan
                if side[i] != 9:
                    new = np.frombuffer(batch.column(3)[i].as_py(), "<f4").astype(float)
                    where = (held[:-1, :-1], held[:-1, -1], held[-1, :-1], held[-1:, -1])[side[i]]
                    new = new.reshape(where.shape)
                    where[...] = np.where(np.isnan(where), new, where)
                    base = 1
                    continue
                gx, gy = (np.asarray(c[i].values) / RESOLUTION - 0.5 for c in (x, y))
                fx, fy = np.floor(gx), np.floor(gy)
                wx, wy = gx - fx, gy - fy
                cx, cy = (fx - tx[i] * tile_px).astype(np.int64), (fy - ty[i] * tile_px).astype(np.int64)
                corners = (held[cy, cx], held[cy, cx + 1], held[cy + 1, cx], held[cy + 1, cx + 1])
                bad = np.zeros(len(gx), bool)
                for c in corners:
                    bad |= np.isnan(c) | (c == NODATA) | (c == 0)
                a, b, c, d = corners
                z_parts.append((a * (1 - wx) + b * wx) * (1 - wy) + (c * (1 - wx) + d * wx) * wy)
                bad_parts.append(bad)
                total += len(gx)
                ends.append(total)
            if len(reads):
                rows = pa.array(reads)
                z = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(np.concatenate(z_parts), pa.float64(), mask=np.concatenate(bad_parts)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(4, 4 + len(keys) + 3)), z], [*keys, "parts", "length", "first", "z"])

    return dealt.mapInArrow(kernel, f"{kinds}, parts int, length double, first int, z array<double>")


def whole_lines(read: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces with z put together: one row (keys, parts, length, z) a line, its heights in order."""
    pieces = F.sort_array(F.collect_list(F.struct("first", "z")))
    return read.groupBy(*keys).agg(F.first("parts").alias("parts"), F.first("length").alias("length"), F.flatten(F.transform(pieces, lambda p: p["z"])).alias("z"))


def _placed(lines: DataFrame, keys: list[str], step: float, tile_px: int) -> DataFrame:
    """Lines with a vertex, their number of samples, and the block (bx, by) of their lower left tile: null where their box has more than REACH_TILES along a side."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows, samples, boxes = [], [], []
            for row, x, y in _lines_in(batch, len(keys)):
                rows.append(row)
                samples.append(max(1, int(np.ceil(np.hypot(np.diff(x), np.diff(y)).sum() / step))) + 1)
                boxes.append((x.min(), y.min(), x.max(), y.max()))
            if rows:
                low = np.floor(np.array(boxes) / RESOLUTION - 0.5).astype(np.int64) // tile_px
                far = (low[:, 2:] - low[:, :2] >= REACH_TILES).any(axis=1)
                block = low[:, :2] // BLOCK_TILES
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows)) for c in batch.columns), pa.array(samples, pa.int64()), *(pa.array(block[:, i], mask=far) for i in (0, 1))], [*keys, "x", "y", "samples", "bx", "by"])

    return lines.select(*keys, "x", "y").mapInArrow(kernel, f"{_kinds(lines, [*keys, 'x', 'y'])}, samples long, bx long, by long")


def _needed(near: DataFrame, step: float, tile_px: int) -> DataFrame:
    """The tiles (tx, ty) with a pixel that a group's lines read: bx, by, salt, tx, ty."""

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            groups = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            for rows, parts, _, x, y in _samples_in(batch, 3, step):
                own = np.repeat(rows, parts + 1)
                px, py = (np.floor(v / RESOLUTION - 0.5).astype(np.int64) for v in (x, y))
                found = []
                for tx, ty in ((a, b) for a in (px // tile_px, (px + 1) // tile_px) for b in (py // tile_px, (py + 1) // tile_px)):
                    new = np.flatnonzero(np.concatenate([[True], (tx[1:] != tx[:-1]) | (ty[1:] != ty[:-1]) | (own[1:] != own[:-1])]))
                    found.append(np.column_stack([groups[own[new]], tx[new], ty[new]]))
                found = np.concatenate(found)
                found = found[np.lexsort(found.T)]
                found = found[np.concatenate([[True], (found[1:] != found[:-1]).any(axis=1)])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T.copy()], ["bx", "by", "salt", "tx", "ty"])

    return near.select("bx", "by", "salt", "x", "y").mapInArrow(kernel, "bx long, by long, salt long, tx long, ty long").distinct()


def _mosaic(tiles: list, tile_px: int):
    """The pixels of tiles (tx, ty, data or None) and the place of the first; nan without terrain, a pixel's width of them beyond the last."""
    import numpy as np

    left, low = (min(t[i] for t in tiles) for i in (0, 1))
    width, height = (max(t[i] for t in tiles) - o + 1 for i, o in ((0, left), (1, low)))
    z = np.full((height * tile_px + 1, width * tile_px + 1), np.nan, "<f4")
    for tx, ty, data in tiles:
        if data is not None:
            where = z[(ty - low) * tile_px : (ty - low + 1) * tile_px, (tx - left) * tile_px : (tx - left + 1) * tile_px]
            where[...] = np.where(np.isnan(where), np.frombuffer(data, "<f4").reshape(tile_px, tile_px), where)
    z[(z == NODATA) | (z == 0)] = np.nan
    return z, left * tile_px, low * tile_px


def heights(lines: DataFrame, keys: list[str], tiles: DataFrame | Callable[[DataFrame], DataFrame], step: float, tile_px: int) -> DataFrame:
    """Lines (keys, x, y) sampled as by :func:`sampled` and read as by :func:`bilinear`: keys, parts, length, z, a row a line.

    Samples are made where they are read, so neither they nor heights are exchanged or written:
    lines are dealt, as vertices, to groups by the block of tiles of their lower left end, a block with
    many samples to several, and each group gets the tiles that its lines touch, which it holds
    as one mosaic of at most BLOCK_TILES + REACH_TILES tiles a side, and one more. So a tile is sent once for each
    group that reads it. Lines whose box is larger than REACH_TILES are cut by tile, as
    :func:`bilinear` does, and their samples exchanged. *tiles* is a table (tx, ty, data), or a function that makes
    the tiles of given (tx, ty) and may make more. Lines are written once, when this is called.
    """
    spark = lines.sparkSession
    placed = materialize(_placed(lines, keys, step, tile_px), "lines", sweep=True)
    blocks = materialize(placed.groupBy("bx", "by").agg(F.sum("samples").alias("n")), "blocks")
    total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = min(MOST_SAMPLES, max(LEAST_SAMPLES, -(-total // (3 * spark.sparkContext.defaultParallelism))))
    # One row for each block of the raster.
    groups = blocks.where("bx IS NOT NULL").select("bx", "by", F.ceil(F.col("n") / most).alias("salts"))
    near = placed.join(F.broadcast(groups), ["bx", "by"]).withColumn("salt", F.pmod(F.xxhash64(*keys, "x", "y"), "salts"))
    needed = materialize(_needed(near, step, tile_px), "needed", sweep=True)
    wanted = needed.select("tx", "ty")
    far = None
    if blocks.where("bx IS NULL").first():
        far = sampled(placed.where("bx IS NULL"), keys, step, tile_px)
        if callable(tiles):
            far = materialize(far, "samples")  # read for the tiles and for the samples
            corners = F.explode(F.array(*(F.struct((F.col("tx") + a).alias("tx"), (F.col("ty") + b).alias("ty")) for a in (0, 1) for b in (0, 1))))
            wanted = wanted.union(far.select("tx", "ty").distinct().select(corners.alias("t")).select("t.*"))
    tiles = tiles(wanted.distinct()) if callable(tiles) else tiles
    # The sizes of tiles are not known to Spark, so it must not choose to broadcast them.
    sent = needed.join(tiles.select("tx", "ty", "data").hint("merge"), ["tx", "ty"], "left")
    none = lambda c: F.lit(None).cast(near.schema[c].dataType).alias(c)
    both = near.select("bx", "by", "salt", F.lit(1).alias("side"), *(F.lit(None).cast(t).alias(c) for c, t in (("tx", "long"), ("ty", "long"), ("data", "binary"))), *keys, "x", "y").unionByName(
        sent.select("bx", "by", "salt", F.lit(0).alias("side"), "tx", "ty", "data", *(none(c) for c in (*keys, "x", "y")))
    )
    count = groups.agg(F.coalesce(F.sum("salts"), F.lit(0))).first()[0]
    # Groups are few and large, so there are more partitions than groups: two seldom meet in one.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * count, 1024))
    dealt = both.repartition(n, "bx", "by", "salt").sortWithinPartitions("bx", "by", "salt", "side")

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        at, held, z = None, [], None
        for batch in batches:
            order = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cut = np.flatnonzero(np.concatenate([[True], (order[1:] != order[:-1]).any(axis=1)])).tolist()
            for start, end in zip(cut, [*cut[1:], batch.num_rows], strict=True):
                own = batch.slice(start, end - start)
                if at != (group := tuple(order[start, :3].tolist())):
                    at, held, z = group, [], None
                if order[start, 3] == 0:
                    held += zip(*(own.column(i).to_pylist() for i in (4, 5, 6)), strict=True)
                    continue
                if z is None:
                    z, left, low = _mosaic(held, tile_px)
                    held, flat, width = [], z.reshape(-1), z.shape[1]
                for rows, parts, lengths, x, y in _samples_in(own, 7 + len(keys), step):
                    gx, gy = (v / RESOLUTION - 0.5 for v in (x, y))
                    fx, fy = np.floor(gx), np.floor(gy)
                    wx, wy = gx - fx, gy - fy
                    p = (fy.astype(np.int64) - low) * width + (fx.astype(np.int64) - left)
                    a, b, c, d = (flat[p + k] for k in (0, 1, width, width + 1))
                    read = (a * (1 - wx) + b * wx) * (1 - wy) + (c * (1 - wx) + d * wx) * wy
                    values = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(parts + 1)]).astype(np.int32)), pa.array(read, pa.float64(), mask=np.isnan(read)))
                    taken = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([*(own.column(7 + i).take(taken) for i in range(len(keys))), pa.array(parts, pa.int32()), pa.array(lengths, pa.float64()), values], [*keys, "parts", "length", "z"])

    read = dealt.mapInArrow(kernel, f"{_kinds(lines, keys)}, parts int, length double, z array<double>")
    return read if far is None else read.unionByName(whole_lines(bilinear(far, keys, tiles, tile_px), keys))


def judged(lines: DataFrame) -> DataFrame:
    """Lines (structure, parts, length, z) with invalid, the samples without terrain, and the outcome; of a structure only the ends count as read."""
    ends = F.array(F.element_at("z", 1), F.element_at("z", -1))
    counted = F.when(F.col("structure").isNull(), F.col("z")).otherwise(ends)
    invalid = F.size(F.filter(counted, lambda v: v.isNull()))
    return lines.withColumns({"invalid": invalid, "outcome": outcome(F.size(counted), invalid, F.col("length"))})


def finished(judged: DataFrame) -> DataFrame:
    """Kept lines of :func:`judged` with distance_m and elevation_m (32-bit), structures on the line that joins their ends."""
    d = F.transform(F.sequence(F.lit(0), F.col("parts")), lambda k: F.when(k == F.col("parts"), F.col("length")).otherwise(F.col("length") * k / F.col("parts")))
    kept = judged.where("outcome = 'kept'").withColumn("distance_m", d)
    z = F.when(F.col("structure").isNull(), F.col("z")).otherwise(deck(F.col("z"), F.col("distance_m")))
    return kept.withColumn("elevation_m", z.cast("array<float>")).drop("z")


def deck(z: Column, d: Column) -> Column:
    """Elevations of a structure: its ends as read, in between on the line that joins them."""
    first, last, end = F.element_at(z, 1), F.element_at(z, -1), F.element_at(d, -1)
    return F.transform(d, lambda v: F.when(end > 0, first + (last - first) * v / end).otherwise(first))


def outcome(read: Column, invalid: Column, length: Column) -> Column:
    """What becomes of a candidate from its samples read and those without terrain."""
    return F.when(length <= 0, "degenerate").when(invalid == 0, "kept").when(invalid == read, "nodata_whole").otherwise("nodata_partial")


def outcome_counts(judged: DataFrame) -> DataFrame:
    """One row of counts over candidates (outcome, invalid, structure)."""
    of = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    kinds = ("kept", "degenerate", "nodata_whole", "nodata_partial")
    return judged.agg(
        F.count("*").alias("candidates"),
        *(of(F.col("outcome") == k).alias(k) for k in kinds),
        F.coalesce(F.sum("invalid"), F.lit(0)).cast("long").alias("nodata_samples"),
        of((F.col("outcome") == "kept") & F.col("structure").isNotNull()).alias("structures"),
    )


def profile_ends(profiles: DataFrame) -> DataFrame:
    """Foot, top and length of each profile; heights are narrowed to 32 bits before they are compared."""
    z = F.col("elevation_m").cast("array<float>")
    return profiles.select("candidate_id", F.element_at(z, 1).cast("double").alias("foot"), F.element_at(z, -1).cast("double").alias("top"), (F.element_at("distance_m", -1) - F.element_at("distance_m", 1)).alias("length"))


def with_ends(profiles: DataFrame, candidates: DataFrame) -> DataFrame:
    """:func:`profile_ends` with start and end nodes; a profile whose candidate is unknown raises."""
    nodes = candidates.select("candidate_id", "start_node_id", "end_node_id", F.lit(True).alias("__known"))
    joined = profile_ends(profiles).join(nodes, "candidate_id", "left")
    known = F.assert_true(F.col("__known"), F.concat(F.lit("no candidate "), F.col("candidate_id").cast("string"), F.lit(" of a profile")))
    return joined.where(known.isNull()).drop("__known")


def without_profile(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """Candidates that have no profile: those that sampling dropped."""
    return candidates.join(profiles.select("candidate_id"), "candidate_id", "left_anti")


def join_profiles(runs: DataFrame, profiles: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Samples (run_id, i, k, distance_m, elevation_m) of whole runs (run_id, candidate_ids).

    Later candidates leave out their first sample, the vertex they share with the one
    before, and start where it ended. A candidate without a profile, or, where
    *ends* (candidate_id, start_node_id, end_node_id) is given, one that does not start
    where the one before ended, raises.
    """
    steps = runs.select("run_id", F.posexplode("candidate_ids").alias("i", "candidate_id"))
    joined = steps.join(profiles, "candidate_id", "left")
    missing = F.col("distance_m").isNull()
    along = Window.partitionBy("run_id").orderBy("i")
    checks = [F.assert_true(~missing, F.concat(F.lit("no profile for candidate "), F.col("candidate_id").cast("string")))]
    if ends is not None:
        joined = joined.join(ends, "candidate_id", "left").withColumn("__before", F.lag("end_node_id").over(along))
        meets = F.col("__before").isNull() | (F.col("__before") == F.col("start_node_id"))
        checks.append(F.assert_true(meets, F.concat(F.lit("run breaks before candidate "), F.col("candidate_id").cast("string"))))
    length = F.element_at("distance_m", -1) - F.element_at("distance_m", 1)
    before = F.coalesce(F.sum(length).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    placed = joined.withColumn("__ok", F.coalesce(*checks, F.lit(True))).where("__ok").withColumn("__offset", before)
    samples = placed.select("run_id", "i", "__offset", F.element_at("distance_m", 1).alias("__first"), F.posexplode(F.arrays_zip("distance_m", "elevation_m")).alias("k", "s"))
    kept = samples.where((F.col("i") == 0) | (F.col("k") > 0))
    return kept.select("run_id", "i", "k", (F.col("s.distance_m") - F.col("__first") + F.col("__offset")).alias("distance_m"), F.col("s.elevation_m").cast("double").alias("elevation_m"))


def clip(samples: DataFrame, windows: DataFrame) -> DataFrame:
    """Samples of each run within its window (run_id, start_m, end_m), both ends included; windows of fewer than two samples go."""
    inside = F.col("distance_m").between(F.col("start_m") - CLIP_TOLERANCE, F.col("end_m") + CLIP_TOLERANCE)
    held = samples.join(windows, "run_id").where(inside)
    n = F.count("*").over(Window.partitionBy("run_id", "start_m", "end_m"))
    return held.withColumn("__n", n).where("__n >= 2").drop("__n")
