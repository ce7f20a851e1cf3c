"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .common import BLANKS, whole_text


def word_tokens(text_col: str = "text") -> Column:
    """Tokens of a text: its words, parted by ASCII white space; at least one, so every row has a place."""
    text = whole_text(text_col)
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(f"[^{BLANKS}]+"))).cast("long")


#: Words from which a text is a book, or an article.
BOOK_WORDS, ARTICLE_WORDS = 2_000, 200
#: A genre by length, the domain of documents whose table names none, in SQL.
GENRE = f"""CASE WHEN regexp_count(coalesce(text, ''), '[^{BLANKS}]+') >= {BOOK_WORDS} THEN 'book' WHEN regexp_count(coalesce(text, ''), '[^{BLANKS}]+') >= {ARTICLE_WORDS} THEN 'article' ELSE 'note' END""".replace("\\", "\\\\")


def _weights(level: str, weights: Mapping[str, int] | None) -> Column:
    """The weight of a node by its name at *level*; names without one weigh 1."""
    if not weights:
        return F.lit(1).cast("long")
    for name, weight in weights.items():
        if isinstance(weight, bool) or not isinstance(weight, int) or weight < 0:
            raise ValueError(f"the weight of {name} must be a whole number of 0 or more")
    names = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    return F.coalesce(F.try_element_at(names, F.col(level)), F.lit(1)).cast("long")


def _shares(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Deals each parent's ``budget`` to its children by weight, none over its ``capacity``.

    Water filling: children are taken by capacity over weight; each either is
    filled, where its part of what is left would not fit, or takes its part.
    So a child's shortage goes to its siblings, and only what none of them can
    hold stays undealt with the parent, whose own capacity has told its siblings so.
    Parts are rounded down; tokens that are left go one each to the children with
    the largest remainders, then by name, who all have room.
    """
    sort = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(0.0))  # a weight of 0 comes with no capacity
    order = Window.partitionBy(*parent).orderBy(sort, F.col(level).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    held = F.coalesce(F.sum("capacity").over(before), F.lit(0))
    weighed = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = nodes.withColumns({"__held": held, "__weighed": weighed})
    full = F.col("capacity") * F.col("__weighed") <= F.col("weight") * (F.col("budget") - F.col("__held"))
    ranked = ranked.withColumn("__full", full)
    # Children that are not full end the order, and the first of them sees most of the budget left.
    open_ = lambda c: F.when(~F.col("__full"), c)
    ranked = ranked.withColumns({
        "__open": F.sum(open_(F.col("weight"))).over(whole),
        "__left": F.max(open_(F.col("budget") - F.col("__held"))).over(whole),
    }).withColumns({"__part": F.expr("__left * weight div __open"), "__rest": F.expr("__left * weight % __open")})
    turn = Window.partitionBy(*parent, "__full").orderBy(F.col("__rest").desc(), F.col(level).asc_nulls_first())
    ranked = ranked.withColumns({"__more": F.col("__left") - F.sum(open_(F.col("__part"))).over(whole), "__turn": F.row_number().over(turn)})
    given = F.when(F.col("__full"), F.col("capacity")).otherwise(F.col("__part") + (F.col("__turn") <= F.col("__more")).cast("int"))
    return ranked.withColumn("given", given.cast("long")).drop("__held", "__weighed", "__full", "__open", "__left", "__part", "__rest", "__more", "__turn")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], target: int | Column, weights: Mapping[str, Mapping[str, int]] | None = None, max_epochs: int = 1) -> DataFrame:
    """*leaves* (the *levels* and ``supply``) with ``budget``, the tokens each is to give.

    Weights are whole numbers of 0 or more by level and name; others raise. What lies
    below a weight of 0 gets nothing and holds nothing for its siblings. The tree has one row for each leaf,
    so it is small beside the documents; each level is one aggregation and one
    window over siblings, which meet in one task.
    """
    weights = weights or {}
    above: DataFrame | None = None
    open_ = reduce(lambda a, b: a & b, (_weights(level, weights.get(level)) > 0 for level in levels))
    leaves = leaves.withColumn("__room", F.when(open_, F.col("supply") * max_epochs).otherwise(F.lit(0)))
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("__room").cast("long").alias("capacity"))
        nodes = nodes.withColumn("weight", _weights(level, weights.get(level)))
        if above is None:
            nodes = nodes.withColumn("budget", (target if isinstance(target, Column) else F.lit(target)).cast("long"))
        else:
            nodes = _join_null_safe(nodes, above, path[:-1])
        parent = path[:-1] or ["__root"]
        nodes = nodes if depth else nodes.withColumn("__root", F.lit(0))
        above = _shares(nodes, parent, level).select(*path, F.col("given").alias("budget"))
    return _join_null_safe(leaves.drop("__room"), above, list(levels))


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    renamed = right.select(*(F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on))
    return left.join(renamed, same, how).drop(*(f"__r_{c}" for c in on))


def mix_sources(
    df: DataFrame,
    levels: Mapping[str, Column],
    share: tuple[int, int] = (1, 2),
    weights: Mapping[str, Mapping[str, int]] | None = None,
    max_epochs: int = 1,
    seed: int = 42,
    tokens: Column | None = None,
    id_col: str = "doc_id",
) -> DataFrame:
    """The rows of *df* that are drawn, with ``mix_tokens`` and ``mix_copies`` (epochs each is drawn in).

    *levels* names the tree from the root down, such as domain, language and
    source, each with the column that places a row. The target is *share* (a
    fraction, two integers) of all tokens; sums are written, and jobs run, when this is called. Budgets go down the tree by integer
    *weights*; what a node cannot fill goes to its siblings first, then to its
    parent's. A leaf is drawn in epochs: each is the leaf in an order seeded by
    the epoch, whole ones first, then the prefix of the last one whose tokens end
    within what is left of the budget.

    A leaf's order is cut into 4,096 parts by its hash, whose sums are added up
    first, so prefix sums over rows run within one part and a leaf with a third of
    all rows is spread over as many tasks. Null levels are a leaf of their own;
    rows that repeat id, tokens and leaf are drawn together or not at all; an empty
    table gives an empty result. Existing columns stay; mix_tokens and mix_copies
    are replaced.
    """
    names = [f"__{k}" for k in levels]
    rows = df.withColumns({"__id": F.col(id_col), "__tokens": word_tokens() if tokens is None else tokens, **{f"__{k}": v.cast("string") for k, v in levels.items()}})
    # Sums need sizes and places only, not the texts.
    slim = materialize(rows.select("__id", *names, "__tokens"), "mixing")
    leaves = slim.groupBy(*names).agg(F.sum("__tokens").alias("supply"))
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("all")).first()["all"]
    given = leaf_budgets(leaves, names, total * share[0] // share[1], {f"__{k}": v for k, v in (weights or {}).items()}, max_epochs)
    given = given.select(*names, F.expr("budget div supply").cast("int").alias("__whole"), F.expr("budget % supply").alias("__rest"))
    given = materialize(given, "budgets")

    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__whole").cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))
    placed = _join_null_safe(slim.groupBy(*names, "__id", "__tokens").agg(F.count("*").alias("__rows")), given, names)
    placed = placed.withColumn("__key", place).withColumn("__part", F.substring("__key", 1, 3))
    sums = placed.groupBy(*names, "__part").agg(F.sum(F.col("__tokens") * F.col("__rows")).alias("__sum"))
    up_to = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, F.col("__part"), F.coalesce(F.sum("__sum").over(up_to), F.lit(0)).alias("__before"), "__sum")
    joined = _join_null_safe(placed, sums, [*names, "__part"])
    cut = (F.col("__before") < F.col("__rest")) & (F.col("__before") + F.col("__sum") > F.col("__rest"))
    inside = joined.where(cut)
    running = Window.partitionBy(*names, "__part").orderBy("__key", F.col("__id").asc_nulls_first(), "__tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("__ends", F.col("__before") + F.sum(F.col("__tokens") * F.col("__rows")).over(running)).withColumn("__in", (F.col("__ends") <= F.col("__rest")).cast("int"))
    outside = joined.where(~cut)
    outside = outside.withColumn("__in", (F.col("__before") + F.col("__sum") <= F.col("__rest")).cast("int"))
    keep = [*names, "__id", "__tokens"]
    drawn = inside.select(*keep, "__whole", "__in").unionByName(outside.select(*keep, "__whole", "__in"))
    drawn = drawn.select(*keep, (F.col("__whole") + F.col("__in")).alias("mix_copies")).where("mix_copies > 0")
    out = _join_null_safe(rows.drop("mix_copies", "mix_tokens"), drawn, keep)
    return out.withColumnRenamed("__tokens", "mix_tokens").drop("__id", *names)
