import re

import pytest
from pyspark.sql import functions as F

from ascenta.llm import mixing


def fill(budget, children):
    """Water filling of whole numbers: name -> (capacity, weight); what rounding leaves goes to the largest remainders."""
    out = {n: 0 for n, (_, w) in children.items() if not w}
    left = sorted(((n, c) for n, c in children.items() if c[1]), key=lambda kv: (kv[1][0] / kv[1][1], kv[0]))
    while left:
        total = sum(w for _, (_, w) in left)
        name, (cap, w) = left[0]
        if cap * total <= w * budget:
            out[name], budget = cap, budget - cap
            left.pop(0)
        else:
            parts = {n: budget * w // total for n, (_, w) in left}
            for n, (_, w) in sorted(left, key=lambda kv: (-(budget * kv[1][1] % total), kv[0]))[: budget - sum(parts.values())]:
                parts[n] += 1
            return out | parts
    return out


def test_budgets(spark):
    leaves = [("a", "en", 100), ("a", "de", 10), ("b", "en", 1000), ("b", "de", 500), ("b", "fr", 5)]
    df = spark.createDataFrame(leaves, "domain string, lang string, supply long")
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"en": 2}}
    for target in (0, 50, 160, 400, 900, 5000):
        found = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(df, ["domain", "lang"], target, weights).collect()}
        top = fill(target, {d: (sum(s for x, _, s in leaves if x == d), weights["domain"][d]) for d in "ab"})
        want = {}
        for d in "ab":
            want |= {(d, k): v for k, v in fill(top[d], {k: (s, 2 if k == "en" else 1) for x, k, s in leaves if x == d}).items()}
        assert found == want, target
    assert sum(found.values()) == 1615  # a target beyond the supply takes all of it


def test_nothing_is_lost_by_rounding(spark):
    df = spark.createDataFrame([(d, 100) for d in "abc"], "domain string, supply long")
    assert sorted(r.budget for r in mixing.leaf_budgets(df, ["domain"], 20).collect()) == [6, 7, 7]


def test_weights_of_zero_and_less(spark):
    leaves = [("a", "x", 500), ("a", "y", 70), ("b", "x", 900), ("c", "x", 40)]
    df = spark.createDataFrame(leaves, "domain string, lang string, supply long")
    found = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(df, ["domain", "lang"], 300, {"domain": {"b": 0}, "lang": {"x": 0}}).collect()}
    assert found == {("a", "x"): 0, ("a", "y"): 70, ("b", "x"): 0, ("c", "x"): 0}
    assert {r.budget for r in mixing.leaf_budgets(df, ["domain", "lang"], 300, {"domain": dict.fromkeys("abc", 0)}).collect()} == {0}
    for bad in (-1, 0.5, True):
        with pytest.raises(ValueError, match="weight of a"):
            mixing.leaf_budgets(df, ["domain", "lang"], 300, {"domain": {"a": bad}})


def test_genre(spark):
    df = spark.createDataFrame([(n, "w " * n) for n in (0, 199, 200, 1999, 2000)], "n int, text string")
    assert [r.g for r in df.select("n", F.expr(mixing.GENRE).alias("g")).orderBy("n").collect()] == ["note", "note", "article", "article", "book"]


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("a", "x", 5), ("a", "y", 1000), ("b", "x", 1000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, supply long")
    found = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(df, ["domain", "lang"], 200).collect()}
    assert found == {("a", "x"): 5, ("a", "y"): 95, ("b", "x"): 100}


def test_prefixes(spark, corpus):
    path, docs = corpus
    df = spark.read.parquet(f"{path}/documents.parquet")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    for share, epochs in (((1, 3), 1), ((1, 1), 1), ((3, 2), 2), ((0, 1), 1)):
        drawn = mixing.mix_sources(df, levels, share, max_epochs=epochs).collect()
        supply = sum(max(1, len((t or "").split())) for _, t, *_ in docs)
        taken = sum(r.mix_tokens * r.mix_copies for r in drawn)
        assert taken <= supply * share[0] / share[1] and len({r.doc_id for r in drawn}) == len(drawn)
        if share == (1, 1):
            assert len(drawn) == len(docs)
    again = mixing.mix_sources(df.repartition(7), levels, (3, 2), max_epochs=2).collect()
    assert sorted((r.doc_id, r.mix_copies) for r in again) == sorted((r.doc_id, r.mix_copies) for r in mixing.mix_sources(df, levels, (3, 2), max_epochs=2).collect())


def test_edges(edge, empty):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    drawn = mixing.mix_sources(edge, levels, (1, 1))
    assert drawn.count() == edge.count() and set(edge.columns) <= set(drawn.columns)
    assert mixing.mix_sources(empty, levels, (1, 1)).count() == 0
    assert not re.search("Python|Arrow|Pandas", drawn._jdf.queryExecution().executedPlan().toString())
