import re

import numpy as np
import pytest

from ascenta.llm import near


def components(docs, words, percent):
    """Smallest id of each document's component over all pairs."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        return frozenset(zip(*[w[i:] for i in range(words)], strict=False)) if len(w) >= words else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and sets[j] and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(docs):
        least.setdefault(find(i), []).append((doc is None, doc or 0, doc))
    return [(doc, len(sets[i]), min(least[find(i)])[2]) for i, (doc, _) in enumerate(docs)]


@pytest.mark.parametrize("like", [near.Similarity(3, 85), near.Similarity()])
@pytest.mark.parametrize("block", [(near.BLOCK_SHINGLES, near.BLOCK_SETS), (400, 3)])
def test_components(spark, corpus, like, block):
    path, docs = corpus
    found = near.near_duplicates(spark.read.parquet(f"{path}/documents.parquet"), like, block=block).collect()
    want = components([(i, t) for i, t, *_ in docs], like.words, like.percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_edges(edge, empty):
    like = near.Similarity(3, 85)
    found = near.near_duplicates(edge, like).collect()
    want = components([(r.doc_id, r.text) for r in edge.collect()], 3, 85)
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((key((r.doc_id, r.n_shingles, r.component_id)) for r in found)) == sorted(map(key, want))
    kept = near.drop_near_duplicates(edge, like)
    assert kept.columns == edge.columns and near.near_duplicates(empty, like).count() == 0 and near.drop_near_duplicates(empty, like).count() == 0
    prose = [r for r in kept.collect() if r.text and r.text.startswith("The first line")]
    assert [r.doc_id for r in prose] == [1]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    for n in (1, 5, 40, 3000):
        common = r.integers(0, 1 << 63, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, r.integers(0, 1 << 63, n // 4, dtype=np.uint64)])) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = (near.super_minhash(a, 192) == near.super_minhash(b, 192)).mean()
        assert abs(same - true) < 0.16
        assert (near.super_minhash(a, 192) == near.super_minhash(a[::-1].copy(), 192)).all()
    # Each element's ranks are spread over the places: one element fills place after place.
    one = near.super_minhash(np.array([5], np.uint64), 64) >> np.uint64(53)
    assert sorted(one.tolist()) == list(range(64))


def test_bands_lose_no_link():
    for like in (near.Similarity(3, 85), near.Similarity()):
        assert (1 - (like.percent / 100) ** like.rows) ** like.bands < 1e-6
