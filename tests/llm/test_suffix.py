import random

import pytest

from ascenta.llm import suffix


def brute(docs, length):
    """Removed spans of documents in order, by every string of *length* bytes."""
    seen, out = set(), []
    for t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(t[p : p + length])
        spans, start = [], None
        for i, g in enumerate([*gone, 0]):
            if g and start is None:
                start = i
            if not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_spans(spark, corpus, small, monkeypatch):
    if small:
        for name, value in {"SAMPLE": 1, "FREQUENT": 3, "RUN_ANCHORS": 200, "RUN_SUFFIXES": 50, "PIECE": 700}.items():
            monkeypatch.setattr(suffix, name, value)
    path, docs = corpus
    docs = sorted((i, (t or "").encode()) for i, t, *_ in docs)
    r = random.Random(5)
    passage = "".join(r.choice("abc ") for _ in range(230)).encode()
    docs += [(1000 + k, b"x" * k + passage[: 90 + 10 * k] + b"y" * 150 + passage[k:]) for k in range(12)] + [(2000, b"ab" * 400), (2001, b"\x00" * 300)]
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string")
    found = {x.doc_id: x for x in suffix.suffix_dedup(df, parts=5).collect()}
    for (i, t), (spans, kept) in zip(docs, brute([t for _, t in docs], 100), strict=True):
        assert (found[i].n_bytes, [tuple(s) for s in found[i].spans], bytes(found[i].kept)) == (len(t), spans, kept), i


def test_edges(edge, empty):
    found = suffix.suffix_dedup(edge, parts=4).collect()
    rows = edge.collect()
    assert len(found) == len(rows) and suffix.suffix_dedup(empty, parts=4).count() == 0
    import hashlib

    once = sorted({(r.doc_id is None, r.doc_id or 0, hashlib.sha256((r.text or "").encode()).hexdigest(), (r.text or "").encode()) for r in rows})
    want = {}
    for (_, i, _, t), (_, kept) in zip(once, brute([x[3] for x in once], 100), strict=True):
        want.setdefault((i, len(t)), []).append(kept)
    for r in found:
        assert bytes(r.kept) in want[(r.doc_id or 0, r.n_bytes)]


def test_loser_tree_merges():
    r = random.Random(2)
    runs = [sorted({bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))) for _ in range(r.randint(0, 40))}) for _ in range(7)]
    coded = []
    for n, run in enumerate(runs):
        last, out = b"", []
        for s in run:
            out.append((suffix._common(last, s, 0), s, n, 0))
            last = s
        coded.append(iter(out))
    merged = list(suffix.merge_runs(coded))
    assert [m[1] for m in merged] == sorted(s for run in runs for s in run)
    last = b""
    for shared, s, _, _ in merged[1:]:
        assert shared == suffix._common(merged[0][1] if last == b"" else last, s, 0)
        last = s
