import hashlib
import re
from collections import defaultdict

from ascenta.llm import exact


def bare(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def expected(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    return {b: (min(g)[3], len(g), hashlib.sha256(b.encode()).hexdigest()) for b, g in groups.items()}


def test_groups(spark, corpus):
    path, docs = corpus
    docs = [(i, t) for i, t, *_ in docs]
    want = expected(docs)
    for most_runs in (2, 16):
        found = exact.exact_duplicates(spark.read.parquet(f"{path}/documents.parquet").repartition(9), most_runs=most_runs).collect()
        assert len(found) == len(docs)
        text = dict(docs)
        for r in found:
            keep, size, sha = want[bare(text[r.doc_id])]
            assert (r.keep_id, r.group_size, r.text_sha256, r.kept) == (keep, size, sha, r.doc_id == keep)


def test_edges(edge):
    found = exact.exact_duplicates(edge).collect()
    want = expected([(r.doc_id, r.text) for r in edge.collect()])
    assert sorted((r.text_sha256, r.group_size, str(r.keep_id)) for r in found if r.kept) == sorted((sha, n, str(k)) for k, n, sha in want.values())


def test_drop_keeps_whole_rows(edge, empty):
    kept = exact.drop_exact_duplicates(edge)
    assert kept.columns == edge.columns
    assert len(kept.collect()) == len({bare(r.text) for r in edge.collect()})
    assert exact.exact_duplicates(empty).count() == 0 and exact.drop_exact_duplicates(empty).count() == 0


def test_no_python_in_plan(edge):
    plan = exact.exact_duplicates(edge)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_release(spark, edge):
    from ascenta import storage

    kept = storage.materialize(edge.select("doc_id"), "held")
    assert kept.count() == edge.count()
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    storage.release(spark)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def test_slices_bound_rows_and_bytes():
    import pyarrow as pa

    from ascenta.llm.common import sliced

    texts = ["x" * n for n in (5, 0, 90, 300, 1, 1, 40, 70)] + [None, "", "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    for part in ([batch], [batch.slice(2), batch.slice(0, 0), batch.slice(4, 3)]):
        whole = [r for b in part for r in b.to_pylist()]
        cut = list(sliced(part, rows=4, size=100))
        assert [r for b in cut for r in b.to_pylist()] == whole
        assert all(b.num_rows <= 4 and (b.num_rows == 1 or sum(len(r["t"] or "") for r in b.to_pylist()) <= 100) for b in cut)


def test_no_setting_changes(spark, edge):
    from ascenta.llm.common import map_arrow

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    assert map_arrow(edge.select("doc_id"), lambda batches: batches, "doc_id long", rows=2).count() == edge.count()
    assert spark.conf.get(key) == before
