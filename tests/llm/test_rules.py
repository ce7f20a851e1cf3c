import re

from ascenta.llm import rules

from .conftest import PROSE


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 5000 else {w for i, w in enumerate(windows) if w in set(windows[:i])} if False else _twice(windows)
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [s for s in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n


def _twice(windows):
    seen, again = set(), set()
    for w in windows:
        (again if w in seen else seen).add(w)
    return again


def test_counts(spark, corpus, edge):
    path, _ = corpus
    for df in (spark.read.parquet(f"{path}/documents.parquet"), edge):
        for r in rules.quality_rules(df).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text), r.text[:80]


def test_verdicts(spark):
    cases = {
        PROSE: True,
        PROSE + "\nAll rights reserved.": True,
        "Hash### star*** more$$$ " * 25 + "\n" + "it goes on and on.": False,
        "\n".join(f"Home{i} | About{i} | Contact{i} | News{i} | Help{i}" for i in range(20)): False,
        "\n".join(f"menu entry number {i} of a long list" for i in range(20)): False,
        " ".join(f"BUY{i}!!" for i in range(80)): False,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.text: r.kept for r in rules.quality_rules(df).collect()}
    assert found == cases


def test_lines_go_before_documents(spark):
    df = spark.createDataFrame([(1, PROSE + "\nHome | News | Help | About\nAll rights reserved.")], "doc_id long, text string")
    r = rules.quality_rules(df).first()
    assert r.kept and r.clean_text == PROSE


def test_stage_keeps_columns(edge, empty):
    kept = rules.drop_rejected(edge)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3}
    assert rules.drop_rejected(empty).count() == 0
    assert not re.search("Python|Arrow|Pandas", kept._jdf.queryExecution().executedPlan().toString())
