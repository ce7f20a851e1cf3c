"""Whole registered queries over the small tables, against brute force, where the tables are there."""

import html as entities
import itertools
import os
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest

from ascenta.llm import queries, urls

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no tables")


@needs_tables
def test_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.op8_html_text(spark, DATA).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))
        clean = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in clean if b) and r.n_chars == len(r.text)


@needs_tables
def test_held_out_accuracy(spark):
    data = DATA.replace("sf0.001", "sf0.01")  # the smallest table has eight bad documents to learn from
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in queries.op1_quality(spark, data).collect() if r.held_out and r.doc_id in labels]
    assert held and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(a == 1 for a, b in held if b == 1)


@needs_tables
def test_token_files(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    found = {r.doc_id: r for r in queries.op5_token_files(spark, DATA).collect()}
    at = 0
    for d in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        ids = [*own.encode(d.text or "", add_special_tokens=False).ids, 1]
        r = found[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@needs_tables
def test_byte_bpe(spark):
    import hashlib

    from ascenta.llm.bpe import encoder

    own = encoder(queries.RANKS, P.PATTERN)
    found = {r.doc_id: r for r in queries.op9_byte_bpe(spark, DATA).collect()}
    for d in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        ids = own.encode_ordinary(d.text or "")
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())


@needs_tables
def test_url_verdicts(spark):
    model = urls.train_url_model(urls.unigram_shares(spark.read.parquet(f"{DATA}/pages.parquet")))
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.op7_url_filter(spark, DATA).collect():
        rest = pages[r.page_id].partition("://")[2]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(n), n, v) for v, names in queries.URL_RULES.items() for n in names if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0])) and path.startswith("/" + n.split("/", 1)[1])]
        rule, verdict = max(fits)[1:] if fits else (None, "block" if urls.block_score(host, path, model) > 0 else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_cheapest_split():
    """The split's cost against every split of short names, each part a known word or a stretch that costs by its letters."""
    model = urls.train_url_model({"ne": 0.01, "ws": 0.002}, ["spam", "win", "bet"], ["news", "net", "a"], ["web"])
    gap, each = model.gap, model.per_char

    def cost(parts):
        return sum(min(model.cost.get(p, gap + each * len(p)), gap + each * len(p)) for p in parts)

    r = random.Random(4)
    for _ in range(300):
        name = "".join(r.choice(["spam", "win", "bet", "ne", "ws", "t", "a", "x", "web"]) for _ in range(r.randint(1, 4)))[:10]
        splits = ([name[a:b] for a, b in zip((0, *c), (*c, len(name)), strict=True)] for k in range(len(name)) for c in itertools.combinations(range(1, len(name)), k))
        assert cost(urls.segment(name, model)) == pytest.approx(min(map(cost, splits)))
