import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ascenta.llm import bpe, tokenbin

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
BITS = ["a", "bc", " ", "  ", "\n", "\x1c", "é", "1", "!!", "'s", "'LL", "Σ", "ς", "İ", "ﬁ", "\u0301", "\xa0", "日本", "\x85", "<|endoftext|>", ".", "क़"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 40))) for _ in range(1500)]


def test_pieces_change_nothing(texts, monkeypatch):
    monkeypatch.setattr(bpe, "RUN_CHARS", 8)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 16)
    monkeypatch.setattr(bpe, "_LONG_RUN", __import__("re").compile(f"[{bpe._WHITE}]{{8,}}"))
    pieces = bpe.safe_pieces
    monkeypatch.setattr(bpe, "safe_pieces", lambda t, size=16: pieces(t, size))
    own = bpe.encoder(RANKS, P.PATTERN)
    for t in [*texts, " " * 50, "a" + " " * 30 + "b", " " * 20 + "\nx"]:
        assert bpe.encode_text(t, RANKS, P.PATTERN) == own.encode_ordinary(t)


def test_white_space_beyond_the_matcher():
    t = "a" + " \n" * 400_000 + "end"
    ids = bpe.encode_text(t, RANKS, P.PATTERN)
    assert bpe.encoder(RANKS, P.PATTERN).decode(ids) == t


def test_encode_decode(edge, empty):
    own = bpe.encoder(RANKS, P.PATTERN)
    text = sorted((r.text or "").encode() for r in edge.collect())
    both = bpe.encode_bpe(edge, RANKS, P.PATTERN, decode=True).collect()
    assert sorted(bytes(r.decoded) for r in both) == text
    apart = bpe.decode_bpe(bpe.encode_bpe(edge, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in apart) == text
    for r in both:
        ids = np.frombuffer(r.token_ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and (len(r.decoded) > 100_000 or ids == own.encode_ordinary(r.decoded.decode()))
    assert bpe.encode_bpe(empty, RANKS, P.PATTERN).count() == 0


def thue_morse(n):
    """A word of 'a' and 'b' and its complement: polynomial hashes of the two collide for any odd base modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_equal_whole_texts(texts):
    own = Tokenizer.from_file(WORDS)
    table = tokenbin._TokenTable(WORDS, most=300)
    special = [f"hello {s} world" for s in ("<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>x", "<|endoftext")] + ["a<|endoftext|>", "", " "]
    hard = [w for n in (1024, 2048, 4096) for w in thue_morse(n)]
    every = texts + special + hard
    for a in range(0, len(every), 100):
        part = every[a : a + 100]
        ids, counts = table.encode([t.encode() for t in part])
        want = [own.encode(t, add_special_tokens=False).ids for t in part]
        assert [i for w in want for i in w] == ids.tolist() and [len(w) for w in want] == counts.tolist()
    assert table.encode([t.encode() for t in hard[:2]])[0].tolist() == [i for t in hard[:2] for i in own.encode(t, add_special_tokens=False).ids]


def test_words_are_looked_up_once_a_batch():
    class Counted(tokenbin._TokenTable):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)

    own, table = Tokenizer.from_file(WORDS), Counted(WORDS)
    texts = ["The cat, the (cat). x1... x1, y's! y's!", "", "THE\tcat \u00e9. e\u0301! \x1c. --a-- a--\n", "cat,"] * 500
    ids, counts = table.encode([t.encode() for t in texts])
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i for w in want for i in w] == ids.tolist() and [len(w) for w in want] == counts.tolist()
    assert table.asked < 30
    ids, counts = table.encode([])
    assert not len(ids) and not len(counts)


def test_byte_coding():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 1 << 32, n) >> r.integers(0, 32, n)).astype(np.uint32)
        control, data = tokenbin.encode_ranks(v)
        assert (tokenbin.decode_ranks(control, data, n) == v).all() and len(control) == -(-n // 4)


def test_files(spark, edge, empty, tmp_path, monkeypatch):
    own = Tokenizer.from_file(WORDS)
    files = tokenbin.write_tokens(edge, f"file://{tmp_path}/t", WORDS, end_id=1, shards=3)
    rows = tokenbin.read_tokens(spark, files).orderBy("start").collect()
    docs = edge.collect()
    assert len(rows) == len(docs)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at and len(r.token_ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = sorted((r.doc_id or -1, zlib.crc32(np.array([*own.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for r in docs)
    assert sorted((r.doc_id or -1, zlib.crc32(r.token_ids)) for r in rows) == want
    assert tokenbin.encode_corpus(empty, WORDS).count() == 0
