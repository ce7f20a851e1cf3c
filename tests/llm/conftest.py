import pytest

LONG = " ".join(f"word{i % 977} and more." for i in range(40_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, keep_id string, id string, row string, mark string, doc string, part string, n string, score string, key string, mix_tokens string, component_id string, group_size string, word_chars string"
PROSE = "The first line of this document says something plain. It goes on for a while, so that it has words enough.\nThe second line adds what the first left out, and ends as lines of prose do.\nA third one closes the text with a remark about the weather, the harvest and the road to town.\nNothing in it is repeated, and so no rule has any reason to turn it away from the corpus."


def rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, equal ids and clashing names."""
    texts = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.replace(" ", "  ")), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, LONG + " tail"), (9, "one"), (9, "one two"), (10, "one"),
        (None, PROSE + " More."), (None, None), (None, "one two three"), (11, "x" * 30_000), (12, " " * 20_000 + "end"), (13, "ÄÖÜ ß é 日本語 🙂 " * 30), (14, "a\x00b \x00 c"), (15, PROSE.upper()),
    ]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"src{k % 5}", None, *["clash"] * 14) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    """A folder with a table of documents that repeat each other, and tables of labels and pages."""
    import random

    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdeilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(300)]
    sentence = lambda: " ".join(r.choice(vocabulary) for _ in range(r.randint(6, 14))).capitalize() + "."
    shared = " ".join(sentence() for _ in range(6))
    base = ["\n".join(sentence() for _ in range(r.randint(4, 14))) for _ in range(60)]
    texts = list(base)
    for t in base[:12]:
        texts += [t, t.replace(" ", "  ", 3)]
        for _ in range(3):
            words = t.split(" ")
            words[r.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [base[40] + "\n" + shared, base[41] + "\n" + shared, shared, None, "", "one two", "one two", "Spam*** eggs### ham$$$ " * 30, "WIN!! NOW!! " * 40]
    r.shuffle(texts)
    docs = [(i, t, r.choice(["en", "de"]), f"src{r.randrange(4)}", len(t or "")) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 0 if t and ("***" in t or "!!" in t) else 1, 0) for i, t, *_ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), docs
