import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from ascenta.llm import tokenbin

WORDS = P.path("word_bpe_49k.json")


def test_added_tokens_as_the_library_reads_them(spark):
    texts = ["see <|endoftext|> here", "plain words", "", "<|startoftext|>a<|endoftext|>", "SEE <|ENDOFTEXT|> Here", "the end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    own = Tokenizer.from_file(WORDS)
    rows = tokenbin.tokenize(df, WORDS, end_id=1).where("id IS NOT NULL").collect()
    found = {r.id: np.frombuffer(r.token_ids, "<u2").tolist() for r in rows}
    assert found == {k: [*own.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    assert found[0] == [862, 49407, 763, 1]
