"""Words and pieces that a polynomial hash modulo 2**64 cannot tell apart are told apart."""

import pyarrow as pa
import public_tokenizers
from rowloom.llm import minhash as M
from rowloom.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


def twins():
    """A word of 1,024 letters, made by appending its own a/b-swapped copy again and again, and its swapped twin."""
    word, swap = "a", str.maketrans("ab", "ba")
    while len(word) < 1024:
        word += word.translate(swap)
    return word, word.translate(swap)


def test_near_duplicates(spark):
    docs = spark.createDataFrame(list(enumerate(twins())), "doc_id bigint, text string")
    assert {r["doc_id"]: (r["component_id"], r["kept"]) for r in M.near_duplicates(docs).collect()} == {0: (0, True), 1: (1, True)}


def test_ids():
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(PATH), [*twins(), " ".join(twins())]
    found = list(P._Encoder(PATH)(pa.array(texts)))
    assert [f.tolist() for f in found] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
