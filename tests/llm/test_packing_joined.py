"""Pieces go to the tokenizers library many at a time, and used remainders leave a shard's index."""

import numpy as np
import pyarrow as pa
import pytest
from rowloom.llm import packing as P
from rowloom.llm.queries import VOCABULARY
from tokenizers import Tokenizer

TEXTS = [
    "plain words, 12 of them; plain again",
    "naïve café – ½ ² don't we'll 'tis  ­\x00\x7f\t\n  𝔘nicode 漢字 🙂" + "".join(map(chr, range(0x300))),
    "",
    None,
    "before <|endoftext|> after",
    "x" * 3000,
]


def expected():
    library = Tokenizer.from_file(VOCABULARY)
    return [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in TEXTS]


class Counted:
    """A tokenizer that counts the texts it is asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_one_text_for_many_pieces():
    encode = P._Encoder(VOCABULARY)
    encode.merger, encode.tokenizer = Counted(encode.merger), Counted(encode.tokenizer)
    assert [f.tolist() for f in encode(pa.array(TEXTS))] == expected()
    assert encode.merger.texts == 1 and encode.tokenizer.texts == 1  # all pieces; the special token's text
    list(encode(pa.array(TEXTS[:2])))
    assert encode.merger.texts == 1


@pytest.mark.parametrize(("joined", "core"), [(1, 0), (7, 5), (50, 20)])
def test_bounds(monkeypatch, joined, core):
    monkeypatch.setattr(P, "JOINED_PIECES", joined)
    monkeypatch.setattr(P, "CORE_PIECES", core)
    encode = P._Encoder(VOCABULARY)
    for _ in range(2):
        assert [f.tolist() for f in encode(pa.array(TEXTS))] == expected()
        assert len(encode.pieces) == len(encode.size) == core and len(encode.ids) == encode.size.sum()


def test_pieces_one_by_one_where_letters_do_not_tell():
    encode = P._Encoder(VOCABULARY)
    encode.letters = encode.letters + 1
    assert [f.tolist() for f in encode(pa.array(TEXTS))] == expected()


def test_smaller_index_gives_the_same_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    ids = [(rng.zipf(1.4, rng.integers(1, 60)) % 400).astype("<u4") for _ in range(200)]
    ids += [np.array([900 + k], dtype="<u4") for k in range(9)]  # alike with none
    rows = [{"doc_id": k, "start": 0, "length": len(v), "doc_tokens": len(v), "ids": v.tobytes()} for k, v in enumerate(ids)]
    idf, found, kept = rng.random(1000), {}, []
    keep = P.Shard.keep
    monkeypatch.setattr(P.Shard, "keep", lambda self, mask: kept.append(len(self.row)) or keep(self, mask))
    for share in (0, 7 / 8):
        monkeypatch.setattr(P, "LEFT_ROWS", share)
        found[share] = list(P._fill(rows, idf, 64, {"sequence": 0, "offset": 0}))
    assert found[0] == found[7 / 8] and sum(p[2] for p in found[0]) == sum(map(len, ids))
    assert len(kept) > 5 and kept == sorted(kept, reverse=True)
