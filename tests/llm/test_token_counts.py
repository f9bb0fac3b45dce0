import random

import pytest
import sentencepiece

from telemetra.llm.catalogue import tokenizer_file
from telemetra.llm.token_counts import PieceMerges, token_counts
from tests.llm.conftest import EDGES

MODEL = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(library):
    merges, source = PieceMerges(MODEL), random.Random(1)
    alphabet = "aabcdeeiotn  \n\t.,'▁éß漢😀<>0123"
    texts = ["".join(source.choices(alphabet, k=source.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "  ", "a ", " a", "▁", "a▁b", "the  the", "aaaa" * 200, "<s></s><unk><0x41>", "\r\n"]
    assert [merges.count(t) for t in texts] == [len(library.encode(t)) for t in texts]


def test_rows_and_edges(spark, edges, documents, library):
    found = sorted((tuple(r) for r in token_counts(edges, MODEL).collect()), key=repr)
    expected = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in EDGES]
    assert found == sorted(expected, key=repr)
    assert token_counts(documents([]), MODEL).count() == 0
    assert token_counts(edges, MODEL, limit=1).where("over_limit").count() == sum(r[2] > 1 for r in expected)
