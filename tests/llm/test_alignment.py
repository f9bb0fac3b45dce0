import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tests.llm.conftest import EDGES
from tokenizers import Tokenizer

from telemetra.llm import alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def spans(tokens):
    out, at = [], 0
    for token in tokens:
        out.append((at, at + len(token)))
        at += len(token)
    return out


def by_definition(data, libraries):
    """Rows as the contract words them, from the libraries alone."""
    a_model, b_model = libraries
    letters = alignment.byte_letters()
    links, parts = Counter(), []
    for key, text in data:
        raw = (" " + (text or "")).encode()
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_model.encode(text or "")
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(b, map(b_model.id_to_piece, b))
        ]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            parts.append((key, [], [], [], []))
            continue
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        here = [(x, y) for x, s in zip(a, a_spans) for y, t in zip(b, b_spans) if s[0] < t[1] and t[0] < s[1]]
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, at = [], 0
        for cut in cuts:
            groups.append(
                ",".join(str(x) for x, s in zip(a, a_spans) if at <= s[0] < cut)
                + "|"
                + ",".join(str(y) for y, t in zip(b, b_spans) if at <= t[0] < cut)
            )
            at = cut
        links.update(here)
        parts.append((key, a, b, here, groups))
    most = defaultdict(int)
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    rows = [
        (
            key, len(a), len(b), len(groups), len(here),
            sum(links[p] == most[p[1]] for p in here), sum(links[p] for p in here),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if here else "",
        )
        for key, a, b, here, groups in parts
    ]
    return sorted(rows, key=repr), links, most


def found(result):
    return sorted((tuple(r) for r in result.documents().collect()), key=repr)


SAMPLES = [
    (20, "The quick brown fox, the QUICK brown fox; antidisestablishmentarianism 12345 1234567"),
    (21, "aaaa aaaaa aaaaaaa aaaaaaaaaaa    two   blanks\n\n\tand tabs\r\n"),
    (22, "Straße naïve façade 漢字かな😀👍🏽 ▁ mark"),
    (23, "<s> </s> <|endoftext|> <0x41> plain strings"),
    (24, "la casa de papel está aquí, où est-ce que c'est? don't we'll"),
]


def test_equals_definition(documents, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    data = EDGES[:-3] + SAMPLES * 2 + [(30 + i, "word " * i + "of the house " * (i % 3)) for i in range(9)]
    result = alignment.Alignment(documents(data), A_FILE, B_FILE)
    rows, links, most = by_definition(data, libraries)
    assert found(result) == rows
    pairs = {(r.a_id, r.b_id): (r.n_links, r.best) for r in result.pairs().collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in links.items()}


def test_edges(edges, libraries):
    assert found(alignment.Alignment(edges, A_FILE, B_FILE)) == by_definition(EDGES, libraries)[0]


def test_empty_table_and_text_ids(spark, documents, libraries):
    assert alignment.Alignment(documents([]), A_FILE, B_FILE).documents().count() == 0
    frame = spark.createDataFrame([("x", "one two", 1, 2), (None, None, 1, 2)], "name string, body string, block int, ids int")
    result = alignment.Alignment(frame, A_FILE, B_FILE, "name", "body")
    assert found(result) == by_definition([("x", "one two"), (None, None)], libraries)[0]


def test_long_text(documents, libraries):
    text = "Einigkeit und Recht, liberté égalité; 2 + 2 = 4. " * 40_000
    [row] = alignment.Alignment(documents([(1, text)]), A_FILE, B_FILE).documents().collect()
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    assert (row.n_a, row.n_b) == (len(a), len(b)) and row.n_links >= max(len(a), len(b))


def test_ids_are_those_of_the_library(libraries):
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in [*range(0x250), *range(0x300, 0x370), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0x1F600, 0xFEFF]]
    vocabulary = alignment.ByteVocabulary(A_FILE)
    texts = [" " + "".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    texts += [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}'s" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for text, encoded in zip(texts, libraries[0].encode_batch(texts, add_special_tokens=False), strict=True):
        assert vocabulary.encode(text) == encoded.ids


def test_identity_map_has_the_same_bytes():
    both = alignment.Aligner(A_FILE, B_FILE)
    known = np.flatnonzero(both.identity >= 0)
    assert len(known) > 10_000
    assert all(both.a.bytes[i] == both.b.bytes[both.identity[i]] for i in known)
