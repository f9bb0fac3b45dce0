import hashlib
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from telemetra.llm import catalogue, toxicity
from telemetra.llm.common import remainder_of_id, table, written
from telemetra.llm.words import plain_words
from tests.llm.test_decontamination import tiled_by_definition
from tests.llm.test_near_duplicates import brute as linked
from tests.llm.test_packing import ids_of

SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    kept, texts = [], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), name)
        assert docs.columns == table(spark, SF_DIR, "documents").columns
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        texts.append({r["doc_id"]: r for r in docs.collect()})
    assert all(later <= earlier for earlier, later in zip([set(before), *kept], kept, strict=False))
    model = toxicity.fit(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"), remainder_of_id("doc_id", 3) != 1)
    scores = toxicity.scored(table(spark, SF_DIR, "documents"), model).collect()
    assert kept[0] == {r["doc_id"] for r in scores if r["score"] < 0.7}
    groups = linked(sorted((i, r["text"]) for i, r in texts[0].items()), size=5)
    assert kept[1] == {i for i, _, smallest in groups if i == smallest}
    assert all(r["n_chars"] == len(r["text"]) for r in texts[2].values() if r["text"] != before[r["doc_id"]]["text"])
    assert any(r["text"] != before[i]["text"] for i, r in texts[2].items())
    assert len(kept[3]) < len(kept[2])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == kept[3]
    for i, own in by_doc.items():
        ids = b"".join(p["ids"] for p in sorted(own, key=lambda p: p["start"]))
        assert ids == b"".join(n.to_bytes(4, "little") for n in ids_of(texts[3][i]["text"]))
        assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] for p in own)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = corpus_pipeline.run(spark, SF_DIR).select(columns).collect()
    assert sorted(map(tuple, whole)) == sorted(tuple(p[c] for c in columns) for p in pieces)


def without_repeats_by_definition(texts, length=400):
    """What is left of each text when all strings that stand twice are cut, window by window."""
    windows = {
        i: [hashlib.blake2b(raw[k : k + length], digest_size=16).digest() for k in range(len(raw) - length + 1)]
        for i, raw in texts.items()
    }
    times = Counter(w for own in windows.values() for w in own)
    left = {}
    for i, raw in texts.items():
        gone = np.zeros(len(raw), dtype=bool)
        for k, window in enumerate(windows[i]):
            if times[window] > 1:
                gone[k : k + length] = True
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes().decode(errors="ignore")
        if kept or not gone.any():
            left[i] = kept
    return left


def covers_by_definition(text, item):
    """Whether half of the item's words are marked; without a common run of the least length none is."""
    least = min(5, len(item))
    if not least:
        return False
    runs = {tuple(item[k : k + least]) for k in range(len(item) - least + 1)}
    if not any(tuple(text[k : k + least]) in runs for k in range(len(text) - least + 1)):
        return False
    return tiled_by_definition(text, item, least) >= len(item) / 2


def test_repeats_and_benchmark_against_brute_force(spark):
    docs, held = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, SF_DIR), f"brute-{name}")
        held.append({r["doc_id"]: r["text"] for r in docs.collect()})
    whole = without_repeats_by_definition({i: (t or "").encode() for i, t in held[1].items()})
    assert {i: t or "" for i, t in held[2].items()} == whole
    items = [plain_words(r["text"].encode()) for r in table(spark, SF_DIR, "benchmark").collect()]
    words = {i: plain_words((t or "").encode()) for i, t in held[2].items()}
    leaked = {i for i, own in words.items() if any(covers_by_definition(own, item) for item in items)}
    assert leaked and held[3].keys() == held[2].keys() - leaked
    assert all(t == held[2][i] for i, t in held[3].items())


def test_the_catalogue_names_each_operator_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalogue.queries())
    assert numbers == list(range(1, 14))
