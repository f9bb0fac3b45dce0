import random
import re
from collections import Counter, defaultdict

import pytest

from telemetra.llm import divergence
from telemetra.llm.common import table

UNIT = 10**9
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_definition(data, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in data:
        lang, source = lang or "", source or ""
        words = [w.translate(LOWER) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in docs[lang].items() if n >= 3}
        sources = sorted(s for x, s in groups if x == lang)
        own = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        n_group = {s: sum(own[s].values()) for s in sources}
        total = {t: sum(own[s][t] for s in sources) for t in kept}
        n_lang = sum(total.values())
        p = {s: {t: 1 + UNIT * (own[s][t] + 1) // (n_group[s] + len(kept)) for t in kept} for s in sources}
        q = {t: 1 + UNIT * (total[t] + 1) // (n_lang + len(kept)) for t in kept}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                items = items if part == "pair" else items[:top]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items, 1)]
    return sorted(out)


def frame(spark, data):
    rows = [(i, text, lang, source, 1, 2) for i, (text, lang, source) in enumerate(data)]
    schema = "doc_id long, text string, lang string, source string, g int, term int"
    return spark.createDataFrame(rows, schema).repartition(4)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = ["the", "House", "naïve", "straße", "漢字", "Über", "x", "re-do", "a_b", "L'été", *(f"w{chr(97 + i)}" for i in range(26))]
    weights = [1 / (1 + i) for i in range(len(words))]
    pick = lambda n: " ".join(rng.choices(words, weights, k=n))
    data = [(pick(rng.randint(0, 60)), rng.choice(["en", "de", "en"]), rng.choice("abcde")) for _ in range(150)]
    data += [(pick(30), "en", "hot") for _ in range(100)]
    data += [(None, "en", "a"), ("", None, None), ("the the", None, ""), ("12 34 \x00\t!", "xx", "a"), ("rare", "xx", "b")]
    return data + [("The Über", "fr", None)] * 3


def test_equals_definition(spark, corpus):
    assert found(divergence.audit(frame(spark, corpus))) == by_definition(corpus)


def test_small_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 5)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    assert found(divergence.audit(frame(spark, corpus))) == by_definition(corpus)


def test_colliding_digests(spark, corpus, monkeypatch):
    """Few digests for all terms of all languages: their strings tell them apart."""
    monkeypatch.setattr(divergence, "digest", lambda language, term: sum(term) % 3)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 50)
    result = divergence.Divergence(frame(spark, corpus))
    assert result.names.where("part = 0").count() == 0
    assert found(divergence.audit(frame(spark, corpus))) == by_definition(corpus)


def test_ties_at_the_last_rank(spark):
    data = [(" ".join(f"t{chr(97 + i)}" for i in range(20)), "en", "a")] * 3 + [("other words", "en", "b")] * 3
    result = divergence.Divergence(frame(spark, data)).terms(top=7)
    expected = [x[:2] + x[3:] for x in by_definition(data, 7) if x[2] == "term"]
    assert found(result) == expected and len(expected) == 9


def test_shares_beyond_64_bits(spark):
    """Counts of a corpus whose product with the unit leaves 64 bits."""
    cases = [(0, 1, 0), (5, 9, 3), (10**10, 10**13, 10**9), (9 * 10**17, 9 * 10**17 + 7, 10**9), (9223372035, 10**12, 7), (9223372036, 10**12, 7)]
    df = spark.createDataFrame(cases, "n long, total long, kinds long")
    got = df.select("n", "total", "kinds", divergence.share(*map(divergence.F.col, ["n", "total", "kinds"])).alias("p"))
    assert {tuple(r) for r in got.collect()} == {(n, t, k, 1 + UNIT * (n + 1) // (t + k)) for n, t, k in cases}


def test_edges(spark):
    assert found(divergence.audit(frame(spark, []))) == []
    long = ("word " * 200_000 + "Other ", "en", "a")
    data = [long, long, long, (None, None, None), ("word", "en", "b"), ("\x85\xa0", "en", "b")]
    assert found(divergence.audit(frame(spark, data))) == by_definition(data)


def test_text_stays_in_the_blocks(spark):
    """The counts that are shuffled hold numbers only."""
    found = divergence.Divergence(table(spark, "/root/testdata/sf0.001", "documents"))
    assert {f.dataType.simpleString() for f in found.counts.schema} <= {"bigint", "int", "array<bigint>"}
    assert "term" not in found.shares.columns
