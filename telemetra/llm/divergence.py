"""How far the vocabularies of the sources of a language lie apart, with late string materialisation.

Terms are counted by a 64-bit digest of language and term. Tasks count whole blocks of texts before
anything moves; what is shuffled to be summed is digest, group and two numbers. The strings stay in the
written counts of the blocks. One pass over their distinct ones takes the smallest and the largest
string of each digest: where they differ, the digest stands for several terms, and its counts are told
apart by the strings themselves. At the end the text is joined back to the few terms that are reported.

A group is a source of a language. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.common import rows, written

#: Shares are counted in parts of this.
UNIT = 1_000_000_000
#: Counts of terms in groups that a task holds before it hands them on.
BLOCK_TERMS = 1_200_000
#: Rows of a batch that leaves a task.
BATCH_TERMS = 20_000
#: Pairs of groups of a batch that are compared at once.
PAIRS_AT_ONCE = 1 << 20

#: Letters of a term, A-Z in lower case: every byte but the ASCII ones that are no letters.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


def digest(language: int, term: bytes) -> int:
    """A digest of the term in this language, as a signed 64-bit number."""
    value = xxhash.xxh3_64_intdigest(term, seed=language & 0xFFFFFFFFFFFFFFFF)
    return value - (1 << 64) if value >> 63 else value


def groups_of(frame: DataFrame) -> tuple[DataFrame, int]:
    """``(l, g, lang, source)`` per group, with digests of the language and of the group, and their seed.

    The seed is raised until no two groups, and no two languages, share a digest.
    """
    pairs = written(frame.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        groups = pairs.select(*group_digests(seed), "lang", "source")
        facts = groups.agg(F.count("*"), F.count_distinct("g"), F.count_distinct("l"), F.count_distinct("lang")).first()
        if facts[0] == facts[1] and facts[2] == facts[3]:
            return groups, seed
        seed += 1


def group_digests(seed: int) -> list[Column]:
    language = F.xxhash64(F.lit(seed), "lang")
    return [language.alias("l"), F.xxhash64(language, "source").alias("g")]


def block_counts(frame: DataFrame) -> DataFrame:
    """``(l, d, docs, term, g, n)`` per term and block of texts, as a table.

    ``docs`` are the texts of the block that have the term, ``n`` its occurrences in each group of ``g``.
    """
    names = ["l", "d", "docs", "term", "g", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, dict[int, Counter]] = defaultdict(lambda: defaultdict(Counter))
        docs: dict[int, Counter] = defaultdict(Counter)

        def lines(language: int, of_group: dict[int, Counter]) -> pa.RecordBatch:
            with_term = docs.pop(language)
            number = {term: i for i, term in enumerate(with_term)}
            place = np.fromiter((number[t] for c in of_group.values() for t in c), dtype=np.int64)
            n = np.fromiter((x for c in of_group.values() for x in c.values()), dtype=np.int64)
            g = np.repeat(np.array(list(of_group), dtype=np.int64), [len(c) for c in of_group.values()])
            order = np.argsort(place, kind="stable")
            offsets = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(number)))]).astype(np.int32)
            columns = [
                pa.array(np.full(len(number), language)),
                pa.array([digest(language, term) for term in number], type=pa.int64()),
                pa.array(list(with_term.values()), type=pa.int64()),
                pa.array(list(number), type=pa.binary()),
                pa.ListArray.from_arrays(offsets, g[order]),
                pa.ListArray.from_arrays(offsets, n[order]),
            ]
            return pa.record_batch(columns, names=names)

        def blocks() -> Iterator[pa.RecordBatch]:
            while counts:
                block = lines(*counts.popitem())
                for start in range(0, block.num_rows, BATCH_TERMS):
                    yield block.slice(start, BATCH_TERMS)

        size = 0
        for language, group, text in rows(batches):
            words = terms_of(text)
            own = counts[language][group]
            size -= len(own)
            own.update(words)
            docs[language].update(set(words))
            size += len(own)
            if size > BLOCK_TERMS:
                yield from blocks()
                size = 0
        yield from blocks()

    kinds = "l bigint, d bigint, docs bigint, term binary, g array<bigint>, n array<bigint>"
    return written(frame.mapInArrow(run, kinds), "term-counts")


def spellings(counts: DataFrame) -> DataFrame:
    """``(d, l, term, other_l, other_term)``: the smallest and the largest string of each digest, as a table."""
    string = F.struct("l", "term")
    ends = counts.groupBy("d").agg(F.min(string).alias("a"), F.max(string).alias("z"))
    return written(
        ends.select("d", "a.l", "a.term", F.col("z.l").alias("other_l"), F.col("z.term").alias("other_term")), "spellings"
    )


def told_apart(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(d, part, docs, g, n)`` and ``(d, part, term)``: a digest of one string is its part 0, the strings
    of any other digest are its parts from 1 on."""
    strings = spellings(counts)
    shared = strings.where((F.col("l") != F.col("other_l")) | (F.col("term") != F.col("other_term")))
    shared = written(shared.select("d"), "shared-digests")
    plain = counts.select("d", F.lit(0).alias("part"), "docs", "g", "n")
    names = strings.select("d", F.lit(0).alias("part"), "term")
    if shared.isEmpty():
        return plain, names
    both = counts.join(shared, "d")
    parts = both.select("d", "l", "term").distinct()
    parts = parts.withColumn("part", F.row_number().over(Window.partitionBy("d").orderBy("l", "term")))
    split = both.join(parts, ["d", "l", "term"])
    return (
        plain.join(shared, "d", "left_anti").unionByName(split.select(plain.columns)),
        names.join(shared, "d", "left_anti").unionByName(parts.select("d", "part", "term")),
    )


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """``(d, part, total, groups)``: terms in enough documents of their language, with each group's count, as a table.

    One exchange, by term; a term has at most one row per block in it.
    """
    rows = counts.repartition("d", "part").select("d", "part", "docs", F.posexplode(F.arrays_zip("g", "n")).alias("at", "x"))
    docs = F.sum(F.when(F.col("at") == 0, F.col("docs")).otherwise(0)).alias("docs")
    by_group = rows.groupBy("d", "part", F.col("x.g").alias("g")).agg(F.sum("x.n").alias("n"), docs)
    terms = by_group.groupBy("d", "part").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("g", "n")).alias("groups")
    )
    return written(terms.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")


def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kinds)), exactly, also where the product leaves 64 bits."""
    small = F.expr(f"bigint({UNIT})") * (n + 1)
    large = n.cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)") + F.lit(UNIT).cast("decimal(10,0)")
    few = n < F.lit((1 << 63) // UNIT - 1)
    return 1 + F.when(few, whole(F.when(few, small), total + kinds)).otherwise(
        whole(large, (total + kinds).cast("decimal(20,0)"))
    )


def whole(number: Column, by: Column) -> Column:
    """The whole part of a quotient of numbers that are not negative."""
    return F.call_function("div", number, by)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most UNIT + 1, so squares fit into 64 bits."""
    return whole((p - q) * (p - q), q)


def group_facts(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """``(g, l, lang, source, n_group, kinds, n_lang, p0)`` per group, as a table; ``p0`` is the share of a term it lacks."""
    n_group = terms.select(F.inline("groups")).groupBy("g").agg(F.sum("n").alias("n_group"))
    by_first = terms.groupBy(F.col("groups")[0]["g"].alias("g")).agg(F.count("*").alias("kinds"), F.sum("total").alias("n_lang"))
    by_lang = by_first.join(groups, "g").groupBy("l").agg(F.sum("kinds").alias("kinds"), F.sum("n_lang").alias("n_lang"))
    facts = groups.join(n_group, "g", "left").join(by_lang, "l", "left").na.fill(0, ["n_group", "kinds", "n_lang"])
    p0 = F.when(F.col("kinds") > 0, share(F.lit(0).cast("bigint"), F.col("n_group"), F.col("kinds")))
    return written(facts.withColumn("p0", p0), "group-facts")


def shares_of(terms: DataFrame, facts: DataFrame) -> DataFrame:
    """``(d, part, g, l, total, n_lang, kinds, p, p0)`` per kept term and group that has it."""
    rows = terms.select("d", "part", "total", F.inline("groups"))
    known = rows.join(facts.drop("lang", "source"), "g")
    return known.withColumn("p", share(F.col("n"), F.col("n_group"), F.col("kinds")))


def typical_terms(shares: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """``(g, item, value, rank)``: the terms a group has most above its language.

    Ranks by value alone select the rows whose text is looked up, with all ties of the last; text then decides ties.
    """
    valued = shares.withColumn("q", share(F.col("total"), F.col("n_lang"), F.col("kinds"))).where("p > q")
    valued = valued.select("g", "d", "part", gap(F.col("p"), F.col("q")).alias("value"))
    by_value = F.rank().over(Window.partitionBy("g").orderBy(F.desc("value")))
    best = valued.withColumn("rank", by_value).where(F.col("rank") <= top).drop("rank")
    named = best.join(names, ["d", "part"]).select("g", F.col("term").cast("string").alias("item"), "value")
    order = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def met_pairs(shares: DataFrame) -> DataFrame:
    """``(g, h, value)``: what terms that both groups have add to the gaps of terms that one of them has.

    Partial sums over blocks of terms; a term of very many groups is cut as well.
    """
    by_term = shares.groupBy("d", "part").agg(F.collect_list(F.struct("g", "p", "p0")).alias("x"))
    frame = by_term.where(F.size("x") > 1).select("x.g", "x.p", "x.p0")

    def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(0).value_lengths(), dtype=np.int64)
            g, p, p0 = (batch.column(i).flatten().to_numpy() for i in range(3))
            groups, number = np.unique(g, return_inverse=True)
            partners = np.repeat(sizes, sizes)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            end = np.cumsum(partners)
            start = 0
            while start < len(g):
                stop = max(start + 1, int(np.searchsorted(end, (end[start - 1] if start else 0) + PAIRS_AT_ONCE)))
                n = partners[start:stop]
                left = np.repeat(np.arange(start, stop), n)
                right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[start:stop], n)
                left, right = left[left != right], right[left != right]
                a, b, a0, b0 = p[left], p[right], p0[left], p0[right]
                keys, place = np.unique(number[left] * len(groups) + number[right], return_inverse=True)
                sums = np.zeros(len(keys), dtype=np.int64)
                np.add.at(sums, place, gaps(a, b) - gaps(a, b0) - gaps(a0, b) + gaps(a0, b0))
                values = groups[keys // len(groups)], groups[keys % len(groups)], sums
                yield pa.record_batch([pa.array(v) for v in values], names=["g", "h", "value"])
                start = stop

    return frame.mapInArrow(run, "g bigint, h bigint, value bigint")


def source_gaps(shares: DataFrame, facts: DataFrame) -> DataFrame:
    """``(g, h, value)``: the gaps of two sources of a language, summed over all its kept terms.

    All terms count as lacking in both at first. A histogram of a group's shares then corrects the terms it
    has against every other group, and terms that both have are corrected together.
    """
    other = facts.select("l", F.col("g").alias("h"), F.col("p0").alias("h0"))
    both = facts.where("kinds > 0").join(other, "l").where("g <> h")
    lacking = both.select("g", "h", (F.col("kinds") * gap(F.col("p0"), F.col("h0"))).alias("value"))
    shares = shares.select("d", "part", "g", "l", "p", "p0")
    histogram = shares.groupBy("g", "l", "p", "p0").agg(F.count("*").alias("times")).join(other, "l").where("g <> h")
    p, p0, h0 = F.col("p"), F.col("p0"), F.col("h0")
    once = histogram.groupBy("g", "h").agg(
        F.sum(F.col("times") * (gap(p, h0) - gap(p0, h0))).alias("here"),
        F.sum(F.col("times") * (gap(h0, p) - gap(h0, p0))).alias("there"),
    )
    sides = F.explode(F.array(F.struct("g", "h", F.col("here").alias("value")), F.struct(F.col("h").alias("g"), F.col("g").alias("h"), F.col("there").alias("value"))))
    parts = lacking.unionByName(once.select(sides.alias("x")).select("x.*")).unionByName(met_pairs(shares))
    return parts.groupBy("g", "h").agg(F.sum("value").alias("value"))


class Divergence:
    """Counts of a corpus, from which ``pairs()`` and ``terms()`` are reported.

    Null text, language and source are empty strings. A group without terms, or a language without kept
    terms, has pairs of value 0 and no terms. Repeated rows are documents each; other columns are not
    read. An empty table gives empty results.
    """

    def __init__(
        self, docs: DataFrame, least_docs: int = 3, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
    ) -> None:
        names = {"text": text_col, "lang": lang_col, "source": source_col}
        frame = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in names.items()))
        self.groups, seed = groups_of(frame)
        self.counts, self.names = told_apart(block_counts(frame.select(*group_digests(seed), "text")))
        self.terms_kept = kept_terms(self.counts, least_docs)
        self.facts = group_facts(self.groups, self.terms_kept)
        self.shares = shares_of(self.terms_kept, self.facts)

    def pairs(self) -> DataFrame:
        """``(lang, source, item, value, rank)``: the gap of each source to each other one of its language."""
        own = self.facts.select("l", "g", "lang", "source")
        other = self.facts.select("l", F.col("g").alias("h"), F.col("source").alias("item"))
        found = own.join(other, "l").where("g <> h").join(source_gaps(self.shares, self.facts), ["g", "h"], "left")
        order = Window.partitionBy("g").orderBy(F.desc("value"), "item")
        found = found.withColumn("value", F.coalesce("value", F.lit(0)))
        return found.withColumn("rank", F.row_number().over(order)).select("lang", "source", "item", "value", "rank")

    def terms(self, top: int = 200) -> DataFrame:
        """``(lang, source, item, value, rank)``: the ``top`` terms of each source that are above its language."""
        found = typical_terms(self.shares, self.names, top)
        return found.join(self.facts.select("g", "lang", "source"), "g").select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame) -> DataFrame:
    """Both reports in one frame, told apart by ``part``."""
    found = Divergence(docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs, terms = (df.withColumn("part", F.lit(part)).select(columns) for part, df in (("pair", found.pairs()), ("term", found.terms())))
    return pairs.unionByName(terms)
