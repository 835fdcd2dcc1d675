"""Collocations: phrases of two to four words whose parts seldom occur apart.

Everything is counted for each language alone (null: ``und``). A-Z are lower-cased,
texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
(``[^\\x20\\x09]+``). A candidate occurs LEAST times or more, inside pieces, overlaps
included. Cut behind its first k words it scores ``floor(2000000 a / (l + r))`` from its
count a and those of its parts, l and r; its lowest cut counts. A candidate goes if some
longer one holds it and has 80 % of its occurrences or more. The rest are ranked.

Branch and bound, best first. Words and pairs are counted as a whole. A phrase of m words
grows by one word only if its bound reaches the threshold of its language: the phrases
that begin with it occur at most a times, and their cuts behind the first 1 to m - 1 words
have the prefix counts known by now, so none of them scores above the least
``floor(2000000 a / (l + a))``. The threshold is the score of the pair at some depth of the
language. When all phrases that may reach it are counted, and those around each
candidate that reaches it (one word longer at either end: a longer phrase never occurs more
often than those in between), everything at or above the threshold is settled, ties
included. A language with fewer survivors than wanted goes on at a greater depth, down to
threshold 0, where nothing is left out.

Pairs are counted by a 64-bit key first, so that only those which may be frequent are
counted by their full names. Counting is one pass over the texts: each task names words by 128-bit hashes and phrases
by mixing these, counts its blocks, and one group-by with map-side combining adds up.
Which phrases to count is told to the tasks by Bloom filters of at most MOST_BITS bits.
A filter that errs counts a phrase too many, and counts it right, so nothing depends
on its size but time.

Null texts count as empty; texts without words, empty tables and rows that repeat need no
special care (a repeated row counts again). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postrank.llm.bpe import text_blocks
from postrank.llm.rows import quoted
from postrank.storage import free, written

LEAST, LONGEST, WANTED = 30, 4, 2000
SCALE = 2_000_000
#: The first threshold is the score of the pair at this depth; each further round goes so many times deeper.
FIRST_DEPTH, DEEPER = 3 * WANTED, 6
#: Bits of a filter for each entry, and bounds of its size: 8 MB at most.
ENTRY_BITS, LEAST_BITS, MOST_BITS, PROBES = 16, 1 << 16, 1 << 26, 3
#: Bytes of text counted at once in a task.
COUNT_BYTES = 4 << 20
#: Ways a language is split for its first ranking.
SPLIT = 64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: 0 in a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

DIGESTS = ("g1", "g2", "p1", "p2", "s1", "s2")
COUNTED = "lang string, " + ", ".join(f"{c} long" for c in DIGESTS) + ", a long"


# ---- inside tasks ----

def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The digests (rows of two numbers) of phrases with a word put behind each."""
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    with np.errstate(over="ignore"):
        return _mixed((prefix ^ _mixed(word + odd)) * (odd | np.uint64(1)) + word[:, ::-1])


def word_digests(words: pa.LargeBinaryArray) -> np.ndarray:
    """128 bits of each word, as rows of two numbers: sums of a mixed number for every
    byte at its place, mixed again with the length."""
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    sizes = np.diff(ends)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    ends = ends - ends[0]
    place = (np.arange(len(data)) - np.repeat(ends[:-1], sizes)).astype(np.uint64)
    some = np.flatnonzero(sizes)
    made = np.zeros((len(words), 2), np.uint64)
    with np.errstate(over="ignore"):
        for lane, odd in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
            mixed = _mixed((place << np.uint64(8) | data) * np.uint64(odd) + np.uint64(odd))
            if len(some):
                made[some, lane] = np.add.reduceat(mixed, ends[:-1][some])
            made[:, lane] = _mixed(made[:, lane] + sizes.astype(np.uint64) * np.uint64(odd))
    return made


def language(lang: str) -> np.uint64:
    """What a filter adds to the phrases of a language."""
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7))


def filter_key(digest: np.ndarray, language: np.ndarray) -> np.ndarray:
    """The number that stands for each phrase of a language in filters."""
    return _mixed(digest[:, 0] ^ language)


def probes(key: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bits of a filter that stand for each key."""
    with np.errstate(over="ignore"):
        step = _mixed(key + np.uint64(1)) | np.uint64(1)
        for i in range(PROBES):
            yield (key + np.uint64(i) * step) & np.uint64(bits - 1)


class Filter:
    """A Bloom filter of keys."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    def holds(self, key: np.ndarray) -> np.ndarray:
        held = np.ones(len(key), bool)
        for bit in probes(key, 64 * len(self.words)):
            held &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return held


class Words:
    """The words of a block of texts in one line."""

    def __init__(self, texts: pa.LargeStringArray, langs: list[str]) -> None:
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held else np.empty(0, np.uint8)
        ends = ends - ends[0]
        kind = KIND[data]
        inside = kind == 0
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        heads = ends[:-1][ends[:-1] < len(data)]
        start[heads] = inside[heads]
        at = np.flatnonzero(start)
        before = np.cumsum(inside, dtype=np.int32)  # a block has less than 2^31 bytes, or is one text
        bounds = np.concatenate([before[at] - 1, before[-1:]]).astype(np.int64) if len(at) else np.zeros(1, np.int64)
        letters = LOWER[data[inside]]
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.word, self.dictionary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        text = np.searchsorted(ends, at, side="right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)[at] if len(data) else np.empty(0, np.int32)
        #: Whether a word and the next one are in one piece.
        self.joined = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
        names = sorted(set(langs))
        number = {n: i for i, n in enumerate(names)}
        self.langs = names
        self.lang = np.array([number[x] for x in langs], np.int64)[text]
        self.languages = np.array([language(n) for n in names], np.uint64)
        self.language = self.languages[self.lang]
        self._digest: np.ndarray | None = None

    def digest(self) -> np.ndarray:
        """The digest of each different word."""
        if self._digest is None:
            self._digest = word_digests(self.dictionary)
        return self._digest

    def in_filter(self, chosen: Filter) -> np.ndarray:
        """Which words are in a filter: each different word is looked up once a language."""
        if len(self.languages) * len(self.dictionary) > len(self.word):
            return chosen.holds(filter_key(self.digest()[self.word], self.language))
        held = np.stack([chosen.holds(filter_key(self.digest(), x)) for x in self.languages]) if len(self.languages) else np.empty((0, 0), bool)
        return held[self.lang, self.word]


def count_words(texts: pa.LargeStringArray, langs: list[str]) -> pa.RecordBatch:
    """Rows (lang, word, a), and one row without a word for each language: all its words."""
    words = Words(texts, langs)
    size = len(words.dictionary) + 1
    key, count = np.unique(words.lang * size + words.word, return_counts=True)
    totals = np.bincount(words.lang, minlength=len(words.langs))
    names = pa.array(words.langs, pa.string())
    of = names.take(pa.array(key // size)) if len(key) else pa.array([], pa.string())
    word = words.dictionary.cast(pa.string(), safe=False).take(pa.array(key % size)) if len(key) else pa.array([], pa.string())
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([of, names]), pa.concat_arrays([word, pa.nulls(len(names), pa.string())]),
        pa.array(np.concatenate([count, totals]).astype(np.int64)),
    ], ["lang", "word", "a"])


def frequent_places(words: Words, size: int, frequent: Filter) -> np.ndarray:
    """Where phrases of ``size`` words that are all frequent begin."""
    known = words.in_filter(frequent)
    n = max(0, len(words.word) - size + 1)
    good = np.ones(n, bool)
    for i in range(size):
        good &= known[i : i + n]
    for i in range(size - 1):
        good &= words.joined[i : i + n]
    return np.flatnonzero(good)


def _digests(words: Words, at: np.ndarray, length: int) -> np.ndarray:
    of = words.digest()
    made = of[words.word[at]]
    for i in range(1, length):
        made = longer(made, of[words.word[at + i]])
    return made


def _ends(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the prefix and suffix of one word less; where phrases overlap, made once."""
    needed = np.zeros(len(words.word) + 1, bool)
    needed[at] = needed[at + 1] = True
    made = _digests(words, np.flatnonzero(needed), size - 1)
    place = np.cumsum(needed, dtype=np.int32) - 1
    return made[place[at]], made[place[at + 1]]


def _kinds(words: Words, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each different phrase of a block is found, how often), by the numbers of its words."""
    kinds = len(words.dictionary) + 1
    key = words.lang[at]
    for i in range(size):
        key = key * kinds + words.word[at + i]
        if 0 < i < size - 1:
            key = np.unique(key, return_inverse=True)[1]
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    return at[first], count.astype(np.int64)


def count_pair_keys(texts: pa.LargeStringArray, langs: list[str], frequent: Filter) -> pa.RecordBatch:
    """Rows (key, a) of pairs: all there is to say which may be frequent."""
    words = Words(texts, langs)
    at, count = _kinds(words, frequent_places(words, 2, frequent), 2)
    key = filter_key(_digests(words, at, 2), words.language[at])
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count)], ["key", "a"])


def count_phrases(texts: pa.LargeStringArray, langs: list[str], size: int, frequent: Filter,
                  prefix: Filter | None, suffix: Filter | None, whole: Filter | None) -> pa.RecordBatch:
    """Rows (lang, digest g, that of its prefix p and suffix s of one word less, a) of phrases
    of ``size`` frequent words whose prefix, suffix or whole is in the filter for it."""
    words = Words(texts, langs)
    at = frequent_places(words, size, frequent)
    spoken = words.language[at]
    wanted = np.zeros(len(at), bool)
    if prefix or suffix:
        p, s = _ends(words, at, size)
        if prefix:
            wanted |= prefix.holds(filter_key(p, spoken))
        if suffix:
            wanted |= suffix.holds(filter_key(s, spoken))
    if whole:
        wanted |= whole.holds(filter_key(_digests(words, at, size), spoken))
    at, count = _kinds(words, at[wanted], size)
    p, s = _ends(words, at, size)
    g = longer(p, words.digest()[words.word[at + size - 1]])
    names = pa.array(words.langs, pa.string())
    lang = names.take(pa.array(words.lang[at])) if len(at) else pa.array([], pa.string())
    columns = [x[:, i].copy().view(np.int64) for x in (g, p, s) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([lang, *map(pa.array, columns), pa.array(count)], ["lang", *DIGESTS, "a"])


# ---- on Spark ----

def _counted(docs: DataFrame, count: Callable[[pa.Array, list[str]], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            at = 0
            for block in text_blocks(texts, COUNT_BYTES):
                yield count(block, batch.column("lang").slice(at, len(block)).to_pylist())
                at += len(block)

    return docs.mapInArrow(run, schema)


def narrowed(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    return docs.select(
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"), F.coalesce(F.col(quoted(lang)), F.lit("und")).alias("lang")
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, a, w1, w2) of frequent words, and of each language's total, whose word is null."""

    @F.pandas_udf("w1 long, w2 long")
    def digest(words):
        import pandas as pd

        found = word_digests(pa.array(words.fillna(""), pa.large_string()).cast(pa.large_binary()))
        return pd.DataFrame(found.view(np.int64), columns=["w1", "w2"])

    counts = _counted(docs, count_words, "lang string, word string, a long").groupBy("lang", "word").agg(F.sum("a").alias("a"))
    return counts.filter(F.col("word").isNull() | (F.col("a") >= LEAST)).select(
        "lang", "word", "a", digest("word").alias("d")
    ).select("lang", "word", "a", "d.w1", "d.w2")


def filter_of(found: DataFrame) -> Filter:
    """A filter of rows (lang, digest, digest), or of keys. What the driver gets is the
    filter's words that are not zero."""
    count = found.count()
    bits = LEAST_BITS
    while bits < min(MOST_BITS, ENTRY_BITS * count):
        bits *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_columns == 1:
                key = batch.column(0).to_numpy().view(np.uint64)
            else:
                digest = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in (1, 2)], axis=1)
                coded = batch.column(0).dictionary_encode()
                spoken = np.array([language(x) for x in coded.dictionary.to_pylist()], np.uint64)
                key = filter_key(digest, spoken[coded.indices.to_numpy()])
            bit = np.concatenate(list(probes(key, bits)))
            order = np.argsort(bit)
            word, value = (bit >> np.uint64(6))[order], (np.uint64(1) << (bit & np.uint64(63)))[order]
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            yield pa.RecordBatch.from_arrays([
                pa.array(word[starts].astype(np.int64)), pa.array(np.bitwise_or.reduceat(value, starts).view(np.int64))
            ], ["word", "bits"])

    words = np.zeros(bits // 64, np.uint64)
    if count:
        placed = found.mapInArrow(place, "word long, bits long")
        bits_ = placed.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words[bits_.column("word").to_numpy()] = bits_.column("bits").to_numpy().view(np.uint64)
    return Filter(words)


def pair_filter(docs: DataFrame, frequent: Filter) -> Filter:
    """The pairs that may occur LEAST times or more, by counts of their keys alone.

    Most different pairs of a corpus are rare; here they cost one number each.
    """
    told = docs.sparkSession.sparkContext.broadcast(frequent)
    keys = _counted(docs, lambda texts, langs: count_pair_keys(texts, langs, told.value), "key long, a long")
    found = written(keys.groupBy("key").agg(F.sum("a").alias("a")).filter(F.col("a") >= LEAST).select("key"), "keys")
    chosen = filter_of(found)
    free(found)
    return chosen


def phrase_counts(docs: DataFrame, size: int, frequent: Filter, prefix: Filter | None = None,
                  suffix: Filter | None = None, whole: Filter | None = None) -> DataFrame:
    """Phrases of ``size`` words that occur LEAST times or more, out of those asked for."""
    told = docs.sparkSession.sparkContext.broadcast((frequent, prefix, suffix, whole))
    parts = _counted(docs, lambda texts, langs: count_phrases(texts, langs, size, *told.value), COUNTED)
    return (
        parts.groupBy("lang", "g1", "g2")
        .agg(*[F.first(c).alias(c) for c in DIGESTS[2:]], F.sum("a").alias("a"))
        .filter(F.col("a") >= LEAST)
    )


def score(a: Column, rest: Column) -> Column:
    """floor(SCALE a / rest), exact beyond 64 bits."""
    return F.call_function("div", a.cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(7,0)"), rest.cast("decimal(20,0)"))


def _cut(l: str, r: str) -> Column:
    return F.struct(score(F.col("a"), F.col(l) + F.col(r)).alias("score"), F.col(l).alias("l"), F.col(r).alias("r"))


def _lowest(cuts: list[tuple[str, str]]) -> Column:
    """The cut of least score, the first of equals: an array's smallest struct of (score, k, ...)."""
    numbered = [F.struct(_cut(l, r)["score"].alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
                for k, (l, r) in enumerate(cuts, 1)]
    return F.least(*numbered) if len(numbered) > 1 else numbered[0]


def _bound(prefixes: list[str]) -> Column:
    found = [score(F.col("a"), F.col(p) + F.col("a")) for p in prefixes]
    return F.least(*found) if len(found) > 1 else found[0]


def _known(table: DataFrame, name: str, **columns: str) -> DataFrame:
    """A table to join by digest ``name``; ``columns`` maps new names to its own."""
    first, second = ("w1", "w2") if "w1" in table.columns else ("g1", "g2")
    return table.select(
        "lang", F.col(first).alias(f"{name}1"), F.col(second).alias(f"{name}2"), *[F.col(c).alias(n) for n, c in columns.items()]
    )


def _beside(found: DataFrame, table: DataFrame, name: str, **columns: str) -> DataFrame:
    return found.join(_known(table, name, **columns), ["lang", f"{name}1", f"{name}2"])


KEPT = ("lang", "g1", "g2", "p1", "p2", "s1", "s2", "a", "phrase", "last", "bound", "best")


def scored_pairs(found: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with their words, score and bound."""
    joined = _beside(_beside(found, words, "p", l1="a", head="word"), words, "s", last_count="a", last="word")
    return joined.select(
        *DIGESTS, "lang", "a", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "l1", "last_count",
        _bound(["l1"]).alias("bound"), _lowest([("l1", "last_count")]).alias("best"),
    )


def scored_triples(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples: a prefix and a suffix that occurs as often is a pair, so both are there."""
    joined = _beside(_beside(found, pairs, "p", l1="l1", l2="a", head="phrase"), pairs, "s", tail="a", last_count="last_count", last="last")
    return joined.select(
        *DIGESTS, "lang", "a", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "l1", "l2", "tail", "last_count",
        _bound(["l1", "l2"]).alias("bound"), _lowest([("l1", "tail"), ("l2", "last_count")]).alias("best"),
    )


def scored_fours(found: DataFrame, triples: DataFrame) -> DataFrame:
    joined = _beside(
        _beside(found, triples, "p", l1="l1", l2="l2", l3="a", head="phrase"),
        triples, "s", tail="a", tail2="tail", last_count="last_count", last="last",
    )
    return joined.select(
        *DIGESTS, "lang", "a", F.concat_ws(" ", "head", "last").alias("phrase"),
        _lowest([("l1", "tail"), ("l2", "tail2"), ("l3", "last_count")]).alias("best"),
    )


def thresholds(pairs: DataFrame, depth: int) -> DataFrame:
    """(lang, least): the score of the pair at a depth of each language, 0 if it has not so many.

    Works on counts by score, of which a language has at most 1,000,001.
    """
    by_score = pairs.groupBy("lang", F.col("best.score").alias("score")).agg(F.count("*").alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    return (
        by_score.withColumn("above", above).groupBy("lang")
        .agg(F.max(F.when(F.col("above") >= depth, F.col("score"))).alias("least"))
        .select("lang", F.coalesce("least", F.lit(0).cast("long")).alias("least"))
    )


def ranked(found: DataFrame, limit: int) -> DataFrame:
    """The best of each language, with their rank; split first, so that no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPLIT))
    few = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = few.filter(F.col("rank") <= limit).drop("rank", "part")
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.filter(F.col("rank") <= limit)


def mine_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", limit: int = WANTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``limit`` phrases of each language.

    By score and count (descending), then phrase (by bytes). A language may have fewer.
    """
    rows = narrowed(docs, text, lang)
    counts = written(word_counts(rows), "words")
    totals = counts.filter("word is null").select("lang", F.col("a").alias("n"))
    words = counts.filter("word is not null")
    frequent = filter_of(words.select("lang", "w1", "w2"))
    counted = phrase_counts(rows, 2, frequent, whole=pair_filter(rows, frequent))
    pairs = written(scored_pairs(counted, words), "pairs")
    chosen = lambda table: filter_of(table.select("lang", "g1", "g2"))
    open_, depth, found = pairs.select("lang").distinct(), max(limit, 1) * FIRST_DEPTH // WANTED, None
    while True:
        wanted = pairs.join(open_, "lang", "left_semi")
        least = written(thresholds(wanted, depth), "least")
        reach = lambda table: table.join(least, "lang").filter("best.score >= least").drop("least")
        grow = lambda table: table.join(least, "lang").filter("bound >= least")
        around = written(
            phrase_counts(rows, 3, frequent, chosen(grow(wanted)), chosen(reach(wanted))), "triples"
        )
        triples = written(scored_triples(around, pairs), "scored")
        beyond = written(
            phrase_counts(rows, 4, frequent, chosen(grow(triples)), chosen(reach(triples))), "fours"
        )
        # The last three words of a phrase of four may not have been asked for.
        grown = grow(triples).select("lang", F.col("g1").alias("p1"), F.col("g2").alias("p2"))
        missing = written(
            beyond.join(grown, ["lang", "p1", "p2"], "left_semi")
            .select("lang", F.col("s1").alias("g1"), F.col("s2").alias("g2")).distinct()
            .join(triples, ["lang", "g1", "g2"], "left_anti"), "missing",
        )
        if not missing.isEmpty():
            more = phrase_counts(rows, 3, frequent, whole=chosen(missing)).join(missing, ["lang", "g1", "g2"], "left_semi")
            triples = triples.unionByName(written(scored_triples(more, pairs), "scored"))
        fours = scored_fours(beyond, triples)
        columns = ["lang", "g1", "g2", "phrase", "a", "best"]
        all_ = reach(wanted).select(columns).union(reach(triples).select(columns)).union(reach(fours).select(columns))
        longer_ = around.select("lang", "p1", "p2", "a").union(around.select("lang", "s1", "s2", "a"))
        longer_ = longer_.union(beyond.select("lang", "p1", "p2", "a")).union(beyond.select("lang", "s1", "s2", "a"))
        most = longer_.toDF("lang", "g1", "g2", "most").groupBy("lang", "g1", "g2").agg(F.max("most").alias("most"))
        stays = F.col("most").isNull() | (F.col("most").cast("decimal(21,0)") * 100 < F.col("a").cast("decimal(21,0)") * 80)
        left = all_.join(most, ["lang", "g1", "g2"], "left").filter(stays)
        top = written(ranked(left.select("lang", "phrase", "a", "best.l", "best.r", "best.score"), limit), "top")
        enough = top.groupBy("lang").agg(F.count("*").alias("rows"))
        still = least.join(enough, "lang", "left").filter((F.col("least") > 0) & (F.coalesce("rows", F.lit(0)) < limit))
        open_ = written(still.select("lang"), "open")
        settled = top.join(open_, "lang", "left_anti")
        found = settled if found is None else found.union(settled)
        if open_.isEmpty():
            break
        depth *= DEEPER
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
