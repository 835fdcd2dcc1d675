"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common point at
no more than half of that from both. So every distinct fingerprint emits all
points within half the radius, the points are shuffled, and those that meet at a
point are pairs to verify. Equal fingerprints are collapsed first, by a group-by
that combines in the map task; what meets at one point is then at most a ball of
different fingerprints (65 for 64 bits and radius 2), whatever the data.

Two uses:

``simhash_groups`` links fingerprints at ``radius`` bits exactly: none is missed
and copies cost nothing. With an even radius all that meet at a point are within
the radius of each other, so a star to the smallest keeps every component.

``drop_near_duplicates`` finds texts whose sets of five-word shingles have a
Jaccard similarity of 0.8 or more. At 0.8 the fingerprints of two sets differ in 15 % of
their bits, whatever was edited: scattered words, one block, or a tail. So each set
gets TABLES independent fingerprints of TABLE_BITS bits, of which some are within
RADIUS bits with probability 0.95 at 0.8, 0.99 at 0.85 and more above. What meets at a
point of a table's ball is linked to one head, the row that meets most others, after a
test on all bits and a comparison of the shingle sets themselves; rows that are not
linked to it go round again with more heads, twice as many each round, until none is
left. No meeting is capped, and none is paired out: a meeting of M rows ends within about
log2(M) rounds, and only a meeting of many unlike rows makes pairs of the order of M**2,
which are all compared; the search then takes as many rounds as before.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.llm.components import roots
from postrank.llm.phrases import filter_of
from postrank.llm.rows import keyed, only, quoted
from postrank.storage import free, written

SEED = 42
SHINGLE, BITS, RADIUS = 3, 64, 2
#: Fingerprints of a set of shingles: bits, how many, and how many are searched at once,
#: which bounds the disk.
TABLE_BITS, TABLES, TABLES_AT_ONCE = 32, 24, 6
#: Bits for the table and for the mask in a packed point.
PART_BITS, MASK_BITS = 8, 6
#: For texts: what decides.
VERIFY_SHINGLE, SIMILARITY = 5, 0.8
#: Of all bits, pairs that differ in more are not compared: at similarity 0.8 some 116 of 768
#: differ, and 168 are five standard deviations more.
FAR = 168


def shingle_hashes(text: str | None, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of ``width`` words, repeats included.

    A-Z are lower-cased; words hold no ASCII white space. Fewer words than the
    width give one shingle of all words; no word gives none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    count = max(1, len(found) - width + 1)
    last = min(width, len(found)) - 1
    return np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:count], ends[last:])), np.uint64, count
    )


def majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the hashes, which have one or more words of 64 bits each."""
    count = 1 if hashes.ndim == 1 else hashes.shape[1]
    ones = np.zeros(count * 64, np.int64)
    for at in range(0, len(hashes), 16384):  # bounds the unpacked bits of a very long text
        block = np.ascontiguousarray(hashes[at : at + 16384].astype("<u8")).reshape(-1, count)
        ones += np.unpackbits(block.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8").astype(np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; zero if it has no word."""
    return int(majority(shingle_hashes(text, width))[0])


def fingerprint_column(text: Column, width: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return simhash(text)


def ball_masks(bits: int, half: int) -> list[int]:
    """What leads from a value to all those within ``half`` bits, as signed numbers."""
    masks = [sum(1 << b for b in at) for k in range(half + 1) for at in combinations(range(bits), k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def ball_groups(points: DataFrame, bits: int = BITS, radius: int = RADIUS) -> DataFrame:
    """(part, values): what meets at a point, two values or more, in ascending order.

    ``points`` has (part, value), without repeats; part is from 0 to 255. At most a ball
    of half the radius meets at a point.
    """
    half = (radius + 1) // 2
    # Many rows come of each point, so the points are spread by number, not by size.
    # What is shuffled is the point and which mask led to it, packed when they fit.
    masks = ball_masks(bits, half)
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = points.repartition(tasks, "part", "value")
    known = F.array(*[F.lit(m).cast("long") for m in masks])
    if bits + PART_BITS + MASK_BITS <= 64 and len(masks) <= 1 << MASK_BITS:
        place = F.shiftleft(F.col("part").cast("long"), bits).bitwiseOR(F.col("value").bitwiseXOR(F.col("mask")))
        emitted = spread.select("part", "value", F.posexplode(known).alias("i", "mask")).select(
            F.shiftleft(place, MASK_BITS).bitwiseOR(F.col("i").cast("long")).alias("packed")
        )
        key, led = F.shiftright("packed", MASK_BITS), F.col("packed").bitwiseAND(F.lit((1 << MASK_BITS) - 1)).cast("int")
        point = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
        return (
            emitted.repartition(tasks, key).select(key.alias("key"), led.alias("i"))
            .groupBy("key").agg(F.collect_list("i").alias("i"))  # at most one ball
            .filter(F.size("i") > 1)
            .select(
                F.shiftright("key", bits).cast("int").alias("part"),
                F.sort_array(F.transform("i", lambda i: point.bitwiseXOR(F.get(known, i)))).alias("values"),
            )
        )
    return (
        spread.select("part", "value", F.explode(known).alias("mask"))
        .select("part", F.col("value").bitwiseXOR(F.col("mask")).alias("point"), "value")
        .repartition(tasks, "point")
        .groupBy("part", "point").agg(F.sort_array(F.collect_list("value")).alias("values"))
        .filter(F.size("values") > 1)
        .select("part", "values")
    )


def ball_pairs(points: DataFrame, bits: int = BITS, radius: int = RADIUS, star: bool | None = None) -> DataFrame:
    """(a, b), a < b as signed numbers: distinct ``value`` of ``points`` in one ``part``
    that differ in 1 to ``radius`` bits.

    ``points`` as for ``ball_groups``. ``star`` (default: if the
    radius is even) gives only the pairs with the smallest value at each point,
    which have the same connected components.
    """
    star = radius % 2 == 0 if star is None else star
    if star and radius % 2:
        raise ValueError("a star keeps all components for an even radius only")
    met = ball_groups(points, bits, radius)
    if star:
        pairs = met.select(
            "part", F.col("values")[0].alias("a"), F.explode(F.slice("values", 2, F.size("values"))).alias("b")
        )
    else:
        pairs = met.select("part", F.posexplode("values").alias("i", "a"), "values").select(
            "part", "a", F.explode(F.slice("values", F.col("i") + 2, F.size("values"))).alias("b")
        )
    return pairs.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = SHINGLE,
                   radius: int = RADIUS) -> DataFrame:
    """doc_id, value (the fingerprint), component_id for every row.

    ``component_id`` is the smallest doc_id that links of at most ``radius`` bits
    reach. Null texts count as empty; texts without a word have fingerprint zero
    and link like any other. A null doc_id is never a component_id unless the
    whole component has none. Repeated rows and other columns change nothing.
    """
    prints = written(
        docs.select(F.col(quoted(doc_id)).alias("doc_id"), fingerprint_column(F.col(quoted(text)), width).alias("value")),
        "prints",
    )
    classes = written(prints.groupBy("value").agg(F.min("doc_id").alias("least")), "classes")
    edges = ball_pairs(classes.select(F.lit(0).alias("part"), "value"), BITS, radius)
    linked = roots(edges.select("a", "b")).withColumnRenamed("node", "value")
    labelled = classes.join(linked, "value", "left").withColumn("root", F.coalesce("root", "value"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labelled.select("value", "root").join(least, "root").select("value", "component_id")
    return prints.join(labels, "value").select("doc_id", "value", "component_id")


def _mixed(hashes: np.ndarray, count: int) -> np.ndarray:
    """``count`` independent 64-bit hashes of each hash, by a fixed mixer."""
    with np.errstate(over="ignore"):
        x = hashes[:, None] + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def table_prints(hashes: np.ndarray) -> np.ndarray:
    """The TABLES fingerprints of a set of shingle hashes, as numbers.

    Ones are counted eight bits a word, for at most 255 rows before they are spread out.
    """
    lanes = -(-TABLES * TABLE_BITS // 64)
    ones = np.zeros(lanes * 64, np.int64)
    for at in range(0, len(hashes), 255 * 16):  # bounds the unpacked bits of a very long text
        block = _mixed(hashes[at : at + 255 * 16], lanes).astype("<u8")
        bits = np.unpackbits(block.view(np.uint8), axis=1, bitorder="little").view(np.uint64)
        for i in range(0, len(bits), 255):
            ones += np.add.reduce(bits[i : i + 255], axis=0).view(np.uint8)
    majority_ = (ones * 2 > len(hashes))[: TABLES * TABLE_BITS].reshape(TABLES, TABLE_BITS)
    return (majority_.astype(np.int64) << np.arange(TABLE_BITS)).sum(axis=1)


def _search_columns(text: Column) -> Column:
    """``same``, equal for texts of equal shingle sets only, and ``values``, the fingerprints."""

    @F.pandas_udf("same binary, values array<long>")
    def columns(texts: pd.Series) -> pd.DataFrame:
        same, values = [], []
        for text in texts:
            found = np.unique(shingle_hashes(text, VERIFY_SHINGLE))
            same.append(xxhash.xxh3_128_digest(found.astype("<u8").tobytes()))
            values.append(table_prints(found))
        return pd.DataFrame({"same": same, "values": values})

    return columns(text)


def _shingle_set(text: Column) -> Column:
    """The sorted set of five-word shingle hashes, as bytes."""

    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: np.unique(shingle_hashes(t, VERIFY_SHINGLE)).astype("<u8").tobytes(), na_action=None)

    return sets(text)


def _jaccard(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(x, y):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0

        return pd.Series([one(x, y) for x, y in zip(left, right)], dtype=float)

    return jaccard(a, b)


def _distance(a: Column, b: Column) -> Column:
    """Bits in which two lists of fingerprints differ."""
    apart = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda n, x: n + x)


def _place(part: Column | str, value: Column | str) -> Column:
    """A table and a value in it, as one number."""
    return F.shiftleft(F.col(part).cast("long") if isinstance(part, str) else part, TABLE_BITS).bitwiseOR(F.col(value))


def places(prints: DataFrame, first: int = 0, count: int | None = None) -> DataFrame:
    """(place, row) of the fingerprints of some tables."""
    values = F.slice("values", first + 1, TABLES if count is None else count)
    return prints.select("row", F.posexplode(values).alias("i", "value")).select(
        _place(F.col("i").cast("long") + first, "value").alias("place"), "row"
    )


def meetings(prints: DataFrame) -> DataFrame:
    """(meeting, row): rows whose fingerprints in a table are equal or meet at a point.

    Fingerprints meet as different values, of which a point has at most one ball,
    whatever the data; how many rows have a value plays no part until here.
    """
    parts = []
    for first in range(0, TABLES, TABLES_AT_ONCE):
        part = F.shiftright("place", TABLE_BITS).cast("int").alias("part")
        value = F.col("place").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).alias("value")
        held = places(prints, first, min(TABLES_AT_ONCE, TABLES - first))
        values = written(held.groupBy("place").agg(F.count("*").alias("rows")).select(part, value, "rows"), "values")
        alone = values.filter("rows > 1").select(F.array(_place("part", "value")).alias("places"))
        met = ball_groups(values.select("part", "value"), TABLE_BITS, RADIUS).select(
            F.transform("values", lambda v: F.shiftleft(F.col("part").cast("long"), TABLE_BITS).bitwiseOR(v)).alias("places")
        )
        parts.append(written(met.union(alone).distinct(), "met"))
        free(values)
    found = reduce(DataFrame.union, parts)
    numbered = written(found.select(F.monotonically_increasing_id().alias("meeting"), "places"), "numbered")
    free(*parts)
    members = numbered.select("meeting", F.explode("places").alias("place"))
    rows = places(prints).join(members.select("place").distinct(), "place", "left_semi")
    met = written(members.join(rows, "place").select("meeting", "row"), "meetings")
    free(numbered)
    return met


def in_order(met: DataFrame) -> DataFrame:
    """(meeting, row, order): the row that meets most has the highest order.

    An original meets all its variants, so it is the head wherever it is.
    """
    sizes = met.groupBy("meeting").agg(F.count("*").alias("size"))
    often = met.join(sizes, "meeting").groupBy("row").agg(F.sum("size").alias("often"))
    order = F.shiftleft(F.least("often", F.lit((1 << 42) - 1)), 20).bitwiseOR(F.pmod(F.xxhash64("row"), F.lit(1 << 20)))
    return met.join(often.select("row", order.alias("order")), "row")


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def likely_pairs(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs whose fingerprints leave open that they are similar."""
    of = lambda end: prints.select(F.col("row").alias(end), F.col("values").alias(f"{end}_values"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(_distance(F.col("a_values"), F.col("b_values")) <= FAR).select("a", "b")


def shingle_sets(table: DataFrame, key: str, prints: DataFrame, members: DataFrame, text: str = "text") -> DataFrame:
    """(row, body): the sets of the rows of ``members``.

    A Bloom filter of bounded size keeps most other texts from being shuffled at all.
    """
    names = written(prints.select("row", "name").join(members, "row"), "names")
    told = table.sparkSession.sparkContext.broadcast(filter_of(names.select(F.xxhash64("name"))))

    @F.pandas_udf("boolean")
    def wanted(keys: pd.Series) -> pd.Series:
        return pd.Series(told.value.holds(keys.to_numpy().view(np.uint64)))

    near = table.select(F.col(quoted(key)).alias("name"), F.col(quoted(text)).alias("body"))
    near = near.filter(wanted(F.xxhash64("name")))
    return written(near.join(names, "name").select("row", _shingle_set(F.col("body")).alias("body")), "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity): the pairs whose sets are similar."""
    left = sets.select(F.col("row").alias("a"), F.col("body").alias("a_set"))
    right = sets.select(F.col("row").alias("b"), F.col("body").alias("b_set"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", _jaccard(F.col("a_set"), F.col("b_set")).alias("similarity"))
        .filter(F.col("similarity") >= SIMILARITY)
    )


def near_pairs(table: DataFrame, key: str, prints: DataFrame, text: str = "text") -> DataFrame:
    """(a, b, similarity): verified pairs of rows that join all similar rows which meet.

    ``table`` is keyed by ``key``; ``prints`` has row (a number), name (the key)
    and values (the fingerprints), stored.
    """
    met = meetings(prints)
    active = written(in_order(met), "active")
    free(met)
    found = sets = parts = None
    spread = 0
    while True:
        # Rows joined to a head stay, so that the rest still meet them; a meeting ends when one
        # part is left in it. The best head comes from its smallest part; beyond it a meeting
        # takes about 2**spread - 1 more, drawn by hash, so that a meeting of many unlike rows
        # ends in rounds as many as the logarithm of its size, every pair in it still compared.
        rooted = active.withColumn("root", F.col("row"))
        if parts is not None:
            rooted = active.join(parts, "row", "left").withColumn("root", F.coalesce("root", "row"))
        shares = rooted.groupBy("meeting", "root").agg(F.count("*").alias("share"))
        live = shares.groupBy("meeting").agg(F.count("*").alias("roots"), F.sum("share").alias("size"))
        ranked = rooted.join(live.filter("roots > 1").select("meeting", "size"), "meeting").join(shares, ["meeting", "root"])
        rank = F.struct((-F.col("share")).alias("share"), F.col("order"))
        best = ranked.groupBy("meeting").agg(F.max_by("row", rank).alias("best"))
        drawn = F.pmod(F.xxhash64("row", F.lit(spread)), F.col("size")) < F.lit((1 << spread) - 1)
        head = ((F.col("row") == F.col("best")) | drawn).alias("head")
        headed = written(ranked.join(best, "meeting").select("meeting", "row", "root", "order", head), "headed")
        free(active)
        heads = headed.filter("head").select("meeting", F.col("row").alias("a"), F.col("root").alias("a_root"))
        others = headed.select("meeting", F.col("row").alias("b"), F.col("root").alias("b_root"))
        pairs = _ordered_pairs(heads.join(others, "meeting").filter("a_root <> b_root").select("a", "b"))
        likely = written(likely_pairs(pairs, prints), "likely")
        if not likely.isEmpty():
            members = likely.select(F.col("a").alias("row")).union(likely.select("b")).distinct()
            if sets is not None:
                members = members.join(sets, "row", "left_anti")
            more = shingle_sets(table, key, prints, members, text)
            sets = more if sets is None else sets.union(more)
            linked = written(verified(likely, sets), "linked")
            found = linked if found is None else found.union(linked)
            # The parts so far and this round's links have the components of all links, in
            # rows as many as the linked rows and new links, not as all links found.
            edges = linked.select("a", "b")
            if parts is not None:
                edges = parts.select("row", "root").union(edges)
            linkage = roots(edges)
            old, parts = parts, written(linkage.withColumnRenamed("node", "row"), "parts")
            free(linkage, *([] if old is None else [old]))
        elif found is None:
            found = table.sparkSession.createDataFrame([], "a long, b long, similarity double")
        active = written(headed.filter(~F.col("head")).select("meeting", "row", "order"), "active")
        free(headed, likely)
        spread = min(spread + 1, 62)
        if active.isEmpty():
            free(active, *([] if parts is None else [parts]))
            return found


def apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that ``parts`` (row, root) leaves in different components."""
    of = lambda end: parts.select(F.col("row").alias(end), F.col("root").alias(f"{end}_root"))
    joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return joined.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select(*pairs.columns)


def table_columns(table: DataFrame, key: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """row, name, id, chars, same, values: the narrow rows all of the search works on."""
    source = F.col(quoted(text))
    found = table.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("name"), F.col(quoted(doc_id)).alias("id"),
        F.length(F.coalesce(source, F.lit(""))).alias("chars"), _search_columns(source).alias("found"),
    )
    return found.select("row", "name", "id", "chars", "found.same", "found.values")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each group of near copies, and all others, with their columns.

    Of a group the longest text stays, then the smallest doc_id (null last), then
    the row stored first. Null counts as empty; documents without a word are near
    copies of each other. An empty table gives an empty table. Repeated rows are
    copies like any other; texts of any length are compared whole; columns of any
    name stay as they are.
    """
    table, key = keyed(docs, "near")
    prints = written(table_columns(table, key, text, doc_id), "prints")
    heads = prints.groupBy("same").agg(F.min("row").alias("a"), F.count("*").alias("rows")).filter("rows > 1")
    equal = written(prints.select("same", F.col("row").alias("b")).join(heads, "same").filter("a <> b").select("a", "b"), "equal")
    searched = prints.join(equal.select(F.col("b").alias("row")), "row", "left_anti").select("row", "name", "values")
    linked = near_pairs(table, key, searched, text).select("a", "b").union(equal)
    linkage = roots(linked)
    groups = written(linkage.withColumnRenamed("node", "row"), "groups")
    free(linkage)
    order = F.struct((-F.col("chars")).alias("order"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row")).alias("order")
    ranked = written(prints.select("row", "name", order).join(groups, "row"), "ranked")
    stays = ranked.groupBy("root").agg(F.min("order").alias("best")).select("root", F.col("best.row").alias("stays"))
    gone = ranked.join(stays, "root").filter("row <> stays")
    return only(table, key, gone, how="left_anti").select(*map(quoted, docs.columns))
