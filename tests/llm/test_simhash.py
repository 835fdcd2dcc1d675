import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from postrank.llm import simhash
from postrank.llm.components import roots
from postrank.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables, same_columns


def slow_fingerprint(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [found] if len(found) < width else [found[i : i + width] for i in range(len(found) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(points, linked):
    """Smallest id reachable, by union over all pairs."""
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if linked(points[i], points[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(points))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [r[1] for r in EDGES if r[1] != EDGES[11][1]])
def test_fingerprint(text):
    if len(text or "") < 1000:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_column_equals_spark_hash(spark):
    """The shingle hash is Spark's own xxhash64."""
    assert spark.sql("select xxhash64('a b c')").first()[0] == signed(int(simhash.shingle_hashes("A b\nC", 3)[0]))


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_ball_pairs_find_all(spark, radius):
    random.seed(radius)
    base = [random.getrandbits(16) for _ in range(12)]
    values = list({b ^ sum(1 << i for i in random.sample(range(16), random.randint(0, 4))) for b in base for _ in range(6)})
    frame = spark.createDataFrame([(0, v) for v in values], "part int, value long")
    got = {tuple(r) for r in simhash.ball_pairs(frame, 16, radius, star=False).select("a", "b").collect()}
    assert got == {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= radius}
    if radius % 2 == 0:
        stars = [tuple(r) for r in simhash.ball_pairs(frame, 16, radius).select("a", "b").collect()]
        assert set(stars) <= got
        want = slow_components(values, lambda x, y: (x ^ y).bit_count() <= radius)
        kept = slow_components(values, lambda x, y: (x, y) in set(stars) or (y, x) in set(stars))
        assert len(set(want)) == len(set(kept))
    else:
        with pytest.raises(ValueError):
            simhash.ball_pairs(frame, 16, radius, star=True)


def test_top_bit_pairs(spark):
    values = [signed(v) for v in (0, 1 << 63, (1 << 63) | 1, (1 << 64) - 1)]
    frame = spark.createDataFrame([(0, v) for v in values], "part int, value long")
    got = {frozenset(r) for r in simhash.ball_pairs(frame, star=False).select("a", "b").collect()}
    assert got == {frozenset(p) for p in ((values[0], values[1]), (values[0], values[2]), (values[1], values[2]))}


def test_roots(spark):
    random.seed(7)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    edges += [(2000, i) for i in range(2001, 2100)]
    got = dict(tuple(r) for r in roots(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    neighbours = {n: set() for n in nodes}
    for a, b in edges:
        if a != b:
            neighbours[a].add(b)
            neighbours[b].add(a)
    want = {}
    for n in nodes:
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo += neighbours[x]
    assert got == want
    assert roots(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    root = slow_components(prints, lambda x, y: (x ^ y).bit_count() <= 2)
    ids = {}
    for (d, _), r in zip(rows, root):
        ids.setdefault(r, []).append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in ids.items()}
    return sorted(((d, f, least[r]) for (d, _), f, r in zip(rows, prints, root)), key=str)


def test_groups_on_edges(docs):
    rows = [(r[0], r[1]) for r in EDGES if len(r[1] or "") < 1000]
    got = simhash.simhash_groups(docs([document(*r) for r in rows])).collect()
    assert sorted(((r.doc_id, r.value & (1 << 64) - 1, r.component_id) for r in got), key=str) == brute(rows)
    assert simhash.simhash_groups(docs([])).count() == 0
    assert simhash.simhash_groups(docs()).count() == len(EDGES)


@needs_tables
def test_query_on_given_tables(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    got = QUERIES["op7_simhash_dedup"](spark, SF_DIR).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=str) == brute(rows)
    assert all(len(r.fingerprint) == 16 for r in got)


# ---- texts ----

def slow_set(text):
    found = (text or "").lower().split()
    return {" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def similar(a, b):
    a, b = slow_set(a), slow_set(b)
    return len(a & b) / len(a | b) >= 0.8 if a | b else True


def make(words, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(3000)}" for _ in range(words)]


def planted():
    """Originals, and copies with a few words changed, in groups of two to forty."""
    rng, rows, truth = random.Random(3), [], []
    for g, (size, n) in enumerate([(2, 60), (2, 120), (3, 300), (40, 400), (2, 2000), (5, 150)]):
        base = make(n, g)
        for c in range(size):
            copy = list(base)
            for _ in range(0 if c == 0 else max(1, n // 150)):
                copy[rng.randrange(n)] = f"new{rng.randrange(10**6)}"
            rows.append(document(len(rows), " ".join(copy)))
            truth.append(g)
    for i in range(60):
        rows.append(document(len(rows), " ".join(make(100, 1000 + i))))
        truth.append(100 + i)
    return rows, truth


def test_near_copies_go_and_others_stay(docs):
    rows, truth = planted()
    out = simhash.drop_near_duplicates(docs(rows))
    same_columns(docs(rows), out)
    kept = [truth[r.doc_id] for r in out.collect()]
    assert sorted(kept) == sorted(set(truth))


def test_pairs_are_similar(docs, spark):
    rows, _ = planted()
    table = docs(rows).withColumn("_key", F.col("doc_id"))
    prints = simhash.table_columns(table, "_key").withColumn("row", F.col("name"))
    pairs = simhash.near_pairs(table, "_key", prints.select("row", "name", "values")).collect()
    assert pairs and all(similar(rows[p.a][1], rows[p.b][1]) for p in pairs)


def test_texts_on_edges(docs):
    out = simhash.drop_near_duplicates(docs())
    same_columns(docs(), out)
    kept = [r.text for r in out.collect()]
    assert not any(similar(a, b) for i, a in enumerate(kept) for b in kept[:i])
    assert all(any(similar(r[1], k) for k in kept) for r in EDGES)
    assert simhash.drop_near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("bits, tables", [(32, 24), (32, 8), (40, 12), (24, 3)])
def test_tables_of_other_sizes(monkeypatch, bits, tables):
    monkeypatch.setattr(simhash, "TABLE_BITS", bits)
    monkeypatch.setattr(simhash, "TABLES", tables)
    for n in (1, 2, 254, 255, 256, 255 * 16 + 1, 9000):
        hashes = np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64)
        lanes = simhash._mixed(hashes, -(-bits * tables // 64))
        want = []
        for t in range(tables):
            at = [divmod(t * bits + b, 64) for b in range(bits)]
            want.append(sum(1 << b for b, (lane, bit) in enumerate(at) if 2 * int((lanes[:, lane] >> np.uint64(bit) & np.uint64(1)).sum()) > n))
        assert simhash.table_prints(hashes).tolist() == want


def test_tables_of_empty_texts():
    assert simhash.table_prints(simhash.shingle_hashes(None, 5)).tolist() == [0] * simhash.TABLES


def test_majority_of_many(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 70_001, dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))
    assert int(simhash.majority(hashes)[0]) == want


# ---- all pairs at 0.8, by brute force ----

def edited(words, share, kind, rng):
    """A copy with a share of the words changed: scattered, one replaced block, or a tail added."""
    n = max(1, round(len(words) * share))
    new = [f"n{rng.randrange(10**9)}" for _ in range(n)]
    if kind == "appended":
        return words + new
    out = list(words)
    at = rng.randrange(len(words) - n + 1)
    places = rng.sample(range(len(words)), n) if kind == "scattered" else range(at, at + n)
    for i, w in zip(places, new):
        out[i] = w
    return out


def hard():
    """An original with variants, block edits, tails and scattered edits near 0.8, at many lengths."""
    rng, texts = random.Random(11), []
    for n in (3, 5, 8, 12, 20, 33, 60, 100, 180, 400):
        for kind, low, high in (("scattered", 0.012, 0.03), ("replaced", 0.06, 0.14), ("appended", 0.12, 0.28)):
            for _ in range(8):
                base = [f"b{rng.randrange(10**9)}" for _ in range(n)]
                texts += [base, edited(base, rng.uniform(low, high), kind, rng)]
    base = [f"b{rng.randrange(10**9)}" for _ in range(400)]
    texts += [base] + [edited(base, rng.uniform(0.013, 0.02), "scattered", rng) for _ in range(250)]
    footer = [f"f{i}" for i in range(60)]
    texts += [[f"u{rng.randrange(10**9)}" for _ in range(60)] + footer for _ in range(60)]
    pair = ["x", "y"]
    texts += [pair * 100, pair * 150 + ["x"], ["y"] + pair * 9, pair * 3 + ["z"] + pair * 50]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [" ".join(texts[i]) for i in order] + ["", None, " "]


def similar_pairs(texts):
    sets = [slow_set(t) for t in texts]
    where, found = {}, set()
    for i, s in enumerate(sets):
        for other in {j for x in s for j in where.get(x, ())} if s else {j for j in range(i) if not sets[j]}:
            if 5 * len(s & sets[other]) >= 4 * len(s | sets[other]):
                found.add((other, i))
        for x in s:
            where.setdefault(x, []).append(i)
    return found


def left_of(docs, texts):
    """Documents the search keeps."""
    return {r.doc_id for r in simhash.drop_near_duplicates(docs([document(i, t) for i, t in enumerate(texts)])).collect()}


def test_components_are_those_of_all_pairs(docs):
    """Texts near 0.8 of every kind: nothing unlike is joined, and at least 0.95 of what is alike goes."""
    texts = hard()
    truth = similar_pairs(texts)
    root = slow_components(list(range(len(texts))), lambda x, y: (y, x) in truth)
    kept = left_of(docs, texts)
    assert {root[d] for d in kept} == set(root)
    groups = len(set(root))
    assert len(kept) - groups <= 0.05 * (len(texts) - groups)


def at_similarity(words, j, kind, rng):
    """A copy whose sets of shingles have a similarity just above ``j``."""
    share = {"scattered": 0.04, "replaced": 0.14, "appended": 0.3}[kind]
    while True:
        other = edited(words, share, kind, rng)
        a, b = slow_set(" ".join(words)), slow_set(" ".join(other))
        if len(a & b) / len(a | b) >= j:
            return other
        share *= 0.95


@pytest.mark.parametrize("low, least", [(0.80, 0.93), (0.83, 0.96), (0.88, 0.99)])
def test_recall_by_similarity(docs, low, least):
    """Pairs of 80 to 500 words for each kind of edit: how many of their copies go."""
    rng, texts = random.Random(int(low * 100)), []
    for kind in ("scattered", "replaced", "appended"):
        for _ in range(100):
            base = [f"b{rng.randrange(10**9)}" for _ in range(rng.choice([80, 150, 300, 500]))]
            texts += [" ".join(base), " ".join(at_similarity(base, low + rng.uniform(0, 0.02), kind, rng))]
    pairs = len(texts) // 2
    found = 2 * pairs - len(left_of(docs, texts))
    print(f"similarity {low}: {found} of {pairs}")
    assert found >= least * pairs


def test_an_original_draws_its_variants(docs):
    """250 variants, mostly unlike each other: their links all go to the original."""
    rng = random.Random(12)
    base = [f"b{rng.randrange(10**9)}" for _ in range(400)]
    texts = [" ".join(base)] + [" ".join(at_similarity(base, rng.uniform(0.82, 0.88), "scattered", rng)) for _ in range(250)]
    assert len(left_of(docs, texts)) <= 1 + 250 * 0.05


def test_shared_footers_give_few_candidates(docs, spark):
    """2000 unlike texts with the same last 40 %: fewer candidates than 1 % of the pairs."""
    rng = random.Random(13)
    footer = [f"f{i}" for i in range(120)]
    texts = [" ".join([f"u{rng.randrange(10**9)}" for _ in range(180)] + footer) for _ in range(2000)]
    table = docs([document(i, t) for i, t in enumerate(texts)]).withColumn("_key", F.col("doc_id"))
    prints = simhash.written(simhash.table_columns(table, "_key"), "prints")
    sizes = simhash.meetings(prints).groupBy("meeting").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0] or 0
    assert sizes < 0.01 * 2000 * 1999 / 2
    assert simhash.near_pairs(table, "_key", prints.select("row", "name", "values")).count() == 0


def test_rows_apart_from_their_head_go_round_again(spark, docs):
    """One meeting with two groups that are not alike: both are joined, each to its own head."""
    one, two = make(120, 1), make(120, 2)
    texts = [" ".join(x[:i] + ["new"] + x[i + 1 :]) for x in (one, two) for i in (5, 60, 115)]
    table = docs([document(i, t) for i, t in enumerate(texts)]).withColumn("_key", F.col("doc_id"))
    prints = simhash.written(simhash.table_columns(table, "_key").withColumn("row", F.col("name")), "prints")
    prints = prints.withColumn("values", F.array_repeat(F.lit(7).cast("long"), simhash.TABLES))  # all meet everywhere
    pairs = [(r.a, r.b) for r in simhash.near_pairs(table, "_key", prints.select("row", "name", "values")).collect()]
    root = slow_components(list(range(6)), lambda x, y: (x, y) in pairs or (y, x) in pairs)
    assert len(set(root[:3])) == len(set(root[3:])) == 1 and root[0] != root[3]


def test_scratch_of_the_search_is_freed(docs, spark, tmp_path):
    import os

    from postrank.storage import shared_folder

    folder = shared_folder(spark)
    old = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = simhash.drop_near_duplicates(docs(planted()[0]))
    labels = {name.split("-")[0] for name in os.listdir(folder) if name not in old}
    assert out.count() and "groups" in labels
    assert not labels & {"values", "met", "active", "headed", "likely", "numbered", "meetings"}


def test_links_through_a_row_joined_to_its_head(spark, docs):
    """Chains a~b~c in one meeting, a and c unlike: rows joined to a head still link the others."""
    texts = []
    for seed in (3, 4, 5, 6):
        base = make(120, seed)
        near = [f"n{i}" if i in (10, 50) else w for i, w in enumerate(base)]
        far = [f"f{i}" if i in (80, 105) else w for i, w in enumerate(near)]
        texts += [" ".join(far), " ".join(near), " ".join(base)]
    for i in range(0, len(texts), 3):
        a, b, c = texts[i : i + 3]
        assert similar(a, b) and similar(b, c) and not similar(a, c)
    table = docs([document(i, t) for i, t in enumerate(texts)]).withColumn("_key", F.col("doc_id"))
    prints = simhash.written(simhash.table_columns(table, "_key").withColumn("row", F.col("name")), "prints")
    prints = prints.withColumn("values", F.array_repeat(F.lit(7).cast("long"), simhash.TABLES))  # all meet everywhere
    pairs = [(r.a, r.b) for r in simhash.near_pairs(table, "_key", prints.select("row", "name", "values")).collect()]
    root = slow_components(list(range(len(texts))), lambda x, y: (x, y) in pairs or (y, x) in pairs)
    assert all(len({root[i], root[i + 1], root[i + 2]}) == 1 for i in range(0, len(texts), 3))
    assert len({root[i] for i in range(0, len(texts), 3)}) == len(texts) // 3


def test_parts_and_edges_of_every_round_are_freed(docs, spark):
    """Each round's components leave no table behind, so disk does not grow with the rounds."""
    import os

    from postrank.storage import shared_folder

    folder = shared_folder(spark)
    old = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = simhash.drop_near_duplicates(docs(planted()[0]))
    labels = [name.split("-")[0] for name in os.listdir(folder) if name not in old]
    assert out.count() and "linked" in labels
    assert not {"parts", "edges"} & set(labels)


def test_a_meeting_of_unlike_rows_ends_in_few_rounds(spark, docs, monkeypatch):
    """60 unlike rows meet everywhere: the rounds grow with the logarithm of the meeting, not its size."""
    texts = [" ".join(make(120, 100 + i)) for i in range(60)]
    table = docs([document(i, t) for i, t in enumerate(texts)]).withColumn("_key", F.col("doc_id"))
    prints = simhash.written(simhash.table_columns(table, "_key").withColumn("row", F.col("name")), "prints")
    prints = prints.withColumn("values", F.array_repeat(F.lit(7).cast("long"), simhash.TABLES))  # all meet everywhere
    labels, store = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda t, label, *a: labels.append(label) or store(t, label, *a))
    pairs = simhash.near_pairs(table, "_key", prints.select("row", "name", "values")).collect()
    assert pairs == [] and labels.count("headed") <= 8
