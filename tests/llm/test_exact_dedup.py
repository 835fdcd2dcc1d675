import hashlib
import re
from collections import defaultdict

from postrank.llm import exact_dedup
from postrank.llm.exact_dedup import drop_exact_duplicates, exact_groups
from postrank.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables, same_columns


def plain(text):
    return re.sub("[\x20\x09-\x0D]", "", text or "")


def by_brute_force(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[plain(t)].append((-len(t or ""), d is None, d or 0, d))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def check(frame, rows):
    got = exact_groups(frame).collect()
    want = by_brute_force(rows)
    digest = {hashlib.sha256(k.encode()).digest(): k for k in want}
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        key = digest[bytes(r.digest)]
        assert (r.keep_id, r.group_size) == want[key]
        kept[key] += r.kept
    assert set(kept.values()) <= {1} and len(kept) == len(want)


def test_edges(docs):
    check(docs(), [(r[0], r[1]) for r in EDGES])


def test_empty(docs):
    assert exact_groups(docs([])).count() == 0
    assert drop_exact_duplicates(docs([])).count() == 0


def test_heavy_and_rare(docs, spark):
    """A text of a third of all rows is settled by broadcast, with the same result."""
    rows = [document(i, "hot text" + " " * (i % 5) if i % 3 == 0 else f"text {i // 4}") for i in range(1500)]
    frame = docs(rows)
    check(frame, [(r[0], r[1]) for r in rows])
    narrow = exact_dedup.digests(frame)
    heavy = exact_dedup.heavy_winners(narrow).collect()
    assert [(h.group_size, h.best.doc_id) for h in heavy if h.group_size > 100] == [(500, 9)]


def test_no_python_in_the_plan(docs):
    plan = exact_groups(docs())._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_dropping_keeps_columns_and_one_of_each(docs):
    out = drop_exact_duplicates(docs())
    same_columns(docs(), out)
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert len(kept) == len({plain(t) for _, t in kept}) == len({plain(r[1]) for r in EDGES})
    assert (3, EDGES[1][1]) in kept  # most code points, white space counted


@needs_tables
def test_query_on_given_tables(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    want = by_brute_force(rows)
    texts = dict(rows)
    got = QUERIES["op1_exact_dedup"](spark, SF_DIR).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[plain(texts[r.doc_id])]
        assert r.kept == (r.keep_id == r.doc_id)
        assert r.text_sha256 == hashlib.sha256(plain(texts[r.doc_id]).encode()).hexdigest()
