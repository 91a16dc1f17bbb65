from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from digestry.llm import near_dups
from digestry.llm.decontaminate import contamination, drop_contaminated
from digestry.llm.graph_parts import components
from digestry.llm.near_dups import NearSettings, block_pruner, least_matches, near_duplicates
from digestry.llm.spots import ANCHORS, fingerprint_digest
from tests.llm.fixtures import BASE, documents, edge_rows, lowered_words, spaced_words, tuples


def shingles(text):
    words = spaced_words(text)
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set()


def roots(count, links):
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(count)]


def brute_classes(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    of = roots(len(rows), links)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[of[i]] = min(least.get(of[i], doc_id), doc_id)
    return sorted(((r[0], len(sets[i]), least.get(of[i])) for i, r in enumerate(rows)), key=repr)


def test_near_duplicates_on_edge_rows(spark):
    rows = edge_rows()
    assert tuples(near_duplicates(documents(spark, rows)), "doc_id", "n_shingles", "component_id") == brute_classes(rows)


def test_near_duplicates_in_groups_of_edits(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        text = [draw.choice(vocabulary) for _ in range(draw.choice([30, 80, 150]))]
        for _ in range(draw.choice([1, 6, 25])):
            rows.append((len(rows), " ".join(text)))
            for _ in range(draw.choice([1, 2, 3])):  # each is an edit of the one before, so groups are chains
                text = list(text)
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
    draw.shuffle(rows)
    assert tuples(near_duplicates(documents(spark, rows)), "doc_id", "n_shingles", "component_id") == brute_classes(rows)


def test_blocks_report_a_pair_from_the_first_bucket_it_shares():
    """Bytes of band 0 agree by chance, its bucket does not; the pair shares the buckets of bands 5 and 7."""
    settings = NearSettings()
    sign = bytes(settings.hashes)
    side = lambda node, codes: [{"node": node, "root": node, "n": 50, "sign": sign, "bands": codes}]
    left = list(range(settings.bands))
    right = [code if code in (5, 7) else -code - 1 for code in left]
    for band, pairs in ((0, []), (5, [(1, 2)]), (7, [])):
        batch = pa.RecordBatch.from_pylist([{"band": band, "same": False, "left": side(1, left), "right": side(2, right)}])
        got = [(r["a"], r["b"]) for found in block_pruner(settings)(iter([batch])) for r in found.to_pylist()]
        assert got == pairs


def test_blocks_of_a_large_bucket_all_meet(spark, monkeypatch):
    """Blocks of about two members, no member in another one's component: links are those of brute force."""
    monkeypatch.setattr(near_dups, "BLOCK", 2)
    base = [f"w{i}" for i in range(200)]
    rows = [(at, " ".join([*base[: 8 * at], f"x{at}", *base[8 * at + 1 :]])) for at in range(20)]
    sets = near_dups.NearSets(documents(spark, rows))
    got = sets.confirmed(sets.pruned_blocks(sets.buckets.withColumn("root", F.col("node"))))
    doc = {r["node"]: r["doc"] for r in sets.nodes.collect()}
    own = [shingles(t) for _, t in rows]
    want = {(i, j) for j in range(20) for i in range(j) if 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j])}
    assert {tuple(sorted((doc[r["a"]], doc[r["b"]]))) for r in got.collect()} == want and len(want) == 190


def test_bounds_keep_similar_pairs():
    for n, needed in least_matches(NearSettings()):
        assert 0 < needed < 0.8 * n


def test_empty_tables(spark):
    none = documents(spark, [])
    benchmark = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    assert near_duplicates(none).count() == 0
    assert contamination(none, benchmark).count() == 0
    assert fingerprint_digest(none).count() == 0
    assert contamination(documents(spark, [(1, BASE)]), benchmark.where("false")).first()["contaminated"] is False


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(i, i + 1) for i in range(60)] + [(draw.randrange(100, 300), draw.randrange(100, 300)) for _ in range(120)] + [(500, 500 + i) for i in range(1, 40)]
    want = roots(600, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = dict(tuples(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert got == {x: want[x] for x in nodes}


def brute_contamination(rows, items, window=10):
    windows = {}
    for item, text in items:
        words = lowered_words(text)
        for s in range(max(len(words) - window + 1, 1) if words else 0):
            windows.setdefault(tuple(words[s : s + window]), set()).add(item)
    out = []
    for doc_id, text, *_ in rows:
        words, hit, ids = lowered_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    ids |= own - {None}
        listed = ",".join(sorted(str(i) for i in ids))
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, BASE[40:180]), (2, "seven grey"), (3, "Word5"), (4, None), (5, "..."), (6, BASE[40:180]), (7, "a b c d e f g h i j k"), (None, "one two"), (10, BASE), (3, "grey geese fly")]
LEAKS = [(50, "a b c d e f g h i j k l a b c d e f g h i j"), (51, "b c d e f g h i j"), (52, "intro " + BASE[60:170] + " outro " + BASE[60:170]), (53, "a b c d e f g h i x j k"), (54, "seven, GREY! grey-geese FLY")]


def test_contamination_equals_brute_force(spark):
    rows = edge_rows() + LEAKS
    got = contamination(documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert tuples(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute_contamination(rows, ITEMS)


def test_contaminated_rows_go_and_others_stay_as_they_are(spark):
    rows = edge_rows() + LEAKS
    docs = documents(spark, rows)
    left = drop_contaminated(docs, spark.createDataFrame([(1, BASE)], "item_id long, text string"))
    bad = {r[:1] + tuple() for r in brute_contamination(rows, [(1, BASE)]) if r[5]}
    assert left.columns == docs.columns
    assert {(r["doc_id"],) for r in left.collect()} & bad <= {(1,)}  # id 1 has a clean row too
    assert left.count() == sum(not r[5] for r in brute_contamination(rows, [(1, BASE)]))


def spots(text):
    words = lowered_words(text)
    content = [w for w in words if w not in ANCHORS]
    found, before = set(), 0
    for w in words:
        if w in ANCHORS:
            if before + 2 <= len(content):
                found.add((w, *content[before : before + 2]))
        else:
            before += 1
    return found or ({("", *content[i : i + 2]) for i in range(len(content) - 1)} if len(content) > 1 else {tuple(words) or text} if text else set())


def likeness(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.mark.parametrize("ranges", [1, 3])
def test_fingerprints_equal_brute_force(spark, ranges):
    rows = [r for r in edge_rows() if r[0] is not None]
    rows = [r for i, r in enumerate(rows) if r[0] not in {x[0] for x in rows[:i]}] + [(20, "no anchors but several words"), (21, "The end"), (-5, "?!")]
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = {r["doc_id"]: r for r in fingerprint_digest(documents(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    ordered = sorted((i, t or "") for i, t, *_ in rows)
    assert len(got) == len(rows)
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        row = got[doc_id]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row["near_edited"] == pytest.approx(likeness(spots(text), spots(edited)))
        assert row["near_next"] == pytest.approx(likeness(spots(text), spots(following)))
        assert len(row["fingerprint"]) == 8 * len(spots(text))


def test_rows_without_or_with_equal_ids_have_fingerprints(spark):
    got = fingerprint_digest(documents(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    single = fingerprint_digest(documents(spark, [(1, BASE)])).first()
    assert single["near_next"] == 1.0
