from __future__ import annotations

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

import corpus_pipeline
from digestry.llm.catalog import tokenizer_path
from digestry.llm.mixing import mix, write_mix
from digestry.llm.ordered import running_sums
from digestry.llm.ppm import EDGE, PpmSettings, Trie, grams, lm_scores, looked_up
from digestry.llm.quality import quality_scores
from digestry.llm.token_files import decode_numbers, encode_numbers, read_token_files, token_digest, write_token_files
from tests.llm.fixtures import BASE, documents, edge_rows, spaced_words, tuples

SF = "/root/testdata/sf0.001"


def test_running_sums(spark):
    from pyspark.sql import functions as F

    rows = [(i % 3 and "hot" or f"s{i % 5}", (i * 7919) % 1000, i % 11) for i in range(500)]
    frame = spark.createDataFrame(rows, "s string, k int, v int")
    got = running_sums(frame, [F.col("s"), F.col("k"), F.col("v")], {"before": "v"}, within=["s"])
    want, seen = [], Counter()
    for s, k, v in sorted(rows):
        want.append((s, k, v, seen[s]))
        seen[s] += v
    assert tuples(got, "s", "k", "v", "before") == sorted(want, key=repr)


def water(sizes, weights, share, epochs):
    full = {s: epochs * n for s, n in sizes.items()}
    target, open_ones, left = {}, set(sizes), share * sum(sizes.values())
    while open_ones:
        total = sum(weights[s] for s in open_ones)
        over = {s for s in open_ones if left * weights[s] / total > full[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in open_ones}
        for s in over:
            target[s] = full[s]
            left -= full[s]
        open_ones -= over
    return target


def check_mix(spark, rows):
    got = mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(spaced_words(text))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    want = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5, 2)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    return got


def test_mix_meets_targets(spark):
    check_mix(spark, [(i, t, s) for i, (_, t, s) in enumerate(edge_rows())])
    rows = [(i, "w " * (i % 17), f"s{i % 4}" if i % 3 else "s9") for i in range(300)] + [(7, "w " * 7, "s9")] * 5
    first = check_mix(spark, rows)
    again = mix(documents(spark, rows[::-1])).collect()
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in first) == sorted((r["doc_id"], r["size"], r["taken"]) for r in again)


def test_written_mix_repeats_whole_rows(spark):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 4}" if i % 3 else None) for i in range(300)]
    docs = documents(spark, rows)
    out = write_mix(docs)
    assert out.columns == docs.columns
    copies = Counter(r["doc_id"] for r in out.collect())
    for r in mix(docs).collect():
        assert copies[r["doc_id"]] in (r["taken"] // r["size"], -(-r["taken"] // r["size"])) and copies[r["doc_id"]] <= 2
    assert mix(documents(spark, [])).count() == write_mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("numbers", [[], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(0, 70000, 7))])
def test_number_coding(numbers):
    control, data = encode_numbers(np.array(numbers, np.uint32))
    assert decode_numbers(control, data, len(numbers)).tolist() == numbers
    assert len(control) == -(-len(numbers) // 4)


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = edge_rows() + [(30, "it's <|endoftext|> é don't x y 'll 12'3"), (31, "tab\x0bfeed\x0cx\x1cy")]
    write_token_files(documents(spark, rows), tokenizer_path(), str(tmp_path / "t"), block_ids=500)
    want = sorted(((i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in rows), key=repr)
    back = read_token_files(spark, str(tmp_path / "t")).collect()
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in back), key=repr) == want
    in_order = sorted(back, key=lambda r: r["start"])
    place = 0
    for r in in_order:
        assert r["start"] == place
        place += r["n_tokens"]
    known = [r["doc_id"] for r in in_order if r["doc_id"] is not None]
    assert known == sorted(known) and in_order[0]["doc_id"] is None
    digest = token_digest(documents(spark, rows), tokenizer_path())
    assert tuples(digest, "doc_id", "n_tokens", "ids_crc32") == sorted(((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want), key=repr)
    assert token_digest(documents(spark, []), tokenizer_path()).count() == 0


def plain_ppm(train, text, order):
    """Code length of a text, context by context, with sets of symbols to exclude."""
    counts = {}
    for t in train:
        full = bytes([EDGE]) * order + t + bytes([EDGE])
        for at in range(order, len(full)):
            for k in range(order + 1):
                counts.setdefault(full[at - k : at], Counter())[full[at]] += 1
    full, total = bytes([EDGE]) * order + text + bytes([EDGE]), 0.0
    for at in range(order, len(full)):
        gone, sym = set(), full[at]
        for k in range(order, -1, -1):
            own = {s: c for s, c in counts.get(full[at - k : at], {}).items() if s not in gone}
            if not own:
                continue
            weight = sum(own.values()) + len(own)
            if sym in own:
                total += log10(own[sym] / weight)
                break
            total += log10(len(own) / weight)
            gone |= set(own)
        else:
            total -= log10(256 - len(gone))
    return total


def test_lm_scores_equal_brute_force(spark):
    rows = [(r[0], r[1] and r[1][:3000]) for r in edge_rows()] + [(40 + i, f"the {w} of the mill") for i, w in enumerate(["bread", "stone", "grey goose", "été", "fox fox"])]
    got = lm_scores(documents(spark, rows), PpmSettings(order=3, head=4)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = [(t or "").encode().lower() for i, t in rows if not held(i)]
    counts = Counter(w for t in train for w in [*t.split(), b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        tokens = [*spaced_words(t), b""]
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6), round(plain_ppm(train, (t or "").encode().lower(), 3), 6)))
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got), key=repr) == sorted(want, key=repr)


def test_settings_of_the_head_do_not_change_scores(spark):
    """With one part in 64 nearly all grams are beyond the head; they count as they were seen all the same."""
    rows = [(r[0], r[1] and r[1][:400]) for r in edge_rows()] + [(40 + i, f"the {w} of the mill") for i, w in enumerate(["bread", "stone", "grey goose", "été", "fox fox"])]
    train = [(t or "").encode().lower() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    got = lm_scores(documents(spark, rows), PpmSettings(order=3, parts=64, head=4)).collect()
    want = [(i, round(plain_ppm(train, (t or "").encode().lower(), 3), 6)) for i, t in rows]
    assert sorted(((r["doc_id"], round(r["score"], 6)) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [0, 5, 1000])
def test_bounds_of_the_head_do_not_change_scores(spark, most):
    rows = [(r[0], r[1] and r[1][:400]) for r in edge_rows()]
    train = [(t or "").encode().lower() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    got = lm_scores(documents(spark, rows), PpmSettings(order=3, most_grams=most, most_words=most)).collect()
    want = [(i, round(plain_ppm(train, (t or "").encode().lower(), 3), 6)) for i, t in rows]
    assert sorted(((r["doc_id"], round(r["score"], 6)) for r in got), key=repr) == sorted(want, key=repr)


def test_head_has_the_most_frequent_within_its_bound(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([100, 70, 70, 40, 9, 9, 9, 1])], "gram long, n long")
    ids = lambda parts, most: sorted(r["gram"] for r in looked_up(counts, 308, parts, most).collect())
    assert ids(308, 100) == list(range(8)) and ids(35, 100) == list(range(7))
    assert ids(308, 5) == [0, 1, 2, 3] and ids(308, 2) == [0] and ids(308, 0) == []


@pytest.mark.parametrize("remembered", [0, 3, 1000])
def test_what_an_encoder_remembers_does_not_change_ids(remembered):
    from tokenizers import Tokenizer

    from digestry.llm.token_files import PieceEncoder

    own, plain = PieceEncoder(tokenizer_path(), remembered), Tokenizer.from_file(tokenizer_path())
    for texts in (["the mill, the river", "été du moulin 42"], ["the river's mill"], ["", "mill mill <|endoftext|>", "the mill, the river"]):
        assert [np.frombuffer(x, own.kind).tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.known) <= remembered + 20


def test_tidy_staging_leaves_no_shuffle_files(spark):
    import time

    from digestry.session import SHUFFLE_CLEANUP_CONF, stage

    def shuffle_files():
        return set(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()) - {""}

    before, conf = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP_CONF)
    rows = stage(spark.range(1000).groupBy("id").count(), "tidy", tidy=True)
    for _ in range(50):  # they go in the background
        left = {name for name in shuffle_files() - before if name.startswith("shuffle_")}
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP_CONF) == conf
    assert rows.count() == 1000


def test_lm_without_training_rows(spark):
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm_scores(documents(spark, [(alone, "abc")])).first()
    assert row["score"] == pytest.approx(-4 * log10(256)) and row["n_known"] == 0
    assert lm_scores(documents(spark, [])).count() == 0


def test_pruned_model_is_a_distribution():
    text = b"abracadabra abra cadabra " * 5
    entries = [(k, int(c & Trie.mask(k + 1))) for codes in grams(text, 3) for c in codes for k in range(4)]
    counts = Counter(entries)
    totals = Counter()
    for (k, c), n in counts.items():
        totals[k, c >> 8] += n
    kept = [(k, c, n, totals[k, c >> 8]) for (k, c), n in counts.items() if n * 30 >= len(text)]
    assert len(kept) < len(counts)
    trie = Trie(3, *(np.array(x) for x in zip(*kept, strict=True)))
    for context in (b"abr", b"xyz", b"ada", b"a c", b"bra"):
        before = sum(b << 8 * (3 - i) for i, b in enumerate(context))
        codes = np.array([before | s for s in range(256)], np.uint64)
        assert (10 ** -trie.lengths(codes)).sum() == pytest.approx(1, abs=0.02)


def test_quality_on_held_out_rows(spark):
    draw = np.random.default_rng(1)
    good = ["the", "of", "river", "stone", "bread", "and", "village", "quiet"]
    rows, marks = [], []
    for i in range(400):
        words = [str(w) for w in draw.choice(good, 40)]
        if i % 4 == 0:
            words = [w + "###" if k % 2 else "|" for k, w in enumerate(words)]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 > 0), 0))
    labels = spark.createDataFrame([*marks, (1, None, 0), (10_000, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(documents(spark, rows + edge_rows()[3:6]), labels).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    own = [r for r in got if r["held_out"] and r["doc_id"] > 12]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 4 > 0) for r in own]) > 0.95


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_scores(documents(spark, edge_rows()), labels).collect()} == {0.5}
    assert quality_scores(documents(spark, []), labels).count() == 0


def test_pipeline_stages_on_edge_rows(spark):
    docs = documents(spark, edge_rows())
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    empty = documents(spark, [])
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, empty, SF).count() == 0


def test_one_of_each_group_stays(spark):
    rows = edge_rows()
    left = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), SF).collect()
    counts = Counter(r["doc_id"] for r in left)
    assert counts[1] == 2 and 3 not in counts and 8 not in counts and counts[2] == 1


def test_rows_without_id_leave_one_of_each_group(spark):
    near = BASE + " end"
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(1, BASE), (None, near), (None, other), (None, other.upper()), (None, other + " end"), (None, "a clean text that nobody else has"), (None, ""), (None, None), (2, "another clean text")]
    left = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), SF)
    assert left.columns == documents(spark, rows).columns
    texts = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert [t for t in texts if t[0] is not None] == [(1, BASE), (2, "another clean text")]
    nameless = [t for i, t in texts if i is None]
    assert len([t for t in nameless if t and t.lower().startswith("other0")]) == 1
    assert sorted((t for t in nameless if not (t and t.lower().startswith("other0"))), key=repr) == sorted(["a clean text that nobody else has", "", None], key=repr)
