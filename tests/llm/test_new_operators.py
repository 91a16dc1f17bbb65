"""Piece ids against the library, clustering and manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from digestry.llm.catalog import PIECE_MODEL, tokenizer_path
from digestry.llm.centroids import Search, cluster, cluster_digest
from digestry.llm.manifest import LEAF_COLUMNS, fold, manifest_digest, merkle_manifest, proof_text
from digestry.llm.pieces import PieceCodec, decode_ids, encode_texts, piece_digest
from tests.llm.fixtures import LOWER, documents, edge_rows, tuples


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(tokenizer_path(PIECE_MODEL))


def test_ids_equal_the_library(codec):
    draw = random.Random(11)
    pieces = sorted(codec.model.id_of)
    makers = [
        lambda: "".join(draw.choice("abcdeilnorstu") for _ in range(draw.randint(0, 40))),
        lambda: "".join(draw.choice(pieces) for _ in range(draw.randint(1, 12))),
        lambda: "".join(draw.choice("ab \n▁²x") for _ in range(draw.randint(0, 30))),
        lambda: "".join(chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0x3000, 0xD7FF), draw.randint(0xE000, 0x10FFFF)])) for _ in range(10)),
        lambda: "".join(draw.choice([" ", " " * draw.randint(1, 40), "=", "-", "==", "aa", "  x"]) for _ in range(12)),
        lambda: " ".join(draw.choice(pieces).replace("▁", "") for _ in range(8)),
    ]
    texts = [draw.choice(makers)() for _ in range(3000)] + [" " * 50_000, "x" * 50_000, "<s>a</s><0x41>"]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == codec.library.encode(text), text[:100]


def test_every_prefix_has_one_compatible_last_token(codec):
    for unit in ("▁unbelievable", "▁▁▁▁▁x", "internationalization", "aaaaaaa", "▁=-=="):
        table = codec.last_tokens(unit)
        for end in range(1, len(unit) + 1):
            fitting = [p for p in codec.model.right if unit[:end].endswith(p) and (len(p) == end or codec.model.compatible(codec.model.pieces[table[end - len(p) - 1][0]], p))]
            assert [codec.model.pieces[table[end - 1][0]]] == fitting


def test_piece_digest_of_edge_rows(spark, codec):
    rows = edge_rows()
    docs = documents(spark, rows)
    want = []
    for doc_id, text, _ in rows:
        ids = codec.library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(codec.library.decode(ids))))
    assert tuples(piece_digest(docs, tokenizer_path(PIECE_MODEL)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert piece_digest(docs.limit(0), tokenizer_path(PIECE_MODEL)).count() == 0
    stored = encode_texts(docs, tokenizer_path(PIECE_MODEL))
    assert tuples(decode_ids(stored, tokenizer_path(PIECE_MODEL)), "doc_id", "decoded") == sorted(((r[0], codec.library.decode(codec.library.encode(r[1] or ""))) for r in rows), key=repr)


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    centroids = [x for _, x in sorted(((sha(f"3:{'' if i is None else i}"), x) for i, x in kept))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        centroids = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if groups[j] else c for j, c in enumerate(centroids)]
    out = [(i, *nearest(x)[::-1]) for i, x in kept]
    per = defaultdict(int)
    for _, j, d in out:
        per[j] += d
    return sorted(((i, j, d, per[j], sum(per.values()), sha(",".join(map(str, centroids[j])))) for i, j, d in out), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 7) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance double, x int")


def test_clusters(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(i % 5, 1, 64)]) for i in range(150)]
    rows += [(7, rows[7][1])] * 3 + [(None, rows[9][1]), (200, [0.0] * 64), (201, [0.0] * 64), (202, None), (203, []), (204, [1.0] * 63), (205, [None] + [1.0] * 63), (206, [float("nan")] * 64), (207, [float("inf")] * 64)]
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert tuples(cluster_digest(vectors(spark, rows)), *names) == plain_clusters(rows)
    same = [(i, [0.25] * 64) for i in range(20)]
    assert tuples(cluster_digest(vectors(spark, same)), *names) == plain_clusters(same)
    few = rows[:3]
    assert tuples(cluster_digest(vectors(spark, few)), *names) == plain_clusters(few)
    assert cluster_digest(vectors(spark, rows[-3:])).count() == 0
    assert cluster_digest(vectors(spark, [])).columns == names
    with pytest.raises(Exception, match="64 bits"):
        cluster(vectors(spark, [(1, [1e9] * 64)]))[0].collect()


def test_search_finds_the_nearest_and_skips_most():
    draw = np.random.default_rng(6)
    centers = draw.integers(-3000, 3000, (300, 16)) + draw.integers(-3000, 3000, (300, 1))
    points = centers[draw.integers(0, 300, 2000)] + draw.integers(-40, 40, (2000, 16))
    points[:50] = centers[:50]
    number, distance, computed = Search.of(centers).nearest(points)
    full = ((points[:, None, :] - centers[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert computed < 0.1 * full.size
    tied = np.array([[0, 2], [2, 0], [0, 2], [-2, 0]])
    assert Search.of(tied).nearest(np.array([[0, 0], [0, 3]]))[0].tolist() == [0, 0]


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows):
    """rows: dicts of documents' columns."""

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def path(tree, at):
        found = []
        for level in tree[:-1]:
            start = at // 16 * 16
            found.append((level[start:at], level[at + 1 : start + 16]))
            at //= 16
        return found

    groups = defaultdict(list)
    for r in rows:
        leaf = sha("".join(part(r[c]) for c in LEAF_COLUMNS))
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        text = r["text"].translate(LOWER) if changed and r["text"] is not None else r["text"]
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, sha("".join(part((r | {"text": text})[c]) for c in LEAF_COLUMNS)), r["doc_id"], changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([g[2] for g in sorted(groups[s], key=lambda g: g[:3])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    want = []
    for k, s in enumerate(names):
        for at, (*_, leaf, found, doc_id, changed) in enumerate(sorted(groups[s], key=lambda g: g[:3])):
            siblings = path(trees[s], at) + path(top, k)
            folded = found
            for left, right in siblings:
                folded = sha("".join(left) + folded + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in siblings))
            want.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0], changed))
    return sorted(want, key=repr)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "tampered"]


def test_manifest(spark):
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "é": 256, "Z": 257, "hot": 700, **{f"s{i}": 1 + i % 2 for i in range(20)}}
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            k += 1
            rows.append((k * 37 % 5003, [f"Text {k} Ü", None, "", "lower"][k % 4 if k % 9 == 0 else 0], source))
    rows += [rows[0], rows[0], (None, "No Id", "a"), (None, None, None), (5, "Same id A", "a"), (5, "same id b", "a")]
    docs = documents(spark, rows)
    got = manifest_digest(docs)
    want = plain_manifest([r.asDict() for r in docs.collect()])
    assert tuples(got, *MANIFEST) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 256, 257])
def test_manifest_of_one_source(spark, n):
    docs = documents(spark, [(i, f"T{i}", "a") for i in range(n)])
    assert tuples(manifest_digest(docs), *MANIFEST) == plain_manifest([r.asDict() for r in docs.collect()])


def test_manifest_of_edge_rows(spark):
    docs = documents(spark, edge_rows())
    assert tuples(manifest_digest(docs), *MANIFEST) == plain_manifest([r.asDict() for r in docs.collect()])
    assert manifest_digest(docs.limit(0)).count() == 0
    rows = merkle_manifest(docs)
    assert rows.where(fold(rows["leaf"], rows["path"]) != rows["root"]).count() == 0
    assert rows.where(proof_text(rows["path"]) == "").count() == 0
