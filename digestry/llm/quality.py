"""Quality of documents: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.llm.lean import lean
from digestry.llm.texts import crc_mod, text_of
from digestry.session import stage

# Runs of letters and digits (everything outside ASCII taken as letters), and runs of other signs.
TOKENS = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+")
SHAPES = ("lower", "upper", "title", "digits", "signs", "other")
HELD_TOKENS = 400_000
# Tokens without a vector of their own whose row a task remembers, and tokens that are summed at once.
HELD_ROWS = 1 << 16
CHUNK = 1 << 13


@dataclass(frozen=True)
class QualitySettings:
    """`words`: a token has a vector of its own if it makes up one part in so many of all tokens; rarer ones
    share the vector of their shape. `train_rows` bounds the labelled rows that the network is fitted on.
    """

    words: int = 1 << 13
    size: int = 64
    nonzero: int = 8
    reach: int = 2
    hidden: int = 32
    train_rows: int = 20_000
    epochs: int = 60
    threshold: float = 0.3
    seed: int = 11


class Index(dict):
    """Token to row of the vectors; a token that is not listed goes to the row of its shape."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(words))
        self.shapes = {name: len(words) + i for i, name in enumerate(SHAPES)}
        self.listed = len(words)

    def __missing__(self, token: bytes) -> int:
        row = self.shapes[shape(token)]
        if len(self) < self.listed + HELD_ROWS:
            self[token] = row
        return row


def shape(token: bytes) -> str:
    if token.isdigit():
        return "digits"
    if not re.match(rb"[A-Za-z0-9\x80-\xff]", token):
        return "signs"
    text = token.decode(errors="replace")
    return "lower" if text.islower() else "upper" if text.isupper() and len(text) > 1 else "title" if text.istitle() else "other"


def index_vectors(rows: int, settings: QualitySettings) -> np.ndarray:
    """A few random signs for each row; one more row of zeros stands for the edge of a text."""
    draw = np.random.default_rng(settings.seed)
    vectors = np.zeros((rows + 1, settings.size), np.int32)
    for row in vectors[:rows]:
        row[draw.choice(settings.size, settings.nonzero, replace=False)] = draw.choice([-1, 1], settings.nonzero)
    return vectors


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(TOKENS.findall(text.encode()))
            if len(counts) > HELD_TOKENS:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def context_sums(words: list[bytes], settings: QualitySettings):
    """Texts to the sum of the index vectors around each token, one row for each token that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(words)
        rows = len(words) + len(SHAPES)
        vectors = index_vectors(rows, settings)
        edge = [rows] * settings.reach
        sums, seen = np.zeros((rows + 1, settings.size), np.int64), np.zeros(rows + 1, bool)

        def add(ids: np.ndarray) -> None:
            for at in range(settings.reach, len(ids) - settings.reach, CHUNK):
                end = min(at + CHUNK, len(ids) - settings.reach)
                around = sum(vectors[ids[at + k : end + k]] for k in range(-settings.reach, settings.reach + 1) if k)
                order = np.argsort(ids[at:end], kind="stable")
                own = ids[at:end][order]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                sums[own[first]] += np.add.reduceat(around[order], first, axis=0)
                seen[own[first]] = True

        for batch in batches:
            held = list(edge)
            for text in batch.column("text").to_pylist():
                held.extend(map(index.__getitem__, TOKENS.findall(text.encode())))
                held.extend(edge)
                if len(held) > 8 * CHUNK:
                    add(np.array(held, np.int64))
                    held = list(edge)
            add(np.array(held, np.int64))
        there = np.flatnonzero(seen[:rows])
        yield pa.RecordBatch.from_arrays([pa.array(there), *(pa.array(sums[there, k]) for k in range(settings.size))], ["row", *(f"v{k}" for k in range(settings.size))])

    return run


def pooler(words: list[bytes], vectors: np.ndarray):
    """Texts to the mean of their word vectors, its norm, the share of distinct tokens and the log of their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(words)
        for batch in batches:
            features = []
            for text in batch.column("text").to_pylist():
                tokens = TOKENS.findall(text.encode())
                total = np.zeros(vectors.shape[1])
                for at in range(0, len(tokens), CHUNK):
                    total += vectors[[index[t] for t in tokens[at : at + CHUNK]]].sum(axis=0)
                n = max(len(tokens), 1)
                mean = total / n
                features.append(np.append(mean, [np.linalg.norm(mean), len(set(tokens)) / n, np.log1p(len(tokens))]).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(features, pa.binary())], ["doc_id", "held_out", "features"])

    return run


@dataclass
class Network:
    """Two layers of weights on standardised features, and the temperature of the logits."""

    middle: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.middle) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def fit(features: np.ndarray, labels: np.ndarray, settings: QualitySettings) -> Network:
    """Fit by Adam on four fifths of the rows, and the temperature on the rest."""
    draw = np.random.default_rng(settings.seed)
    middle, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    size = features.shape[1]
    net = Network(middle, scale, draw.normal(0, size**-0.5, (size, settings.hidden)), np.zeros(settings.hidden), draw.normal(0, settings.hidden**-0.5, settings.hidden), 0.0)
    order = draw.permutation(len(labels))
    kept, checked = order[len(order) // 5 :], order[: len(order) // 5]
    inputs = (features - middle) / scale
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (net.first, net.first_bias, net.second, np.zeros(()))]
    turn = 0
    for _ in range(settings.epochs):
        draw.shuffle(kept)
        for at in range(0, len(kept), 128):
            own = kept[at : at + 128]
            hidden = np.tanh(inputs[own] @ net.first + net.first_bias)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.second + net.second_bias, -30, 30))) - labels[own]) / len(own)
            back = np.outer(error, net.second) * (1 - hidden**2)
            slopes = [inputs[own].T @ back + 1e-4 * net.first, back.sum(axis=0), hidden.T @ error + 1e-4 * net.second, error.sum()]
            turn += 1
            steps = []
            for slope, moments in zip(slopes, state, strict=True):
                moments[0] = 0.9 * moments[0] + 0.1 * slope
                moments[1] = 0.999 * moments[1] + 0.001 * slope**2
                steps.append(0.005 * moments[0] / (1 - 0.9**turn) / (np.sqrt(moments[1] / (1 - 0.999**turn)) + 1e-8))
            net.first, net.first_bias, net.second = net.first - steps[0], net.first_bias - steps[1], net.second - steps[2]
            net.second_bias -= float(steps[3])
    if len(checked):
        logits, truth = net.logits(features[checked]), labels[checked]
        choices = np.geomspace(0.25, 8, 121)
        losses = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in choices]
        net.temperature = float(choices[int(np.argmin(losses))])
    return net


def applied(net: Network, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = np.frombuffer(b"".join(batch.column("features").to_pylist()), "<f4").reshape(batch.num_rows, -1)
            scores = net.probabilities(features.astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [*batch.schema.names[:-1], "score", "predicted"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, settings: QualitySettings | None = None, divisor: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`.

    Token counts and context sums are taken over all texts. Labels come only
    from rows whose crc32(doc_id) mod `divisor` is not `held`; of these the
    `train_rows` with the smallest hash are used. Only the text enters a score.
    Null texts are empty; rows without a label or with a null one teach nothing,
    and a doc_id labelled several times counts several times. With no labels at
    all every score is 0.5.
    """
    settings = settings or QualitySettings()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (crc_mod(F.col("doc_id"), divisor) == held).alias("held_out"), text_of().alias("text"))
    counts = stage(rows.select("text").mapInArrow(lean(count_tokens), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "tokens")
    whole = counts.agg(F.sum("n")).first()[0] or 0
    listed = counts.where(F.col("n") * settings.words >= whole).toPandas()  # at most settings.words rows
    words = [bytes(w) for w in listed.assign(token=listed["token"].map(bytes)).sort_values(["n", "token"], ascending=[False, True])["token"]]
    columns = [f"v{k}" for k in range(settings.size)]
    summed = rows.select("text").mapInArrow(lean(context_sums(words, settings)), "row long, " + ", ".join(f"{c} long" for c in columns))
    sums = summed.groupBy("row").agg(*(F.sum(c).alias(c) for c in columns)).toPandas()  # at most settings.words + len(SHAPES) rows
    contexts = np.zeros((len(words) + len(SHAPES), settings.size))
    contexts[sums["row"].to_numpy(int)] = sums[columns].to_numpy(float)
    own = index_vectors(len(contexts), settings)[:-1] / settings.nonzero**0.5
    vectors = (contexts / (np.linalg.norm(contexts, axis=1, keepdims=True) + 1e-9) + own).astype(np.float32)
    pooled = stage(rows.mapInArrow(lean(pooler(words, vectors)), f"doc_id {id_type}, held_out boolean, features binary"), "features")
    marks = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    taught = pooled.where("NOT held_out").join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features", "quality").limit(settings.train_rows)
    taught = taught.select("features", "quality").toPandas()  # at most settings.train_rows rows
    if taught.empty:
        return pooled.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(int(settings.threshold <= 0.5)).alias("predicted"))
    net = fit(np.stack([np.frombuffer(x, "<f4") for x in taught["features"]]).astype(np.float64), taught["quality"].to_numpy(float), settings)
    return pooled.mapInArrow(lean(applied(net, settings.threshold)), f"doc_id {id_type}, held_out boolean, score double, predicted int")
