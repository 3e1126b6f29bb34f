"""Quality scores by Bradley-Terry ranking.

Preference pairs (a document marked good over one marked bad) are formed of all labelled
documents; a linear score is learned by logistic loss on feature differences, which is the
Bradley-Terry likelihood of the pairs. Tasks learn from blocks of bounded size, and the
mean of their weights is the model. The decision threshold is the quantile of all labelled
scores that leaves the marked share of bad documents below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from chamberlens.functions.ranks import order_statistics
from chamberlens.llm.common import draw_limit, draw_of, without
from chamberlens.llm.grams import byte_table, descend, gram_counts, packed, platt, root_shares, sigmoid, unpacked
from chamberlens.session import stored

ORDER, BITS = 4, 11
THRESHOLD = 0.3
# Documents of a label that a task learns from, and the fewest it gets of the rarer label.
BLOCK_ROWS, LEAST_ROWS = 3000, 300
# Classes of raw scores from which the slope is found.
CLASSES = 4096


def _shape(b: int) -> int:
    """Letters by case, digits as one, blanks and marks as they are."""
    return 97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b


_SHAPES = byte_table(_shape)
_EXTRAS = 4


def features(text: str | None) -> np.ndarray:
    """Shares of shape n-grams, and four measures of size and repetition, each from 0 to 1."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    extras = [
        min(1.0, np.log1p(len(text)) / 16),
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / len(lines),
        min(1.0, len(text) / max(1, len(words)) / 20),
    ]
    return np.append(root_shares(gram_counts(text, _SHAPES, ORDER, BITS)), np.array(extras, np.float32) * 0.25)


@dataclass
class QualityModel:
    weights: np.ndarray
    slope: float
    cut: float

    def score(self, text: str | None) -> float:
        """0.3 at the chosen quantile of the sample's raw scores, rising with the raw score."""
        raw = float(features(text) @ self.weights)
        return float(sigmoid(self.slope * (raw - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD))))


def fit_quality(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "quality", key_col: str = "doc_id", sample: int | None = None, pairs: int = 40000
) -> QualityModel | None:
    """Fit on all labelled documents, in blocks of about ``BLOCK_ROWS`` of a label with at
    least ``pairs`` preference pairs each, in which every document of the block stands.

    With ``sample`` the model is one block of so many labelled documents, half of each
    label where there are enough, chosen by a hash of ``key_col``.

    Labels are counted only if a document has their key. Of documents that share a key the
    one whose text has the smallest hash is learned from, so a crowded key counts once.
    Repeated labels count once, rows whose label is neither 0 nor 1 are not used; a null
    text counts as empty. None if no labelled document is left of a label: then there is
    nothing to prefer.
    """
    labelled = labels.where(F.col(label_col).isin(0, 1) & F.col(key_col).isNotNull()).select(
        F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("label"), draw_of(F.col(key_col)).alias("draw")
    ).distinct()
    # keys alone meet before the draw: labels without a document neither count nor are drawn
    usable = stored(labelled.join(docs.select(F.col(key_col).alias("key")), "key", "left_semi"))
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    texts = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"), draw_of(F.col(text_col)).alias("pick"))
    if sample is None:
        return _fitted_on_all(texts, usable.select("key", "label"), sizes, pairs)
    half = sample // 2

    def smallest(label: int) -> DataFrame:  # of twice as many and more, so that there are enough
        below = F.col("draw") < draw_limit(2 * half + 100, sizes[label])
        return usable.where((F.col("label") == label) & below).orderBy("draw", "key").limit(half)

    spark = docs.sparkSession
    chosen = smallest(0).unionByName(smallest(1)).select("key", "label")
    chosen = spark.createDataFrame(chosen.collect(), chosen.schema)  # at most ``sample`` rows
    picks = texts.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("pick").alias("pick"))
    picks = spark.createDataFrame(picks.collect(), picks.schema)
    drawn = texts.join(F.broadcast(picks), ["key", "pick"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            numbers, labels_here, texts_here = (c.to_pylist() for c in batch.columns)
            fresh = [i for i, n in enumerate(numbers) if n not in seen and not seen.add(n)]
            rows = [packed(features(texts_here[i])) for i in fresh]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([numbers[i] for i in fresh], pa.int64()),
                    pa.array([labels_here[i] for i in fresh], pa.int32()),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["number", "label", "at", "value"],
            )

    number = F.xxhash64("key", "label").alias("number")  # names a chosen label among at most ``sample``
    rows = drawn.select(number, "label", "text").mapInArrow(pack, "number long, label int, at binary, value binary")
    rows = rows.dropDuplicates(["number"]).select("label", "at", "value").collect()
    rows = sorted(rows, key=lambda r: (r["label"], r["at"], r["value"]))
    labels = np.array([r["label"] for r in rows])
    x = unpacked([(r["at"], r["value"]) for r in rows], (1 << BITS) + _EXTRAS)
    return _fitted(x, labels, sizes[0] / (sizes[0] + sizes[1]), pairs)


def _fitted_on_all(texts: DataFrame, labels: DataFrame, sizes: dict[int, int], pairs: int) -> QualityModel | None:
    """Weights averaged over blocks, slope and threshold from the scores of all labelled rows."""
    spark, width = texts.sparkSession, (1 << BITS) + _EXTRAS
    blocks = -(-max(sizes.values()) // BLOCK_ROWS)
    # rows of a rare label stand in several blocks, so that each has some to compare with
    copies = {label: min(blocks, -(-blocks * LEAST_ROWS // n)) if n < blocks * LEAST_ROWS else 1 for label, n in sizes.items()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [packed(features(t.as_py())) for t in batch.column(1)]
            at, value = (pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), at, value], names=["key", "pick", "at", "value"])

    # features are shuffled, and later scores; texts stay where they are read
    texts = texts.where("key IS NOT NULL").select("key", "text", "pick")
    kind = texts.schema["key"].dataType.simpleString()
    found = texts.mapInArrow(pack, f"key {kind}, pick long, at binary, value binary").join(labels, "key")
    once = found.groupBy("key", "label").agg(F.min_by(F.struct("at", "value"), "pick").alias("row"))
    turns = F.when(F.col("label") == 1, copies[1]).otherwise(copies[0])
    turn = F.explode(F.sequence(F.lit(0), turns - 1)).alias("turn")
    dealt = once.select("label", "row.at", "row.value", F.xxhash64("key", "label").alias("number"), turn)
    dealt = dealt.withColumn("block", F.pmod(F.col("number") + F.col("turn"), F.lit(blocks)).cast("int")).drop("turn")

    def learn(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("label", "number", "at", "value"))))
        marks = np.array([r[0] for r in rows])
        if marks.min() == marks.max():
            return pa.table({"n": pa.array([], pa.int64()), "w": pa.array([], pa.list_(pa.float64()))})
        w = _weights(unpacked([r[2:] for r in rows], width), *_every_pair(marks, pairs))
        return pa.table({"n": [len(rows)], "w": [w.astype(float).tolist()]})

    learned = dealt.groupBy("block").applyInArrow(learn, "n long, w array<double>")
    entries = learned.select("n", F.posexplode("w").alias("slot", "w")).groupBy("slot").agg((F.sum(F.col("n") * F.col("w")) / F.sum("n")).alias("w"))
    w = np.zeros(width, np.float32)
    for r in entries.collect():  # one row per weight
        w[r["slot"]] = r["w"]

    shared = spark.sparkContext.broadcast(w)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [float(features(t.as_py()) @ shared.value) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(raw, pa.float64())], names=["key", "pick", "raw"])

    judged = texts.mapInArrow(judge, f"key {kind}, pick long, raw double")
    raws = stored(judged.groupBy("key").agg(F.min_by("raw", "pick").alias("raw")).join(labels, "key").select("raw", "label"))
    n = sizes[0] + sizes[1]
    hits = order_statistics(raws, ["raw"], lambda _, size: [size * sizes[0] // n, size * sizes[0] // n + 1])["raw"]
    low, high, mean = raws.agg(F.min("raw"), F.max("raw"), F.avg("raw")).first()
    place = F.floor((F.col("raw") - F.lit(low)) / F.lit(max(high - low, 1e-12)) * CLASSES)
    classes = raws.groupBy("label", place.alias("place")).agg(F.avg("raw").alias("raw"), F.count(F.lit(1)).alias("n")).collect()
    classes = sorted((r["label"], r["raw"], r["n"]) for r in classes)
    marks, margins, rows = (np.array(c, float) for c in zip(*classes))
    slope = max(1e-3, platt(margins - mean, marks, rows=rows)[0])
    return QualityModel(w, slope, float(sum(h.value for h in hits.values()) / len(hits)))


def _weights(x: np.ndarray, better: np.ndarray, worse: np.ndarray, penalty: float = 1e-4) -> np.ndarray:
    pairs = len(better)

    def gradient(w):
        s = x @ w.astype(np.float32)
        pull = -sigmoid(s[worse] - s[better]) / pairs
        on_rows = np.bincount(better, pull, len(x)) - np.bincount(worse, pull, len(x))
        return x.T @ on_rows.astype(np.float32) + penalty * w

    return descend(gradient, x.shape[1], 300, 1.0).astype(np.float32)


def _every_pair(labels: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """(better, worse) rows of at least ``pairs`` pairs; every row stands in one at least."""
    draw = np.random.default_rng(7)
    sides = [np.flatnonzero(labels == label) for label in (1, 0)]
    size = max(pairs, *(len(s) for s in sides))
    return tuple(np.concatenate([draw.permutation(s) for _ in range(-(-size // len(s)))])[:size] for s in sides)


def _fitted(x: np.ndarray, labels: np.ndarray, bad_share: float, pairs: int, penalty: float = 1e-4) -> QualityModel:
    draw = np.random.default_rng(7)
    better = draw.choice(np.flatnonzero(labels == 1), pairs)
    worse = draw.choice(np.flatnonzero(labels == 0), pairs)
    w = _weights(x, better, worse, penalty)
    raw = (x @ w).astype(np.float64)
    slope = max(1e-3, platt(raw - raw.mean(), labels)[0])
    # the sample is balanced: weigh its rows back to the labels' own shares
    weight = np.where(labels == 0, bad_share / (labels == 0).sum(), (1 - bad_share) / (labels == 1).sum())
    order = np.argsort(raw, kind="stable")
    at = min(int(np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-9)), len(raw) - 2)
    return QualityModel(w, slope, float((raw[order[at]] + raw[order[at + 1]]) / 2))


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.3, else 0).

    Only the whole text counts. A null text is scored as an empty one. Without a model
    every row scores 0.5. Rows are judged one by one; input columns with the names of the
    results are replaced.
    """
    base = without(docs, "score", "predicted")
    if model is None:
        return base.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*base.columns, "score", "predicted"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            scores = np.array([shared.value.score(t.as_py()) for t in texts], np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=names
            )

    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return base.mapInArrow(judge, schema)
