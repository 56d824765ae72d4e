"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

Statistics are counted where texts are read.  The model is fitted on a bounded sample of labelled
rows, so it has a fixed size; its trees are flattened into arrays that a task walks level by level
for all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from chronoweave.scratch import write_scratch

#: Labelled rows the model is fitted on, at most; they are chosen by a hash of their id.
SAMPLE_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
LEAST_ROWS = 20
RIDGE = 1.0

CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "space": (32,),
    "break": (10, 13),
    "stop": b".!?",
    "comma": b",;:",
    "high": range(128, 256),
}
_OF_BYTE = np.zeros((256, len(CLASSES)))
for _i, _members in enumerate(CLASSES.values()):
    _OF_BYTE[list(_members), _i] = 1.0
_LETTERS = frozenset([*range(65, 91), *range(97, 123), *range(128, 256)])
_OTHER = np.array([c not in _LETTERS and c > 32 and not 48 <= c <= 57 for c in range(256)])
WIDTH = len(CLASSES) + 11


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a text; those of a null or empty text are all zero."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * WIDTH
    size, n = len(text), len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    symbols = counts[_OTHER]
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        *(counts @ _OF_BYTE / size),
        symbols.sum() / size,
        symbols.max() / size,
        np.log1p(size),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(size / len(lines)),
        sum(x.rstrip()[-1] in b".!?\"'" for x in lines) / len(lines),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(t.as_py()) for t in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.float64()))], names=["doc", "x"])


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node ``i`` of a level has the children ``2 i`` and ``2 i + 1``."""

    prior: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        rows, total = np.arange(len(x)), np.full(len(x), self.prior)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.ones(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + (x[rows, feature[at]] > cut[at])
            total += leaf[at - (1 << DEPTH)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost ``TREES`` trees on logistic loss; without rows the score is 0.5, with one class its rate."""
    mean = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(mean / (1 - mean)))
    nodes, leaves = 1 << DEPTH, 1 << DEPTH
    if len(y) < 2 * LEAST_ROWS or y.min() == y.max():
        none = np.zeros((0, nodes))
        return Trees(prior, none.astype(np.int64), none, np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), prior)
    features, places, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        at = np.ones(len(y), np.int64)
        for level in range(DEPTH):
            width = 1 << level
            cell = (at - width)[:, None] * BINS + bins
            split = np.zeros(len(y), np.int64)
            sums = np.zeros((3, x.shape[1], width, BINS))
            for j in range(x.shape[1]):
                for k, weight in enumerate((grad, hess, None)):
                    sums[k, j] = np.bincount(cell[:, j], weight, width * BINS).reshape(width, BINS)
            left = sums.cumsum(axis=3)
            right = left[..., -1:] - left
            part = lambda s: s[0] ** 2 / (s[1] + RIDGE)
            gain = np.where((left[2] >= LEAST_ROWS) & (right[2] >= LEAST_ROWS), part(left) + part(right), -np.inf)
            gain = gain - part(left[..., -1:])
            for node in range(width):
                j, b = np.unravel_index(np.argmax(gain[:, node]), (x.shape[1], BINS))
                if gain[j, node, b] > 1e-9 and b < len(cuts[j]):
                    feature[width + node], cut[width + node] = j, cuts[j][b]
                    mine = at == width + node
                    split[mine] = bins[mine, j] > b
            at = 2 * at + split
        leaf_of = at - leaves
        leaf = RATE * np.bincount(leaf_of, grad, leaves) / (np.bincount(leaf_of, hess, leaves) + RIDGE)
        margin += leaf[leaf_of]
        features.append(feature)
        places.append(cut)
        values.append(leaf)
    return Trees(prior, np.stack(features), np.stack(places), np.stack(values))


def training_rows(held_out: bool = False):
    """Whether a row, by crc32 of its id as text, is outside (or inside) the held-out third."""
    inside = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    return inside if held_out else ~inside


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    keep: tuple[str, ...] = (),
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, ``keep``, held_out, score, predicted.

    The model learns from at most ``sample_rows`` labelled rows outside the held-out third.  Null ids
    count as the empty text for ``held_out``; ids labelled twice take the larger label, null labels and
    ids are passed over.  Null and empty texts score like a text without words.  Repeated rows keep
    their own row.
    """
    def read(columns: tuple[str, ...], mapped, out: StructField) -> DataFrame:
        carried = F.struct(F.col(doc_id).alias("doc_id"), *columns).alias("doc")
        texts = docs.select(carried, F.col(text).cast("string").alias("text"))
        return texts.mapInArrow(mapped, StructType([texts.schema["doc"], out]))

    rows = write_scratch(read((), _statistics, StructField("x", ArrayType(DoubleType()))), "quality-statistics").df
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).filter(training_rows())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # The sample has a fixed bound, and so have the rows that come to the driver.
    texts = rows.select(F.col("doc.doc_id").alias("doc_id"), "x").join(F.broadcast(chosen), "doc_id")
    sample = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).collect()
    x = np.array([r["x"] for r in sample], dtype=np.float64).reshape(-1, WIDTH)
    model = fit(x, np.array([r["y"] > 0 for r in sample], dtype=np.float64))

    @F.pandas_udf("double")
    def scored(values):
        return pd.Series(model.score(np.array(values.to_list(), dtype=np.float64).reshape(-1, WIDTH)))

    def counted_and_scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            score = model.score(np.array(x, dtype=np.float64).reshape(-1, WIDTH))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc", "score"])

    # Kept columns may hold texts, which are cheaper to read again than to write here.  One function counts and scores
    # them: with one for each, a task has two Python workers, whose memory the executor keeps in later stages.
    if keep:
        out = read(keep, counted_and_scored, StructField("score", DoubleType())).select("doc.*", "score")
    else:
        out = rows.select("doc.*", scored("x").alias("score"))
    return out.withColumn("held_out", training_rows(held_out=True)).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def digest(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents predicted to be of good quality, with all their columns as they are, whatever their names.

    Without labels every score is 0.5 and all documents stay; an empty table gives an empty one.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    read = docs.select("doc_id", "text", whole.alias("_doc"))
    return score_documents(read, labels, keep=("_doc",)).filter("predicted = 1").select("_doc.*")
