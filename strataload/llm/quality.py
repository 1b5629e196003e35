"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed batch-wise with numpy where the documents are. Training takes a
bounded, reproducible sample of the labelled rows; each statistic is cut into at most
64 bins, trees grow level by level on histograms of gradients. The trained trees are
flattened into arrays, and all documents of a batch walk a tree at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_bytes words mean_word word_spread longest_word distinct_words top_word repeated_pairs lines mean_line "
    "repeated_lines short_lines letters upper digits spaces punctuation symbols high_bytes distinct_bytes "
    "byte_entropy runs ends_marked initial_capitals digit_words"
).split()
_END = re.compile(r"[.!?\"')\]]\s*$")
_CLASS = np.zeros(256, np.int64)
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\v\f",
                           b".,;:!?'\"()-", b"#$%&*+/<=>@[]\\^_`{|}~"), start=1):
    _CLASS[list(_set)] = _k
_CLASS[128:] = 7


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of FEATURES; zeros for no text."""
    if not text:
        return [0.0] * len(FEATURES)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    size = len(data)
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, counts, 8) / size
    words = text.split()
    n = len(words) or 1
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in text.split("\n") if x]
    share = counts[counts > 0] / size
    return [
        np.log1p(size), np.log1p(n), lengths.mean(), lengths.std(), np.log1p(lengths.max()), len(seen) / n,
        max(seen.values(), default=0) / n, 1 - len(set(zip(words, words[1:]))) / max(n - 1, 1), np.log1p(len(lines)),
        size / (len(lines) or 1), 1 - len(set(lines)) / (len(lines) or 1), sum(len(x) < 30 for x in lines) / (len(lines) or 1),
        kinds[1] + kinds[2], kinds[1], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7], len(share),
        float(-(share * np.log2(share)).sum()), float((data[1:] == data[:-1]).mean()) if size > 1 else 0.0,
        float(_END.search(text) is not None), sum(map(str.istitle, words)) / n,
        sum(any(c.isdigit() for c in w) for w in seen) / len(seen) if seen else 0.0,
    ]


def statistics_of(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """All trees in flat arrays: node i of tree t tests statistic[t, i] <= cut[t, i] and has the children 2i+1, 2i+2."""

    statistic: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.statistic.shape[1]
        for statistic, cut, value in zip(self.statistic, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, statistic[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.2, bins: int = 64,
    smooth: float = 2.0, least_weight: float = 2.0,
) -> Trees:
    """Boosted trees for the log-odds of y; both labels weigh the same in total.

    With one label alone, or no rows, the trees are empty and every score is the same.
    """
    inner, leaves = 2**depth - 1, 2**depth
    share = min(max(float(y.mean()) if len(y) else 0.5, 0.0), 1.0)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), 0.0, depth)
    if share in (0.0, 1.0) or not len(y):
        out.base = 5.0 * (2 * share - 1)
        return out
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    features, wide = np.arange(x.shape[1]), bins
    flat = binned + features * wide
    total = np.zeros(len(y))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, here = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (len(features) * wide) + flat).ravel()
            shape = (here, len(features), wide)
            g = np.bincount(at, np.repeat(gradient, len(features)), here * len(features) * wide).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(curve, len(features)), here * len(features) * wide).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            gain[(h < least_weight) | (h_all - h < least_weight)] = 0
            for k, best in enumerate(gain.reshape(here, -1).argmax(1)):
                f, b = divmod(int(best), wide)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    out.statistic[t, first + k], out.cut[t, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), out.statistic[t, node]] > out.cut[t, node])
        leaf = node - inner
        sums = np.bincount(leaf, gradient, leaves), np.bincount(leaf, curve, leaves)
        out.value[t] = rate * sums[0] / (sums[1] + smooth)
        total += out.value[t][leaf]
    return out


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id's decimal text leaves 1 modulo 3. A NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **settings) -> Trees:
    """Trees fitted on at most ``max_rows`` labelled rows that are not held out.

    The rows are those with the smallest hash of the id, the same for every run; up to
    ``max_rows`` of each label. A label without a document, with a NULL, or given twice
    with different values is not used; of documents that share an id, the least statistics
    are. Only statistics and labels reach the driver, one row per id.
    """
    known = labels.filter("quality in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("_other")).filter("y = _other")
    order = F.xxhash64("doc_id")
    chosen = None
    for label in (0, 1):  # at most max_rows rows each, so small enough to broadcast
        some = known.filter(F.col("y") == label).orderBy(order, "doc_id").limit(max_rows // 2).select("doc_id", "y")
        chosen = some if chosen is None else chosen.unionByName(some)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "x": list(statistics_of(batch["text"]))})

    measured = sample.mapInPandas(measure, "doc_id long, y int, x array<double>")
    rows = measured.groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    x = np.stack(rows["x"]) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows["y"].to_numpy(np.float64), **settings)


def score(docs: DataFrame, trees: Trees, to: str) -> DataFrame:
    """``docs`` with the quality of every whole text, 0 to 1, in column ``to``.

    NULL and empty texts get the score of all-zero statistics; a row's score depends on
    its text alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # a few hundred kB, whatever the data

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(statistics_of(texts)))

    return docs.withColumn(to, quality(F.col("text")))
