"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text (shares of character classes, word and line
repetition, lengths) are computed in Arrow batches. The trees are fitted on a
bounded sample of labelled rows: at most ``SAMPLE`` ids, those with the
smallest hash, so the sample is the same in every run. Features are put into
histogram bins; each level of a tree is one pass of gradient sums by (node,
feature, bin). Trees are complete and flattened into arrays by heap position,
so a batch is scored by numpy indexing, one step per level.

Defined results: null and empty texts have all statistics 0 and a score like
any other; labels that are null or whose id is held out teach nothing; without
labels of both classes the score is the share of label 1 (0.5 without any); a
null id is not held out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, whole

#: Most labelled ids that the trees are fitted on.
SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
BINS = 64
TREES = 120
DEPTH = 4
RATE = 0.1
#: Ridge on leaf values, and the least hessian of a leaf.
RIDGE = 1.0
LEAST = 2.0

#: Classes of bytes whose share of a text is a statistic.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t", "line": b"\n\r",
    "stop": b".", "comma": b",;:", "exclaim": b"!?", "quote": b"\"'`", "bracket": b"()[]{}<>", "mark": b"*#$%&@^~", "bar": b"|\\/", "dash": b"-_=+",
    "control": bytes([*range(9), *range(14, 32), 127]), "high": bytes(range(128, 256)),
}
OTHER = ("log_bytes", "log_words", "log_lines", "word_length", "distinct_words", "top_word", "same_next", "same_byte", "distinct_lines", "line_length", "ends_stop")
FEATURES = (*CLASSES, *OTHER)


def statistics(texts: list):
    """One row of FEATURES for each text (bytes or None)."""
    import numpy as np

    classes = np.array([[b in v for v in CLASSES.values()] for b in range(256)], float)
    bytes_of = np.zeros((len(texts), 256))
    other = np.zeros((len(texts), len(OTHER)))
    for k, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text, np.uint8)
        bytes_of[k] = np.bincount(raw, minlength=256) / len(raw)
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        n, m = max(len(words), 1), max(len(lines), 1)
        times = Counter(words)
        other[k] = (
            np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / n, len(times) / n,
            max(times.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, np.count_nonzero(raw[1:] == raw[:-1]) / len(raw),
            len(set(lines)) / m, len(text) / m, sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / m,
        )
    return np.hstack([bytes_of @ classes, other])


@dataclass(frozen=True)
class Trees:
    """Complete trees by heap position: inner nodes k have children 2k + 1 and 2k + 2."""

    feature: object  # (trees, 2**depth - 1)
    cut: object  # same shape; greater values go right
    leaf: object  # (trees, 2**depth)
    start: float

    def score(self, x):
        import numpy as np

        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[row, feature[at]] > cut[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x, y, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    import numpy as np

    inner, n_features = 2**depth - 1, len(FEATURES)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1)  # bin b: above cuts[b - 1], at most cuts[b]
    offset = np.arange(n_features) * bins
    out = ([], [], [])
    total = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((at - first)[:, None] * (n_features * bins) + offset + code).ravel()
            shape = (nodes, n_features, bins)
            g = np.bincount(cell, np.repeat(grad, n_features), nodes * n_features * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hess, n_features), nodes * n_features * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(h < LEAST) | (all_h - h < LEAST)] = 0
            for k in range(nodes):
                f, b = divmod(int(gain[k].argmax()), bins)
                if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                    feature[first + k], cut[first + k] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        g = np.bincount(at - inner, grad, inner + 1)
        h = np.bincount(at - inner, hess, inner + 1)
        leaf = RATE * g / (h + RIDGE)
        total += leaf[at - inner]
        for to, what in zip(out, (feature, cut, leaf)):
            to.append(what)
    return Trees(*map(np.array, out), start)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the labelled rows that are not held out. The labels choose at
    most ``sample`` ids, so what is joined by broadcast and collected is bounded."""
    import numpy as np

    known = labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = pa.array(statistics(as_bytes(batch.column(2))).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], names=["doc_id", "quality", "x"])

    got = rows.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(run, "doc_id long, quality int, x array<double>").collect()
    got.sort(key=lambda r: r["doc_id"])
    return fit(np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES)), np.array([r["quality"] for r in got], float))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with quality_score, the probability of label 1."""
    import pandas as pd

    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.value.score(statistics([t.encode() if t else None for t in batch])))

    score.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("quality_score", F.pandas_udf(score, "double")(F.col("text")))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs.select("doc_id", "text"), labels)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    rows = scored(docs.select(whole(docs), "doc_id", "text"), labels)
    return rows.filter(F.col("quality_score") >= THRESHOLD).select("row.*")
