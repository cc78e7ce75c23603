"""A quality classifier: gradient-boosted trees over statistics of documents."""

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import slices

_ENDS = (".", "!", "?", ":", ";", '"', "'", ")")
_BINS = 64


def _of(*characters):
    mask = np.zeros(256)
    for c in characters:
        mask[list(c.encode())] = 1
    return mask


#: Classes of bytes whose shares are statistics of a text.
_CLASSES = {
    "upper": _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _of("abcdefghijklmnopqrstuvwxyz"),
    "digit": _of("0123456789"),
    "space": _of(" \t\r\v\f"),
    "feed": _of("\n"),
    "stop": _of(".?"),
    "comma": _of(",;:"),
    "shout": _of("!"),
    "marks": _of("#$%&*@^~"),
    "table": _of("|_=+<>\\/"),
    "brackets": _of("()[]{}"),
    "quotes": _of("\"'`-"),
    "wide": np.concatenate((np.zeros(128), np.ones(128))),
}
_MATRIX = np.stack(list(_CLASSES.values()), axis=1)
STATISTICS = [
    "log_bytes", "log_words", "word_length", "long_words", "short_words", "distinct_words",
    "distinct_pairs", "top_word", "upper_words", "mixed_words", "digit_words", "lines",
    "line_length", "repeated_lines", "ended_lines", "short_lines", "stop_gap", "entropy",
    "leading_space", "byte_runs",
    *_CLASSES,
]


def statistics(text: str) -> list[float]:
    """The statistics of one text, all of them finite; an empty text has zeros."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    words = text.split()
    if not len(raw) or not words:
        return [math.log1p(len(raw))] + [0.0] * (len(STATISTICS) - 1)
    n, size = len(words), len(raw)
    histogram = np.bincount(raw, minlength=256)
    share = histogram[histogram > 0] / size
    counts = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [s for s in (line.strip() for line in text.split("\n")) if s]
    stops = int(histogram[ord(".")] + histogram[ord("!")] + histogram[ord("?")])
    return [
        math.log1p(size),
        math.log1p(n),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float((lengths <= 3).mean()),
        len(counts) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1),
        max(counts.values()) / n,
        sum(map(str.isupper, words)) / n,
        sum(w.isalpha() for w in counts) / len(counts),
        sum(w.isdigit() for w in counts) / len(counts),
        math.log1p(len(lines)),
        math.log1p(sum(map(len, lines)) / max(len(lines), 1)),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(line.endswith(_ENDS) for line in lines) / max(len(lines), 1),
        sum(len(line) < 30 for line in lines) / max(len(lines), 1),
        n / (stops + 1),
        float(-(share * np.log2(share)).sum()),
        (len(text) - len(text.lstrip())) / len(text),
        float((raw[1:] == raw[:-1]).mean()) if size > 1 else 0.0,
        *(histogram @ _MATRIX / size).tolist(),
    ]


@dataclass
class Trees:
    """Boosted trees as flat arrays: node ``i`` sends rows with ``x[feature] <= cut`` to ``left[i]``
    and others to ``left[i] + 1``; a leaf points at itself with an infinite cut."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, for all rows at once, level by level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = self.left[node] + (x[rows, self.feature[node]] > self.cut[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, least: int = 20
) -> Trees:
    """Histogram gradient boosting for labels 0 and 1: features are binned once by quantile, and
    every level of a tree takes the best cut of each node from sums per bin."""
    if not len(y):
        x, y = np.zeros((1, len(STATISTICS))), np.array([0.5])
    mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, _BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    total = np.full(len(y), base)
    roots, feature, cut, left, value = [], [], [], [], []

    def leaf(v):
        feature.append(0)
        cut.append(np.inf)
        left.append(len(left))
        value.append(v)
        return len(left) - 1

    ridge = 1.0
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        roots.append(leaf(0.0))
        node = np.full(len(y), roots[-1])
        open_nodes = [roots[-1]]
        for level in range(depth + 1):
            place = np.full(len(left), -1)
            place[open_nodes] = np.arange(len(open_nodes))
            live = np.flatnonzero(place[node] >= 0)
            if not len(live):
                break
            group, k = place[node[live]], len(open_nodes)
            g_all = np.bincount(group, gradient[live], k)
            w_all = np.bincount(group, weight[live], k)
            for i, nd in enumerate(open_nodes):
                value[nd] = rate * g_all[i] / (w_all[i] + ridge)
            if level == depth:
                break
            best, choice = np.full(k, 1e-6), [None] * k
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                key = group * _BINS + binned[live, f]
                g = np.bincount(key, gradient[live], k * _BINS).reshape(k, _BINS).cumsum(axis=1)
                w = np.bincount(key, weight[live], k * _BINS).reshape(k, _BINS).cumsum(axis=1)
                c = np.bincount(key, minlength=k * _BINS).reshape(k, _BINS).cumsum(axis=1)
                gain = (
                    g**2 / (w + ridge)
                    + (g_all[:, None] - g) ** 2 / (w_all[:, None] - w + ridge)
                    - (g_all**2 / (w_all + ridge))[:, None]
                )
                gain[(c < least) | (c[:, -1:] - c < least)] = 0
                gain = gain[:, : len(edge)]
                at = gain.argmax(axis=1)
                for i in np.flatnonzero(gain[np.arange(k), at] > best):
                    best[i], choice[i] = gain[i, at[i]], (f, at[i])
            following = []
            for i, nd in enumerate(open_nodes):
                if choice[i] is None:
                    continue
                f, b = choice[i]
                low = leaf(0.0)
                high = leaf(0.0)
                feature[nd], cut[nd], left[nd] = f, edges[f][b], low
                mine = live[group == i]
                node[mine] = np.where(binned[mine, f] <= b, low, high)
                following += [low, high]
            open_nodes = following
            if not open_nodes:
                break
        total += np.array(value)[node]
    arrays = (np.array(a) for a in (roots, feature, cut, left, value))
    return Trees(base, *arrays, depth)


def _measure(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            values = [statistics(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(values, pa.list_(pa.float64()))], names=["label", "x"]
            )


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **options) -> Trees:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    At most ``max_labelled`` labelled documents, taken by a hash of the id, are read; that bounds
    the list of labels that is broadcast and the statistics that come to the driver, where the
    trees are grown. Labels that are null or neither 0 nor 1 are left out. With no labels every
    score is 0.5.
    """
    drawn = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("double"))
        .where("doc_id is not null and label in (0, 1)")
        .orderBy(F.xxhash64("doc_id", F.lit(29)), "doc_id", "label")
        .limit(max_labelled)
    )
    sample = (
        docs.join(F.broadcast(drawn), "doc_id")
        .select("label", "text")
        .mapInArrow(_measure, "label double, x array<double>")
        .limit(2 * max_labelled)
        .toPandas()
    )
    x = np.array(sample["x"].to_list(), dtype=np.float64).reshape(len(sample), len(STATISTICS))
    order = np.lexsort((*x.T, sample["label"].to_numpy()))  # however the rows came in
    return fit_trees(x[order], sample["label"].to_numpy(dtype=np.float64)[order], **options)


def _scored(batches, model):
    for batch in batches:
        for part in slices(batch, "text"):
            x = np.array([statistics(t or "") for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(model.score(x))], names=["doc_id", "score"]
            )


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: how likely label 1 is, 0 to 1, from the whole text alone.

    Null and empty texts get the score of an empty text. Repeated rows are scored each; a null id
    stays. An empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(partial(_scored, model=model), "doc_id bigint, score double")
