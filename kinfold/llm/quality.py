"""Quality classifier: a generalised additive model with pairwise interactions.

Each measurement of a text is binned; boosting goes round the features again and again and
adds a shallow tree over one feature's bins to that feature's lookup table. Pairs of
features get tables of their own in the same way. A text's score is the sum of its table
entries, so scoring is a few vectorised look-ups and additions per batch.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import held_out, labelled_sample, table
from kinfold.llm.substring import run_hashes, words_in

#: At most this many labelled rows are collected to fit the tables.
TRAIN_LIMIT = 20_000
BINS, ROUNDS, RATE, PAIRS, PAIR_BINS = 32, 120, 0.15, 6, 8
FEATURES = (
    "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "exclamations", "pipes", "beyond_ascii",
    "lines", "distinct_words", "same_as_before", "sentence_ends", "short_words", "distinct_lines",
)


def _classes() -> np.ndarray:
    out = np.zeros((8, 256), np.float32)
    sets = [range(65, 91), range(48, 58), b".,;:?!'\"()-", b"#*$%&|<>", b"!", b"|", range(128, 256), b"\n"]
    for k, members in enumerate(sets):
        out[k, list(members)] = 1
    return out


_CLASSES = _classes()


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text of a buffer; a text without words gives zeros mostly."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    share = np.zeros((n, 8))
    if len(data):
        counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
        share = counts @ _CLASSES.T
    words, text, first = words_in(data, offsets)
    total = np.diff(first).astype(float)
    w, size = np.maximum(total, 1), np.maximum(np.diff(offsets), 1)
    spaces = np.bincount(row[np.isin(data, [9, 10, 11, 12, 13, 32])], minlength=n) if len(data) else np.zeros(n)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        h, o = hashes[order], of[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (o[1:] != o[:-1]))) if len(h) else np.zeros(0, bool)
        return np.bincount(o[new], minlength=n)

    again = np.bincount(text[1:][(words[1:] == words[:-1]) & (text[1:] == text[:-1])], minlength=n) if len(words) else 0 * total
    solid = np.ones(len(data), bool)
    solid[np.isin(data, [9, 10, 11, 12, 13, 32])] = False
    after = np.append(solid[1:], False)
    after[offsets[1:-1][(offsets[1:-1] > 0)] - 1] = False
    last = np.flatnonzero(solid & ~after)
    ends = np.bincount(row[last[np.isin(data[last], list(b".!?"))]], minlength=n) if len(last) else 0 * total
    before = np.concatenate(([False], solid[:-1]))
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    short = np.bincount(row[starts[(last - starts) < 3]], minlength=n) if len(starts) else 0 * total
    # lines: runs between newlines
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data):
        cut[1:][data == 10] = True
    edges = np.flatnonzero(cut)
    lines = run_hashes(data, edges[:-1], edges[1:])
    of = np.searchsorted(offsets, edges[:-1], "right") - 1
    n_lines = np.bincount(of, minlength=n)
    return np.column_stack([
        np.log1p(total), (size - spaces) / w, *(share[:, k] / size for k in range(7)), share[:, 7] / w,
        distinct(words, text) / w, again / w, ends / w, short / w, distinct(lines, of) / np.maximum(n_lines, 1),
    ])


def measured(batch_texts, size: int = 1_000_000) -> np.ndarray:
    """Features of an Arrow text column, some bytes at a time."""
    import pyarrow as pa

    texts = batch_texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out, i = [np.zeros((0, len(FEATURES)))], 0
    while i < len(texts):
        j = min(len(texts), max(i + 1, int(np.searchsorted(ends, ends[i] + size, "right")) - 1), i + 4096)
        out.append(measure(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]))
        i = j
    return np.concatenate(out)


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Leaf values by bin of a tree over ordered bins, grown greedily."""
    value = np.full(len(grad), grad.sum() / (hess.sum() + 1.0))
    if depth and len(grad) > 1:
        g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
        gr, hr = grad.sum() - g, hess.sum() - h
        gain = np.where((h > least) & (hr > least), g * g / (h + 1.0) + gr * gr / (hr + 1.0), -1.0)
        k = int(gain.argmax())
        if gain[k] > grad.sum() ** 2 / (hess.sum() + 1.0) + 1e-6:
            value[: k + 1] = _tree(grad[: k + 1], hess[: k + 1], depth - 1, least)
            value[k + 1 :] = _tree(grad[k + 1 :], hess[k + 1 :], depth - 1, least)
    return value


def _quarters(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """The best two-by-two tree over a pair's grid, and its gain."""
    n = len(grad)
    g, h = (np.cumsum(np.cumsum(x, 0), 1) for x in (grad, hess))
    a, b = np.meshgrid(np.arange(n - 1), np.arange(n - 1), indexing="ij")
    cut = lambda s: (s[a, b], s[a, -1] - s[a, b], s[-1, b] - s[a, b], s[-1, -1] - s[a, -1] - s[-1, b] + s[a, b])
    parts = list(zip(cut(g), cut(h), strict=True))
    gain = sum(x * x / (y + 1.0) for x, y in parts)
    k = np.unravel_index(gain.argmax(), gain.shape)
    leaf = [x[k] / (y[k] + 1.0) for x, y in parts]
    left, top = np.arange(n)[:, None] <= k[0], np.arange(n)[None, :] <= k[1]
    value = np.where(left, np.where(top, leaf[0], leaf[1]), np.where(top, leaf[2], leaf[3]))
    return value, float(gain[k])


class Additive:
    """Bin edges and lookup tables; ``fit`` on rows of features and 0/1 labels."""

    def __init__(self):
        self.edges: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.bias = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]) if len(x) else np.zeros((0, len(self.edges)), int)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Additive:
        """Without rows of both labels the score is the share of ones, or a half without rows."""
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, quantiles)) if len(x) else np.zeros(0) for c in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        p = (y.sum() + 0.5) / (len(y) + 1.0)
        self.bias = float(np.log(p / (1 - p)))
        if len(np.unique(y)) < 2:
            return self
        b = self.bins(x)
        f = np.full(len(y), self.bias)
        least = min(5.0, len(y) / 50)

        def slope():
            q = 1 / (1 + np.exp(-f))
            return y - q, q * (1 - q)

        for _ in range(ROUNDS):
            for k, t in enumerate(self.tables):
                g, h = (np.bincount(b[:, k], v, len(t)) for v in slope())
                step = RATE * _tree(g, h, 2, least / 4)
                t += step
                f += step[b[:, k]]
        coarse = [np.minimum(np.arange(len(t)) * PAIR_BINS // len(t), PAIR_BINS - 1) for t in self.tables]
        c = [coarse[k][b[:, k]] for k in range(len(coarse))]
        grid = lambda i, j: [np.bincount(c[i] * PAIR_BINS + c[j], v, PAIR_BINS**2).reshape(PAIR_BINS, -1) for v in slope()]
        gains = sorted(((_quarters(*grid(i, j))[1], i, j) for i, j in combinations(range(len(c)), 2)), reverse=True)
        self.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in gains[:PAIRS]]
        for _ in range(ROUNDS // 4):
            for i, j, t in self.pairs:
                step = RATE * _quarters(*grid(i, j))[0]
                t += step
                f += step[c[i], c[j]]
        self.coarse = coarse
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        b = self.bins(x)
        f = np.full(len(x), self.bias)
        for k, t in enumerate(self.tables):
            f += t[b[:, k]]
        for i, j, t in self.pairs:
            f += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return 1 / (1 + np.exp(-np.clip(f, -500, 500)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(id, features, and the columns ``more``) per row."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            x = measured(b.column(1))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat, *b.columns[2:]], ["doc_id", "x", *more])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)
    kinds = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in more)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>{kinds}")


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", limit: int = TRAIN_LIMIT) -> Additive:
    """Fits on a bounded sample of labelled rows that are not held out, one row an id; without any, scores are a half."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, column, limit)
    rows = features(sample, more=("label",)).collect()  # at most ``limit`` rows
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES))
    return Additive().fit(x, np.array([r["label"] for r in rows], float))


def classify(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted per row. Null and empty texts get the score of no words; rows repeat as they come.

    A very long text is measured as a whole in one task; an empty table gives no rows; other
    columns are not read.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches):
        for b in batches:
            s = sent.value.score(measured(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, model: Additive, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows whose score reaches ``cut``, all columns as they were; no shuffle. Awkward rows as in ``classify``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(sent.value.score(measured(pc.fill_null(b.column(at), ""))) >= cut))

    return docs.mapInArrow(run, docs.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by a model fitted on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = classify(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
