"""Toxicity by a chain of linear classifiers: each category's model sees the probabilities of the earlier ones."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import map_batches

#: Labelled documents that the chain learns from, at most: those with the smallest hash of their id.
TRAIN_DOCS = 8_000
FOLDS = 3
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5)
#: The categories in the order of the chain.  The last has no label of its own: a toxic document is severe if its
#: share of toxic words is above the median of the toxic ones.
CATEGORIES = ("low_quality", "toxic", "severe")
LEAST_Z = 4.0
MOST_FEATURES = 20_000
WORD_CACHE = 200_000
_DENSE = 5


class _WordFeatures(dict):
    """Word -> hashed features: the word and its beginnings, for inflected and compound words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        bare = word.strip("\"'.,;:!?()[]{}«»„“”‘’¿¡*$%#@&-–—…")
        names = [f"w {bare}", *[f"p {bare[:n]}" for n in PREFIXES if len(bare) > n]] if bare else []
        ids = tuple(xxhash.xxh3_64_intdigest(n) % BUCKETS for n in names)
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = ids
        return ids


def text_features(text: str | None, words: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of a whole text, and a few figures: bias, length, variety, case and marks."""
    tokens = text.lower().split() if text else []
    different = set(tokens)
    ids = {i for token in different for i in words[token]}
    n = len(text) if text else 0
    dense = [
        1.0,
        np.log1p(len(tokens)) / 10,
        len(different) / len(tokens) if tokens else 1.0,
        sum(map(str.isupper, text)) / n if n else 0.0,
        1 - sum(map(str.isalnum, text)) / n if n else 0.0,
    ]
    return np.sort(np.fromiter(ids, np.int32, len(ids))), np.array(dense)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Linear:
    """Logistic regression on screened sparse features, dense figures and earlier categories' log-odds."""

    def __init__(self, most_features: int = MOST_FEATURES):
        self.most_features = most_features

    def fit(self, rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray) -> Linear:
        n, positive = len(y), float(y.sum())
        self.ids, self.weight = np.empty(0, np.int64), np.empty(0)
        share = (positive + 0.5) / (n + 1)
        self.mean, self.scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
        self.mean[0], self.scale[0] = 0.0, 1.0
        self.dense = np.zeros(dense.shape[1])
        self.dense[0] = np.log(share / (1 - share))
        if not 0 < positive < n:
            return self
        # Screening: features that are clearly more, or clearly less, frequent in the category.
        all_, with_ = np.bincount(cols, minlength=BUCKETS), np.bincount(cols, y[rows], BUCKETS)
        p, q = with_ / positive, (all_ - with_) / (n - positive)
        pool = all_ / n
        with np.errstate(divide="ignore", invalid="ignore"):
            z = (p - q) / np.sqrt(pool * (1 - pool) * (1 / positive + 1 / (n - positive)))
        z[(all_ < 3) | ~np.isfinite(z)] = 0
        strong = np.flatnonzero(np.abs(z) >= LEAST_Z)
        self.ids = np.sort(strong[np.argsort(-np.abs(z[strong]), kind="stable")[: self.most_features]])
        column = np.full(BUCKETS, -1)
        column[self.ids] = np.arange(len(self.ids))
        used = column[cols] >= 0
        r, c = rows[used], column[cols[used]]
        d = (dense - self.mean) / self.scale
        w, v = np.zeros(len(self.ids)), self.dense.copy()
        gw, gv = np.full(len(w), 1e-8), np.full(len(v), 1e-8)
        for step in range(150):  # full batches, AdaGrad steps
            error = (_sigmoid(np.bincount(r, w[c], n) + d @ v) - y) / n
            dw = np.bincount(c, error[r], len(w)) + 2e-4 * w
            dv = d.T @ error + 1e-4 * np.r_[0, v[1:]]
            gw += dw**2
            gv += dv**2
            w -= 0.4 * dw / np.sqrt(gw)
            v -= 0.2 * dv / np.sqrt(gv)
        self.weight, self.dense = w, v
        return self

    def log_odds(self, rows: np.ndarray, cols: np.ndarray, dense: np.ndarray) -> np.ndarray:
        table = np.zeros(BUCKETS)
        table[self.ids] = self.weight
        return np.bincount(rows, table[cols], len(dense)) + ((dense - self.mean) / self.scale) @ self.dense


def train_chain(
    sparse: list[np.ndarray], dense: np.ndarray, marks: np.ndarray, folds: np.ndarray, most_features: int = MOST_FEATURES
) -> dict:
    """One model per category.  ``marks`` has low_quality and toxic; models behind the first are trained with
    out-of-fold log-odds of the earlier ones, so that they see these as they will be on new documents."""
    rows = np.repeat(np.arange(len(sparse)), [len(s) for s in sparse])
    cols = np.concatenate(sparse) if sparse else np.empty(0, int)
    models, seen = [], dense
    targets = [marks[:, 0], marks[:, 1], None]
    share = 0.5
    for k in range(len(CATEGORIES)):
        y = targets[k]
        outside = np.zeros(len(dense))
        for fold in range(FOLDS):
            train = folds != fold
            inside = train[rows]
            at = np.cumsum(train) - 1
            model = Linear(most_features).fit(at[rows[inside]], cols[inside], seen[train], y[train])
            outside[~train] = model.log_odds((np.cumsum(~train) - 1)[rows[~inside]], cols[~inside], seen[~train])
        model = Linear(most_features).fit(rows, cols, seen, y)
        models.append(model)
        if CATEGORIES[k] == "toxic":
            # The verdict's threshold: the best F1 out of fold, the middle of those that reach it.
            tries = np.linspace(0.1, 0.9, 33)
            hit = [(_sigmoid(outside) >= t) for t in tries]
            f1 = np.array([2 * (h & (y == 1)).sum() / max(1, h.sum() + (y == 1).sum()) for h in hit])
            share = float(np.median(tries[f1 >= f1.max() - 1e-9])) if y.any() else 0.5
            strong = np.zeros(BUCKETS, bool)
            strong[model.ids[model.weight > 0.5]] = True
            density = np.bincount(rows, strong[cols], len(dense)) / np.maximum(1, [len(s) for s in sparse])
            middle = np.median(density[y == 1]) if y.any() else np.inf
            targets[2] = ((y == 1) & (density > middle)).astype(float)
        seen = np.column_stack([seen, outside])
    return {"models": models, "threshold": share}


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordFeatures()
    for batch in batches:
        sparse, dense, hashes = [], [], []
        for text in batch.column("text"):
            hashes.append(xxhash.xxh3_128_digest((text.as_py() or "").encode("utf-8", "surrogatepass")))
            s, d = text_features(text.as_py(), words)
            sparse.append(s.tobytes())
            dense.append(d.tobytes())
        columns = [batch.column(c) for c in ("place", "low_quality", "toxic")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(sparse, pa.binary()), pa.array(dense, pa.binary()), pa.array(hashes, pa.binary())],
            names=["place", "low_quality", "toxic", "sparse", "dense", "hash"],
        )


def _train(table: pa.Table, most_features: int) -> pa.Table:
    table = table.sort_by("place")
    sparse = [np.frombuffer(s, np.int32) for s in table.column("sparse").to_pylist()]
    dense = np.array([np.frombuffer(d) for d in table.column("dense").to_pylist()])
    marks = np.column_stack([table.column(c).to_numpy() for c in ("low_quality", "toxic")]).astype(float)
    folds = np.arange(len(sparse)) % FOLDS
    return pa.table({"model": pa.array([pickle.dumps(train_chain(sparse, dense, marks, folds, most_features))], pa.binary())})


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, most_features: int = MOST_FEATURES
) -> bytes | None:
    """The trained chain, or None without labelled documents.

    It learns from at most ``most`` labelled documents, in one task, and gives weights to at most ``most_features`` hashed
    features a category, those that differ most between its documents and others; the first bound also holds what is broadcast to find them.
    Of several labels of a document, the worst counts; labels with nulls are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    known = known.agg((1 - F.min("quality")).cast("int").alias("low_quality"), F.max("toxic").cast("int").alias("toxic"))
    place = F.xxhash64(F.lit("toxicity"), "doc_id")
    sample = stage_table(known.withColumn("place", place).orderBy("place", "doc_id").limit(most), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = texts.join(F.broadcast(sample), "doc_id").select("place", "low_quality", "toxic", "text")
    rows = map_batches(chosen, _features, "place long, low_quality int, toxic int, sparse binary, dense binary, hash binary")
    # Repeated ids must not make the sample larger than its bound; of their texts the one with the smallest hash is taken.
    rows = rows.groupBy("place", "low_quality", "toxic").agg(F.min_by(F.struct("sparse", "dense"), "hash").alias("seen"))
    rows = rows.select("place", "low_quality", "toxic", "seen.sparse", "seen.dense")
    train = lambda table: _train(table, most_features)
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(train, "model binary").collect()
    return found[0].model if found else None


def _scores(model: bytes | None, text_of, keep=None):
    """Batches -> batches with the categories' probabilities; or, with ``keep``, the rows it keeps."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = pickle.loads(model) if model else None
        words = _WordFeatures()
        tables = []
        for m in chain["models"] if chain else ():
            table = np.zeros(BUCKETS, np.float32)
            table[m.ids] = m.weight
            tables.append(table)
        weights = np.stack(tables, axis=1) if tables else None
        for batch in batches:
            chances = np.zeros((batch.num_rows, len(CATEGORIES)))
            for row, text in enumerate(text_of(batch)):
                text = text.as_py()
                if chain is None or not text:
                    continue
                ids, seen = text_features(text, words)
                sums = weights[ids].sum(axis=0, dtype=np.float64)
                for k, m in enumerate(chain["models"]):
                    odds = sums[k] + ((seen - m.mean) / m.scale) @ m.dense
                    chances[row, k] = _sigmoid(odds)
                    seen = np.append(seen, odds)
            toxic = chances[:, CATEGORIES.index("toxic")] >= (chain["threshold"] if chain else 2.0)
            yield keep(batch, toxic) if keep else _with_chances(batch, chances, toxic)

    return score


def _with_chances(batch: pa.RecordBatch, chances: np.ndarray, toxic: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *[pa.array(c) for c in chances.T], pa.array(toxic), pa.array(~toxic)],
        names=["doc_id", *[f"p_{c}" for c in CATEGORIES], "toxic", "kept"],
    )


def score_toxicity(docs: DataFrame, model: bytes | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, p_low_quality, p_toxic, p_severe, toxic, kept.

    Whole texts are read.  Null and empty texts, and all texts if nothing was labelled, get probabilities of 0
    and are kept.  Repeated rows are judged each; rows without an id too.
    """
    schema = f"doc_id long, {', '.join(f'p_{c} double' for c in CATEGORIES)}, toxic boolean, kept boolean"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(source, _scores(model, lambda b: b.column("text")), schema)


def drop_toxic(docs: DataFrame, model: bytes | None) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all columns."""
    at = docs.columns.index("text")
    keep = lambda batch, toxic: batch.filter(pa.array(~toxic))
    return map_batches(docs, _scores(model, lambda b: b.column(at), keep), docs.schema)
