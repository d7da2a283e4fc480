"""Language identification by a convolutional network over bytes, trained here in numpy."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import map_batches

UNKNOWN = "und"
HELD_OUT = 5
#: Documents per language that the network learns from, at most, and windows of each.
TRAIN_DOCS = 800
TRAIN_WINDOWS = 4
WINDOW = 256
EMBED = 8
FILTERS = 8
WIDTHS = (2, 3, 4)
EPOCHS = 8
_BATCH = 64
_STRIP = 256


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % HELD_OUT == 0


def windows(text: bytes) -> np.ndarray:
    """A whole text as rows of WINDOW bytes; the last is filled up with zeros."""
    n = -(-len(text) // WINDOW)
    return np.frombuffer(text.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class ByteNetwork:
    """Byte embedding, filters of several widths, the maximum of each over the window, softmax."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.filters = [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> ByteNetwork:
        """Adam over shuffled batches; the maximum passes its gradient to one place per filter only."""
        rng = np.random.default_rng(seed)
        ps = self._parameters()
        m, v = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps]
        step = 0
        for epoch in range(EPOCHS):
            rate = 0.01 * (1 - epoch / EPOCHS)
            order = rng.permutation(len(x))
            for start in range(0, len(order), _BATCH):
                rows = order[start : start + _BATCH]
                step += 1
                for p, g, a, b in zip(ps, self._gradients(x[rows], y[rows]), m, v, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        emb = self.embed[x]
        hidden, taken = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            spans = np.lib.stride_tricks.sliding_window_view(emb, w, axis=1).transpose(0, 1, 3, 2)
            z = spans.reshape(n, -1, w * EMBED) @ f
            best = z.argmax(axis=1)
            taken.append(best)
            hidden.append(np.take_along_axis(z, best[:, None], 1)[:, 0] + b)
        h = np.concatenate(hidden, axis=1)
        active = np.maximum(h, 0)
        chance = _softmax(active @ self.out + self.out_bias)
        chance[np.arange(n), y] -= 1
        chance /= n
        g_out, g_out_bias = active.T @ chance, chance.sum(axis=0)
        g_h = (chance @ self.out.T) * (h > 0)
        g_embed = np.zeros_like(self.embed)
        g_filters, g_bias = [], []
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            g = g_h[:, k * FILTERS : (k + 1) * FILTERS]
            places = taken[k][:, :, None] + np.arange(w)
            bytes_ = x[np.arange(n)[:, None, None], places]
            spans = self.embed[bytes_].reshape(n, FILTERS, w * EMBED)
            g_filters.append(np.einsum("nfd,nf->df", spans, g))
            g_bias.append(g.sum(axis=0))
            back = (g[:, :, None] * f.T[None]).reshape(-1, EMBED)
            np.add.at(g_embed, bytes_.reshape(-1), back)
        return [g_embed, *g_filters, *g_bias, g_out, g_out_bias]

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width, what a pair of bytes gives a filter by its first two places, and by its last one or two."""
        tables = []
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            parts = [self.embed @ f[i * EMBED : (i + 1) * EMBED] for i in range(w)]
            first = (parts[0][:, None] + parts[1][None] + b).reshape(-1, FILTERS)
            rest = parts[2] if w == 3 else None
            if w == 4:
                rest = (parts[2][:, None] + parts[3][None]).reshape(-1, FILTERS)
            tables.append((np.ascontiguousarray(first, np.float32), rest))
        return tables

    def predict(self, x: np.ndarray, tables: list) -> np.ndarray:
        """Class probabilities of windows.  A filter's value at a place is a sum of table rows."""
        found = []
        for start in range(0, len(x), _STRIP):
            part = x[start : start + _STRIP].astype(np.intp)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            tops = []
            for w, (first, rest) in zip(WIDTHS, tables, strict=True):
                z = first.take(pairs[:, : WINDOW - w + 1].ravel(), axis=0)
                if w == 3:
                    z += rest.take(part[:, 2:].ravel(), axis=0)
                elif w == 4:
                    z += rest.take(pairs[:, 2:].ravel(), axis=0)
                tops.append(z.reshape(len(part), -1, FILTERS).max(axis=1))
            h = np.maximum(np.concatenate(tops, axis=1), 0)
            found.append(_softmax(h @ self.out + self.out_bias))
        return np.concatenate(found)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _training_windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Windows that lie evenly over each text, and its last one, so that filled-up windows are learned too."""
    for batch in batches:
        places, langs, rows, hashes = [], [], [], []
        texts = batch.column("text").cast(pa.binary())
        for place, lang, text in zip(batch.column("place"), batch.column("lang"), texts, strict=True):
            x = windows(text.as_py())
            at = np.unique(np.linspace(0, len(x) - 1, min(len(x), most)).astype(int))
            places.append(place.as_py())
            langs.append(lang.as_py())
            rows.append(x[at].tobytes())
            hashes.append(xxhash.xxh3_128_digest(text.as_py()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(langs, pa.string()), pa.array(rows, pa.binary()), pa.array(hashes, pa.binary())],
            names=["place", "lang", "windows", "hash"],
        )


def _train(table: pa.Table) -> pa.Table:
    table = table.sort_by([("place", "ascending"), ("lang", "ascending")])
    langs = table.column("lang").to_pylist()
    classes = sorted(set(langs))
    parts = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for w in table.column("windows").to_pylist()]
    y = np.repeat([classes.index(lang) for lang in langs], [len(p) for p in parts])
    network = ByteNetwork(classes).train(np.concatenate(parts), y)
    return pa.table({"model": pa.array([pickle.dumps(network)], pa.binary())})


def fit_language(docs: DataFrame, most: int = TRAIN_DOCS, most_windows: int = TRAIN_WINDOWS) -> bytes | None:
    """The trained network, or None if no document may be learned from.

    It learns from documents with a language and a text that are not held out, of each language at most ``most``, those
    with the smallest hash of their id, and of each at most ``most_windows`` windows, in one task.  Of several texts under
    one id the one with the smallest hash is taken, so that reruns learn the same.
    """
    from pyspark.sql import Window

    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> '' AND doc_id IS NOT NULL")
    usable = usable.filter(~held_out("doc_id")).select("doc_id", "lang")
    place = F.xxhash64(F.lit("language"), "doc_id")
    # In three rounds of 64, 8 and 1 lanes, so that the documents of one language are never ranked in a single task.
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    ranked = usable.distinct().withColumns({"place": place, "lane": lane, "middle": F.pmod(lane, F.lit(8))})
    for keys in (["lang", "lane"], ["lang", "middle"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("place", "doc_id")
        ranked = ranked.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= most)
    sample = stage_table(ranked.select("doc_id", "lang", "place"), "languages")
    texts = docs.select("doc_id", "lang", "text").filter("text <> ''")
    chosen = texts.join(F.broadcast(sample), ["doc_id", "lang"]).select("place", "lang", "text")
    rows = map_batches(
        chosen, partial(_training_windows, most=most_windows), "place long, lang string, windows binary, hash binary"
    )
    rows = rows.groupBy("place", "lang").agg(F.min_by("windows", "hash").alias("windows"))
    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_train, "model binary").collect()
    return found[0].model if found else None


def _identify(model: bytes | None, text_of, finish):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = pickle.loads(model) if model else None
        tables = network.tables() if network else None
        for batch in batches:
            column = text_of(batch)
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for row, text in enumerate(column):
                text = text.as_py()
                if network is None or not text or not any(map(str.isalpha, text)):
                    continue
                x = windows(text.encode("utf-8", "surrogatepass"))
                # Windows weigh by the letters' bytes in them.
                weight = ((x | 32) - 97 < 26).sum(axis=1) + (x >= 128).sum(axis=1) + 1e-6
                chance = weight @ network.predict(x, tables) / weight.sum()
                best = int(chance.argmax())
                langs[row], scores[row] = network.classes[best], min(1.0, float(chance[best]))
            yield finish(batch, langs, scores)

    return identify


def identify_language(docs: DataFrame, model: bytes | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score.

    Whole texts are read in windows, and only their text.  ``score`` is the mean probability of the language over the
    windows.  Texts that are null or have no letter, and all texts if nothing could be learned, are ``und`` with score 0.
    Repeated rows are judged each, rows without an id too.
    """

    def finish(batch: pa.RecordBatch, langs: list[str], scores: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(scores)],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out("doc_id"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return map_batches(source, _identify(model, lambda b: b.column("text"), finish), schema)


def keep_identified(docs: DataFrame, model: bytes | None, least_score: float = 0.3) -> DataFrame:
    """The rows whose text has a language and reaches ``least_score`` for it, with all columns.

    Without a model nothing can be judged and only texts without letters go.
    """
    at = docs.columns.index("text")

    def finish(batch: pa.RecordBatch, langs: list[str], scores: np.ndarray) -> pa.RecordBatch:
        if model is None:
            keep = [bool(t.as_py()) and any(map(str.isalpha, t.as_py())) for t in batch.column(at)]
        else:
            keep = [lang != UNKNOWN and score >= least_score for lang, score in zip(langs, scores, strict=True)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, _identify(model, lambda b: b.column(at), finish), docs.schema)
