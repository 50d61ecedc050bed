"""Quality: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .nb_linear import MODULUS, labelled

#: Bytes a filter sees and steps over, channels of a byte, filters, hidden units, and filter places in half a chunk.
WIDTH, STRIDE, CHANNELS, FILTERS, HIDDEN, HALF = 8, 4, 8, 32, 16, 64
#: Labelled rows of each class that are fitted on at most; whole texts count, in the fit as in the score.
SAMPLE = 2200
#: Filter places that go through at once, a multiple of HALF.
BLOCK = 1 << 14
THRESHOLD = 0.3
_PAD = np.zeros(WIDTH, np.uint8)

Model = dict[str, np.ndarray]


def new_model(seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)

    def normal(scale, *shape):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embed": normal(0.5, 256, CHANNELS),
        "conv": normal((WIDTH * CHANNELS) ** -0.5 * 1.5, WIDTH * CHANNELS, FILTERS),
        "conv_b": np.zeros(FILTERS, np.float32),
        "dense": normal((3 * FILTERS) ** -0.5 * 1.5, 3 * FILTERS, HIDDEN),
        "dense_b": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN**-0.5, 2 * HIDDEN),
        "out_b": np.zeros(1, np.float32),
    }


def _places(raw: bytes) -> np.ndarray:
    """Byte offsets of the filter places, padded so that the last byte is covered: (places, WIDTH)."""
    text = np.frombuffer(raw, np.uint8)
    n = max(1, -(-max(0, len(text) - WIDTH) // STRIDE) + 1)
    text = np.concatenate([text, np.zeros(max(0, (n - 1) * STRIDE + WIDTH - len(text)), np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(text, WIDTH)[::STRIDE][:n]


class _Layout:
    """Several texts' filter places one after the other, each text padded to whole halves, and what is a half, a chunk and a text of them.

    A chunk is two neighbouring halves of a text, so that each overlaps the next by half; a single half is one chunk.
    """

    def __init__(self, raws: list[bytes]):
        views = [_places(raw) for raw in raws]
        halves = np.array([-(-len(v) // HALF) for v in views])
        ends = np.cumsum(halves)
        self.view = np.zeros((int(ends[-1]) * HALF, WIDTH), np.uint8)
        self.sizes = np.full(int(ends[-1]), HALF, np.float32)
        for v, h, end in zip(views, halves, ends):
            self.view[(end - h) * HALF : (end - h) * HALF + len(v)] = v
            self.sizes[end - 1] = len(v) - (h - 1) * HALF
        single = np.repeat(halves == 1, halves)
        inner = np.ones(int(ends[-1]), bool)
        inner[ends - 1] = False
        self.left = np.flatnonzero(inner | single)
        self.pair = inner[self.left]
        self.right = np.where(self.pair, self.left + 1, self.left)
        self.total = self.sizes[self.left] + self.sizes[self.right] * self.pair
        self.chunks = np.maximum(1, halves - 1)
        self.first = np.cumsum(self.chunks) - self.chunks

    def blocks(self) -> Iterator[tuple[slice, slice]]:
        """Halves, and their places, that go through at once."""
        step = BLOCK // HALF
        for at in range(0, len(self.sizes), step):
            end = min(at + step, len(self.sizes))
            yield slice(at, end), slice(at * HALF, end * HALF)

    def both(self, x: np.ndarray) -> np.ndarray:
        """The sum over the halves of each chunk."""
        return x[self.left] + x[self.right] * self.pair[:, None]

    def spread(self, d: np.ndarray) -> np.ndarray:
        """Each chunk's row added to its halves."""
        out = np.zeros((len(self.sizes), d.shape[1]), d.dtype)
        out[self.left] += d
        out[self.right[self.pair]] += d[self.pair]
        return out


def _activations(view: np.ndarray, sizes: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """The filters' inputs, and their activations by half; padding is zero."""
    x = np.take(m["embed"], view, axis=0).reshape(-1, WIDTH * CHANNELS)
    act = x @ m["conv"]
    act += m["conv_b"]
    np.maximum(act, 0, out=act)
    act = act.reshape(-1, HALF, FILTERS)
    for k in np.flatnonzero(sizes < HALF):
        act[k, int(sizes[k]) :] = 0
    return x, act


def _forward(raws: list[bytes], m: Model, keep: bool = False):
    """Probabilities of the texts; with keep, what the backward pass needs. Activations are made block by block, so long texts need no more."""
    layout, parts = _Layout(raws), []
    for halves, places in layout.blocks():
        last = _activations(layout.view[places], layout.sizes[halves], m)
        parts.append((last[1].sum(1), np.einsum("hpf,hpf->hf", last[1], last[1]), last[1].max(1)))
    sums, squares, most = (np.concatenate(p) for p in zip(*parts))
    top = np.maximum(most[layout.left], most[layout.right])
    pooled = np.concatenate([layout.both(sums) / layout.total[:, None], layout.both(squares) / layout.total[:, None], top], 1)
    hidden = np.maximum(pooled @ m["dense"] + m["dense_b"], 0)
    both = np.concatenate([np.maximum.reduceat(hidden, layout.first), np.add.reduceat(hidden, layout.first) / layout.chunks[:, None]], 1).astype(hidden.dtype)
    z = both @ m["out"] + m["out_b"][0]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))
    return (p, (layout, last, most, pooled, hidden, both)) if keep else p


def _gradients(raws: list[bytes], y: np.ndarray, m: Model, weights: np.ndarray) -> tuple[np.ndarray, Model]:
    """Probabilities, and gradients of the texts' weighted losses in sum; where there are several blocks, activations are computed again."""
    p, (layout, last, most, pooled, hidden, both) = _forward(raws, m, keep=True)
    dz = ((p - y) * weights).astype(hidden.dtype)
    g = {"out": both.T @ dz, "out_b": dz.sum(keepdims=True)}
    d_both = dz[:, None] * m["out"]
    d_hidden = np.repeat(d_both[:, HIDDEN:] / layout.chunks[:, None].astype(hidden.dtype), layout.chunks, 0)
    # a maximum's gradient goes to its first place
    places = np.arange(len(hidden))[:, None]
    at = np.minimum.reduceat(np.where(hidden == np.repeat(both[:, :HIDDEN], layout.chunks, 0), places, len(hidden)), layout.first)
    d_hidden[at, np.arange(HIDDEN)] += d_both[:, :HIDDEN]
    d_hidden *= hidden > 0
    g["dense"], g["dense_b"] = pooled.T @ d_hidden, d_hidden.sum(0)
    d_pooled = d_hidden @ m["dense"].T
    d_pooled[:, : 2 * FILTERS] /= layout.total[:, None]
    s_mean, s_square = layout.spread(d_pooled[:, :FILTERS]), layout.spread(d_pooled[:, FILTERS : 2 * FILTERS])
    d_top, s_top = d_pooled[:, 2 * FILTERS :], np.zeros_like(most)
    earlier = most[layout.left] >= most[layout.right]
    s_top[layout.left] += np.where(earlier, d_top, 0)
    s_top[layout.right] += np.where(earlier, 0, d_top)
    g["conv"], g["conv_b"], g["embed"] = 0, 0, 0
    for halves, places in layout.blocks():
        x, act = last if len(layout.sizes) * HALF <= BLOCK else _activations(layout.view[places], layout.sizes[halves], m)
        d_act = act * (2 * s_square[halves][:, None, :])
        d_act += s_mean[halves][:, None, :]
        d_act[np.arange(len(act))[:, None], act.argmax(1), np.arange(FILTERS)] += s_top[halves]
        d_act *= act > 0
        d_act = d_act.reshape(-1, FILTERS)
        g["conv"], g["conv_b"] = g["conv"] + x.T @ d_act, g["conv_b"] + d_act.sum(0)
        d_x = (d_act @ m["conv"].T).reshape(-1, CHANNELS)
        flat = layout.view[places].ravel()
        g["embed"] = g["embed"] + np.stack([np.bincount(flat, d_x[:, c], 256) for c in range(CHANNELS)], 1).astype(d_x.dtype)
    return p, g


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 8, size: int = 16, seed: int = 7) -> Model:
    """Adam on cross-entropy, both classes with equal weight; the result depends on the rows' order and the seed alone."""
    m, rng = new_model(seed), np.random.default_rng(seed)
    if not texts:
        return m
    labels = np.asarray(labels, np.float64)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first, second, step, steps = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0, epochs * -(-len(texts) // size)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            total = _gradients([texts[i] for i in rows], labels[rows], m, weights[rows] / size)[1]
            step += 1
            rate = 4e-3 * (1 - step / (steps + 1))
            for k in m:
                first[k] += 0.1 * (total[k] - first[k])
                second[k] += 0.01 * (total[k] ** 2 - second[k])
                m[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return m


def score(raws: list[bytes | None], model: Model) -> np.ndarray:
    """Probabilities of the texts, null ones as empty; as many go through together as fill a block."""
    out, waiting, size = np.zeros(len(raws)), [], 0
    for i, raw in enumerate(raws):
        waiting.append(raw or b"")
        size += len(waiting[-1]) // STRIDE + HALF
        if size >= BLOCK or i + 1 == len(raws):
            out[i + 1 - len(waiting) : i + 1] = _forward(waiting, model)
            waiting, size = [], 0
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled(docs, labels, "quality", sample)
    return fit([r[1] for r in rows], np.array([r[2] for r in rows]))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, held_out, score, predicted.

    The model has a fixed size of a few KB. A null text is scored as empty. Repeated rows and null
    ids stay; other columns are ignored. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), common.held_out(F.col("doc_id"), MODULUS).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = score(common.binary(b.column(1)), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return common.mapped(source, run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs whose score reaches THRESHOLD, with all their columns as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(score(common.binary(b.column(at)), shared.value) >= THRESHOLD))

    return common.mapped(docs, run, docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, common.table(spark, sf_dir, "labels")))
