"""Quality classifier: a byte-level convolutional network in numpy.

Filters slide over the bytes of the whole text; their rectified outputs are averaged and
max-pooled in chunks that overlap by half; a hidden layer reads each chunk; its units are
max-pooled and averaged over all chunks of the text and combined into one probability.

The network is fitted on the driver to a bounded, documented sample of labelled rows
(``SAMPLE`` per class, texts up to ``SAMPLE_CHARS``), then scores every text in the executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import map_texts

WIDTH, STRIDE = 6, 3
FILTERS, HIDDEN = 24, 24
#: Half a chunk: filter positions, and bytes.
HALF = 40
HALF_BYTES = HALF * STRIDE
#: Most labelled rows of each class that the network is fitted to, and their longest text.
SAMPLE = 700
SAMPLE_CHARS = 30_000
EPOCHS, BATCH, RATE = 10, 24, 0.01
THRESHOLD = 0.3
#: Halves whose filter outputs are in memory at once.
BLOCK = 256


class Layout:
    """The bytes of some texts, each padded to whole half chunks, and what belongs to whom."""

    def __init__(self, texts: list[str | None]):
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        sizes = np.array([len(d) for d in data], np.int64)
        halves = np.maximum(1, -(-(sizes + WIDTH - 1) // HALF_BYTES))
        first = np.concatenate([[0], np.cumsum(halves)])
        self.codes = np.zeros(first[-1] * HALF_BYTES + WIDTH, np.uint8)
        for d, f in zip(data, first[:-1] * HALF_BYTES, strict=True):
            self.codes[f : f + len(d)] = np.frombuffer(d, np.uint8)
        of = np.repeat(np.arange(len(data)), halves)
        left = sizes[of] - (np.arange(first[-1]) - first[of]) * HALF_BYTES
        #: Filter positions of each half that begin inside the text.
        self.count = np.clip(-(-left // STRIDE), 0, HALF)
        chunks = np.maximum(1, halves - 1)
        self.start = np.concatenate([[0], np.cumsum(chunks)])[:-1]
        self.chunks = chunks
        owner = np.repeat(np.arange(len(data)), chunks)
        self.owner = owner
        self.low = first[owner] + np.arange(len(owner)) - self.start[owner]
        self.high = np.minimum(self.low + 1, first[owner + 1] - 1)
        self.alone = self.low == self.high
        self.n = first[-1]

    def weight(self) -> np.ndarray:
        return np.maximum(1, self.count[self.low] + np.where(self.alone, 0, self.count[self.high]))


def _reduce(outputs: np.ndarray, join: np.ufunc) -> np.ndarray:
    """Reduces the positions of each half by joining the first with the last ones."""
    n = HALF
    while n > 1:
        half = n // 2
        joined = join(outputs[:, :half], outputs[:, n - half : n])
        outputs = np.concatenate([joined, outputs[:, half : half + 1]], axis=1) if n % 2 else joined
        n -= half
    return outputs[:, 0]


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f32 = np.float32
        self.p = {
            "table": (r.normal(size=(WIDTH, 256, FILTERS)) * 0.4).astype(f32),
            "bias": np.zeros(FILTERS, f32),
            "w": (r.normal(size=(2 * FILTERS, HIDDEN)) * 0.4).astype(f32),
            "c": np.zeros(HIDDEN, f32),
            "u": (r.normal(size=2 * HIDDEN) * 0.1).astype(f32),
            "d": np.zeros(1, f32),
        }
        self.mean = np.zeros(2 * FILTERS, f32)
        self.scale = np.ones(2 * FILTERS, f32)
        self.shift = 0.0

    def _filters(self, x: Layout, low: int, high: int) -> np.ndarray:
        """Rectified filter outputs at the positions of some halves; 0 outside the text."""
        n = (high - low) * HALF
        at = low * HALF_BYTES
        out = np.broadcast_to(self.p["bias"], (n, FILTERS)).copy()
        for j in range(WIDTH):
            out += self.p["table"][j].take(x.codes[at + j : at + j + n * STRIDE : STRIDE], axis=0)
        np.maximum(out, 0, out=out)
        out = out.reshape(high - low, HALF, FILTERS)
        short = np.flatnonzero(x.count[low:high] < HALF)
        for i in short:
            out[i, x.count[low + i] :] = 0
        return out

    def chunk_features(self, x: Layout) -> np.ndarray:
        sums = np.empty((x.n, FILTERS), np.float32)
        most = np.empty((x.n, FILTERS), np.float32)
        for low in range(0, x.n, BLOCK):
            high = min(low + BLOCK, x.n)
            outputs = self._filters(x, low, high)
            sums[low:high] = _reduce(outputs, np.add)
            most[low:high] = _reduce(outputs, np.maximum)
        return self._features(x, sums, most)

    def _features(self, x: Layout, sums: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Of each chunk, from its two halves: mean and largest output of each filter."""
        both = sums[x.low] + np.where(x.alone[:, None], 0, sums[x.high])
        return np.concatenate([both / x.weight()[:, None], np.maximum(most[x.low], most[x.high])], axis=1).astype(np.float32)

    def _top(self, x: Layout, means: np.ndarray):
        hidden = np.maximum(((means - self.mean) / self.scale) @ self.p["w"] + self.p["c"], 0)
        most = np.maximum.reduceat(hidden, x.start)
        average = np.add.reduceat(hidden, x.start) / x.chunks[:, None]
        pooled = np.concatenate([most, average], axis=1)
        return hidden, pooled, pooled @ self.p["u"] + self.p["d"][0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = Layout(texts)
        logit = self._top(x, self.chunk_features(x))[2].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))

    def _gradient(self, x: Layout, labels: np.ndarray) -> dict[str, np.ndarray]:
        outputs = self._filters(x, 0, x.n)
        peaks = outputs.max(1)
        features = self._features(x, outputs.sum(1), peaks)
        hidden, pooled, logit = self._top(x, features)
        d_logit = ((1 / (1 + np.exp(-np.clip(logit, -50, 50)))) - labels).astype(np.float32) / len(labels)
        d_pooled = d_logit[:, None] * self.p["u"]
        most, average = d_pooled[:, :HIDDEN], d_pooled[:, HIDDEN:]
        owner = x.owner
        top = hidden == pooled[owner, :HIDDEN]
        ties = np.add.reduceat(top, x.start).astype(np.float32)
        d_hidden = np.where(top, (most / ties)[owner], 0) + (average / x.chunks[:, None])[owner]
        d_hidden = np.where(hidden > 0, d_hidden, 0).astype(np.float32)
        normal = (features - self.mean) / self.scale
        d_features = (d_hidden @ self.p["w"].T) / self.scale
        d_means = d_features[:, :FILTERS] / x.weight()[:, None]
        d_peaks = np.zeros((x.n, FILTERS), np.float32)
        lower = peaks[x.low] >= peaks[x.high]
        np.add.at(d_peaks, x.low, np.where(lower, d_features[:, FILTERS:], 0))
        np.add.at(d_peaks, x.high, np.where(lower, 0, d_features[:, FILTERS:]))
        d_sums = np.zeros((x.n, FILTERS), np.float32)
        np.add.at(d_sums, x.low, d_means)
        np.add.at(d_sums, x.high[~x.alone], d_means[~x.alone])
        d_out = np.repeat(d_sums[:, None, :], HALF, axis=1)
        at = outputs.argmax(1)[:, None, :]
        np.put_along_axis(d_out, at, np.take_along_axis(d_out, at, 1) + d_peaks[:, None, :], 1)
        d_out = np.where(outputs > 0, d_out, 0).reshape(-1, FILTERS)
        n = len(d_out)
        table = np.empty_like(self.p["table"])
        columns = np.ascontiguousarray(d_out.T)
        for j in range(WIDTH):
            codes = x.codes[j : j + n * STRIDE : STRIDE].astype(np.intp)
            for f in range(FILTERS):
                table[j, :, f] = np.bincount(codes, columns[f], 256)
        return {
            "table": table,
            "bias": columns.sum(1),
            "w": normal.T @ d_hidden,
            "c": d_hidden.sum(0),
            "u": pooled.T @ d_logit,
            "d": d_logit.sum(keepdims=True),
        }

    def fit(self, texts: list[str], labels: np.ndarray, seed: int = 3) -> None:
        """Adam on cross-entropy; chunk features are standardised once by the sample's own."""
        if not texts:
            return
        x = Layout(texts)
        features = self.chunk_features(x)
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-3
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        total = EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = random.permutation(len(texts))
            for low in range(0, len(order), BATCH):
                batch = order[low : low + BATCH]
                gradient = self._gradient(Layout([texts[i] for i in batch]), labels[batch].astype(np.float32))
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for k, g in gradient.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    hat = first[k] / (1 - 0.9**step)
                    self.p[k] -= (rate * hat / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def sample(docs: DataFrame, labels: DataFrame, learn) -> tuple[list[str], np.ndarray, float]:
    """Bounded training rows, and the log odds that they must be shifted by.

    Of the labelled rows that ``learn`` admits, the ``SAMPLE`` of each class with the smallest
    hashes of their ids; null and repeated labels and labels other than 0 and 1 are left out.
    """
    labelled = (
        labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn(F.col("doc_id")))
        .dropDuplicates()
    )
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = None
    for label in (0, 1):
        part = labelled.filter(F.col("label") == label).orderBy(*order).limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most 2 * SAMPLE narrow rows.
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["text"]))
    got = np.array([r["label"] for r in rows], int)
    have = [max(1, int((got == k).sum())) for k in (0, 1)]
    true = [max(1, counts.get(k, 0)) for k in (0, 1)]
    shift = float(np.log(true[1] / true[0]) - np.log(have[1] / have[0]))
    return [r["text"] for r in rows], got, shift


def train(docs: DataFrame, labels: DataFrame, learn) -> Network:
    """Fits the network; without any labelled row it keeps its first weights."""
    texts, got, shift = sample(docs, labels, learn)
    network = Network()
    network.fit(texts, got)
    network.shift = shift
    return network


def score(docs: DataFrame, network: Network, columns=("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``columns``, ``score`` and ``predicted`` of every whole text; null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # fixed size

    def start():
        return lambda texts: [shared.value.scores(texts)]

    scored = map_texts(docs, list(columns), "score double", start)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
