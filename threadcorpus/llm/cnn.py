"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters run over each chunk, the largest response of each filter in
a chunk is kept, a small layer describes the chunk, and the mean and the
maximum of the chunks give one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, text_chunks, text_of
from threadcorpus.session import materialize

CHUNK, STEP = 256, 192  # bytes of a chunk, and between the starts of two
WIDTH, STRIDE = 8, 2  # bytes a filter sees, and between two places
EMBED, FILTERS, HIDDEN = 6, 32, 16
# Labelled rows that the network is fitted on: at most so many of either label, the first by a hash.
FIT_ROWS = 1_500
STEPS, BATCH_TEXTS, RATE, DECAY = 550, 32, 0.004, 1e-5
FIT_CHUNKS = 64  # chunks of one text used in a fitting step, spread over all of it; scoring takes all
PREDICT_FROM = 0.3
# Chunks scored at once.
SCORE_CHUNKS = 512


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the chunks that cover ``n`` bytes; an empty text has one empty chunk."""
    return np.arange(0, max(n - (CHUNK - STEP), 1), STEP)


def text_to_chunks(data: np.ndarray) -> np.ndarray:
    """Chunks of one text, the last one padded with zeros."""
    starts = chunk_starts(len(data))
    padded = np.zeros(starts[-1] + CHUNK, np.uint8)
    padded[:len(data)] = data
    return padded[starts[:, None] + np.arange(CHUNK)]


class Network:
    """The weights, the forward pass, and gradients of the log loss."""

    SHAPES = {"embed": (256, EMBED), "w": (WIDTH * EMBED, FILTERS), "b": (FILTERS,), "u": (FILTERS, HIDDEN),
              "c": (HIDDEN,), "mean": (HIDDEN,), "top": (HIDDEN,), "bias": (1,)}

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.p = {k: (rng.normal(0, 1 if k == "embed" else (2 / s[0]) ** 0.5 if len(s) > 1 else 0.05, s)).astype(np.float32)
                  for k, s in self.SHAPES.items()}
        self.p["b"][:] = self.p["c"][:] = self.p["bias"][:] = 0

    def _windows(self, chunks: np.ndarray) -> np.ndarray:
        e = self.p["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
        view = np.lib.stride_tricks.sliding_window_view(e, WIDTH * EMBED, axis=1)[:, ::STRIDE * EMBED]
        return np.ascontiguousarray(view)

    def chunk_features(self, chunks: np.ndarray, keep: bool = False):
        """What each chunk contributes: the filters' largest responses through the hidden layer."""
        cols = self._windows(chunks)
        n, places, _ = cols.shape
        z = (cols.reshape(n * places, -1) @ self.p["w"]).reshape(n, places, FILTERS)
        at = z.argmax(1) if keep else None
        a = np.maximum(z.max(1) + self.p["b"], 0)
        h = np.maximum(a @ self.p["u"] + self.p["c"], 0)
        return (h, a, cols, at) if keep else h

    def combine(self, mean: np.ndarray, top: np.ndarray) -> np.ndarray:
        return mean @ self.p["mean"] + top @ self.p["top"] + self.p["bias"][0]

    def gradients(self, chunks: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients for texts whose chunks start at ``first``."""
        h, a, cols, at = self.chunk_features(chunks, keep=True)
        counts = np.diff(np.append(first, len(chunks)))
        owner = np.repeat(np.arange(len(first)), counts)
        mean = np.add.reduceat(h, first) / counts[:, None]
        top = np.maximum.reduceat(h, first)
        d = (1 / (1 + np.exp(-self.combine(mean, top))) - labels) / len(labels)
        g = {"mean": mean.T @ d, "top": top.T @ d, "bias": np.array([d.sum()])}
        is_top = h == top[owner]
        ties = np.add.reduceat(is_top.astype(np.float32), first)[owner]
        dh = d[owner, None] * (self.p["mean"] / counts[owner, None] + self.p["top"] * is_top / ties)
        dh = np.where(h > 0, dh, 0).astype(np.float32)
        g["u"], g["c"] = a.T @ dh, dh.sum(0)
        da = np.where(a > 0, dh @ self.p["u"].T, 0)
        g["b"] = da.sum(0)
        n = len(chunks)
        best = cols[np.arange(n)[:, None], at]  # (chunks, filters, window)
        g["w"] = np.einsum("nfw,nf->wf", best, da)
        dwin = (da[:, :, None] * self.p["w"].T[None]).reshape(n, FILTERS, WIDTH, EMBED)
        where = at[:, :, None] * STRIDE + np.arange(WIDTH)
        byte = chunks[np.arange(n)[:, None, None], where]
        g["embed"] = np.zeros((256, EMBED))
        for e in range(EMBED):
            g["embed"][:, e] = np.bincount(byte.ravel(), dwin[..., e].ravel(), minlength=256)
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 1) -> Network:
        """Adam on the log loss, for about ``steps`` steps; labels are 0 and 1."""
        epochs = max(1, round(steps * BATCH_TEXTS / len(texts)))
        rng = np.random.default_rng(seed)
        m = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        v = {k: np.zeros(s) for k, s in self.SHAPES.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), BATCH_TEXTS):
                rows = order[lo:lo + BATCH_TEXTS]
                parts = []
                for i in rows:
                    c = text_to_chunks(np.frombuffer(texts[i], np.uint8))
                    if len(c) > FIT_CHUNKS:
                        c = c[np.sort(rng.choice(len(c), FIT_CHUNKS, replace=False))]
                    parts.append(c)
                first = np.cumsum([0] + [len(c) for c in parts[:-1]])
                g = self.gradients(np.concatenate(parts), first, labels[rows])
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for k in self.p:
                    grad = g[k] + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                    update = rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                    self.p[k] = (self.p[k] - update).astype(np.float32)
        return self

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 for every whole text of a column."""
        out = []
        for _, _, data, offsets in text_chunks(column):
            # Chunks of all texts of the run, scored in blocks and reduced by text.
            starts = [chunk_starts(n) for n in np.diff(offsets)]
            counts = np.array([len(s) for s in starts])
            at = np.concatenate([s + o for s, o in zip(starts, offsets[:-1])])
            end = np.repeat(offsets[1:], counts)
            padded = np.concatenate([data, np.zeros(CHUNK, np.uint8)])
            h = np.empty((len(at), HIDDEN), np.float32)
            for lo in range(0, len(at), SCORE_CHUNKS):
                place = at[lo:lo + SCORE_CHUNKS, None] + np.arange(CHUNK)
                inside = place < end[lo:lo + SCORE_CHUNKS, None]
                block = np.where(inside, padded[np.where(inside, place, 0)], 0)
                h[lo:lo + SCORE_CHUNKS] = self.chunk_features(block)
            first = np.cumsum(counts) - counts
            mean = np.add.reduceat(h, first) / counts[:, None]
            top = np.maximum.reduceat(h, first)
            out.append(1 / (1 + np.exp(-self.combine(mean, top).astype(np.float64))))
        return np.concatenate(out) if out else np.zeros(0)


def held_out(column: str = "doc_id"):
    """Rows never used for fitting: the CRC-32 of the id as text divides by 5 (a null id does not)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Network:
    """Fit on a bounded sample of labelled rows that are not held out.

    Up to ``fit_rows`` ids of either label enter, the first by a hash of the
    id, with one text each; the bias is then shifted to the share of labels among all labelled
    rows. Rows with a null or another label are left out. With one label only,
    or none, the score is that label's (1 without any labels).
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select("doc_id", F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"])
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    net = Network()
    if len(totals) < 2:
        for k in net.p:
            net.p[k][:] = 0
        net.p["bias"][0] = -20 if totals == {0: totals.get(0)} else 20
        return net
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    # The sample has a proven bound (twice fit_rows ids), so it may be broadcast.
    chosen = materialize(chosen)
    # Of an id's texts the least by bytes enters, so the network does not depend on the order of rows.
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "quality").agg(F.min(F.encode("text", "UTF-8")).alias("data"))
    rows = sorted(rows.toLocalIterator(), key=lambda r: r["doc_id"])
    if not rows:
        net.p["mean"][:] = net.p["top"][:] = 0
        return net
    y = np.array([r["quality"] for r in rows], np.float32)
    net.fit([bytes(r["data"]) for r in rows], y)
    ones = float(np.clip(y.mean(), 0.01, 0.99))
    net.p["bias"][0] += np.log(totals[1] / totals[0]) - np.log(ones / (1 - ones))
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    A null text scores as the empty one; repeated rows score alike; an empty
    table gives no rows; other columns are ignored.
    """
    source = docs.select("doc_id", held_out().alias("held_out"), text_of().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    key = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            s = shared.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= PREDICT_FROM).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return arrow_map(source, run, f"doc_id {key}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` without the rows that :func:`score` predicts as 0; columns stay.

    A null text is judged as the empty one, repeated rows alike, so all copies
    stay or go; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(batch.column("text")) >= PREDICT_FROM))

    return arrow_map(docs, run, docs.schema)
