"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions in numpy.

The patterns give the base spans. The network learns to tag characters from
labelled spans (of a bounded sample), reads overlapping windows of every text
and its windows' paths are reconciled over the whole text. A span that it adds
holds a digit or ``@`` and overlaps no base span; a window with neither of
these characters can add nothing and need not be read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, strings, text_of

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 64, 32  # characters of a window, and between the starts of two
EMBED, HIDDEN = 8, 12
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
OTHER, PAD = 128, 129  # characters beyond ASCII; beyond the text's end
# The network is fitted on at most so many texts, the first by a hash, and windows of them.
FIT_ROWS, FIT_WINDOWS = 3_000, 3_000
STEPS, BATCH, RATE = 400, 64, 0.03
MIN_CONFIDENCE, MIN_LENGTH = 0.95, 7
# Windows tagged at once.
TAG_WINDOWS = 2_048

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits are taken whole (possessively): a shorter run would fail as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Matches keyed by their ``@``, which stands between a local part and a domain that hold none."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start; leftmost and non-overlapping within a kind."""
    if not _TRIGGER.search(text):
        return []
    out = _emails(text)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def encode(text: str) -> np.ndarray:
    """Character classes: ASCII by itself, the rest as one class."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), OTHER).astype(np.int64)


_IS_TRIGGER = np.zeros(PAD + 1, bool)
_IS_TRIGGER[[ord("@"), *range(ord("0"), ord("9") + 1)]] = True


def window_starts(chars: np.ndarray) -> np.ndarray:
    """Starts of the windows with a digit or ``@``, on a fixed grid."""
    at = np.flatnonzero(_IS_TRIGGER[chars]) // STEP * STEP
    return np.unique(np.concatenate([at, np.maximum(at - STEP, 0)]))


def windows(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([chars, np.full(WINDOW, PAD)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def tag_sequence(n: int, spans: list[Span]) -> np.ndarray:
    """Tags of ``n`` characters; an earlier span wins where kinds overlap."""
    tags = np.zeros(n, np.int64)
    for kind, start, end in spans:
        if not tags[start:end].any():
            tags[start] = 1 + 2 * kind
            tags[start + 1:end] = 2 + 2 * kind
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Bidirectional LSTM over characters, a CRF over tags."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        h = HIDDEN

        def init(*shape):
            return rng.normal(0, (1 / shape[0]) ** 0.5, shape).astype(np.float32)

        self.p = {"embed": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32), "out": init(2 * h, TAGS),
                  "out_b": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32),
                  "start": np.zeros(TAGS, np.float32)}
        for d in "fb":
            self.p |= {f"wx{d}": init(EMBED, 4 * h), f"wh{d}": init(h, 4 * h), f"b{d}": np.zeros(4 * h, np.float32)}
            self.p[f"b{d}"][h:2 * h] = 1  # the forget gates start open
        self.p["trans"][0, 2::2] = -3  # nothing begins inside
        self.p["start"][2::2] = -3

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states of one direction for windows of classes; ``x`` is (windows, time)."""
        h_size = HIDDEN
        gates = (self.p["embed"] @ self.p[f"wx{d}"] + self.p[f"b{d}"])[x]
        wh = self.p[f"wh{d}"]
        n, t_size = x.shape
        h = np.zeros((n, h_size), np.float32)
        c = np.zeros((n, h_size), np.float32)
        hs = np.zeros((n, t_size, h_size), np.float32)
        kept = {}
        for t in (range(t_size) if d == "f" else range(t_size - 1, -1, -1)):
            g = gates[:, t] + h @ wh
            s = _sigmoid(g[:, :3 * h_size])
            i, f, o = s[:, :h_size], s[:, h_size:2 * h_size], s[:, 2 * h_size:]
            z = np.tanh(g[:, 3 * h_size:])
            before, last = c, h
            c = f * c + i * z
            tc = np.tanh(c)
            h = o * tc
            hs[:, t] = h
            if keep:
                kept[t] = (i, f, o, z, before, tc, last)
        return hs, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        hidden = np.concatenate([self._run(x, d, False)[0] for d in "fb"], -1)
        return hidden @ self.p["out"] + self.p["out_b"]

    def _sums(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward sums over tag paths, and the sum over all of them (logarithms)."""
        trans = self.p["trans"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.p["start"]
        for t in range(1, e.shape[1]):
            alpha[:, t] = e[:, t] + _logsum(alpha[:, t - 1][:, :, None] + trans, 1)
        for t in range(e.shape[1] - 2, -1, -1):
            beta[:, t] = _logsum(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        return alpha, beta, _logsum(alpha[:, -1], 1)

    def _crf(self, e: np.ndarray, tags: np.ndarray):
        """Gradients of the negative log-likelihood for emissions, transitions and start."""
        n, t_size, _ = e.shape
        trans = self.p["trans"]
        alpha, beta, log_z = self._sums(e)
        de = np.exp(alpha + beta - log_z[:, None, None])
        pair = np.exp(alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
                      - log_z[:, None, None, None]).sum((0, 1))
        dstart = de[:, 0].sum(0)
        np.subtract.at(dstart, tags[:, 0], 1)
        np.subtract.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        de[np.arange(n)[:, None], np.arange(t_size), tags] -= 1
        return de / n, pair / n, dstart / n

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        size = HIDDEN
        runs = {d: self._run(x, d, True) for d in "fb"}
        hidden = np.concatenate([runs[d][0] for d in "fb"], -1)
        de, dtrans, dstart = self._crf(hidden @ self.p["out"] + self.p["out_b"], tags)
        n, t_size = x.shape
        g = {"trans": dtrans, "start": dstart, "out": hidden.reshape(n * t_size, -1).T @ de.reshape(n * t_size, -1),
             "out_b": de.sum((0, 1)), "embed": np.zeros_like(self.p["embed"])}
        dhidden = de @ self.p["out"].T
        for j, d in enumerate("fb"):
            kept, wh = runs[d][1], self.p[f"wh{d}"]
            dgates = np.zeros((n, t_size, 4 * size), np.float32)
            dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
            dwh = np.zeros_like(wh)
            for t in (range(t_size - 1, -1, -1) if d == "f" else range(t_size)):
                i, f, o, z, before, tc, last = kept[t]
                dh = dh + dhidden[:, t, j * size:(j + 1) * size]
                dc = dc + dh * o * (1 - tc ** 2)
                dg = np.concatenate([dc * z * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - z ** 2)], 1)
                dgates[:, t] = dg
                dwh += last.T @ dg
                dh, dc = dg @ wh.T, dc * f
            flat = dgates.reshape(n * t_size, -1)
            emb = self.p["embed"][x].reshape(n * t_size, -1)
            g[f"wx{d}"], g[f"wh{d}"], g[f"b{d}"] = emb.T @ flat, dwh, flat.sum(0)
            np.add.at(g["embed"], x.ravel(), flat @ self.p[f"wx{d}"].T)
        return g

    def fit(self, x: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 1) -> Tagger:
        """Adam on the CRF's likelihood of tagged windows."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        order = np.concatenate([rng.permutation(len(x)) for _ in range(steps * BATCH // len(x) + 1)])
        for step in range(1, steps + 1):
            rows = order[(step - 1) * BATCH:step * BATCH]
            g = self.gradients(x[rows], tags[rows])
            norm = np.sqrt(sum(float((a ** 2).sum()) for a in g.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            rate = RATE * (1 - (step - 1) / steps) + 1e-4
            for k in self.p:
                grad = g[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** step))
                             / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window (Viterbi), and their marginal probabilities."""
        e = self.emissions(x)
        n, t_size, _ = e.shape
        back = np.zeros(e.shape, np.int8)
        best = e[:, 0] + self.p["start"]
        for t in range(1, t_size):
            paths = best[:, :, None] + self.p["trans"]
            back[:, t] = paths.argmax(1)
            best = paths.max(1) + e[:, t]
        tags = np.zeros((n, t_size), np.int64)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(t_size - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        share = np.ones((n, t_size))
        tagged = np.flatnonzero(tags.any(1))
        alpha, beta, log_z = self._sums(e[tagged])
        chance = np.exp(alpha + beta - log_z[:, None, None])
        share[tagged] = np.take_along_axis(chance, tags[tagged][:, :, None], 2)[:, :, 0]
        return tags, share


def window_spans(tags: np.ndarray, share: np.ndarray, start: int, n: int) -> list[tuple[int, int, int, float, bool]]:
    """Spans of one window's tags: kind, start, end, confidence, and whether the window's edge cuts it."""
    out, t, size = [], 0, len(tags)
    while t < size:
        if tags[t] == 0:
            t += 1
            continue
        kind, first = (int(tags[t]) - 1) // 2, t
        t += 1
        while t < size and tags[t] == 2 + 2 * kind:
            t += 1
        cut = (first == 0 and start > 0) or (t == size and start + size < n)
        out.append((kind, start + first, min(start + t, n), float(share[first:t].mean()), cut))
    return out


def reconcile(found: list[tuple[int, int, int, float, bool]]) -> list[tuple[int, int, int, float]]:
    """One set of spans without overlaps for a text, from the spans of its overlapping windows.

    Spans of one kind that overlap where a window's edge cuts one are joined;
    among the spans then left, those without overlaps whose lengths, weighted
    by confidence, add up to most are taken.
    """
    joined: list[list] = []
    for kind, start, end, sure, cut in sorted(found, key=lambda s: (s[0], s[1], s[2])):
        last = joined[-1] if joined else None
        if last and last[0] == kind and start < last[2] and (cut or last[4]):
            last[3] = max(last[3], sure) if start == last[1] and end == last[2] else (last[3] + sure) / 2
            last[2], last[4] = max(last[2], end), cut and last[4]
        else:
            joined.append([kind, start, end, sure, cut])
    spans = sorted({(k, s, e, c) for k, s, e, c, _ in joined}, key=lambda s: (s[2], s[1], s[0], s[3]))
    ends = [s[2] for s in spans]
    best: list[tuple[float, int, bool]] = [(0.0, -1, False)]
    for i, (_, start, end, sure) in enumerate(spans):
        before = int(np.searchsorted(ends[:i], start, side="right"))
        take = best[before][0] + sure * (end - start)
        best.append((take, before, True) if take > best[-1][0] else (best[-1][0], i, False))
    out, i = [], len(spans)
    while i > 0:
        _, before, taken = best[i]
        if taken:
            out.append(spans[i - 1])
        i = before
    return out[::-1]


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """What the network adds to the base spans of each text."""
    chars = {i: encode(t) for i, t in enumerate(texts) if _TRIGGER.search(t)}
    starts = {i: window_starts(c) for i, c in chars.items()}
    places = [(i, int(s)) for i, ss in starts.items() for s in ss]
    found: list[list] = [[] for _ in texts]
    for lo in range(0, len(places), TAG_WINDOWS):
        block = places[lo:lo + TAG_WINDOWS]
        x = np.full((len(block), WINDOW), PAD)
        for j, (i, s) in enumerate(block):
            part = chars[i][s:s + WINDOW]
            x[j, :len(part)] = part
        tags, share = tagger.decode(x)
        for j in np.flatnonzero(tags.any(1)):
            i, s = block[j]
            found[i] += window_spans(tags[j], share[j], s, len(chars[i]))
    out = []
    for text, known, spans in zip(texts, base, found):
        more = []
        for kind, start, end, sure in reconcile(spans):
            free = all(end <= s or e <= start for _, s, e in known)
            if sure >= MIN_CONFIDENCE and end - start >= MIN_LENGTH and free and _TRIGGER.search(text, start, end):
                more.append((kind, start, end))
        out.append(more)
    return out


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, label: Callable[[str], list[Span]] = base_spans) -> Tagger:
    """Fit on windows of a bounded sample of texts with a digit or ``@``, labelled by ``label``.

    Without such a text the network stays unfitted and tags nothing.
    """
    texts = docs.select(text_of().alias("text")).where(F.col("text").rlike("[0-9@]")) \
        .select("text", F.xxhash64("text").alias("h"))
    # The sample is chosen by its hashes alone, of a proven number, before any text moves.
    chosen = texts.select("h").distinct().orderBy("h").limit(fit_rows)
    rows = texts.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).orderBy("h").toLocalIterator()
    xs, ys = [], []
    for row in rows:
        chars = encode(row["text"])
        tags = tag_sequence(len(chars), label(row["text"]))
        starts = window_starts(chars)
        xs.append(windows(chars, starts))
        ys.append(np.concatenate([tags, np.zeros(WINDOW, np.int64)])[starts[:, None] + np.arange(WINDOW)])
    tagger = Tagger()
    if not xs:
        tagger.p["out"][:] = 0
        tagger.p["out_b"][0] = 20
        return tagger
    x, y = np.concatenate(xs), np.concatenate(ys)
    pick = np.random.default_rng(0).permutation(len(x))[:FIT_WINDOWS]
    return tagger.fit(x[pick], y[pick])


def _both(texts: list[str], tagger: Tagger) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, added_spans(texts, base, tagger)


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _struct(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``doc_id, base, spans`` of every row: spans by kind, then start; code points, ends exclusive.

    A null text is empty and has no spans; repeated rows give their spans
    again; an empty table gives no rows; other columns are ignored.
    """
    source = docs.select("doc_id", text_of().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    key = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            base, more = _both(strings(batch.column("text")).to_pylist(), shared.value)
            both = [sorted(b + m) for b, m in zip(base, more)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_struct(s) for s in base], _SPANS),
                 pa.array([_struct(s) for s in both], _SPANS)], names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:int,start:bigint,end:bigint>>"
    return arrow_map(source, run, f"doc_id {key}, base {spans}, spans {spans}")


def mask(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``docs`` with every span's text replaced by its kind, as ``[email]``.

    Overlapping spans are replaced together, under the first one's kind.
    ``n_chars``, where there is such a column, becomes the new length. A row
    without spans, and a null text, stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = strings(batch.column("text")).to_pylist()
            base, more = _both(texts, shared.value)
            new, lengths = batch.column("text").to_pylist(), None
            changed = [i for i, (b, m) in enumerate(zip(base, more)) if b or m]
            if "n_chars" in names:
                lengths = batch.column("n_chars").to_pylist()
            for i in changed:
                parts, at = [], 0
                for kind, start, end in sorted(base[i] + more[i], key=lambda s: (s[1], s[2], s[0])):
                    if start >= at:
                        parts += [texts[i][at:start], f"[{KINDS[kind]}]"]
                    at = max(at, end)
                new[i] = "".join([*parts, texts[i][at:]])
                if lengths is not None:
                    lengths[i] = len(new[i])
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(new, batch.schema.field("text").type)
            if lengths is not None:
                columns[names.index("n_chars")] = pa.array(lengths, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return arrow_map(docs, run, docs.schema)


def _joined(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    # A second argument of a filter's function would be the element's index, so the kind is no default argument.
    counts = [F.size(F.filter("base", _of_kind(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))
