"""Quality rules as weak supervision.

Each rule votes for (+1) or against (-1) a document or abstains (0). A label
model without any labels estimates, by expectation-maximisation over the
counts of all vote patterns in the table, how often each rule votes either way
on good and on bad documents; the posterior probability of "good" replaces
the demand that every rule passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import SpanHasher, arrow_map, chain, mix, text_chunks, text_of, word_spans
from threadcorpus.session import materialize

REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_POSTERIOR = 0.5
EM_ROUNDS = 200
# Pseudo-count of each vote, and the start values: how often a rule votes
# against, abstains and votes for by class, and the share of good documents.
SMOOTHING = 1.0
START_BAD, START_GOOD, START_PRIOR = (0.3, 0.6, 0.1), (0.02, 0.5, 0.48), 0.8

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
_POINT = (np.arange(256) & 0xC0 != 0x80).astype(np.int64)
_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = 1
_STOP = np.zeros(256, np.int64)
_STOP[np.frombuffer(b".!?", np.uint8)] = 1

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_letters", "n_stops", "n_lines", "n_distinct", "n_top_word"]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the values found twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] = same
    flags[order[:-1]] |= same
    return flags


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)), np.int64)
    hasher = SpanHasher(data)
    start, end = word_spans(data, offsets)
    doc = np.searchsorted(offsets, start, side="right") - 1
    salt = mix(doc.astype(np.uint64) + np.uint64(1))

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    points = np.concatenate([[0], np.cumsum(_POINT[data])])
    out[:, 0] = np.bincount(doc, minlength=n)
    out[:, 1] = np.bincount(doc, points[end] - points[start], minlength=n)
    out[:, 2] = total(_SYMBOL[data])
    out[:, 5] = total(_UPPER[data])
    out[:, 6] = total(_LETTER[data])
    out[:, 7] = total(_STOP[data])

    # Lines with a word, and those equal to an earlier line of the text.
    breaks = np.flatnonzero(data == 0x0A)
    first = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    first = first[first < len(data)]
    owner = np.searchsorted(offsets, first, side="right") - 1
    stop = np.minimum(np.append(first[1:], len(data)), offsets[owner + 1])
    ended = np.zeros(len(data) + 1, bool)
    ended[breaks] = True
    stop = np.where((stop > first) & ended[np.maximum(stop - 1, 0)], stop - 1, stop)
    filled = np.searchsorted(start, stop, side="left") > np.searchsorted(start, first, side="left")
    first, stop, owner = first[filled], stop[filled], owner[filled]
    out[:, 8] = np.bincount(owner, minlength=n)
    line = hasher.spans(first, stop) ^ mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(line, kind="stable")
    again = order[1:][line[order][1:] == line[order][:-1]]
    out[:, 3] = np.bincount(owner[again], minlength=n)

    # Words in windows found twice or more in their text; distinct words; the commonest word.
    words = hasher.spans(start, end) ^ salt
    k = REPEAT_WINDOW
    if len(words) >= k:
        inside = doc[k - 1:] == doc[:len(doc) - k + 1]
        at = np.flatnonzero(inside)
        at = at[_repeated(chain(words, k)[at])]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + k, -1)
        out[:, 4] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    if len(words):
        ordered = np.sort(words)
        new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(new, len(ordered)))
        at = np.searchsorted(ordered[new], words)
        is_first = np.zeros(len(words), bool)
        is_first[np.unique(at, return_index=True)[1]] = True
        out[:, 9] = np.bincount(doc[is_first], minlength=n)
        np.maximum.at(out[:, 10], doc, counts[at])
    return out


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts named in ``FEATURES`` for each row's whole text (null: empty)."""
    source = docs.select("doc_id", text_of().alias("text"))

    def run(batches):
        for batch in batches:
            rows = [_features(data, off) for _, _, data, off in text_chunks(batch.column("text"))]
            values = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(values[:, i]) for i in range(len(FEATURES)))],
                names=["doc_id", *FEATURES])

    key = source.schema["doc_id"].dataType.simpleString()
    return arrow_map(source, run, f"doc_id {key}, " + ", ".join(f"{c} bigint" for c in FEATURES))


@dataclass(frozen=True)
class Rule:
    """Votes against where ``bad`` holds, else for where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str = "false"


# Shares are written as products, so that no division by zero can arise.
# Most rules only object; "prose" speaks for plain running text of any length.
RULES = (
    Rule("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("upper_case", "10 * n_upper > 4 * n_letters"),
    Rule("duplicate_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule("repeated_windows", "7 * n_repeat_words > n_words"),
    Rule("common_word", "n_words >= 20 and 5 * n_top_word > n_words"),
    Rule("vocabulary", "n_words between 50 and 1000 and 4 * n_distinct < n_words"),
    Rule("sentences", "n_words >= 30 and 60 * n_stops < n_words"),
    Rule("prose", "2 * n_stops > n_words and n_words >= 20",
         "word_chars between 2 * n_words and 15 * n_words and 40 * n_symbols <= n_words and "
         "4 * n_upper <= n_letters and 60 * n_stops >= n_words and 7 * n_repeat_words <= n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    return [F.when(F.expr(r.bad), F.lit(-1)).when(F.expr(r.good), F.lit(1)).otherwise(F.lit(0)).alias(f"vote_{r.name}")
            for r in rules]


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """Chance of each vote (-1, 0, 1) of each rule by class (bad, good), and the prior of good."""
    chance = np.zeros((2, patterns.shape[1], 3))
    chance[0], chance[1] = START_BAD, START_GOOD
    prior = START_PRIOR
    hot = np.stack([patterns == v for v in (-1, 0, 1)], -1).astype(float)
    before = None
    for _ in range(rounds):
        good = posterior(patterns, chance, prior)
        if before is not None and np.abs(good - before).max(initial=0) < 1e-9:
            break
        before = good
        for y, share in ((0, 1 - good), (1, good)):
            got = np.einsum("p,prv->rv", share * counts, hot) + SMOOTHING
            chance[y] = got / got.sum(-1, keepdims=True)
        prior = float(np.clip(((good * counts).sum() + 1) / (counts.sum() + 2), 0.05, 0.95))
    return chance, prior


def weights(chance: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Log-odds of good that each vote of each rule adds, and the prior's."""
    return np.log(chance[1] / chance[0]), float(np.log(prior / (1 - prior)))


def posterior(patterns: np.ndarray, chance: np.ndarray, prior: float) -> np.ndarray:
    """Probability of good for each vote pattern."""
    by_vote, base = weights(chance, prior)
    odds = base + by_vote[np.arange(patterns.shape[1]), patterns + 1].sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the base counts, the votes, ``posterior``, ``base_failed`` and ``kept`` of every row.

    The label model is fitted on the counts of vote patterns of all rows (at
    most 3 to the power of the number of rules, however many rows there are);
    it sees no labels. A null or empty text has no words, so the base rule
    fails; a repeated row counts and is returned again; an empty table gives
    no rows; other columns are ignored.
    """
    voted = materialize(features(docs).select("*", *votes(rules)))
    names = [f"vote_{r.name}" for r in rules]
    rows = voted.groupBy(*names).count().collect()
    patterns = np.array([[r[c] for c in names] for r in rows], int).reshape(-1, len(names))
    counts = np.array([r["count"] for r in rows], float)
    by_vote, base = weights(*fit(patterns, counts))
    # The posterior's log-odds is a sum over the rules, so it needs no join.
    odds = F.lit(base)
    for i, c in enumerate(names):
        against, none, for_ = (float(x) for x in by_vote[i])
        odds = odds + F.when(F.col(c) < 0, against).when(F.col(c) > 0, for_).otherwise(none)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = voted.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_POSTERIOR))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "posterior")
