"""Spelling variants by k-d trees over letter-count vectors.

A word is a point: how often each letter stands in it. One inserted or deleted
letter moves the point by one in L1 distance, one replaced letter by two, so
the near words of a word lie in a small ball among the points of its own
length (radius two) and of the next length (radius one). For each such pair of
lengths the points of one are a k-d tree, and the other's words search it: a
branch whose box is further away than the radius is pruned. Points in the ball
have the right letters; the letters' order is then compared exactly.

A length with many words is dealt over tasks by the upper part of its tree,
fitted on a bounded sample of its words. Every word has one home cell, and
searches all cells that its ball touches, so the result does not depend on the
sample. A cell that is still too large, as with ties that no plane can part,
is dealt into blocks by a hash, each with a tree of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, strings
from threadcorpus.operators.joins import checked_join
from threadcorpus.session import materialize

MIN_LETTERS, MIN_COUNT = 5, 3
# A run whose hash this number divides loses one letter.
TYPO_EVERY = 97
# Distinct words counted in a task before they are handed on.
COUNT_WORDS = 200_000
# Letters of the words of one cell, words of a length in the sample that its upper tree is fitted on (in
# expectation), points of a leaf, and searching words handled at once.
CELL_LETTERS = 1 << 18
SAMPLE_WORDS = 16_384
LEAF_POINTS = 8
SEARCH_WORDS = 4_096
COMPARE_BYTES = 8 << 20

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % MIN_LETTERS)
# Letters are Latin-1 characters: a to z, then U+00C0 to U+00FF.
N_LETTERS = 26 + 64
_LETTER = np.zeros(256, np.int64)
_LETTER[0x61:0x7B] = np.arange(26)
_LETTER[0xC0:] = 26 + np.arange(64)
_SIGN_LEVELS = 8
_SIGN = np.uint64(1) << np.random.default_rng(5).integers(0, 64, (_SIGN_LEVELS, N_LETTERS), dtype=np.uint64)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: lower-cased runs of letters of all texts, some with a letter less, of at least five letters."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def handed_on(found: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in found], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        found: dict[bytes, int] = {}
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")).to_pylist()):
                # Other characters become a question mark, which is no letter.
                runs = Counter(_RUN.findall(text.encode("latin-1", "replace").translate(_LOWER)))
                start = zlib.crc32(f"{key}:".encode())
                for word, n in runs.items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % TYPO_EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < MIN_LETTERS:
                            continue
                    found[word] = found.get(word, 0) + n
                if len(found) >= COUNT_WORDS:
                    yield handed_on(found)
                    found = {}
        if found:
            yield handed_on(found)

    return arrow_map(source, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words of one length: their letters, letter counts, and a 64-bit sign of the counts."""

    def __init__(self, words: list[bytes]):
        n, length = len(words), len(words[0]) if words else 0
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(n, length)
        flat = _LETTER[self.letters] + np.arange(n)[:, None] * N_LETTERS
        self.points = np.bincount(flat.ravel(), minlength=n * N_LETTERS).reshape(n, N_LETTERS).astype(np.int32)
        # Each count flips as many bits as it is high: signs differ in no more bits than points differ in steps.
        self.signs = np.zeros(n, np.uint64)
        for level in range(min(_SIGN_LEVELS, int(self.points.max(initial=0)))):
            self.signs ^= np.bitwise_xor.reduce(np.where(self.points > level, _SIGN[level], np.uint64(0)), axis=1)


EVERYWHERE = (-1, 1 << 30)


class Tree:
    """A k-d tree of integer points. Children of a node part one coordinate, each with its own box in it.

    Boxes end at the outermost points; with ``whole`` they fill the space, for
    a tree that is fitted on some of the points.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF_POINTS, whole: bool = False):
        self.order = np.arange(len(points))
        self.axis, self.child, self.known, self.box, self.span = [], [], [], [], []
        # Bounds of the box as far as the path has fixed them, by axis.
        stack = [(self._node(0, len(points)), {})]
        while stack:
            node, bounds = stack.pop()
            lo, hi = self.span[node]
            if hi - lo <= leaf:
                continue
            some = points[self.order[lo:hi]]
            axis = int(np.argmax(some.var(axis=0)))
            x = some[:, axis]
            values, n = np.unique(x, return_counts=True)
            if len(values) == 1:
                continue  # all points are equal
            cut = int(np.argmin(np.abs(np.cumsum(n)[:-1] - (hi - lo) / 2)))
            left = x <= values[cut]
            part = self.order[lo:hi]
            middle = lo + int(left.sum())
            self.order[lo:hi] = np.concatenate([part[left], part[~left]])
            known = bounds.get(axis, EVERYWHERE)
            boxes = ((values[0], values[cut]), (values[cut + 1], values[-1]))
            if whole:
                boxes = ((known[0], values[cut]), (values[cut] + 1, known[1]))
            self.axis[node], self.known[node] = axis, known
            self.box[node] = boxes
            self.child[node] = self._node(lo, middle), self._node(middle, hi)
            stack += [(c, {**bounds, axis: b}) for c, b in zip(self.child[node], boxes)]
        self.axis, self.child, self.span = np.array(self.axis), np.array(self.child), np.array(self.span)
        self.known, self.box = np.array(self.known), np.array(self.box)

    def _node(self, lo: int, hi: int) -> int:
        self.axis.append(-1)
        self.child.append((-1, -1))
        self.known.append((0, 0))
        self.box.append(((0, 0), (0, 0)))
        self.span.append((lo, hi))
        return len(self.axis) - 1

    def leaves(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of all leaves whose boxes are within ``radius`` of the point."""
        who, node, away = np.arange(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        found = []
        while len(who):
            end = self.axis[node] < 0
            found.append((who[end], node[end]))
            who, node, away = who[~end], node[~end], away[~end]
            x = points[who, self.axis[node]]
            away = away - _outside(x, self.known[node])
            parts = []
            for side in (0, 1):
                total = away + _outside(x, self.box[node, side])
                near = total <= radius
                parts.append((who[near], self.child[node[near], side], total[near]))
            who, node, away = (np.concatenate(p) for p in zip(*parts))
        return tuple(np.concatenate(p) for p in zip(*found))

    def home(self, points: np.ndarray) -> np.ndarray:
        """The one leaf of each point: that of the side of every plane on which it lies."""
        node = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(self.axis[node] >= 0)).size:
            at = node[inner]
            right = points[inner, self.axis[at]] > self.box[at, 0, 1]
            node[inner] = self.child[at, right.astype(int)]
        return node

    def near(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(searching point, tree point) of all tree points in leaves within the radius."""
        who, leaf = self.leaves(points, radius)
        lo, hi = self.span[leaf].T
        n = hi - lo
        place = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
        return np.repeat(who, n), self.order[place]


def _outside(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.maximum(np.maximum(bounds[:, 0] - x, x - bounds[:, 1]), 0)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter, or (b longer by one) one inserted letter."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    unequal = a != b[:, :length]
    ahead = np.where(unequal.any(axis=1), unequal.argmax(axis=1), length)
    unequal = (a != b[:, 1:])[:, ::-1]
    behind = np.where(unequal.any(axis=1), unequal.argmax(axis=1), length)
    return ahead + behind >= length


def near_pairs(tree: Tree, targets: Words, searching: Words) -> tuple[np.ndarray, np.ndarray]:
    """(searching, target) of all words one edit apart; targets are of the same length or longer by one."""
    radius = 2 if targets.letters.shape[1] == searching.letters.shape[1] else 1
    who, what = tree.near(searching.points, radius)
    close = np.bitwise_count(searching.signs[who] ^ targets.signs[what]) <= radius
    who, what = who[close], what[close]
    step = max(1, COMPARE_BYTES // max(1, targets.letters.shape[1]))
    same = [one_edit(searching.letters[who[i:i + step]], targets.letters[what[i:i + step]]) for i in range(0, len(who), step)]
    same = np.concatenate(same) if same else np.zeros(0, bool)
    return who[same], what[same]


# What a row is in a cell: a word that lives there, one of the same length that searches it, one shorter by a letter.
HOME, SAME, SHORTER = 0, 1, 2


class _Cell:
    """One block of a cell: its tree, the words that search it, and what both sides found."""

    def __init__(self):
        self.words, self.counts, self.tree, self.waiting = [], [], None, []

    def take(self, role: int, word: bytes, n: int) -> Iterator[pa.RecordBatch]:
        if role == HOME:
            self.words.append(word)
            self.counts.append(n)
            return
        if self.waiting and (role != self.waiting[0][0] or len(self.waiting) >= SEARCH_WORDS
                             or len(self.waiting) * len(word) >= COMPARE_BYTES):
            yield self.search()
        self.waiting.append((role, word, n))

    def search(self) -> pa.RecordBatch:
        if self.tree is None:
            self.targets = Words(self.words)
            self.tree = Tree(self.targets.points)
            self.found = [[0, 0, b""] for _ in self.words]
        role = self.waiting[0][0]
        words, counts = [w for _, w, _ in self.waiting], [n for _, _, n in self.waiting]
        self.waiting = []
        who, what = near_pairs(self.tree, self.targets, Words(words)) if self.words else (np.zeros(0, int),) * 2
        out = [[0, 0, b""] for _ in words]
        for i, j in zip(who.tolist(), what.tolist()):
            _add(out[i], self.counts[j], self.words[j])
            if role == SHORTER:
                _add(self.found[j], counts[i], words[i])
        return _found(words, out)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            yield self.search()
        if self.tree is not None:
            yield _found(self.words, self.found)


def _add(found: list, n: int, word: bytes) -> None:
    found[0] += 1
    if n > found[1] or (n == found[1] and word < found[2]):
        found[1], found[2] = n, word


def _found(words: list[bytes], found: list[list]) -> pa.RecordBatch:
    some = [(w.decode("latin-1"), n, best_n, best.decode("latin-1")) for w, (n, best_n, best) in zip(words, found) if n]
    columns = list(zip(*some)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                       pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                                      names=["word", "n_near", "best_n", "best"])


def _upper_trees(words: DataFrame, cell_letters: int, sample_words: int) -> dict[int, Tree]:
    """The upper tree of every length with more letters than a cell holds, fitted on a sample of its words."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    large = {r.length: r.n for r in sizes.where(F.col("n") * F.col("length") > cell_letters).collect()}
    if not large:
        return {}
    every = F.create_map(*[F.lit(x) for length, n in large.items() for x in (length, max(1, n // sample_words))])
    drawn = words.where(F.length("word").isin(list(large))) \
        .where(F.pmod(F.xxhash64("word"), F.element_at(every, F.length("word"))) == 0).select("word").collect()
    by_length: dict[int, list[bytes]] = {}
    for r in drawn:
        by_length.setdefault(len(r.word), []).append(r.word.encode("latin-1"))
    return {length: Tree(Words(some).points, max(1, len(some) * cell_letters // (large[length] * length)), whole=True)
            for length, some in by_length.items()}


def _dealt(words: DataFrame, trees: dict[int, Tree], cell_letters: int) -> DataFrame:
    """``cell, block, role, word, n``: every word in its home cell, and in all cells that it searches."""
    def run(batches):
        for batch in batches:
            by_length: dict[int, list] = {}
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                by_length.setdefault(len(word), []).append((word, n))
            cells, roles, texts, counts = [], [], [], []
            for length, rows in by_length.items():
                points = Words([w.encode("latin-1") for w, _ in rows]).points
                own, longer = trees.get(length), trees.get(length + 1)
                none = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                for role, of, (who, leaf) in (
                        (HOME, length, (none[0], own.home(points)) if own else none),
                        (SAME, length, own.leaves(points, 2) if own else none),
                        (SHORTER, length + 1, longer.leaves(points, 1) if longer else none)):
                    cells.append((of << 32) + leaf)
                    roles.append(np.full(len(who), role))
                    texts += [rows[i][0] for i in who.tolist()]
                    counts += [rows[i][1] for i in who.tolist()]
            if cells:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), pa.array(np.concatenate(roles).astype(np.int32)), pa.array(texts, pa.string()),
                     pa.array(counts, pa.int64())], names=["cell", "role", "word", "n"])

    dealt = materialize(arrow_map(words, run, "cell bigint, role int, word string, n bigint"))
    # A row only for each cell that holds words, blocks by its letters.
    blocks = dealt.where(F.col("role") == HOME).groupBy("cell").agg(
        F.ceil(F.sum(F.length("word")) / cell_letters).cast("int").alias("blocks"))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    return dealt.join(blocks, "cell").withColumn("block", F.explode(F.when(F.col("role") == HOME, own).otherwise(every))) \
        .select("cell", "block", "role", "word", "n")


def _searched(dealt: DataFrame, parts: int) -> DataFrame:
    """``word, n_near, best_n, best`` for each word and block in which it has near words."""
    def run(batches):
        current, cell = None, None
        for batch in batches:
            for key, block, role, word, n in zip(*(batch.column(c).to_pylist() for c in ("cell", "block", "role", "word", "n"))):
                if (key, block) != current:
                    if cell is not None:
                        yield from cell.end()
                    current, cell = (key, block), _Cell()
                yield from cell.take(role, word.encode("latin-1"), n)
        if cell is not None:
            yield from cell.end()

    placed = dealt.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "role")
    return arrow_map(placed, run, "word string, n_near bigint, best_n bigint, best string")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: where the forms end. Each round doubles the steps taken.

    A form's count is at least twice its word's, so chains are short and no cycle exists.
    """
    step = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(checked_join(step, onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return step


def variants(docs: DataFrame, cell_letters: int = CELL_LETTERS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of at least five letters and three occurrences.

    ``n_near`` counts the words one edit away; ``form`` is the most frequent of
    them (ties: the least in code-point order) if it is at least twice as
    frequent, ``form_n`` its count; ``root`` is where the forms end. A null
    text has no words; a null doc_id is written as an empty string in the
    hashed name of a run; a repeated row counts as often as it stands; an empty
    table gives no rows; other columns are ignored. Texts are read whole, and a
    run of any length is one word.
    """
    words = materialize(word_counts(docs).where(F.col("n") >= MIN_COUNT))
    dealt = materialize(_dealt(words, _upper_trees(words, cell_letters, sample_words), cell_letters))
    cells = dealt.where(F.col("role") == HOME).select("cell", "block").distinct().count()
    parts = min(max(cells, 1), 10_000)
    found = _searched(dealt, parts).groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("form"))).alias("best"))
    form_n = -F.col("best.minus_n")
    chosen = words.join(found, "word", "left").withColumn("has", F.coalesce(form_n >= 2 * F.col("n"), F.lit(False)))
    chosen = materialize(chosen.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("has"), F.col("best.form")).alias("form"), F.when(F.col("has"), form_n).alias("form_n")))
    roots = _roots(chosen.where("form is not null"))
    return chosen.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE
bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i::UBIGINT] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d,
         unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r
  FROM documents),
spelled AS (
  SELECT d, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM runs WHERE length(r) >= 5 GROUP BY ALL),
named AS (SELECT w, k, hex(encode(d || ':' || w)) AS x FROM spelled),
hashed AS (
  SELECT w, k, xor(4294967295::UBIGINT, list_reduce(
    [4294967295::UBIGINT] || list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::UBIGINT),
    lambda c, b: xor(t[(xor(c & 255, b) + 1)::BIGINT], c >> 8))) AS h
  FROM named, bits),
typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, k
  FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
places AS (SELECT word, n, unnest(range(length(word)))::BIGINT AS i FROM words),
holes AS (SELECT word, n, i, length(word) AS l, left(word, i) AS a, substr(word, i + 2) AS b FROM places),
shorter AS (SELECT DISTINCT word, n, a || b AS s FROM holes),
near AS (
  SELECT x.word, y.word AS other, y.n AS m FROM holes x JOIN holes y USING (l, i, a, b) WHERE x.word <> y.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.s
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.s),
ranked AS (
  SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place
  FROM near),
chosen AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near, CASE WHEN r.m >= 2 * w.n THEN r.other END AS form,
         CASE WHEN r.m >= 2 * w.n THEN r.m END::BIGINT AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
  SELECT word, word AS at FROM chosen
  UNION ALL SELECT c.word, f.form FROM chain c JOIN chosen f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN chosen f ON f.word = c.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM chosen JOIN ends USING (word)
"""
