"""Suffix-array dedup: removing repeated 100-byte strings by merging shard Burrows-Wheeler transforms.

A string of 100 bytes is a window. Every window belongs to the least hash of
its 32-byte substrings, so equal windows meet wherever they stand; a run of
neighbouring windows with the same least hash is one piece of text. Pieces are
exchanged by that hash, in four steps:

1. Each document's pieces are named by their least hash and a 128-bit identity
   (least hash, and a hash of the first and the last window and the length,
   which cover the piece). A piece whose hash occurs once holds no
   repeat, unless the hash stands in it twice. Of
   equal pieces all but the earliest are repeats as a whole; this collapses
   groups of copies before any text moves. Each task first does so with its
   own pieces, so a passage of very many documents is sent once by each task.
2. The text of the earliest of each of several different pieces under one hash
   is fetched from the documents.
3. Pieces are indexed in shards: the suffixes of a shard are sorted once, which
   gives its Burrows-Wheeler transform. The shards' transforms are then merged
   by refining their interleave: the rows are dealt by eight symbols that the
   transforms give, then each round by the intervals of the rows as many
   symbols on, which orders all suffixes by twice the symbols; a boundary
   between two rows means that they do not share those. After 100 symbols the
   rows without a boundary between them are the repeated intervals. Only rows
   of open intervals are dealt again, and no suffixes are compared in the merge.
4. The windows found, except the earliest of each interval, are removed.

A hash with very many different pieces (text around a very common passage) is
dealt again by a hash of each whole window, so that no task holds it all.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, mix, prepare, strings, text_chunks, text_of
from threadcorpus.session import materialize

LENGTH = 100  # bytes of a repeated string
SEED = 32  # bytes of the substrings whose least hash names a window
PIECE_WINDOWS = 100  # windows of a piece at most
INNER = 1 << 15
# Bytes of text for each group of documents and of pieces.
GROUP_BYTES = 16 << 20
MIN_GROUPS = 64
# Bytes of text named at once: their hashes stay in a core's cache.
NAME_BYTES = 1 << 16
# Pieces named in a task before they are sent.
SEND_PIECES = 1 << 20
# Different pieces under one hash from which it is dealt again by whole windows.
MANY_PIECES = 2_000
# Bytes merged at once, in so many shards.
MERGE_BYTES, SHARDS = 1 << 15, 4

_BYTE = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(0xD1342543DE82EF95, n, 1 << 64))


def _slide(values: np.ndarray, want: int, better) -> np.ndarray:
    """``better`` (minimum or maximum) of each run of ``want`` values."""
    n, span = len(values) - want + 1, 1
    while span * 2 <= want:
        values = better(values[:-span], values[span:])
        span *= 2
    return better(values[:n], values[want - span:want - span + n])


def window_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least hash, and whole hash, of the window at each byte of ``data``; the hash of the substring there."""
    h = _BYTE[data]
    by_size, size = {1: h}, 1
    while size < 64:
        h, rest = h[:-size] * _power(size), h[size:]
        h += rest
        size *= 2
        by_size[size] = h
    n = len(data) - LENGTH + 1
    # 100 = 64 + 32 + 4
    whole = (by_size[64][:n] * _power(32) + by_size[32][64:64 + n]) * _power(4) + by_size[4][96:96 + n]
    seeds = mix(by_size[SEED])
    return _slide(seeds, LENGTH - SEED + 1, np.minimum), mix(whole), seeds


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Least hash, identity, text number, start in the text and number of windows of every piece.

    The number of windows carries the flag ``INNER`` where the least hash
    occurs in the piece more than once, so that windows may repeat inside it.
    """
    none = np.zeros(0, np.uint64)
    if len(data) < LENGTH:
        return none, none, np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint16)
    least, whole, seeds = window_hashes(data)
    n = len(least)
    new = np.ones(n + 1, bool)
    new[1:-1] = least[1:] != least[:-1]
    # A window that begins within 99 bytes of a text's end crosses into the next one.
    valid = np.zeros(n + 1, np.int8)
    last = offsets[1:] - LENGTH + 1
    fits = last > offsets[:-1]
    np.add.at(valid, offsets[:-1][fits], 1)
    np.add.at(valid, last[fits], -1)
    inside = np.cumsum(valid[:-1]) > 0
    new[offsets[:-1][offsets[:-1] <= n]] = True
    new[last[fits]] = True
    start = np.flatnonzero(new[:-1])
    count = np.diff(np.append(start, n))
    start, count = start[inside[start]], count[inside[start]]
    parts = -(-count // PIECE_WINDOWS)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        count = np.minimum(np.repeat(count, parts) - nth * PIECE_WINDOWS, PIECE_WINDOWS)
        start = np.repeat(start, parts) + nth * PIECE_WINDOWS
    text = np.searchsorted(offsets, start, side="right") - 1
    # The first and the last window cover a piece of at most 100 windows.
    identity = mix(whole[start] * np.uint64(0x9FB21C651E98DF25) + whole[start + count - 1] + count.astype(np.uint64))
    # Where a least hash stands: the substrings that are the least of some window around them.
    reach = LENGTH - SEED
    around = _slide(np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)]), reach + 1, np.maximum)
    at = np.flatnonzero(around == seeds)
    lo, hi = np.searchsorted(at, start), np.searchsorted(at, start + count + reach)
    size = hi - lo
    owner = np.repeat(np.arange(len(start)), size)
    near = at[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[owner]]
    times = np.bincount(owner[seeds[near] == least[start][owner]], minlength=len(start))
    flags = np.where(times > 1, INNER, 0) + count
    return least[start], identity, text, (start - offsets[text]).astype(np.int32), flags.astype(np.uint16)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of several runs."""
    sizes = sizes.astype(np.int64)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _whole_hashes(data: np.ndarray, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whole hashes of ``windows`` windows from each ``first`` on, some pieces' text side by side at a time."""
    size = windows + LENGTH - 1
    filled = np.concatenate([[0], np.cumsum(size)])
    out, lo = [np.zeros(0, np.uint64)], 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(filled, filled[lo] + NAME_BYTES, side="right")) - 1)
        text = data[np.repeat(first[lo:hi], size[lo:hi]) + _within(size[lo:hi])]
        at = np.repeat(filled[lo:hi] - filled[lo], windows[lo:hi]) + _within(windows[lo:hi])
        out.append(window_hashes(text)[1][at])
        lo = hi
    return np.concatenate(out)


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join([np.int64(len(columns[0])).tobytes(), *(np.ascontiguousarray(c).tobytes() for c in columns)])


def _unpack(packed: list[bytes], *types) -> list[np.ndarray]:
    """Columns of several packed blocks, one after the other."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in types]
    for block in packed:
        n, at = int(np.frombuffer(block, np.int64, 1)[0]), 8
        for out, t in zip(parts, types):
            out.append(np.frombuffer(block, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(p) for p in parts]


_NAMED = (np.uint64, np.uint64, np.int64, np.int32, np.uint16)  # least hash, identity, document, start, windows
_ASKED = (np.uint64, np.int64, np.int32, np.uint16, np.bool_)  # least hash, document, start, windows, many
_FOUND = (np.int64, np.int32, np.int32)  # document, start, end
_WINDOWS = (np.uint64, np.int64, np.int32)  # whole hash, document, start


def _dealt(key: np.ndarray, n: int, *columns: np.ndarray):
    """Rows split by a key from 0 to n - 1: (key, packed columns)."""
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(key.astype(np.uint16) if n <= 1 << 16 else key, kind="stable")
    bounds = np.searchsorted(key[order], np.arange(n + 1))
    columns = tuple(c[order] for c in columns)
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), _pack(*(c[bounds[k]:bounds[k + 1]] for c in columns))


def _group_of(doc: np.ndarray, n: int) -> np.ndarray:
    return (mix(doc.view(np.uint64) + np.uint64(1)) % np.uint64(n)).astype(np.int64)


def _own_repeats(least: np.ndarray, identity: np.ndarray, doc: np.ndarray, start: np.ndarray,
                 windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Among pieces held together: flags of those that are not repeats, and the spans (document, start, end) of the others."""
    order = np.argsort(identity)
    same = identity[order][1:] == identity[order][:-1]
    some = order[(np.append(same, False) | np.append(False, same))[:len(order)]]
    some = some[np.lexsort((start[some], doc[some], least[some], identity[some]))]
    new = np.ones(len(some), bool)
    new[1:] = (identity[some][1:] != identity[some][:-1]) | (least[some][1:] != least[some][:-1])
    lead = some[new][np.cumsum(new) - 1]
    own = np.ones(len(least), bool)
    own[some[~new]] = False
    later = some[(doc[some] != doc[lead]) | (start[some] != start[lead])]
    later = later[np.lexsort((start[later], doc[later]))]
    d, s = doc[later], start[later]
    e = s.astype(np.int64) + windows[later] % np.uint16(INNER) + (LENGTH - 1)
    first = np.ones(len(d), bool)
    first[1:] = d[1:] != d[:-1]
    ahead = np.cumsum(first) << 40
    e = (np.maximum.accumulate(e + ahead) - ahead).astype(np.int32)  # the furthest end so far in the document
    first[1:] |= s[1:] > e[:-1]
    at = np.flatnonzero(first)
    return own, d[at], s[at], e[np.append(at[1:], len(d)) - 1] if len(d) else e


def _name_pieces(docs: DataFrame, groups: int) -> DataFrame:
    """Repeats within a task, dealt by document (kind 0), and all other pieces, dealt by least hash (kind 1)."""
    def run(batches):
        held, count = [], 0

        def send():
            columns = tuple(np.concatenate(c) for c in zip(*held))
            own, doc, start, end = _own_repeats(*columns)
            columns = tuple(c[own] for c in columns)
            rows = [(p, 0, b) for p, b in _dealt(_group_of(doc, groups), groups, doc, start, end)]
            rows += [(p, 1, b) for p, b in _dealt((columns[0] % np.uint64(groups)).astype(np.int64), groups, *columns)]
            for lo in range(0, len(rows), 256):
                part, kind, packed = zip(*rows[lo:lo + 256])
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(kind, pa.int32()),
                                                  pa.array(packed, pa.binary())], names=["part", "kind", "packed"])

        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in text_chunks(batch.column("text"), NAME_BYTES):
                least, identity, text, start, windows = pieces(data, offsets)
                held.append((least, identity, ids[lo + text], start, windows))
                count += len(least)
            if count >= SEND_PIECES:
                yield from send()
                held, count = [], 0
        if held:
            yield from send()

    return arrow_map(docs, run, "part bigint, kind int, packed binary")


def _earliest(groups: int):
    """Repeats of whole pieces (kind 0; those found before stay), and the pieces to be fetched, dealt by document."""
    def run(table: pa.Table) -> pa.Table:
        sent = list(zip(table.column("part").to_pylist(), table.column("kind").to_pylist(),
                        table.column("packed").to_pylist()))
        least, identity, doc, start, windows = _unpack([b for _, k, b in sent if k == 1], *_NAMED)
        order = np.argsort(least)
        same = least[order][1:] == least[order][:-1]
        again = order[np.append(same, False) | np.append(False, same) | (windows[order] >= INNER)] if len(order) else order
        again = again[np.lexsort((start[again], doc[again], identity[again], least[again]))]
        least, identity, doc, start, windows = (c[again] for c in (least, identity, doc, start, windows))
        inner, windows = windows >= INNER, windows % np.uint16(INNER)
        n = len(least)
        new_hash, new_piece = np.ones(n, bool), np.ones(n, bool)
        new_hash[1:] = least[1:] != least[:-1]
        new_piece[1:] = new_hash[1:] | (identity[1:] != identity[:-1])
        first = np.flatnonzero(new_piece)[np.cumsum(new_piece) - 1] if n else np.zeros(0, np.int64)
        repeat = (doc != doc[first]) | (start != start[first])
        kinds = np.bincount(np.cumsum(new_hash) - 1, new_piece, minlength=0)[np.cumsum(new_hash) - 1] if n else np.zeros(0)
        asked = new_piece & ((kinds > 1) | inner)
        rows = [row for row in sent if row[1] == 0]
        rows += [(p, 0, b) for p, b in _dealt(_group_of(doc[repeat], groups), groups, doc[repeat], start[repeat],
                                              start[repeat] + windows[repeat] + np.int32(LENGTH - 1))]
        rows += [(p, 1, b) for p, b in _dealt(_group_of(doc[asked], groups), groups, least[asked], doc[asked],
                                              start[asked], windows[asked], kinds[asked] > MANY_PIECES)]
        part, kind, packed = zip(*rows) if rows else ((), (), ())
        return pa.table({"part": pa.array(part, pa.int64()), "kind": pa.array(kind, pa.int32()),
                         "packed": pa.array(packed, pa.binary())})
    return run


def _texts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, bytes and offsets of a group of documents."""
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, _, data, offsets = next(text_chunks(table.column("text").combine_chunks(), 1 << 62))
    return table.column("doc").to_numpy(), data, offsets


def _fetch(groups: int):
    """The asked pieces' bytes, dealt by least hash (kind 0); windows of hashes with many pieces (kind 1)."""
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        ids, data, offsets = _texts(docs)
        least, doc, start, windows, many = _unpack(asked.column("packed").to_pylist(), *_ASKED)
        order = np.argsort(ids, kind="stable")
        row = order[np.minimum(np.searchsorted(ids[order], doc), max(len(order) - 1, 0))] if len(ids) else doc[:0]
        rows = []
        first = offsets[row] + start
        size = windows.astype(np.int64) + LENGTH - 1
        fits = first + size <= offsets[row + 1]
        few = np.flatnonzero(~many & fits)
        few = few[np.argsort(least[few] % np.uint64(groups), kind="stable")]
        part = (least[few] % np.uint64(groups)).astype(np.int64)
        bounds = np.searchsorted(part, np.arange(groups + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            some = few[bounds[p]:bounds[p + 1]]
            text = b"".join(data[a:a + n].tobytes() for a, n in zip(first[some].tolist(), size[some].tolist()))
            rows.append((int(p), 0, _pack(least[some], doc[some], start[some], windows[some]) + text))
        some = np.flatnonzero(many & fits)
        whole = _whole_hashes(data, first[some], windows[some].astype(np.int64))
        again = np.repeat(some, windows[some])
        rows += [(p, 1, b) for p, b in _dealt((whole % np.uint64(groups)).astype(np.int64), groups, whole, doc[again],
                                              start[again] + _within(windows[some]).astype(np.int32))]
        part, kind, packed = zip(*rows) if rows else ((), (), ())
        return pa.table({"part": pa.array(part, pa.int64()), "kind": pa.array(kind, pa.int32()),
                         "packed": pa.array(packed, pa.binary())})
    return run


class _Order:
    """Rows ordered by symbols, more of them each round, and their intervals: neighbours that share all symbols so far.

    ``interval`` has for each row the place in ``rows`` of its interval's
    first. Rows flagged ``alone`` share with no other.
    """

    def __init__(self, key: np.ndarray, alone: np.ndarray | None = None):
        self.rows, self.lead, self.interval = np.arange(len(key)), np.arange(len(key)), np.arange(len(key))
        self._deal(np.arange(len(key)), key, alone)

    def _deal(self, places: np.ndarray, key: np.ndarray, alone: np.ndarray | None) -> None:
        order = np.argsort(key)
        rows, key = self.rows[places[order]], key[order]
        new = np.ones(len(rows), bool)
        new[1:] = key[1:] != key[:-1]
        if alone is not None:
            new |= alone[rows]
        lead = places[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        self.rows[places], self.lead[places], self.interval[rows] = rows, lead, lead

    def refine(self, step: np.ndarray, alone: np.ndarray | None = None) -> bool:
        """Order by the symbols from the rows ``step`` on too, which are ordered by as many; False if no rows share any."""
        same = self.lead[1:] == self.lead[:-1]
        places = np.flatnonzero(np.append(same, False) | np.append(False, same))
        rows = self.rows[places]
        self._deal(places, self.interval[rows] * len(self.rows) + self.interval[step[rows]], alone)
        return len(places) > 0


class Shard:
    """Sorted suffixes of some texts, and the Burrows-Wheeler transform they give.

    Row ``r`` is the suffix at ``place[r]`` of text ``text[r]``; ``symbol[r]``
    is the byte before it, ``before[r]`` the row of the suffix with that byte
    put in front. Rows without a byte before them hold the symbol 255, which
    UTF-8 never uses. The first rows are the empty suffixes, one for each text.
    """

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) + 1 for t in texts])
        end = np.cumsum(lengths) - 1
        owner = np.repeat(np.arange(len(texts)), lengths)
        at = np.arange(lengths.sum()) - np.repeat(end + 1 - lengths, lengths)
        joined = np.frombuffer(b"\xff" + b"\xff".join(texts) + b"\xff", np.uint8)
        # The symbols of each suffix, eight at first, then twice as many each round; its end comes before all bytes.
        key = joined[1:] + np.uint64(1)
        key[end] = 0
        here, end, size = np.arange(len(at)), end[owner], 1
        while size < 8:
            key = (key << np.uint64(8 * size)) + key[np.minimum(here + size, end)]
            size *= 2
        order = _Order(key)
        while size < lengths.max() and order.refine(np.minimum(here + size, end)):
            size *= 2
        rows = order.rows[np.lexsort((order.rows, order.lead))]
        self.text, self.place = owner[rows], at[rows]
        self.symbol = joined[rows]
        rank = np.empty(len(rows), np.int64)
        rank[rows] = np.arange(len(rows))
        self.before = np.where(self.place > 0, rank[rows - 1], -1)
        self.n_texts = len(texts)


def merge(shards: list[Shard], depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' rows in the order of their first ``depth`` symbols, and their intervals.

    Rows are numbered through all shards. Two rows have the same interval
    number if they share ``depth`` symbols (a text's end is like no other).
    """
    sizes = np.array([len(s.symbol) for s in shards])
    shift = np.cumsum(sizes) - sizes
    symbol = np.concatenate([s.symbol for s in shards])
    before = np.concatenate([np.where(s.before < 0, -1, s.before + o) for s, o in zip(shards, shift)])
    ends = np.concatenate([o + np.arange(s.n_texts) for s, o in zip(shards, shift)])
    n = len(symbol)
    # The row without its first symbol; an end has none and stays.
    after = np.arange(n)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    first = symbol[after] + np.uint64(1)
    first[ends] = 0
    ended = np.zeros(n, bool)  # within the symbols taken so far
    ended[ends] = True
    key, known, steps = first, 1, [after]  # rows after 1, 2, 4, ... symbols
    while known * 2 <= min(depth, 8):
        key = (key << np.uint64(8 * known)) + key[steps[-1]]
        ended |= ended[steps[-1]]
        steps.append(steps[-1][steps[-1]])
        known *= 2
    order = _Order(key, ended)
    while known < depth:
        more = min(known, depth - known)
        step = functools.reduce(lambda a, b: b[a], [s for j, s in enumerate(steps) if more >> j & 1])
        ended |= ended[step]
        if not order.refine(step, ended):
            break
        known += more
        if known < depth:
            steps.append(steps[-1][steps[-1]])
    return order.rows, order.lead


def repeats(texts: list[bytes], doc: np.ndarray, start: np.ndarray, shards: int = SHARDS
            ) -> tuple[np.ndarray, np.ndarray]:
    """Document and start of each window that occurs earlier, among texts that stand at ``start`` in documents."""
    numbers = [np.arange(k, len(texts), shards) for k in range(min(shards, len(texts)))]
    made = [Shard([texts[i] for i in own]) for own in numbers]
    order, interval = merge(made)
    text = np.concatenate([own[s.text] for own, s in zip(numbers, made)])[order]
    place = np.concatenate([s.place for s in made])[order]
    same = interval[1:] == interval[:-1]
    rows = np.flatnonzero(np.append(same, False) | np.append(False, same))
    text, place, interval = text[rows], place[rows], interval[rows]
    d, at = doc[text], start[text].astype(np.int64) + place
    sort = np.lexsort((at, d, interval))
    d, at, interval = d[sort], at[sort], interval[sort]
    first = np.ones(len(d), bool)
    first[1:] = interval[1:] != interval[:-1]
    lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(d) else np.zeros(0, np.int64)
    later = (d != d[lead]) | (at != at[lead])
    return d[later], at[later]


def _spans(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows joined to spans: document, start, end."""
    if not len(doc):
        return doc, at.astype(np.int32), at.astype(np.int32)
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + LENGTH)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], at[first].astype(np.int32), (at[last] + LENGTH).astype(np.int32)


def _merge_pieces(groups: int):
    """Spans of repeated windows among the pieces of a group, dealt by document."""
    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        blocks = table.column("packed").to_pylist()
        few = [b for k, b in zip(kinds, blocks) if k == 0]
        least, doc, start, windows = _unpack(few, np.uint64, np.int64, np.int32, np.uint16)
        texts: list[bytes] = []
        for b in few:
            n = int(np.frombuffer(b, np.int64, 1)[0])
            at = 8 + n * 22
            for size in (np.frombuffer(b, np.uint16, n, 8 + n * 20).astype(int) + LENGTH - 1).tolist():
                texts.append(b[at:at + size])
                at += size
        order = np.lexsort((start, doc, least))
        sizes = windows[order].astype(np.int64) + LENGTH - 1
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        lo, n = 0, len(order)
        new = np.append(np.flatnonzero(np.append(True, least[order][1:] != least[order][:-1])), n) if n else np.zeros(1, int)
        filled = np.concatenate([[0], np.cumsum(sizes)])
        while lo < n:  # whole hashes, until enough bytes are held
            want = np.searchsorted(filled, filled[lo] + MERGE_BYTES)
            hi = int(new[min(np.searchsorted(new, want), len(new) - 1)])
            hi = max(hi, int(new[np.searchsorted(new, lo, side="right")]))
            some = order[lo:hi]
            found.append(repeats([texts[i] for i in some], doc[some], start[some]))
            lo = hi
        whole, d, at = _unpack([b for k, b in zip(kinds, blocks) if k == 1], *_WINDOWS)
        order = np.lexsort((at, d, whole))
        whole, d, at = whole[order], d[order], at[order]
        first = np.append(True, whole[1:] != whole[:-1])[:len(whole)]
        lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(whole) else np.zeros(0, np.int64)
        later = (d != d[lead]) | (at != at[lead])
        found.append((d[later], at[later].astype(np.int64)))
        doc, begin, end = _spans(*(np.concatenate(c) for c in zip(*found)))
        rows = list(_dealt(_group_of(doc, groups), groups, doc, begin, end))
        part, packed = zip(*rows) if rows else ((), ())
        return pa.table({"part": pa.array(part, pa.int64()), "packed": pa.array(packed, pa.binary())})
    return run


_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _cut(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Each document's removed spans and what is left of its bytes."""
    numbers, data, offsets = _texts(docs)
    ids = docs.column("doc_id").combine_chunks() if docs.num_rows else pa.array([], pa.int64())
    doc, start, end = _unpack(found.column("packed").to_pylist(), *_FOUND)
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    lo, hi = np.searchsorted(doc, numbers), np.searchsorted(doc, numbers, side="right")
    spans, kept = [], []
    for i in range(len(numbers)):
        text = data[offsets[i]:offsets[i + 1]]
        own: list[dict] = []
        if hi[i] > lo[i]:
            s, e = start[lo[i]:hi[i]], np.minimum(np.maximum.accumulate(end[lo[i]:hi[i]]), len(text))
            new = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
            s, e = s[new], e[np.append(new[1:], len(e)) - 1]
            own = [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())]
            mask = np.zeros(len(text) + 1, np.int8)
            mask[s] += 1
            mask[e] -= 1
            text = text[np.cumsum(mask[:-1]) == 0]
        spans.append(own)
        kept.append(text.tobytes())
    return pa.table({"doc_id": ids, "n_bytes": pa.array(np.diff(offsets)), "spans": pa.array(spans, _SPAN_TYPE),
                     "kept": pa.array(kept, pa.binary())})


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, text`` of every row; ``doc`` tells the documents apart and gives their order.

    A document is a row, but rows of one doc_id and one text are one document.
    ``doc`` is the doc_id where that tells all documents apart. Where a doc_id
    is null or has several texts, the documents are numbered by doc_id, null
    last, then row; their row numbers are written with the table.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    hashed = F.sha2("text", 256)
    several = source.select("doc_id", F.xxhash64("text").alias("h"), F.hash("text").alias("g")).groupBy("doc_id").agg(
        F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("g").alias("g0"), F.max("g").alias("g1")) \
        .where("doc_id is null or h0 <> h1 or g0 <> g1")
    if several.isEmpty():
        return source.select(F.col("doc_id").alias("doc"), "doc_id", "text")
    rows = materialize(source.select("doc_id", "text", F.monotonically_increasing_id().alias("row")))
    named = rows.withColumn("name", F.when(F.col("doc_id").isNull(), F.col("row").cast("string")).otherwise(
        F.concat_ws(":", F.col("doc_id").cast("string"), hashed)))
    first = named.groupBy("name").agg(F.min("doc_id").alias("id"), F.min("row").alias("first"))
    # Numbers grow from one sorted partition to the next.
    numbers = materialize(first.orderBy(F.col("id").asc_nulls_last(), "first").select(
        "name", F.monotonically_increasing_id().alias("doc")))
    return materialize(named.join(numbers, "name").select("doc", "doc_id", "text"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: removed byte spans and the remaining bytes of every row.

    A byte is removed if a string of 100 bytes that covers it also starts
    earlier: in a document of a smaller doc_id, in an earlier row of the same
    doc_id with another text, or earlier in the same document. Matches never
    cross documents. A null text is empty; a text of fewer than 100 bytes is
    kept; rows of a null doc_id are documents of their own and come after all
    others, in their order; rows of the same doc_id and text count as one
    document, so that a repeated row gives its result again; an empty table
    gives no rows; other columns are ignored. Equal strings are those of equal
    128-bit hashes where whole pieces agree, and of equal bytes (64-bit hashes
    under a hash of very many pieces) elsewhere.
    """
    prepare(docs.sparkSession)
    source = _numbered(docs)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(MIN_GROUPS, total // GROUP_BYTES + 1)
    found = materialize(_name_pieces(source.select("doc", "text"), groups).groupBy("part").applyInArrow(
        _earliest(groups), "part bigint, kind int, packed binary"))

    def number(batches):
        for batch in batches:
            part = _group_of(batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64), groups)
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column("doc"), batch.column("doc_id"),
                                              pa.array(strings(batch.column("text")))],
                                             names=["part", "doc", "doc_id", "text"])

    grouped = arrow_map(source, number, "part bigint, doc bigint, doc_id bigint, text string").groupBy("part")
    fetched = grouped.cogroup(found.where("kind = 1").groupBy("part")).applyInArrow(
        _fetch(groups), "part bigint, kind int, packed binary")
    merged = fetched.groupBy("part").applyInArrow(_merge_pieces(groups), "part bigint, packed binary")
    spans = found.where("kind = 0").select("part", "packed").unionByName(merged)
    return grouped.cogroup(spans.groupBy("part")).applyInArrow(
        _cut, "doc_id bigint, n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary")


def digest(cut: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
