"""Cross-tokenizer alignment by galloping intersection of token ends, with corpus-wide link counts.

Two tokenizers cut the same bytes. Where tokens of both end at one byte offset
the text falls into groups. The shorter list of ends drives the search: each
of its ends is looked up in the longer list by doubling steps from a known
lower bound and a binary search of the bracket found. Common ends slice the
groups, and the differences of ranks are the ranges of overlapping tokens.

Documents are handled in chunks of bounded size. A chunk keeps its documents
as one compressed block, in which every link is a number into the chunk's own
list of distinct id pairs. That list is counted over all chunks, and each
chunk asks for the counts of its own pairs only: no table of all pairs is
broadcast or collected, and a pair that stands in every document is one row
for each chunk.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map, prepare, strings
from threadcorpus.session import materialize

TOKENIZERS = "/opt/tokenizers"
# Bytes of text in one chunk (a longer text is a chunk of its own) and handed to a tokenizer at once.
CHUNK_TEXT = 8 << 20
ENCODE_TEXT = 256 << 10
# Texts longer than this are encoded segment by segment.
SEGMENT_TEXT = 64 << 10
STRIDE = 64


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in byte-level vocabularies.

    Visible bytes stand for themselves; the others follow from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


# The fixed pattern of the byte-level vocabulary's words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def merge_ranks(json_text: str) -> dict[bytes, int] | None:
    """Ids by bytes, if the file is a plain byte-level vocabulary whose merges are in the order of their ids.

    Then the least id among possible merges is the first merge, and the faster
    encoder by ranks gives the same ids.
    """
    file, alphabet = json.loads(json_text), byte_alphabet()
    model, words = file["model"], file.get("pre_tokenizer") or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    vocabulary, special = model.get("vocab", {}), {t["content"] for t in file.get("added_tokens", [])}
    ids = [vocabulary.get(a + b, -1) for a, b in merges]
    plain = (file.get("normalizer") is None and words.get("type") == "ByteLevel" and words.get("use_regex", True)
             and not words.get("add_prefix_space") and not model.get("ignore_merges") and not model.get("dropout"))
    entries = {e: i for e, i in vocabulary.items() if e not in special}
    if not plain or any(x >= y for x, y in zip(ids, ids[1:])) or len(entries) != len(ids) + 256 or min(ids, default=256) < 256:
        return None
    return {bytes(alphabet[c] for c in e): i for e, i in entries.items()}


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and the written forms of ids with what follows them."""

    def __init__(self, vocabulary_file: str, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(vocabulary_file)
        self.a.encode_special_tokens = True
        ranks = merge_ranks(vocabulary_file)
        self.by_ranks = ranks and tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            known = all(c in alphabet for c in entry)
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        # A piece over a word's start would forbid cutting long texts there.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.size = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(self.size)]

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        if self.by_ranks:
            return [self.by_ranks.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of each text by both, or none where the joined bytes differ from space and text."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            cut = segments(text) if self.cuttable and len(text) > SEGMENT_TEXT else [text] if text else []
            parts += cut
            owner += [i] * len(cut)
        ids_a: list[list[int]] = [[] for _ in texts]
        ids_b: list[list[int]] = [[] for _ in texts]
        lo = 0
        while lo < len(parts):
            hi, size = lo, 0
            while hi < len(parts) and (hi == lo or size + len(parts[hi]) <= ENCODE_TEXT):
                size += len(parts[hi])
                hi += 1
            some = parts[lo:hi]
            for i, a, b in zip(owner[lo:hi], self.ids_a([" " + p for p in some]), self.b.encode(some, num_threads=1)):
                ids_a[i] += a
                ids_b[i] += b
            lo = hi
        for text, a, b in zip(texts, ids_a, ids_b):
            whole = b" " + text.encode()
            same = text and whole == b"".join(map(self.bytes_a.__getitem__, a)) == b"".join(map(self.bytes_b.__getitem__, b))
            yield (a, b) if same else ([], [])


def segments(text: str) -> list[str]:
    """Parts of a long text, cut at single spaces between visible characters; the spaces are left out.

    Neither tokenizer has a token over such a place, and both put a space
    before a part again, so the parts' ids together are those of the text.
    """
    out, start = [], 0
    while len(text) - start > SEGMENT_TEXT:
        at = text.find(" ", start + SEGMENT_TEXT)
        while at > 0 and (at + 1 == len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at + 1
    return [*out, text[start:]]


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each value of ascending ``few`` the number of smaller values of ascending ``many``.

    Every ``STRIDE``-th value is looked up first; its rank is the lower bound
    of those after it. From there steps double until a value is not smaller,
    and the bracket is halved; all values step together.
    """
    n, end = len(few), len(many)
    lo = np.zeros(n, np.int64)
    if n > STRIDE:
        lo = np.repeat(gallop(few[::STRIDE], many), STRIDE)[:n]
    hi, open_, step = lo.copy(), np.arange(n), 1
    while len(open_):
        open_ = open_[hi[open_] < end]
        open_ = open_[many[hi[open_]] < few[open_]]
        lo[open_] = hi[open_] + 1
        hi[open_] += step
        step *= 2
    np.minimum(hi, end, out=hi)
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        middle = (lo[open_] + hi[open_]) >> 1
        smaller = many[middle] < few[open_]
        lo[open_[smaller]] = middle[smaller] + 1
        hi[open_[~smaller]] = middle[~smaller]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last overlapping B token of each A token, and the indices in A and B of the common ends."""
    if len(ends_a) <= len(ends_b):
        below = gallop(ends_a, ends_b)
        common_a = np.flatnonzero(ends_b[np.minimum(below, len(ends_b) - 1)] == ends_a) if len(ends_a) else below
        common_b = below[common_a]
        upto = below.copy()
        upto[common_a] += 1
    else:
        rank = gallop(ends_b, ends_a)
        common_b = np.flatnonzero(ends_a[np.minimum(rank, len(ends_a) - 1)] == ends_b) if len(ends_b) else rank
        common_a = rank[common_b]
        # Ranks of B ends among A ends, counted up, are the ranks of A ends among B ends.
        upto = np.cumsum(np.bincount(rank, minlength=len(ends_a) + 1))[:len(ends_a)]
        below = upto.copy()
        below[common_a] -= 1
    first = np.concatenate([[0], upto[:-1]]) if len(upto) else upto
    return first, below, common_a, common_b


def align(tokens: Tokenizers, texts: list[str]) -> tuple[dict[str, np.ndarray], list[bytes | None], np.ndarray]:
    """Counts of each text, the digest of its groups (none without tokens), and the id pair of every link in order."""
    encoded = list(tokens.encode(texts))
    n_a, n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1))
    a, b = (np.array([i for e in encoded for i in e[k]], np.int64) for k in (0, 1))
    first, last, common_a, common_b = overlaps(np.cumsum(tokens.length_a[a]), np.cumsum(tokens.length_b[b]))
    width = last - first + 1
    at = np.cumsum(width) - width
    pairs = np.repeat(a, width) * len(tokens.bytes_b) + b[np.arange(int(width.sum())) + np.repeat(first - at, width)]
    # Ends of documents are common ends, so groups and links of all texts are found at once.
    last_a = np.cumsum(n_a)
    n_groups = np.diff(np.searchsorted(common_a, np.concatenate([[0], last_a])))
    n_links = np.diff(np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], last_a])])

    # The written form: A ids of a group, then its B ids; a mark follows each id.
    mark = np.zeros(len(a) + len(b), np.int64)
    group_a, group_b = (np.repeat(np.arange(len(c)), np.diff(np.concatenate([[-1], c]))) for c in (common_a, common_b))
    place_a = np.arange(len(a)) + np.concatenate([[0], common_b + 1])[group_a]
    place_b = np.arange(len(b)) + (common_a + 1)[group_b]
    mark[place_a[common_a]], mark[place_b[common_b]] = 1, 2
    mark *= tokens.size
    mark[place_a] += a
    mark[place_b] += b
    written = list(map(tokens.written.__getitem__, mark.tolist()))
    ends = np.cumsum(n_a + n_b)
    digests = [hashlib.sha256("".join(written[lo:hi])[:-1].encode()).digest() if hi > lo else None
               for lo, hi in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}, digests, pairs


def _sealed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class _Chunk:
    """Documents and pairs gathered until the chunk is full."""

    def __init__(self):
        self.keys, self.counts, self.digests, self.pairs, self.size = [], {c: [] for c in COUNTS}, [], [], 0

    def add(self, keys: pa.Array, counts: dict, digests: list, pairs: np.ndarray, size: int) -> None:
        self.keys.append(keys)
        for c in COUNTS:
            self.counts[c].append(counts[c])
        self.digests += digests
        self.pairs.append(pairs)
        self.size += size

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """One row with the documents, and a row for each distinct pair; links are numbers of pairs."""
        code, pairs = pd.factorize(np.concatenate(self.pairs))
        n = np.bincount(code, minlength=len(pairs))
        code = code.astype(np.uint16 if len(pairs) < 1 << 16 else np.uint32)
        columns = {c: np.concatenate(self.counts[c]) for c in COUNTS}
        offsets = np.concatenate([[0], np.cumsum(columns["n_links"])])
        keys = pa.concat_arrays(self.keys)
        block = pa.RecordBatch.from_arrays(
            [keys, *(pa.array(columns[c]) for c in COUNTS), pa.array(self.digests, pa.binary()),
             pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(code))],
            names=["doc_id", *COUNTS, "digest", "links"])
        yield _row_batch([number], [_sealed(block)], [None], [None], [None])
        for lo in range(0, len(pairs), 100_000):
            some = slice(lo, lo + 100_000)
            m = len(pairs[some])
            yield _row_batch([number] * m, [None] * m, pairs[some], np.arange(lo, lo + m), n[some])


CHUNK_SCHEMA = "chunk bigint, docs binary, pair bigint, code bigint, n bigint"


def _row_batch(chunk, docs, pair, code, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(docs, pa.binary()), pa.array(pair, pa.int64()),
         pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["chunk", "docs", "pair", "code", "n"])


def load(folder: str = TOKENIZERS, byte_level: str = "byte_bpe_50k.json", pieces: str = "piece_bpe_32k.model"):
    """The two vocabulary files, read on the driver: about 2 MB, whatever the corpus."""
    with open(os.path.join(folder, byte_level), encoding="utf-8") as f, open(os.path.join(folder, pieces), "rb") as g:
        return f.read(), g.read()


def chunks(docs: DataFrame, files: tuple[str, bytes], chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """``chunk, docs, pair, code, n``: a row with the sealed documents of each chunk, and one for each of its pairs."""
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches):
        tokens = Tokenizers(*sent.value)
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            keys, texts = batch.column("doc_id"), strings(batch.column("text")).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= ENCODE_TEXT):
                    size += len(texts[hi])
                    hi += 1
                if chunk.size and chunk.size + size > chunk_text:
                    yield from chunk.rows(number)
                    number, chunk = number + 1, _Chunk()
                chunk.add(keys.slice(lo, hi - lo), *align(tokens, texts[lo:hi]), size)
                lo = hi
        if chunk.keys:
            yield from chunk.rows(number)

    return arrow_map(source, run, CHUNK_SCHEMA)


def _sums(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """The documents of one chunk with their links' counts summed."""
    total, best = (np.zeros(asked.num_rows, np.int64) for _ in range(2))
    code = asked.column("code").to_numpy()
    total[code], best[code] = asked.column("total").to_numpy(), asked.column("is_best").to_numpy()
    out = []
    for sealed in docs.column("docs").to_pylist():
        with pa.ipc.open_stream(sealed) as stream:
            block = stream.read_next_batch()
        links = block.column("links")
        offsets, code = links.offsets.to_numpy(), links.values.to_numpy()
        sums = [np.concatenate([[0], np.cumsum(x[code])])[offsets] for x in (best, total)]
        digest = [d.hex() if d else "" for d in block.column("digest").to_pylist()]
        out.append(pa.RecordBatch.from_arrays(
            [block.column("doc_id"), *(block.column(c) for c in COUNTS), *(pa.array(np.diff(s)) for s in sums),
             pa.array(digest, pa.string())], names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]))
    return pa.Table.from_batches(out) if out else pa.table(
        {c: pa.array([], pa.string() if c == "groups_sha256" else pa.int64())
         for c in ("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")})


def link(docs: DataFrame, files: tuple[str, bytes] | None = None, chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link is a pair of an A and a B token whose byte ranges overlap; its count
    is that of its id pair in all rows; ``n_best`` are the links whose count is
    the highest of their B id, ties included. A null or empty text, and one
    whose tokens do not give back its bytes, has zeros and an empty digest. A
    repeated row counts as often as it stands; a null doc_id stays null; an
    empty table gives no rows; other columns are ignored. A very long text is
    encoded in segments and is a chunk of its own.
    """
    files = files or load()
    found = materialize(chunks(docs, files, chunk_text))
    pairs = found.where("pair is not null")
    n_pieces = len(Tokenizers(*files).bytes_b)
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("piece", F.col("pair") % n_pieces)
    # At most one row for each id of the vocabulary.
    highest = counts.groupBy("piece").agg(F.max("total").alias("highest"))
    asked = pairs.select("chunk", "code", "pair").join(counts, "pair").join(F.broadcast(highest), "piece") \
        .select(F.col("chunk").alias("asking"), "code", "total", (F.col("total") == F.col("highest")).cast("bigint").alias("is_best"))
    prepare(docs.sparkSession)
    key_type = docs.schema["doc_id"].dataType.simpleString()
    return found.where("docs is not null").select("chunk", "docs").groupBy("chunk").cogroup(asked.groupBy("asking")).applyInArrow(
        _sums, f"doc_id {key_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
               "count_sum bigint, groups_sha256 string")
