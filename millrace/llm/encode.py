"""Encoding a corpus with a public byte-level BPE tokenizer.

Texts of up to :data:`CHUNK` characters are encoded where they are.  Longer ones are cut into
overlapping chunks that are pre-tokenised and encoded in parallel and stitched where the pre-token
boundaries of neighbours resynchronise: scanning depends on nothing before a boundary, so from the
first boundary that two neighbours share in their overlap they agree for good.  Where an overlap has
none (a run without any boundary), the text is scanned on from the last sure boundary, once for as
many chunks as the run has; it is recovered by decoding, which concatenates the tokens' raw bytes.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread

#: Characters per chunk and of overlap with the next one.
CHUNK, OVERLAP = 16_384, 512
DEFAULT_TOKENIZER = "byte_bpe_50k"

_loaded: dict[tuple[str, str | None], Codec] = {}


class Codec:
    """A tokenizer given as ranks of byte sequences.  Special tokens are ordinary text."""

    def __init__(self, name: str, folder: str | None):
        import public_tokenizers as P
        import regex
        import tiktoken

        path = os.path.join(folder, f"{name}.tiktoken") if folder else P.path(f"{name}.tiktoken")
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(P.PATTERN)
        self.pieces: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def piece(self, piece: str) -> list[int]:
        """The ids of one pre-token.  Kept for reuse up to a bound."""
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > 200_000:
                self.pieces.clear()
            ids = self.encoding._core_bpe.encode_single_piece(piece.encode("utf-8")) if piece else []
            if len(piece) < 64:
                self.pieces[piece] = ids
        return ids

    def scan(self, text: str, at: int) -> tuple[list[int], list[list[int]]]:
        """The ends (counted from ``at``) and ids of the pre-tokens of ``text``."""
        ends, ids = [], []
        for m in self.pattern.finditer(text):
            ends.append(at + m.end())
            ids.append(self.piece(m.group()))
        return ends, ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.encoding.decode_single_token_bytes(i) for i in ids)


def codec(name: str = DEFAULT_TOKENIZER, folder: str | None = None) -> Codec:
    """The tokenizer ``name`` of the public tokenizers, or of another ``folder``; loaded once a process."""
    key = (name, folder)
    if key not in _loaded:
        _loaded[key] = Codec(name, folder)
    return _loaded[key]


Chunk = tuple[int, list[int], list[list[int]]]  # start, ends of pre-tokens, their ids


def _sure(ends: list[int]) -> list[int]:
    """The boundaries that no text behind a chunk can change: scanning looks at most two characters beyond a
    pre-token (at ``'ll``, ``'re``, ``'ve`` and at the end of white space)."""
    return ends[: bisect_right(ends, ends[-1] - 2)]


def stitch(c: Codec, chunks: list[Chunk]) -> list[list[int]]:
    """The pre-tokens' ids of the whole text from those of its overlapping chunks, in order.

    Once a chunk starts at a boundary, all of its boundaries are sure but those at its end.  Where a chunk shares no boundary with what stands before it, its text is
    put behind that; it is scanned when a chunk brings boundaries of its own, so that a run through many
    chunks is scanned and encoded once: the whole is linear in the text.
    """
    start, ends, ids = chunks[0]
    done: list[list[int]] = []
    waiting: list[str] = []  # text from `start` on that is not scanned yet
    text = lambda pre: c.decode([i for x in pre for i in x]).decode("utf-8")
    for nxt_start, nxt_ends, nxt_ids in chunks[1:]:
        theirs = [nxt_start, *_sure(nxt_ends)]  # boundaries that the next chunk is sure of, if it starts at one
        sure = [] if waiting else _sure(ends)
        known = set(theirs)
        k = next((i for i in range(bisect_left(sure, nxt_start), len(sure)) if sure[i] in known), None)
        if k is not None:
            done += ids[: k + 1]
            j = theirs.index(sure[k])
            start, ends, ids = sure[k], nxt_ends[j:], nxt_ids[j:]
            continue
        upto = ends[-1]
        if not waiting:
            start = sure[-1] if sure else start
            done += ids[: len(sure)]
            waiting = [text(ids[len(sure) :])]
        waiting.append(text(nxt_ids)[upto - nxt_start :])
        ends = [max(upto, nxt_ends[-1])]
        if len(nxt_ends) > 1:
            ends, ids = c.scan("".join(waiting), start)
            waiting = []
    if waiting:
        ends, ids = c.scan("".join(waiting), start)
    return done + ids


def chunk_starts(length: int, size: int = CHUNK) -> int:
    """How many chunks a text of ``length`` characters has."""
    return max(1, -(-length // size))


def encode_text(text: str, name: str = DEFAULT_TOKENIZER, folder: str | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The same by chunks in one process."""
    c = codec(name, folder)
    if len(text) <= size:
        return c.encode(text)
    chunks = [(s, *c.scan(text[s : s + size + overlap], s)) for s in range(0, len(text), size)]
    return [i for x in stitch(c, chunks) for i in x]


def _encode(docs: DataFrame, key: str, text: str, name: str, folder: str | None, size: int, overlap: int, count_only: bool) -> DataFrame:
    value, ddl = (pa.int32(), "int") if count_only else (pa.list_(pa.int32()), "array<int>")
    field = "n_tokens" if count_only else "ids"
    schema = pa.schema([(key, pa.int64()), (field, value)])
    d = spread(docs.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("__t")))

    def short(batches):
        c = codec(name, folder)
        for b in batches:
            ids = [c.encode(t) if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in ids] if count_only else ids, value)], schema=schema)

    def scan(batches):
        c = codec(name, folder)
        out_schema = pa.schema([(key, pa.int64()), ("h", pa.int64()), ("n", pa.int32()), ("ends", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int32()))])
        for b in batches:
            cols: list[list] = [[], [], []]
            for n, t in zip(b.column("n").to_pylist(), b.column("t").to_pylist()):
                ends, ids = c.scan(t, n * size)
                for col, x in zip(cols, (ends, [len(x) for x in ids], [i for x in ids for i in x])):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("h"), b.column("n"), *(pa.array(x, pa.list_(pa.int32())) for x in cols)], schema=out_schema)

    def join(batches):
        c = codec(name, folder)
        doc, chunks, copies = None, [], 0

        def done():
            if doc is None:
                return
            ids = [i for x in stitch(c, chunks) for i in x]
            for _ in range(copies):
                yield pa.RecordBatch.from_arrays([pa.array([doc[0]], pa.int64()), pa.array([len(ids) if count_only else ids], value)], schema=schema)

        for b in batches:
            for row in zip(*(b.column(x).to_pylist() for x in (key, "h", "n", "ends", "counts", "ids"))):
                if row[:2] != doc:
                    yield from done()
                    doc, chunks, copies = row[:2], [], 0
                if row[2] == 0:
                    copies += 1
                if len(chunks) > row[2]:
                    continue  # the same text under the same id once more
                at, ids = 0, []
                for m in row[4]:
                    ids.append(row[5][at : at + m])
                    at += m
                chunks.append((row[2] * size, row[3], ids))
        yield from done()

    few = d.where(F.coalesce(F.length("__t"), F.lit(0)) <= size).mapInArrow(short, f"{key} bigint, {field} {ddl}")
    long = d.where(F.length("__t") > size)
    pos = F.explode(F.sequence(F.lit(0), F.floor((F.length("__t") - 1) / size).cast("int")))
    cut = long.select(key, F.xxhash64("__t").alias("h"), "__t", pos.alias("n")).select(key, "h", "n", F.expr(f"substring(__t, n * {size} + 1, {size + overlap})").alias("t"))
    scanned = cut.repartition(F.col(key), F.col("n")).mapInArrow(scan, f"{key} bigint, h bigint, n int, ends array<int>, counts array<int>, ids array<int>")
    many = scanned.repartition(F.col(key), F.col("h")).sortWithinPartitions(key, "h", "n").mapInArrow(join, f"{key} bigint, {field} {ddl}")
    return few.unionAll(many)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT_TOKENIZER, folder: str | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, ids`` of each row without special tokens; NULL and empty texts give an empty list.

    Only texts longer than ``size`` are shuffled, chunk by chunk.
    """
    return _encode(docs, key, text, name, folder, size, overlap, False)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT_TOKENIZER, folder: str | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_tokens``: the length of :func:`encode`'s list."""
    return _encode(docs, key, text, name, folder, size, overlap, True)


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", name: str = DEFAULT_TOKENIZER, folder: str | None = None) -> DataFrame:
    """``key, text``: the concatenated raw bytes as UTF-8; an empty list gives ''."""

    def run(batches):
        c = codec(name, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []).decode("utf-8", "replace") for x in b.column(1).to_pylist()], pa.string())], [key, "text"])

    return encoded.select(F.col(key).cast("bigint").alias(key), ids).mapInArrow(run, f"{key} bigint, text string")
