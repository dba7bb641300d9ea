"""Token ids of a byte-level vocabulary for whole corpora.

Texts of a batch are laid end to end, pre-token boundaries come from
``pretokens.starts``, and every distinct slice is merged once per worker and
kept; what remains per token is a lookup. Offsets are kept so that every id can
be traced to its bytes and decoding is exact.

Defined cases: null and empty texts have no ids (an empty list); strings of
special tokens are ordinary text; texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pretokens import starts

#: Folder of the vocabulary files; they are read where they lie.
TOKENIZER_DIR = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: Characters laid end to end at once, and slices kept per worker.
CHUNK_CHARS, KEPT_SLICES = 400_000, 400_000


class Encoder:
    """Encodes texts with the ranks of a byte-level vocabulary."""

    def __init__(self, folder: str = TOKENIZER_DIR, name: str = BYTE_BPE):
        with open(f"{folder}/{name}", "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.kept: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: the pair with the least rank is merged first, the leftmost of equals."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        length = [1] * n
        heap = []
        for k in range(n - 1):
            r = ranks.get(piece[k : k + 2])
            if r is not None:
                heap.append((r, k, 2))
        heapq.heapify(heap)
        while heap:
            _, k, size = heapq.heappop(heap)
            right = after[k]
            if not length[k] or right >= n or length[k] + length[right] != size:
                continue  # one of the two has been merged since
            length[k] = size
            length[right] = 0
            after[k] = follow = after[right]
            if follow < n:
                before[follow] = k
                size_right = size + length[follow]
                r = ranks.get(piece[k : k + size_right])
                if r is not None:
                    heapq.heappush(heap, (r, k, size_right))
            left = before[k]
            if left >= 0:
                size_left = length[left] + size
                r = ranks.get(piece[left : left + size_left])
                if r is not None:
                    heapq.heappush(heap, (r, left, size_left))
        return tuple(ranks[piece[k : k + length[k]]] for k in range(n) if length[k])

    def _chunk(self, texts: list[str]) -> tuple[list[list[tuple[int, ...]]], list[np.ndarray]]:
        """For each text the id tuples of its slices, and where the slices start."""
        joined = "\0".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts])
        breaks = ends[:-1] - 1
        at = np.flatnonzero(starts(codes, breaks))
        text_of = np.searchsorted(ends, at, side="right")
        # a slice ends at the next one or at the end of its text
        until = np.append(at[1:], len(joined))
        until = np.minimum(until, ends[text_of] - 1)
        kept, merge = self.kept, self.merge
        ids = []
        for a, b in zip(at.tolist(), until.tolist()):
            piece = joined[a:b]
            found = kept.get(piece)
            if found is None:
                if len(kept) >= KEPT_SLICES:
                    kept.clear()
                found = kept[piece] = merge(piece.encode())
            ids.append(found)
        cuts = np.searchsorted(text_of, np.arange(len(texts) + 1))
        begin = ends - [len(t) + 1 for t in texts]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])], [at[a:b] - o for a, b, o in zip(cuts[:-1], cuts[1:], begin)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, list[tuple[int, ...]]]]:
        """For each text its ids, the character offsets of its slices and the ids of each slice."""
        chunk: list[str] = []
        size = 0
        for k, text in enumerate(texts):
            chunk.append(text or "")
            size += len(chunk[-1]) + 1
            if size > CHUNK_CHARS or k == len(texts) - 1:
                slices, offsets = self._chunk(chunk)
                for parts, where in zip(slices, offsets):
                    yield [i for part in parts for i in part], where, parts
                chunk, size = [], 0

    def decode(self, ids: list[int]) -> bytes:
        """The bytes behind ``ids``."""
        if not hasattr(self, "bytes_of"):
            self.bytes_of = {r: b for b, r in self.ranks.items()}
        return b"".join(self.bytes_of[i] for i in ids)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(folder: str = TOKENIZER_DIR, name: str = BYTE_BPE) -> Encoder:
    """One encoder per worker process, with what it has merged so far."""
    key = (folder, name)
    if key not in _encoders:
        _encoders[key] = Encoder(folder, name)
    return _encoders[key]


def _pieces(batch: pa.RecordBatch, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``chars`` bytes, so that a few long texts do not fill the memory."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // chars)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def token_ids(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = BYTE_BPE) -> DataFrame:
    """``doc_id`` and ``ids`` of every row; rows stay where they are, nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(folder, name)
        for batch in (p for b in batches for p in _pieces(b)):
            texts = batch.column(1).to_pylist()
            ids = [np.asarray(x, np.int32) for x, _, _ in e.encode(texts)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate([*ids, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, "doc_id bigint, ids array<int>")


def token_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = BYTE_BPE) -> DataFrame:
    """``doc_id``, ``slice_starts`` (character offsets) and ``slice_tokens`` (ids in each slice): what decoding by offset needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(folder, name)
        for batch in (p for b in batches for p in _pieces(b)):
            texts = batch.column(1).to_pylist()
            rows = [(where.tolist(), [len(p) for p in parts]) for _, where, parts in e.encode(texts)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], kind)], names=["doc_id", "slice_starts", "slice_tokens"]
            )

    schema = "doc_id bigint, slice_starts array<int>, slice_tokens array<int>"
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, schema)


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = BYTE_BPE) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(folder, name)
        for batch in (p for b in batches for p in _pieces(b)):
            texts = batch.column(1).to_pylist()
            n = [sum(map(len, parts)) for _, _, parts in e.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, "doc_id bigint, n_tokens bigint")
