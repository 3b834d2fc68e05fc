"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The texts of a block are cut into pieces by the tokenizer's pattern; the distinct pieces that are
not known yet are laid end to end as byte symbols.  An inverted index from symbol pair to
positions is built once; the pairs that are tokens are then taken in rank order from a heap, each
merge is applied at all its positions at once, and only the index entries of the touched
neighbours change.  A text's ids are its pieces' ids in order.

Within one piece this is the usual rule (always merge the pair of lowest rank, the leftmost
first), as in a rank file a token ranks after the tokens that its merges are made of.

Blocks bound the memory; no result depends on where they end.  Null text counts as empty and has
no ids; an empty table gives no rows.  Very long pieces cost n log n.  Nothing is shuffled; repeated rows are encoded again.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import kept_in_worker, map_texts, sha256_hex

#: Texts of one block of the replay, by total characters.
BLOCK_CHARS = 2_000_000
#: Pieces whose ids a worker remembers.
KNOWN_PIECES = 300_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Replay:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes((b,))] for b in range(256)], np.int64)
        #: Every pair of tokens that makes a token, sorted, with the rank of what it makes.
        pairs = sorted((ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.pair_keys, self.pair_ranks = np.array(pairs or [(-1, -1)], np.int64).T.copy()
        self.known: dict[str, bytes] = {}

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or -1."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def learn(self, pieces: Iterable[str]) -> None:
        """Ids of the given distinct pieces, by replay over all of them together."""
        rest, raws = [], []
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is None:
                rest.append(piece)
                raws.append(raw)
            else:  # a piece that is a token is that token
                self.known[piece] = struct.pack("<I", whole)
        if not rest:
            return
        ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        ids = self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[0] = before[ends[:-1]] = -1
        pair = np.full(n, -1, np.int64)  # rank of the pair that starts at each position
        first = np.flatnonzero(after >= 0)
        pair[first] = self.merged(ids[first], ids[after[first]])
        index: dict[int, list[np.ndarray]] = {}
        pending: list[int] = []

        def note(places: np.ndarray) -> None:
            """Add positions to the index under the rank of their pair."""
            ranks = pair[places]
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, start, end in zip(ranks[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)], strict=True):
                held = index.get(rank)
                if held is None:
                    index[rank] = [places[start:end]]
                    heapq.heappush(pending, rank)
                else:
                    held.append(places[start:end])

        note(first)
        while pending:
            rank = heapq.heappop(pending)
            held = index.pop(rank)
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            at = at[pair[at] == rank]  # entries that earlier merges have changed go
            if len(at) > 1:  # of pairs that overlap, every second one from the left
                linked = np.concatenate(([False], after[at[:-1]] == at[1:]))
                if linked.any():
                    place = np.arange(len(at))
                    at = at[(place - np.maximum.accumulate(np.where(linked, 0, place))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            right = after[gone]
            ids[at], ids[gone], pair[gone] = rank, -1, -1
            after[at] = right
            more = right >= 0
            before[right[more]] = at[more]
            pair[at] = -1
            with_right, left = at[more], before[at]
            left = left[left >= 0]
            touched = np.unique(np.concatenate((with_right, left)))
            if len(touched):
                pair[touched] = self.merged(ids[touched], ids[after[touched]])
                note(touched)
        live = ids >= 0
        counts = np.concatenate(([0], np.cumsum(live)))[np.concatenate(([0], ends))] * 4
        packed = ids[live].astype("<u4").tobytes()
        for piece, start, end in zip(rest, counts[:-1].tolist(), counts[1:].tolist(), strict=True):
            self.known[piece] = packed[start:end]

    def encode_block(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [self.split(t) for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        new = set().union(*cut) - self.known.keys()
        if new:
            self.learn(new)
        for pieces in cut:
            yield b"".join(map(self.known.__getitem__, pieces))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


def blocks_of(rows: Iterator[tuple]) -> Iterator[tuple[list, list[str]]]:
    """(id, text) rows in blocks of about BLOCK_CHARS."""
    ids, texts, size = [], [], 0
    for doc, text in rows:
        ids.append(doc)
        texts.append(text or "")
        size += len(texts[-1])
        if size >= BLOCK_CHARS or len(ids) >= 4096:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode_documents(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens and the ids (array), or with ``digests`` the hashes of ids and of the decoded bytes.

    The vocabulary file (its size is fixed by the tokenizer, not by the data) is read once and broadcast.
    """
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = _coder(shared.value, pattern)
        for ids, texts in blocks_of(rows):
            for doc, packed in zip(ids, coder.encode_block(texts), strict=True):
                if digests:
                    yield doc, len(packed) // 4, sha256_hex(packed), sha256_hex(coder.decode(packed))
                else:
                    yield doc, len(packed) // 4, memoryview(packed).cast("I").tolist()

    fields = [("doc_id", "long", pa.int64()), ("n_tokens", "long", pa.int64())]
    fields += [("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())] if digests else [("ids", "array<int>", pa.list_(pa.int32()))]
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, fields, "doc_id", "text", keeps=True)


def decode_documents(spark: SparkSession, encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of each row of (doc_id, ids); null ids count as empty."""
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        coder = _coder(shared.value, pattern)
        for doc, ids in rows:
            yield doc, b"".join(map(coder.tokens.__getitem__, ids or ()))

    return map_texts(encoded, run, [("doc_id", "long", pa.int64()), ("decoded", "binary", pa.binary())], "doc_id", "ids", keeps=True)


def _coder(data: bytes, pattern: str) -> Replay:
    """One coder per worker and vocabulary, so that later tasks find its pieces known."""
    return kept_in_worker(("bpe", hash(data), pattern), lambda: Replay(read_ranks(data), pattern))
