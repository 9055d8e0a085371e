"""Harmonic packing of token sequences.

Class ``k`` holds pieces of exactly ``capacity // k`` tokens, for every k, and each of its sequences takes ``k`` of them. A document is cut
into full sequences and what is left into the longest pieces that fit, so that it has few pieces. Every worker fills the sequences of
every class on its own while it reads its rows: a sequence is given out once its ``k`` pieces are there, so a worker holds fewer
than ``k`` open pieces of a class. At its end a worker puts the pieces that are left, longest first, into the first sequence with
room. No shuffle, no driver work; a worker that is lost repeats its own rows with the same numbers.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallyframe.llm.shared import picked, sub_batches

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SEQUENCES_PER_WORKER = 1 << 40


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, as the vocabulary file gives them: a special token's name is that token.

    Ordinary text is encoded from the same vocabulary's ranks, which gives the same ids several times as fast; texts that name a special token
    and texts with very long runs of white space, on which the faster encoder fails, go the file's own way.
    """

    def __init__(self, vocabulary_path: str, ranks_path: str, pattern: str, longest_run: int = 50_000):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.own = Tokenizer.from_file(vocabulary_path)
        special = [re.escape(t.content) for t in self.own.get_added_tokens_decoder().values()]
        self.special, self.run, self.longest_run = re.compile("|".join(special) or r"(?!)"), re.compile(rf"\s{{{longest_run}}}"), longest_run

    def ids(self, text: str) -> bytes:
        if self.special.search(text) or len(text) >= self.longest_run and self.run.search(text):
            found = array("I", self.own.encode(text, add_special_tokens=False).ids)
        else:
            found = array("I", self.fast.encode_ordinary(text))
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()


_ENCODERS: dict[tuple[str, ...], Encoder] = {}


def encoder(*files: str) -> Encoder:
    """One per Python worker."""
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


def classes(capacity: int) -> list[int]:
    """The lengths of pieces, longest first: ``capacity // k`` for every k."""
    return sorted({capacity // k for k in range(1, capacity + 1)}, reverse=True)


def cut(tokens: int, lengths: list[int]) -> list[int]:
    """Lengths of the pieces of a document: each the longest that what is left allows."""
    out = [lengths[0]] * (tokens // lengths[0])
    left = tokens % lengths[0]
    for length in lengths:
        while length <= left:
            out.append(length)
            left -= length
    return out


class Bins:
    """The open sequences of one worker. A piece is (doc_id, start, length, crc, doc_tokens)."""

    def __init__(self, worker: int, capacity: int):
        self.next_id, self.capacity = worker * SEQUENCES_PER_WORKER, capacity
        self.open: dict[int, list[tuple]] = {}

    def close(self, pieces: list[tuple]) -> Iterator[tuple]:
        """One sequence."""
        at = 0
        for piece in pieces:
            yield (*piece, self.next_id, at)
            at += piece[2]
        self.next_id += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        held = self.open.setdefault(piece[2], [])
        held.append(piece)
        if len(held) == self.capacity // piece[2]:
            del self.open[piece[2]]
            yield from self.close(held)

    def rest(self) -> Iterator[tuple]:
        """The open pieces of all classes together: fewer than the classes' numbers allow, whatever the worker has read."""
        sequences: list[list] = []
        for length in sorted(self.open, reverse=True):
            for piece in self.open[length]:
                fit = next((s for s in sequences if s[0] + length <= self.capacity), None)
                if fit is None:
                    sequences.append(fit := [0, []])
                fit[0] += length
                fit[1].append(piece)
        for _, pieces in sequences:
            yield from self.close(pieces)


def harmonic_pack(docs: DataFrame, vocabulary_path: str, ranks_path: str, pattern: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents as pieces of sequences of ``capacity`` tokens, ``end_id`` after each document.

    Result: one row per piece: doc_id, start (tokens of the document before it), length, ids_crc32 (of the ids as unsigned little-endian
    32-bit numbers), doc_tokens, sequence_id, offset. Null and empty texts are the end token alone; a null doc_id stays null;
    repeated rows are packed as often as they occur; other columns are ignored. A sequence of class k lacks fewer than k tokens; only what a
    worker has open at its end can lack more.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    lengths = classes(capacity)
    end = end_id.to_bytes(4, "little")
    types = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*found)], schema=types)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, encode = Bins(TaskContext.get().partitionId(), capacity), encoder(vocabulary_path, ranks_path, pattern).ids
        for batch in sub_batches(batches, "text"):
            found: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = (encode(text) if text else b"") + end
                start = 0
                for length in cut(len(ids) // 4, lengths):
                    found.extend(bins.add((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), len(ids) // 4)))
                    start += length
            if found:
                yield rows(found)
        if found := list(bins.rest()):
            yield rows(found)

    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(pack, SCHEMA)
