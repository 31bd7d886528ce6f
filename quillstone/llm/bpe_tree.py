"""Byte-level BPE encoding and decoding as a tree reduction over halves of a text.

A node of the tree holds the ids of its part of the text, encoded on its own. Joining two
neighbours re-encodes a window around the seam, and grows the window until nothing outside can
change. Two facts prove that:

* A split-pattern match never spans a *fixed edge*: a place where the kind of character changes
  between letter, number, other and white space, the left one is not white space, and the left
  one is not an apostrophe before a letter. Between two fixed edges the ids depend on nothing else.
* Within one match a row of tokens is the encoding if and only if each neighbouring pair is the
  encoding of its own bytes. If a re-encoded window still begins and ends with the tokens it had,
  the pairs across its ends are as they were.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from . import common

#: A part of a text no longer than this is a leaf: some hundred tokens.
LEAF_CHARS = 1024
LEAF_TOKENS = 1024
_EDGE = regex.compile(r"(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=\p{L})")
_ONE_KIND = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}']+")


class TreeCodec:
    """Encodes and decodes by halves; `ranks` is the content of a .tiktoken file."""

    def __init__(self, ranks: bytes, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_tokens: int = LEAF_TOKENS):
        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.one_match = tiktoken.Encoding("one match", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})
        self.token = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.token[rank] = token
        self.decimal = [str(i) for i in range(len(self.token))]
        self.leaf_chars, self.leaf_tokens = max(1, leaf_chars), max(1, leaf_tokens)

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf_chars:
            return self.encoding.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._encode(text, lo, mid), self._encode(text, mid, hi))

    def _join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        joined = self._inside_match(text, lo, mid, hi, left, right)
        if joined is not None:
            return joined
        reach = 64
        while True:
            a, b = max(lo, mid - reach), min(hi, mid + reach)
            edges = [a + m.start() for m in _EDGE.finditer(text[a:b])]
            before = max((e for e in edges if e <= mid), default=lo if a == lo else None)
            after = min((e for e in edges if e >= mid), default=hi if b == hi else None)
            if before is not None and after is not None:
                break
            reach *= 2
        if before == mid:
            return left + right
        keep = self._cut(left[::-1], len(text[before:mid].encode()))
        skip = self._cut(right, len(text[mid:after].encode()))
        return left[: len(left) - keep] + self.encoding.encode_ordinary(text[before:after]) + right[skip:]

    def _cut(self, ids: list[int], size: int) -> int:
        """The number of leading ids that make up `size` bytes."""
        n = 0
        while size > 0:
            size -= len(self.token[ids[n]])
            n += 1
        if size:
            raise AssertionError("a fixed edge lies inside a token")
        return n

    def _inside_match(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int] | None:
        """The join where the seam lies deep inside one match; None where it doesn't."""
        k = 8
        while k < len(left) and k < len(right):
            head, tail = b"".join(map(self.token.__getitem__, left[-k:])), b"".join(map(self.token.__getitem__, right[:k]))
            a, b = mid - len(head), mid + len(tail)
            if a < lo or b > hi or not _ONE_KIND.fullmatch(text, a, b):
                return None
            try:
                ids = self.one_match.encode_ordinary((head + tail).decode())
            except UnicodeDecodeError:  # the window's tokens begin or end inside a character
                ids = []
            if len(ids) > 1 and ids[0] == left[-k] and ids[-1] == right[k - 1]:
                return left[:-k] + ids + right[k:]
            k *= 2
        return None

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf_tokens:
            return b"".join(map(self.token.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> TreeCodec:
    return TreeCodec(ranks, pattern)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode each row's text, decode the ids again, and report digests (and the ids, if asked for).

    One row per input row, repeated rows included. A null or empty text has no tokens and the
    digests of the empty string; a very long text is reduced as a tree of leaves; a null doc_id stays
    null; an empty table gives an empty one. Only doc_id and text are read, so other columns can't
    clash. No shuffle; a worker holds one text, its ids and the vocabulary.
    """
    spark = common.prepare(docs.sparkSession)
    held = spark.sparkContext.broadcast(common.file_bytes(ranks_path))
    schema = SCHEMA.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held.value, pattern)
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "")
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join(map(codec.decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(ids)
            yield common.batch_of(schema, batch.column(0), counts, digests, decoded, *([lists] if with_ids else []))

    names = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, names)
