"""Encoding of the whole corpus with a public tokenizer (byte-level BPE from a local rank file).

Texts travel as Arrow batches to the tiktoken library; each Python worker loads the rank file once. A long text is cut
at safe boundaries first: before white space that follows a visible character, where the splitting pattern can never
join the two sides, so the ids are the same as for the whole text and the library never sees a piece above
`PIECE` characters unless the text has no such place.

Defined results: null and empty texts have an empty list of ids; strings of special tokens are ordinary text; repeated
rows are encoded each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

if TYPE_CHECKING:
    import pyarrow as pa

RANKS = os.environ.get("ALLOCATA_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE = 20_000
_SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(ranks: str = RANKS):
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cuts of a text at safe boundaries, each of about `size` characters; joined they are the text."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(text: str | None, ranks: str = RANKS) -> list[int]:
    if not text:
        return []
    enc = encoding(ranks)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    out: list[int] = []
    for piece in pieces(text):
        out += enc.encode_ordinary(piece)
    return out


def decode(ids: list[int], ranks: str = RANKS) -> bytes:
    """Raw bytes of the ids: exact even where a cut falls inside a character."""
    return b"".join(encoding(ranks).decode_single_token_bytes(i) for i in ids)


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(key, ids): ids ARRAY<INT> of every text."""
    rows = documents.select(key, text)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            # Long texts make batches of very different weight; small slices keep what is in memory small.
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = pa.array([encode(t, ranks) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [key, "ids"])

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(key, n_tokens): sizes only, so no list of ids leaves the Python worker."""
    rows = documents.select(key, text)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            sizes = pa.array([len(encode(t, ranks)) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes], [key, "n_tokens"])

    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")
