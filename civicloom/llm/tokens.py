"""Documents as token ids, cut into pieces."""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from civicloom.llm.common import text_of

END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Below this code point both libraries' pattern engines put every character in the same class.
PLAIN_BELOW = 0x250


@functools.cache
def encoder(tokenizer: str = "byte_bpe_50k"):
    """``text -> ids`` of a byte-level BPE, special tokens as ordinary text.

    The vocabulary comes as a tokenizers file and as ranks of the same ids. Plain text
    takes the ranks, which tiktoken encodes four times as fast; any other text takes
    the tokenizers file itself. The tests hold the two against each other.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path(f"{tokenizer}.json"))
    full.encode_special_tokens = True
    with open(public_tokenizers.path(f"{tokenizer}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if text.isascii() or max(text) < chr(PLAIN_BELOW):
            return np.asarray(fast.encode_ordinary(text), "<u4")
        return np.asarray(full.encode(text, add_special_tokens=False).ids, "<u4")

    return encode


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """``(start, ids)`` of each piece; all but the first are full."""
    first = len(ids) % capacity or min(len(ids), capacity)
    starts = [0, *range(first, len(ids), capacity)]
    return [(a, ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document's ids and its end id; null text is empty, so it is the end id alone.

    A null ``doc_id`` stays null; rows that repeat are packed as often as they come.
    ``with_ids`` adds the piece's ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = [
                (doc, k, start, len(ids), zlib.crc32(ids.tobytes()), ids if with_ids else None)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for k, (start, ids) in enumerate(cut(np.append(encode(text), np.uint32(END_ID)).astype("<u4"), capacity))
            ]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            width = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:width], kinds)], names[:width])

    rows = docs.selectExpr("cast(doc_id AS bigint) doc_id", "text").select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(run, PIECES + (", ids array<bigint>" if with_ids else ""))
