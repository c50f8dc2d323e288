"""Byte-level BPE encoding and decoding with the tiktoken library.

Ranks come from a local file. Every match of the split pattern is encoded by
itself and no special token is recognised. Long texts are first cut at safe
boundaries: between a character that is not white space and a following space
or line feed. No match of ``public_tokenizers.PATTERN`` holds white space after another
character (for another pattern, say so only if that holds for it too), so such a place is always a boundary between two matches, and what
follows is matched without regard to what stands before it; the ids of the
pieces, one after the other, are the ids of the whole text.

Defined results: null text counts as empty and gives no ids; a text without a
safe boundary is encoded in one piece; repeated rows each get their ids; other
columns are not read.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from daybook.llm.common import arrow_map, kept_by_worker

#: Texts of more characters are cut, at the first safe boundary after so many.
PIECE_CHARS = 1 << 16
SAFE_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")


def load_encoding(rank_file: str, pattern: str):
    """The encoding of a rank file: one line ``base64-bytes rank`` per token."""

    def build():
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return kept_by_worker(f"encoding {rank_file} {pattern}", build)


def safe_pieces(text: str, piece_chars: int = PIECE_CHARS):
    """Pieces of about ``piece_chars`` characters that encode independently."""
    start, end = 0, len(text)
    while end - start > piece_chars:
        cut = SAFE_BOUNDARY.search(text, start + piece_chars)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding, text: str | None, piece_chars: int = PIECE_CHARS) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit integers."""
    if not text:
        return np.empty(0, dtype="<u4")
    if len(text) <= piece_chars:
        return np.asarray(encoding.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
    return np.concatenate([np.asarray(encoding.encode_to_numpy(p, disallowed_special=()), dtype="<u4") for p in safe_pieces(text, piece_chars)])


def encode(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Columns ``doc_id, n_tokens, ids``; ids packed as little-endian unsigned 32-bit integers."""
    schema = StructType([StructField("doc_id", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = load_encoding(rank_file, pattern)
        packed = [encode_text(encoding, t.as_py(), piece_chars).tobytes() for t in batch.column(1)]
        return pa.record_batch([batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())], names=schema.names)

    return arrow_map(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Columns ``doc_id, n_tokens, ids, decoded``: the raw bytes of the ids, valid UTF-8 or not."""
    schema = StructType([StructField("doc_id", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", BinaryType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding = load_encoding(rank_file, pattern)
        decoded = [encoding.decode_bytes(np.frombuffer(p.as_py(), dtype="<u4").tolist()) for p in batch.column(2)]
        return pa.record_batch([*batch.columns[:3], pa.array(decoded, pa.binary())], names=schema.names)

    return arrow_map(df.select("doc_id", "n_tokens", "ids"), run, schema)


def token_arrays(encoded: DataFrame) -> DataFrame:
    """``encode``'s rows with the ids as array<long>, for readers that want them unpacked."""
    digits = F.hex("ids")
    byte = lambda i, k: F.conv(F.substring(digits, i * 8 + 1 + 2 * k, 2), 16, 10).cast("long")
    value = lambda i: byte(i, 0) + byte(i, 1) * 256 + byte(i, 2) * 65536 + byte(i, 3) * 16777216
    ids = F.when(F.col("n_tokens") > 0, F.transform(F.sequence(F.lit(0), (F.col("n_tokens") - 1).cast("int")), value)).otherwise(F.array().cast("array<bigint>"))
    return encoded.withColumn("token_ids", ids)


def round_trip_digests(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""
    decoded = decode(encode(df, rank_file, pattern), rank_file, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
