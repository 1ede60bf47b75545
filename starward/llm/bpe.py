"""Byte-level BPE ids of whole texts through a table of distinct words, and back through a table of pieces."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import size_blocks, text_column
from starward.llm.tokens import byte_letters, encoder

#: A word is in the shared table if it makes up this part of all words, so the table has at most 2**20 rows
#: however many texts there are.
ENTRIES = 1 << 20
BLOCK = 4 << 20
#: A single space with something other than white space on both sides: words of the model never reach over it.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_PLAIN = re.compile(r" \s|\s ")


def words_of(text: str) -> list[str]:
    """``text`` cut before each single space, which stays with what follows; joined again they are the text.

    White space of any other kind stays inside a word, with what is around it.
    """
    if _PLAIN.search(text):
        return _CUT.split(text)
    head, *rest = text.split(" ")
    return [head, *map(" ".__add__, rest)] if head or not rest else [" " + w for w in rest]


@dataclass
class WordTable:
    """Sorted word hashes, a second hash to be sure, and each word's ids."""

    keys: np.ndarray
    checks: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray

    def find(self, words: list[str]) -> np.ndarray:
        """Row of each word, or -1."""
        if not len(self.keys) or not words:
            return np.full(len(words), -1)
        raw = [w.encode() for w in words]
        wanted = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))
        checks = np.fromiter(map(xxhash.xxh32_intdigest, raw), np.uint32, len(raw))
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (self.checks[at] == checks), at, -1)


@dataclass
class Pieces:
    """The bytes of each id."""

    offsets: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, path: str) -> Pieces:
        known = encoder(path)
        if known.fast is None:
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        vocab = known.library.get_vocab(with_added_tokens=True)
        pieces = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            pieces[i] = token.encode() if token in known.special else bytes(letters[c] for c in token)
        return cls(np.concatenate(([0], np.cumsum([len(p) for p in pieces]))), np.frombuffer(b"".join(pieces), np.uint8))

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids' bytes one after another, and where each id's end."""
        return _gather(self.data, self.offsets, ids)


def _gather(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows of a ragged array, joined, and the end of each."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(offsets[rows] - (ends - sizes), sizes) + np.arange(total)
    return flat[at], ends


def _ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.concatenate(([0], np.cumsum(sizes))), np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))


def distinct_words(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows of ``texts (text)``; each block is counted before the shuffle."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,) in size_blocks(((b.column(0),) for b in batches), BLOCK):
            counts: dict[str, int] = {}
            for text in block.to_pylist():
                for w in words_of(text or ""):
                    counts[w] = counts.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    return texts.mapInArrow(emit, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(texts: DataFrame, path: str, entries: int = ENTRIES) -> WordTable:
    """The shared part of the word table: each word encoded once; at most ``entries`` rows reach the driver."""
    from starward.sources.scratch import staged

    words = staged(distinct_words(texts), "words")
    least = (words.agg(F.sum("n")).first()[0] or 0) / entries

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown = batch.column(0).to_pylist()
            raw = [w.encode() for w in shown]
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)) ^ np.uint64(1 << 63)
            checks = np.fromiter(map(xxhash.xxh32_intdigest, raw), np.uint32, len(raw))
            ids = [np.array(x, np.uint32).tobytes() for x in encoder(path).encode(shown)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(checks.view(np.int32)), pa.array(ids, pa.binary())], ["h", "c", "ids"])

    shared = words.where(F.col("n") >= least).select("word")
    found = shared.mapInArrow(encode, "h bigint, c int, ids binary").orderBy("h").toArrow()
    column = found["ids"].combine_chunks() if found.num_rows else pa.array([], pa.binary())
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = np.array([len(x) for x in column.to_pylist()], np.int64) // 4
    return WordTable(
        found["h"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63),
        found["c"].to_numpy().view(np.uint32),
        np.concatenate(([0], np.cumsum(sizes))),
        np.frombuffer(b"".join(column.to_pylist()), np.uint32),
    )


def encode_block(texts: list[str], table: WordTable, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, joined, and where each text's end.

    Each distinct word of the block is looked up once; those that are too rare for the shared table are
    encoded here, once.  Ids come back to every occurrence by its word's number.
    """
    number: dict[str, int] = {}
    codes: list[int] = []
    ends = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        codes.extend([number.setdefault(w, len(number)) for w in words_of(text)])
        ends[i] = len(codes)
    words = list(number)
    rows = table.find(words)
    rare = np.flatnonzero(rows < 0)
    own_offsets, own_ids = _ragged(encoder(path).encode([words[i] for i in rare.tolist()]))
    rows[rare] = len(table.keys) + np.arange(len(rare))
    offsets = np.concatenate((table.offsets, table.offsets[-1] + own_offsets[1:]))
    ids, word_ends = _gather(np.concatenate((table.ids, own_ids)), offsets, rows[np.array(codes, np.int64)])
    return ids, np.concatenate(([0], word_ends))[ends]


def encoded(text: Column, path: str, table) -> Column:
    """A list of ids for each text; ``table`` is a broadcast word table."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            ids, ends = encode_block([x or "" for x in block.to_pylist()], table.value, path)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.view(np.int32)))

    return encode.asNondeterministic()(text)


def decode_lists(ids: np.ndarray, ends: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The text of each list of ids; bytes that are no UTF-8 become the replacement character."""
    data, piece_ends = pieces.join(ids)
    bounds = np.concatenate(([0], piece_ends))[np.concatenate(([0], ends))].tolist()
    joined = data.tobytes()
    return [joined[a:b].decode("utf-8", "replace").encode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def decoded(ids: Column, path: str) -> Column:
    """The text of each list of ids, special tokens included; null lists are null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces.of(path)
        for batch in batches:
            ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(batch), 0).to_numpy(zero_copy_only=False))
            texts = decode_lists(batch.flatten().to_numpy(zero_copy_only=False).view(np.uint32), ends, pieces)
            found = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.compute.if_else(pa.compute.is_null(batch), pa.scalar(None, pa.string()), found)

    return decode.asNondeterministic()(ids)


def _digests(text: Column, path: str, table) -> Column:
    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces.of(path)
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            ids, ends = encode_block([x or "" for x in block.to_pylist()], table.value, path)
            bounds = np.concatenate(([0], ends)).tolist()
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            texts = [hashlib.sha256(t).hexdigest() for t in decode_lists(ids, ends, pieces)]
            yield pa.StructArray.from_arrays([pa.array(np.diff(bounds)), pa.array(sums, pa.string()), pa.array(texts, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest.asNondeterministic()(text)


def word_table(df: DataFrame, path: str, text: str = "text", entries: int = ENTRIES):
    """The shared word table of a column's texts, as a broadcast."""
    body = text_column(df, text)
    return df.sparkSession.sparkContext.broadcast(frequent_words(df.where(body.isNotNull()).select(body.alias("text")), path, entries))


def encode_and_decode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", entries: int = ENTRIES) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, a row for each row of ``df``.

    Null texts count as empty: no tokens, and the checksums of nothing.  Special strings in a text become their
    ids, as the library has it.  Null ids and repeated rows stay.  An empty table gives no rows.  Further columns
    are ignored.
    """
    found = F.col("found")
    out = df.select(text_column(df, doc_id).alias("doc_id"), _digests(text_column(df, text), path, word_table(df, path, text, entries)).alias("found"))
    return out.select("doc_id", *(found[c].alias(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")))
