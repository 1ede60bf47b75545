"""Substring deduplication by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import fresh, size_blocks, text_column, texts_of
from starward.sources.scratch import staged

#: Text bytes that one step works on.
BLOCK = 2 << 20
#: Words that a span needs, so that chance repeats don't count.  A span is as many sentences as it takes.
SPAN_WORDS = 12
#: Sentences of more words are cut behind each word whose hash is the smallest of its own and so many to either side, which
#: makes parts of nine words on average and of five at least; each part counts as a sentence.  Whether there is a cut depends on
#: those words alone, so a passage is cut alike wherever it stands, but for its outermost words.
SPLIT_WORDS, SPLIT_REACH = 12, 4
#: A sentence ends after . ! ? and white space, after a full-width stop, and at a line's end; the white space is its own.
END = re.compile(rb"[.!?]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*|(?:\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)[\x20\x09-\x0D]*")
#: White space inside a sentence other than single spaces.
ODD_SPACE = re.compile(rb"[\x09\x0B-\x0D]|  ")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def sentences(text: bytes) -> np.ndarray:
    """End offset of each sentence or part of a long one; together they cover the text."""
    ends = [m.end() for m in END.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return _cut_long(text, np.array(ends, np.int64))


def _cut_long(text: bytes, ends: np.ndarray) -> np.ndarray:
    """``ends`` and those of the parts; white space behind a part is its own."""
    raw = np.frombuffer(text, np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1  # of words, but for one at the text's start
    first = np.concatenate(([0], ends[:-1]))
    words = np.searchsorted(starts, ends) - np.searchsorted(starts, first, side="right") + 1
    if not (words > SPLIT_WORDS).any():
        return ends
    last = np.flatnonzero(~white[:-1] & white[1:])  # last byte of each word that has something behind it
    leading = 0
    if white[0]:
        leading, starts = starts[0], starts[1:]
    last = last[: len(starts)]  # the word before each start
    one, two, three = raw[last].astype(np.uint32), raw[np.maximum(last - 1, 0)].astype(np.uint32), raw[np.maximum(last - 2, 0)].astype(np.uint32)
    two[(last < 1) | white[np.maximum(last - 1, 0)]] = 0
    three[(last < 2) | (two == 0) | white[np.maximum(last - 2, 0)]] = 0
    length = (last - np.concatenate(([leading], starts[:-1]))).astype(np.uint32)
    mixed = (one | two << np.uint32(8) | three << np.uint32(16) | length << np.uint32(24)) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA77)
    smallest = np.ones(len(mixed), bool)
    for i in range(1, SPLIT_REACH + 1):
        smallest[i:] &= mixed[i:] < mixed[:-i]
        smallest[:-i] &= mixed[:-i] <= mixed[i:]
    cuts = starts[smallest]
    inside = np.searchsorted(ends, cuts, side="left")  # the sentence that a cut at this place lies in
    cuts = cuts[words[np.minimum(inside, len(ends) - 1)] > SPLIT_WORDS]
    return np.unique(np.concatenate((ends, cuts)))


def spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``ends`` of sentences, and for each span its first sentence, its number of sentences, and two hashes (64 and 32 bits).

    A run of sentences is a span if it has ``SPAN_WORDS`` words and lacks them without its first or without its last sentence.
    Each sentence of a longer run lies under a span inside it, so longer ones would find nothing more.  Words count as they are;
    the white space between them doesn't.
    """
    ends = sentences(text)
    digest = xxhash.xxh3_64_intdigest
    starts = [0, *ends[:-1].tolist()]
    parts = [text[s:e].strip() for s, e in zip(starts, ends.tolist(), strict=False)]
    if ODD_SPACE.search(text):
        parts = [b" ".join(p.split()) for p in parts]
    n = np.fromiter((p.count(b" ") + 1 if p else 0 for p in parts), np.int64, len(parts))
    h = np.fromiter(map(digest, parts), np.uint64, len(parts))
    run = np.concatenate(([0], np.cumsum(n)))
    first, many, one, two = [], [], [], []
    for k in range(1, min(len(h), SPAN_WORDS) + 1):
        less = run[k - 1 :] - run[: len(run) - k + 1]  # words of each run of one sentence fewer
        if k > 1 and less.min() >= SPAN_WORDS:
            break
        taken = (run[k:] - run[:-k] >= SPAN_WORDS) & (np.minimum(less[:-1], less[1:]) < SPAN_WORDS)
        at = np.flatnonzero(taken)
        mixed, sum_ = np.full(len(at), k, np.uint64), np.zeros(len(at), np.uint64)
        for i in range(k):
            each = h[at + i]
            mixed = (mixed ^ each) * _MIX[i % 3]
            mixed ^= mixed >> np.uint64(29)
            sum_ += each * _MIX[(i + 1) % 3]
        first.append(at)
        many.append(np.full(len(at), k))
        one.append(mixed)
        two.append(((mixed * _MIX[1] + sum_) >> np.uint64(32)).astype(np.uint32))
    if not first:
        none = np.zeros(0, np.int64)
        return ends, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return ends, np.concatenate(first), np.concatenate(many), np.concatenate(one), np.concatenate(two)


def _first_places(first: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Whether each span is the first of its hash in its text."""
    order = np.lexsort((first, one))
    same = np.zeros(len(order), bool)
    same[1:] = one[order][1:] == one[order][:-1]
    leading = np.empty(len(order), bool)
    leading[order] = ~same
    return leading


def without_repeats(text: bytes, seen_before: np.ndarray) -> tuple[bytes, int, int]:
    """The text without sentences that a span repeats, in this text or by its hash in ``seen_before``; all and removed sentences."""
    ends, first, many, one, _ = spans(text)
    gone = ~_first_places(first, one) | np.isin(one, seen_before)
    if not gone.any():
        return text, len(ends), 0
    cover = np.zeros(len(ends) + 1, np.int64)
    np.add.at(cover, first[gone], 1)
    np.add.at(cover, first[gone] + many[gone], -1)
    removed = np.cumsum(cover[:-1]) > 0
    starts = np.concatenate(([0], ends[:-1]))
    kept = b"".join(text[s:e] for s, e, r in zip(starts.tolist(), ends.tolist(), removed.tolist(), strict=True) if not r)
    return kept, len(ends), int(removed.sum())


def _hashes(text: Column) -> Column:
    """Whether a text repeats a span of its own, and an array of (h1, h2) with each of its spans once."""

    @F.arrow_udf("struct<own:boolean,s:array<struct<h1:bigint,h2:int>>>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            ones, twos, counts, own = [], [], [], []
            for t in texts_of(block):
                _, first, _, one, two = spans(t)
                leading = _first_places(first, one)
                ones.append(one[leading])
                twos.append(two[leading])
                counts.append(int(leading.sum()))
                own.append(not leading.all())
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            both = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([*ones, np.zeros(0, np.uint64)]).view(np.int64)),
                    pa.array(np.concatenate([*twos, np.zeros(0, np.uint32)]).view(np.int32)),
                ],
                ["h1", "h2"],
            )
            lists = pa.ListArray.from_arrays(pa.array(offsets), both)
            yield pa.StructArray.from_arrays([pa.array(own, pa.bool_()), lists], ["own", "s"])

    return hashed.asNondeterministic()(text)


def _cleaned(text: Column, hashes: Column, clean: Column) -> Column:
    """The text without repeats; ``clean`` texts are known to have none and are only counted."""

    @F.arrow_udf("struct<text:string,n_sentences:bigint,n_removed:bigint>")
    def cleaned(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for block, seen, known_clean in size_blocks(batches, BLOCK):
            found = []
            for t, s, whole in zip(texts_of(block), seen, known_clean.to_pylist(), strict=True):
                if whole:
                    found.append((t, len(sentences(t)), 0))
                    continue
                known = np.zeros(0, np.uint64) if not s.is_valid else s.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                found.append(without_repeats(t, known))
            texts = pa.array([x[0] for x in found], pa.binary()).cast(pa.string())
            if block.null_count:
                texts = pa.compute.if_else(pa.compute.is_null(block), pa.scalar(None, pa.string()), texts)
            counts = [pa.array([x[i] for x in found], pa.int64()) for i in (1, 2)]
            yield pa.StructArray.from_arrays([texts, *counts], ["text", "n_sentences", "n_removed"])

    return cleaned.asNondeterministic()(text, hashes, clean)


def drop_repeated_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with cleaned texts and two more columns, ``n_sentences`` and ``n_removed`` (before them, underscores if taken).

    Every run of consecutive sentences that just has ``SPAN_WORDS`` words is hashed.  All hashes meet in one aggregate, which finds those in several documents and the
    smallest id that has each.  A sentence goes if any span over it occurs in a document with a smaller id
    or earlier in its own text; the rest of the text stays byte for byte.

    Rows of one id count as one document: they don't take sentences from each other.  Rows without an id are
    compared with their own text only.  Null texts stay null, empty ones and those of white space stay as they
    are; a text may become empty.  An empty table gives no rows.

    Spans are written once with their ids; an id's hashes that others have first come back as one list,
    bounded by its own texts, so a span that a third of all documents share is only counted, never gathered.
    """
    body, key = text_column(df, text), text_column(df, doc_id)
    named = df.where(key.isNotNull() & body.isNotNull()).select(key.alias("id"), _hashes(body).alias("f"))
    hashed = staged(named.select("id", "f.own", "f.s"), "spans")
    rows = hashed.select("id", F.inline("s"))
    several = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = rows.join(several, ["h1", "h2"]).where("id > first").select("id", "h1")
    mine, hashes, found = fresh(df, "span_id"), fresh(df, "span_hashes"), fresh(df, "span_found")
    # An id is here if it has anything to remove; nulls are no hashes.
    own = hashed.where("own").select("id", F.lit(None).cast("bigint").alias("h1"))
    lists = later.unionByName(own).groupBy(F.col("id").alias(mine)).agg(F.collect_set("h1").alias(hashes))
    clean = key.isNotNull() & F.col(mine).isNull()
    joined = df.join(lists, key == F.col(mine), "left").withColumn(found, _cleaned(body, F.col(hashes), clean))
    cleaned = [F.col(f"{found}.text").alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    counts = [F.col(f"{found}.{c}").alias(fresh(df, c)) for c in ("n_sentences", "n_removed")]
    return joined.select(*cleaned, *counts)


def remaining(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with cleaned texts; rows of which nothing but white space is left go."""
    cleaned = drop_repeated_spans(df, doc_id, text)
    removed = cleaned.columns[-1]
    return cleaned.where((F.col(removed) == 0) | text_column(df, text).rlike(r"[^\x20\x09-\x0D]")).select(*[f"`{c}`" for c in df.columns])
