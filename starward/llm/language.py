"""Language identification by bit-sliced Bloom filters of n-grams, one bit for each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starward.llm.common import fresh, size_blocks, text_column
from starward.sources.scratch import staged

#: An n-gram belongs to a language if it makes up this part of the language's n-grams, so a language has at
#: most 131,072 of them however large the corpus is ...
MIN_RATE = 2.0**-17
#: ... and if it is at least this part as frequent there as where it is most frequent.
MIN_SHARE = 0.5
HASHES = 4
#: Slots for each stored n-gram; the table is rounded up to a power of two.
SLOTS_EACH = 4
#: Documents of the training part whose score is lower are no language that was learned.
MIN_SCORE = 0.25
UNKNOWN = "und"
#: Arrays of eight bytes a character are held for a block, several at a time.
BLOCK = 2 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letter trigrams of the lower-cased texts, each packed exactly into 63 bits; the text each is in; letters by text.

    Whatever is no letter counts as a space; the middle of a trigram is a letter, so no trigram spans two words.
    """
    padded = [f" {t.lower()} " if t else " " for t in texts]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[points]
    owner = np.repeat(np.arange(len(texts)), sizes)
    middle = np.flatnonzero(is_letter[1:-1]) + 1
    clean = np.where(is_letter, points, np.uint32(32)).astype(np.int64)
    grams = (clean[middle - 1] << 42) | (clean[middle] << 21) | clean[middle + 1]
    of = owner[middle]
    return grams, of, np.bincount(of, minlength=len(texts))


def slots(grams: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The ``HASHES`` slots of each n-gram in a table of ``size``, a power of two."""
    x = grams.view(np.uint64)
    one = (x ^ (x >> np.uint64(31))) * _M1
    one ^= one >> np.uint64(32)
    two = (one * _M2) | np.uint64(1)
    for i in range(HASHES):
        yield ((one + np.uint64(i) * two) >> np.uint64(20)) & np.uint64(size - 1)


@dataclass
class Filters:
    """``masks[w, slot]`` has bit b set if the slot belongs to an n-gram of language 64 w + b; languages stand by weight."""

    langs: list[str]
    masks: np.ndarray

    def chances(self) -> np.ndarray:
        """How often each language's filter claims an n-gram that it doesn't hold: all its slots happen to be set."""
        size = self.masks.shape[1]
        fill = [np.count_nonzero(self.masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / size for i in range(len(self.langs))]
        return np.array(fill) ** HASHES

    def predict(self, texts: list[str | None], chances: np.ndarray) -> tuple[list[str], np.ndarray]:
        grams, of, n = trigrams(texts)
        places = list(slots(grams, self.masks.shape[1]))
        found = np.zeros((len(texts), len(self.langs)))
        for w in range(len(self.masks)):
            claimed = self.masks[w][places[0]]
            for p in places[1:]:
                claimed &= self.masks[w][p]
            for b in range(min(64, len(self.langs) - 64 * w)):
                hit = (claimed >> np.uint64(b)) & np.uint64(1)
                found[:, 64 * w + b] = np.bincount(of[hit.astype(bool)], minlength=len(texts))
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = np.maximum(n, 1)[:, None]
        share = np.clip((found / total - chances) / np.maximum(1 - chances, 1e-9), 0, 1)
        best = share.argmax(axis=1)
        score = np.where(n > 0, share[np.arange(len(texts)), best], 0.0)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)], score


def counted_trigrams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``docs (text, lang)``; each block is summed before the shuffle."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, lang in size_blocks(((b.column(0), b.column(1)) for b in batches), BLOCK):
            coded = lang.dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            grams, of, _ = trigrams(text.to_pylist())
            for i, name in enumerate(names):
                each, n = np.unique(grams[codes[of] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(each), pa.string()), pa.array(each), pa.array(n)], ["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(emit, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> Filters:
    """Filters of the languages of ``docs (text, lang)``, both not null.

    What reaches the driver is the table itself, whose rows are bounded by the stored n-grams, and a row a language.
    """
    counted = staged(counted_trigrams(docs), "trigrams")
    totals = staged(counted.groupBy("lang").agg(F.sum("n").alias("total")), "totals")  # its size decides how it is joined
    weights = {r["lang"]: r["total"] for r in totals.collect()}
    langs = sorted(weights, key=lambda x: (-weights[x], x))
    rates = counted.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate")).where(F.col("rate") >= MIN_RATE)
    highest = F.max("rate").over(Window.partitionBy("gram"))  # a row a language
    members = staged(rates.withColumn("highest", highest).where(F.col("rate") >= MIN_SHARE * F.col("highest")).select("lang", "gram"), "members")
    size = 1 << max(10, int(members.count() * SLOTS_EACH - 1).bit_length())
    number = {x: i for i, x in enumerate(langs)}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.fromiter((number[x] for x in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            bits = (np.uint64(1) << (of % 64).astype(np.uint64)).view(np.int64)
            for places in slots(batch.column(1).to_numpy(), size):
                yield pa.RecordBatch.from_arrays([pa.array(of // 64), pa.array(places.view(np.int64)), pa.array(bits)], ["w", "slot", "bits"])

    table = members.mapInArrow(emit, "w bigint, slot bigint, bits bigint").groupBy("w", "slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    masks = np.zeros((max(1, -(-len(langs) // 64)), size), np.uint64)
    masks[table["w"].to_numpy(), table["slot"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return Filters(langs, masks)


def predicted(text: Column, filters) -> Column:
    """A struct of ``lang_pred`` and ``score``; ``filters`` is a broadcast."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chances = filters.value.chances()
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            langs, score = filters.value.predict(block.to_pylist(), chances)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return predict.asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, by their checksum; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _filters(df: DataFrame, doc_id: str, text: str, lang: str):
    body, code = text_column(df, text), text_column(df, lang)
    known = df.where(~held_out(text_column(df, doc_id)) & code.isNotNull() & body.isNotNull())
    return df.sparkSession.sparkContext.broadcast(learn(known.select(body.alias("text"), code.alias("lang"))))


def identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, a row for each row of ``df``; no shuffle of texts.

    The score is the part of a text's n-grams that the language holds, less what its filter would claim by chance.
    Equal scores go to the language with more training text.

    Null texts and texts without a letter are ``und`` with score 0, as are all if no row can be learned from.  Null
    ids aren't held out.  Rows without a language teach nothing but are predicted.  Repeated rows stay.  An empty table
    gives no rows.  Further columns are ignored.
    """
    found = F.col("found")
    key = text_column(df, doc_id)
    out = df.select(key.alias("doc_id"), held_out(key).alias("held_out"), predicted(text_column(df, text), _filters(df, doc_id, text, lang)).alias("found"))
    return out.select("doc_id", "held_out", found.lang_pred.alias("lang_pred"), found.score.alias("score"))


def in_a_language(df: DataFrame, least: float = MIN_SCORE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text is in a learned language with a score of at least ``least``; all columns stay."""
    found = fresh(df, "found")
    out = df.withColumn(found, predicted(text_column(df, text), _filters(df, doc_id, text, lang)))
    return out.where((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least)).drop(found)
