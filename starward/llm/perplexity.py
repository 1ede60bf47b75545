"""Quality rules: plain counts of a text, and bands of its perplexity under a character n-gram model.

The model is an interpolated modified Kneser-Ney model of the characters within words, one for each
language.  It is counted in Spark over all documents; no n-gram reaches over a word's ends, so a word's
score is a property of the word and each distinct word of a block is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import fresh, size_blocks, text_column, texts_of
from starward.sources.scratch import staged

ORDER = 5
#: Entries of the models that are sent to the executors at once (twelve bytes each).  Languages are dealt to as many models as that
#: takes, each with its own pass over its documents, so what is stored grows with the corpus and what a task holds does not.  A language
#: is not parted; how many n-grams of five letters inside words it can have is bounded by its letters.
MODEL_ENTRIES = 1 << 24
#: N-grams of three and more letters are stored from this count on: what stands only once says nothing about
#: the text that it was counted in.
LEAST_COUNT = 2
#: Band around a language's median log perplexity: so many quartile ranges each way.
BAND_RANGES = 6.0
BLOCK = 2 << 20
START, END = "\x02", "\x03"
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_M = np.uint64(0x9E3779B97F4A7C15)


# --- counts of single texts -------------------------------------------------------------------


@dataclass
class Words:
    """The words of a block: distinct ones, the number of each occurrence, and the text it is in."""

    distinct: list[bytes]
    codes: np.ndarray
    owner: np.ndarray
    per_text: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    split = [t.split() for t in texts]
    per_text = np.fromiter(map(len, split), np.int64, len(split))
    number: dict[bytes, int] = {}
    for words in split:
        for w in words:
            if w not in number:
                number[w] = len(number)
    codes = np.fromiter((number[w] for words in split for w in words), np.int64, int(per_text.sum()))
    return Words(list(number), codes, np.repeat(np.arange(len(texts)), per_text), per_text)


def base_counts(texts: list[bytes], words: Words) -> dict[str, np.ndarray]:
    n = len(texts)
    lengths = np.fromiter((len(w.decode("utf-8", "replace")) for w in words.distinct), np.int64, len(words.distinct))
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n))
    symbols = np.searchsorted(ends, np.flatnonzero(_SYMBOLS[buffer]), side="right")
    lines = [[x for x in t.split(b"\n") if x.strip()] if b"\n" in t else () for t in texts]
    return {
        "n_words": words.per_text,
        "word_chars": np.bincount(words.owner, lengths[words.codes], n).astype(np.int64),
        "n_symbols": np.bincount(symbols, minlength=n).astype(np.int64),
        "n_dup_lines": np.fromiter((len(x) - len(set(x)) for x in lines), np.int64, n),
        "n_repeat_words": _repeated_words(words, n),
    }


def _repeated_words(words: Words, n: int, window: int = 5) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    total = len(words.codes)
    if total < window:
        return np.zeros(n, np.int64)
    starts = np.flatnonzero(words.owner[: total - window + 1] == words.owner[window - 1 :])
    h = (words.owner[starts].astype(np.uint64) + np.uint64(1)) * _M
    for i in range(window):
        h = (h ^ words.codes[starts + i].astype(np.uint64)) * _M
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(total + 1, np.int64)
    cover[starts[twice]] += 1
    cover[starts[twice] + window] -= 1
    return np.bincount(words.owner[np.cumsum(cover[:-1]) > 0], minlength=n).astype(np.int64)


# --- n-grams ----------------------------------------------------------------------------------


@dataclass
class Grams:
    """Distinct (language, n-gram) pairs of a block, and the one at each character of its distinct words."""

    letters: np.ndarray  # a row of ORDER code points for each pair
    langs: np.ndarray  # the pair's language, by number
    joined: str  # all padded words
    at: np.ndarray  # where in ``joined`` the pair first stands
    inverse: np.ndarray  # pair at each character, word by word
    word_starts: np.ndarray  # first character of each word in ``inverse``
    word_of: np.ndarray  # (language, word) of each occurrence


def grams_of(words: Words, lang: np.ndarray, order: int = ORDER) -> Grams:
    """``lang`` numbers each text's language."""
    many = max(len(words.distinct), 1)
    pairs, word_of = np.unique(lang[words.owner] * many + words.codes, return_inverse=True)
    shown = [words.distinct[i].decode("utf-8", "replace") for i in (pairs % many).tolist()]
    pad = START * (order - 1)
    joined = "".join([pad + w + END for w in shown])
    letters = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, shown), np.int64, len(shown)) + 1
    word_starts = np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)
    begins = word_starts + np.arange(len(shown)) * (order - 1)
    places = np.repeat(begins - word_starts, sizes) + np.arange(int(sizes.sum()))
    langs = np.repeat(pairs // many, sizes)
    h = (langs.astype(np.uint64) + np.uint64(1)) * _M
    for i in range(order):
        h = (h ^ letters[places + i].astype(np.uint64)) * _M
        h ^= h >> np.uint64(29)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    at = places[first]
    rows = letters[at[:, None] + np.arange(order)] if len(at) else np.zeros((0, order), np.uint32)
    return Grams(rows, langs[first], joined, at, inverse, word_starts, word_of)


def gram_hash(lang_seed: np.ndarray, letters: np.ndarray, kind: int) -> np.ndarray:
    """Hash of rows of letters, apart for each language, length and kind (0 n-gram, 1 context)."""
    h = lang_seed ^ np.uint64(2 * letters.shape[1] + kind)
    for i in range(letters.shape[1]):
        h = (h ^ letters[:, i].astype(np.uint64)) * _M
        h ^= h >> np.uint64(32)
    return h


def lang_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _codes(langs: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = langs.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def counted_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, c`` over all rows of ``docs (text, lang)``; each block is summed before the shuffle."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, lang in size_blocks(((b.column(0), b.column(1)) for b in batches), BLOCK):
            names, codes = _codes(lang)
            g = grams_of(words_of(texts_of(text)), codes, order)
            uses = np.bincount(g.word_of, minlength=len(g.word_starts))
            sizes = np.diff(np.append(g.word_starts, len(g.inverse)))
            count = np.bincount(g.inverse, np.repeat(uses, sizes), len(g.at)).astype(np.int64)
            shown = [g.joined[i : i + order] for i in g.at.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(pa.array(g.langs)), pa.array(shown, pa.string()), pa.array(count)],
                ["lang", "gram", "c"],
            )

    return docs.select("text", "lang").mapInArrow(emit, "lang string, gram string, c bigint").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


# --- the model --------------------------------------------------------------------------------


@dataclass
class Model:
    """Sorted hashes with their values: discounted shares of n-grams, back-off shares of contexts."""

    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    backs: np.ndarray
    floor: dict[str, float]

    def log_probability(self, langs: list[str], which: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """ln P(last letter | the ones before), by interpolation from single letters upwards."""
        order = letters.shape[1]
        seeds = np.array([lang_seed(x) for x in langs] or [0], np.uint64)[which]
        p = np.array([self.floor.get(x, 1e-6) for x in langs] or [1.0])[which]
        for n in range(1, order + 1):
            gram, context = letters[:, order - n :], letters[:, order - n : order - 1]
            share = _look_up(self.grams, self.shares, gram_hash(seeds, gram, 0), 0.0)
            back = _look_up(self.contexts, self.backs, gram_hash(seeds, context, 1), 1.0)
            p = share + back * p
        return np.log(np.maximum(p, 1e-12))


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def discounts(n: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3`` from counts of counts; usual values where there are too few."""
    seen = [F.sum((F.col("c") == i).cast("bigint")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.expr("n1 / (n1 + 2 * n2)")

    def d(i: int, plain: float) -> Column:
        found = F.when((F.col("n1") > 0) & (F.col(f"n{i}") > 0), i - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0)))
        return F.when(found.between(0, i), found).otherwise(plain).alias(f"d{i}")

    return n.groupBy("lang").agg(*seen).select("lang", d(1, 0.5), d(2, 1.0), d(3, 1.5))


def kneser_ney(counted: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """N-grams ``(lang, gram, share)``, contexts ``(lang, context, back)`` and ``(lang, floor)``.

    The longest n-grams have their counts; a shorter one counts the different letters before it, or its
    occurrences where it begins a word and nothing else can stand before.
    """
    grams, contexts = [], []
    level = counted.select("lang", "gram", "c", F.col("c").alias("raw"))
    floor = None
    for n in range(order, 0, -1):
        if n < order:
            shorter = F.expr("substring(gram, 2)").alias("gram")
            level = level.groupBy("lang", shorter).agg(F.count("*").alias("different"), F.sum("raw").alias("raw"))
            level = staged(
                level.select("lang", "gram", F.when(F.col("gram").startswith(START), F.col("raw")).otherwise(F.col("different")).alias("c"), "raw"),
                f"grams{n}",
            )
        least = LEAST_COUNT if n >= 3 else 1
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rated = (
            level.join(staged(discounts(level), "discounts"), "lang")  # by its size, not by dealing n-grams to languages
            .withColumn("kept", F.when(F.col("c") >= least, F.col("c") - off))
            .withColumn("context", F.expr(f"substring(gram, 1, {n - 1})"))
        )
        stats = rated.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.coalesce(F.sum("kept"), F.lit(0.0)).alias("mass"))
        shares = rated.where("kept IS NOT NULL").join(stats, ["lang", "context"])
        grams.append(shares.select("lang", "gram", (F.col("kept") / F.col("total")).alias("share")))
        contexts.append(stats.where("mass > 0").select("lang", "context", (1 - F.col("mass") / F.col("total")).alias("back")))
        floor = level.groupBy("lang").agg((1 / (F.count("*") + 1)).alias("floor"))
    both = [x[0] for x in (grams, contexts)]
    for g, c in zip(grams[1:], contexts[1:], strict=True):
        both = [both[0].unionByName(g), both[1].unionByName(c)]
    return both[0], both[1], floor


def sorted_hashes(rows: DataFrame, text: str, value: str, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows, sorted in Spark, and their values; the caller bounds the rows."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, codes = _codes(batch.column(0))
            seeds = np.array([lang_seed(x) for x in names] or [0], np.uint64)
            shown = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, shown), np.int64, len(shown))
            h = np.zeros(len(shown), np.uint64)
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                letters = np.frombuffer("".join(shown[i] for i in at.tolist()).encode("utf-32-le", "surrogatepass"), np.uint32)
                h[at] = gram_hash(seeds[codes[at]], letters.reshape(-1, n) if n else np.zeros((len(at), 0), np.uint32), kind)
            yield pa.RecordBatch.from_arrays([pa.array((h ^ np.uint64(1 << 63)).view(np.int64)), batch.column(2)], ["h", "v"])

    found = rows.select("lang", text, F.col(value).cast("float")).mapInArrow(hashed, "h bigint, v float").orderBy("h").toArrow()
    keys = found["h"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    return keys, found["v"].to_numpy()


def train(docs: DataFrame, order: int = ORDER, entries: int = MODEL_ENTRIES) -> Iterator[tuple[list[str], Model]]:
    """The models of ``docs (text, lang)``, one after the other, each with its languages; they hold about ``entries`` rows or one language."""
    counted = staged(counted_grams(docs, order), "grams")
    grams, contexts, floor = kneser_ney(counted, order)
    grams, contexts = staged(grams, "shares"), staged(contexts, "backs")
    floors = {r["lang"]: r["floor"] for r in floor.collect()}  # a row a language
    sizes = grams.select("lang").unionByName(contexts.select("lang")).groupBy("lang").count()
    for langs in dealt(sorted((r["lang"], r["count"]) for r in sizes.collect()), entries):
        mine = F.col("lang").isin(langs)
        yield langs, Model(
            *sorted_hashes(grams.where(mine), "gram", "share", 0),
            *sorted_hashes(contexts.where(mine), "context", "back", 1),
            {x: floors[x] for x in langs},
        )


def dealt(sizes: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Names in runs whose sizes sum to ``most`` at most, or of one name."""
    runs: list[list[str]] = []
    held = 0
    for name, size in sizes:
        if runs and held + size <= most:
            runs[-1].append(name)
            held += size
        else:
            runs.append([name])
            held = size
    return runs


# --- judging ----------------------------------------------------------------------------------

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(text: Column, lang: Column, model) -> Column:
    """A struct of the plain counts and ``log_perplexity`` (null without words); ``model`` is a broadcast."""
    kind = ",".join(f"{c}:bigint" for c in BASE)

    @F.arrow_udf(f"struct<{kind},log_perplexity:double>")
    def measure(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for block, lang in size_blocks(batches, BLOCK):
            texts = texts_of(block)
            names, codes = _codes(lang)
            words = words_of(texts)
            counts = base_counts(texts, words)
            g = grams_of(words, codes)
            each = model.value.log_probability(names, g.langs, g.letters)[g.inverse]
            sizes = np.diff(np.append(g.word_starts, len(g.inverse)))
            sums = np.add.reduceat(each, g.word_starts) if len(each) else np.zeros(0)
            letters = np.bincount(words.owner, sizes[g.word_of], len(texts))
            logs = np.bincount(words.owner, sums[g.word_of], len(texts))
            score = pa.array(-logs / np.maximum(letters, 1), mask=letters == 0)
            yield pa.StructArray.from_arrays([*(pa.array(counts[c]) for c in BASE), score], [*BASE, "log_perplexity"])

    return measure.asNondeterministic()(text, lang)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def rounded(log_perplexity: Column) -> Column:
    """In thousandths, as bands are; a text may lie exactly on an edge, such as where all of a language are alike."""
    return F.round(log_perplexity, 3)


def bands(scored: DataFrame, ranges: float = BAND_RANGES) -> DataFrame:
    """``lang, lower, upper`` around the median log perplexity of the texts that pass the base rules.

    Values are rounded, so the exact quartiles need one count for each of a few thousand values.
    """
    value = rounded(F.col("log_perplexity"))
    found = scored.where("NOT base_failed").groupBy("lang").agg(F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"))
    reach = ranges * (F.col("q")[2] - F.col("q")[0]) + 0.0005  # half a thousandth, for sums of binary fractions
    return found.select("lang", (F.col("q")[1] - reach).alias("lower"), (F.col("q")[1] + reach).alias("upper"))


def _scored(df: DataFrame, lang: Column, text: Column, model, keep: list[Column]) -> DataFrame:
    m = fresh(df, "measured")
    out = df.withColumn(m, measured(text, lang, model))
    failed = base_failed(F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words"))
    return out.select(*keep, lang.alias("lang"), f"{m}.*", failed.alias("base_failed"))


def _models(df: DataFrame, lang: Column, text: Column, entries: int) -> list[tuple[Column, Broadcast]]:
    """Which rows of ``df`` each model is for, and its broadcast; every row has one, and at most one model is in a task."""
    context = df.sparkSession.sparkContext
    models, known = [], []
    for langs, model in train(df.where(text.isNotNull()).select(text.alias("text"), lang.alias("lang")), entries=entries):
        models.append((lang.isin(langs), context.broadcast(model)))
        known += langs
    if len(models) == 1:
        return [(F.lit(True), models[0][1])]
    none = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    return [*models, (~lang.isin(known) if known else F.lit(True), context.broadcast(Model(*none, *none, {})))]


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", entries: int = MODEL_ENTRIES) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity``, a row for each row.

    ``kept`` is false where the base rules fail or the perplexity lies outside its language's band.

    Null texts count as empty and fail.  A null language is one of its own.  Null ids and repeated rows stay.  A
    language whose texts all fail has no band and keeps none.  An empty table gives no rows.  Further columns are ignored.
    """
    body, code = text_column(df, text), F.coalesce(text_column(df, lang), F.lit(""))
    key = text_column(df, doc_id).alias("doc_id")
    parts = [_scored(df.where(mine), code, body, model, [key]) for mine, model in _models(df, code, body, entries)]
    scored = staged(reduce(DataFrame.unionByName, parts), "scored")
    inside = F.coalesce(rounded(F.col("log_perplexity")).between(F.col("lower"), F.col("upper")), F.lit(False))
    return scored.join(staged(bands(scored), "bands"), "lang", "left").select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & inside).alias("kept"), F.exp("log_perplexity").alias("perplexity")
    )


def kept_documents(df: DataFrame, text: str = "text", lang: str = "lang", entries: int = MODEL_ENTRIES) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with their columns.

    Texts are measured twice, for the bands and for the choice, so that they needn't be shuffled to meet their scores.
    """
    body, code = text_column(df, text), F.coalesce(text_column(df, lang), F.lit(""))
    models = _models(df, code, body, entries)
    scored = staged(reduce(DataFrame.unionByName, [_scored(df.where(mine), code, body, m, []) for mine, m in models]), "scored")
    limits = bands(scored).collect()  # a row a language
    found = fresh(df, "measured")
    log, n, repeated = (F.col(f"{found}.{c}") for c in ("log_perplexity", "n_words", "n_repeat_words"))
    inside = F.lit(False)
    for r in limits:
        inside = F.when(code == r["lang"], rounded(log).between(r["lower"], r["upper"])).otherwise(inside)
    parts = [df.where(mine).withColumn(found, measured(body, code, m)).where(~base_failed(n, repeated) & inside).drop(found) for mine, m in models]
    return reduce(DataFrame.unionByName, parts)
