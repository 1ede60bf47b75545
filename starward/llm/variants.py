"""Spelling variants of words by permuterm rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starward.llm.common import text_column
from starward.operators.keys import assign_keys
from starward.sources.scratch import staged

#: A run of letters is a word's raw form.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many, by its checksum, loses a letter.
NOISE_EVERY = 199
MIN_LETTERS = 6
MIN_COUNT = 5
#: A form stands at least so many times as often as its variant.
FORM_TIMES = 5
#: Marks a word's end inside its rotations.
TERMINATOR = "$"
#: Letters up to which a rotation is kept as text.  All rotations of a longer word would take the square of its
#: length, so there a rotation is the length and two 64-bit hashes of what stands before and behind the edited place.
SHOWN_LETTERS = 64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LETTER = np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the corpus's words and their occurrences.

    A run whose checksum with its document's id is divisible by ``NOISE_EVERY`` lacks the letter that the
    checksum names.  Runs of documents without an id stay whole.
    """
    shown = F.translate(text_column(df, text), UPPER, LOWER)
    runs = df.select(
        text_column(df, doc_id).cast("string").alias("doc"), F.explode(F.regexp_extract_all(shown, F.lit(RUN), F.lit(0))).alias("run")
    ).where(F.char_length("run") >= MIN_LETTERS)
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    hit = F.pmod("h", F.lit(NOISE_EVERY)) == 0
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(hit, cut).otherwise(F.col("run")).alias("word")
    counted = runs.withColumn("h", h).select(word).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT))


def rotations(words: DataFrame) -> DataFrame:
    """``key, place, n, whole, canonical`` for ``words (place, word, n)``.

    A word ``xy`` stands whole under its rotation ``y$x``, and ``xcy`` under ``y$x`` too, the skipped letter ``c``
    being the end of its rotation ``y$xc``.  So a key gathers exactly the words that one edit at one place makes of each
    other: one whole word at most, and one word for each skipped letter.  A letter that is taken out of a run of equal ones leaves
    the same word at each place of the run; the first of them is ``canonical``.
    """
    length = F.char_length("word")
    placed = words.where(length <= SHOWN_LETTERS + 1).select(
        "place", "word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i")
    )
    before, i = F.substr("word", F.lit(1), F.col("i")), F.col("i")
    wholes = placed.where(length <= SHOWN_LETTERS).select(
        F.concat(F.substr("word", i + 1), F.lit(TERMINATOR), before).alias("key"),
        "place", "n", F.lit(True).alias("whole"), F.lit(False).alias("canonical"),
    )
    first = (i == 0) | (F.substr("word", i, F.lit(1)) != F.substr("word", i + 1, F.lit(1)))
    cuts = placed.where(i < length).select(
        F.concat(F.substr("word", i + 2), F.lit(TERMINATOR), before).alias("key"),
        "place", "n", F.lit(False).alias("whole"), first.alias("canonical"),
    )
    long = words.where(length > SHOWN_LETTERS).select("place", "word", "n")
    hashed = long.mapInArrow(_long_rotations, "key string, place bigint, n bigint, whole boolean, canonical boolean")
    return wholes.unionByName(cuts).unionByName(hashed)


def _sides(letters: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first i letters and of those from i on, for i from 0 to the length; the latter don't depend on i."""
    n = len(letters)
    powers, inverse = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    mixed = (letters + np.uint64(1)) * _LETTER
    mixed ^= mixed >> np.uint64(29)
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * powers[:n])))
    return before, (before[-1] - before) * inverse


def _long_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for place, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            letters = np.fromiter(map(ord, word), np.uint64, len(word))
            size = len(letters)
            both = [_sides(letters, b) for b in _BASES]

            def keys(before: np.ndarray, behind: np.ndarray, size: int, both=both) -> list[str]:
                halves = []
                for left, right in both:
                    h = left[before]
                    h = (h ^ (h >> np.uint64(31))) * _LETTER + right[behind]
                    halves.append(h ^ (h >> np.uint64(30)))
                return [f"{size}:{a:016x}{b:016x}" for a, b in zip(*(x.tolist() for x in halves), strict=True)]

            at = np.arange(size + 1)
            shown, whole, canonical = keys(at, at, size), [True] * (size + 1), [False] * (size + 1)
            if size > SHOWN_LETTERS + 1:  # else the shorter keys are texts
                shown += keys(at[:-1], at[1:], size - 1)
                whole += [False] * size
                canonical += [True, *(letters[1:] != letters[:-1]).tolist()]
            many = len(shown)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shown), pa.array([place] * many), pa.array([n] * many), pa.array(whole), pa.array(canonical)],
                ["key", "place", "n", "whole", "canonical"],
            )


def neighbours(words: DataFrame) -> DataFrame:
    """``place, n_near, best_n, best`` for each of ``words (place, word, n)`` that has a near word.

    All rotations are sorted; the words of one edit lie together there and are scanned group by group.  A group has
    one member for each letter of the alphabet and one more at most.  Any two of a group are near, so a member's
    best neighbour in it is the first by count, or the second for the first one itself.
    """
    sorted_ = rotations(words).repartitionByRange("key")
    ordered = Window.partitionBy("key").orderBy(F.desc("n"), "place")
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct(F.col("n"), F.col("place"))
    seen = sorted_.select(
        "place",
        "whole",
        "canonical",
        F.count("*").over(group).alias("members"),
        F.count_if("whole").over(group).alias("wholes"),
        F.count_if("canonical").over(group).alias("canonicals"),
        F.first(member).over(group).alias("first"),
        F.nth_value(member, 2).over(group).alias("second"),
    ).where("members > 1")
    by_letter = F.col("members") - F.col("wholes") - 1 + F.when(F.col("canonical"), F.col("wholes")).otherwise(0)
    best = F.when(F.col("first.place") == F.col("place"), F.col("second")).otherwise(F.col("first"))
    found = seen.select(
        "place", F.when(F.col("whole"), F.col("canonicals")).otherwise(by_letter).alias("near"), best.alias("best")
    )
    top = F.max(F.struct(F.col("best.n"), (-F.col("best.place")).alias("place")))
    return (
        found.groupBy("place")
        .agg(F.sum("near").alias("n_near"), top.alias("top"))
        .select("place", "n_near", F.col("top.n").alias("best_n"), (-F.col("top.place")).alias("best"))
    )


def roots_of(forms: DataFrame) -> DataFrame:
    """``place, root`` from ``forms (place, form)``: forms are followed to the last one.

    Every step makes the count five times larger, so no path is longer than 27 steps, and each round doubles what
    a row has behind it.
    """
    current = staged(forms.select("place", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("place").alias("root"), F.col("root").alias("next"))
        moved = staged(
            current.join(further, "root", "left").select(
                "place", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        current = moved.select("place", "root")
        if moved.where("moved").isEmpty():
            return current


def spelling_variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word of the corpus, its near words and the form that it varies.

    Words are those of ``words_of`` with ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences.  Two are near if one
    letter is inserted, deleted or replaced.  A word's form is its near word of most occurrences, the smallest in code-point
    order among equals, if that has ``FORM_TIMES`` the word's; ``root`` follows forms to the last and is the word itself
    without one.

    Null and empty texts have no words.  Rows without an id count, their runs as they stand.  Repeated rows count each time.
    A text of one long run is one word; its rotations take space in proportion to its length.  An empty table gives no rows.
    Further columns are ignored.
    """
    words = staged(assign_keys(words_of(df, doc_id, text), "place", ["word"], unique=True), "words")
    near = neighbours(words)
    form = F.when(F.col("best_n") >= FORM_TIMES * F.col("n"), F.col("best"))
    judged = staged(
        words.join(near, "place", "left").select(
            "place", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), form.alias("form")
        ),
        "judged",
    )
    varied = judged.where("form IS NOT NULL")
    roots = roots_of(varied)

    def named(place: str, *columns: str) -> DataFrame:
        return words.select(F.col("place").alias(place), *[F.col(c).alias(f"{place}_{c}") for c in columns])

    found = (
        varied.select("place", "form").join(roots, "place").join(named("form", "word", "n"), "form").join(named("root", "word"), "root")
    )
    shown = found.select("place", "form_word", "form_n", "root_word")
    return judged.drop("form").join(shown, "place", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )


def variants_sql() -> str:
    """The same in DuckDB's SQL: near words meet under the word with a gap at the edited place."""
    return rf"""
    WITH RECURSIVE bytes AS (
      SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, e: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
    ), runs AS (
      SELECT CAST(doc_id AS VARCHAR) AS doc, run, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
      WHERE length(run) >= {MIN_LETTERS} GROUP BY ALL
    ), codes AS (
      SELECT run, k, flatten([[4294967295], flatten(list_transform(string_split(doc || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END))]) AS bytes FROM runs
    ), sums AS (
      SELECT run, k, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM codes, bytes
    ), words AS (
      SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT k, CASE WHEN h % {NOISE_EVERY} = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM sums)
      WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(k) >= {MIN_COUNT}
    ), gaps AS (
      SELECT word, n, i, substr(word, 1, i) AS x, substr(word, i + 2) AS y FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
    ), wholes AS (
      SELECT word, n, substr(word, 1, i) AS x, substr(word, i + 1) AS y FROM (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words)
    ), near AS (
      SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.x = b.x AND a.y = b.y AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM gaps a JOIN wholes b ON a.x = b.x AND a.y = b.y
      UNION SELECT b.word, a.word, a.n FROM gaps a JOIN wholes b ON a.x = b.x AND a.y = b.y
    ), best AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
    ), formed AS (
      SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FORM_TIMES} * n THEN other END AS form,
        CASE WHEN other_n >= {FORM_TIMES} * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)
    ), path AS (
      SELECT word, word AS tip FROM formed
      UNION ALL SELECT path.word, formed.form FROM path JOIN formed ON formed.word = path.tip WHERE formed.form IS NOT NULL
    ), roots AS (
      SELECT path.word, tip AS root FROM path JOIN formed ON formed.word = tip WHERE formed.form IS NULL
    )
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """
