"""Small tables with every kind of awkward row, and plain versions of the operators."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, found string, measured string, lost_id bigint, "
    "span_id bigint, span_hashes string, span_found string, id bigint, fp bigint, shard int, size bigint, tie bigint, word string, n_removed string"
)


def documents(spark, rows):
    """A table of ``(doc_id, text, lang)`` with further columns whose names the operators use inside."""
    from starward.llm.common import prepared

    return prepared(spark).createDataFrame([(*r, "s", None, "x", None, 1, 2, "y", None, 3, 4, 5, 6, 7, "w", "z") for r in rows], SCHEMA)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    pool = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(vocabulary)]
    return " ".join(rng.choice(pool) + ("." if rng.random() < 0.1 else "") for _ in range(words))


def awkward():
    """Nulls, empty and white texts, very long ones, repeated rows, null ids, odd characters."""
    long = prose(9, 30_000)
    rows = [(i, prose(i, 40 + i), "en") for i in range(12)]
    rows += [(12, None, "en"), (13, "", "fr"), (14, " \n\t ", None), (15, "a", "fr"), (16, "...", "en"), (17, long, "en"), (18, long, None)]
    rows += [(3, prose(3, 43), "en"), (3, prose(3, 43), "en"), (None, prose(1, 41), "en"), (None, None, None), (19, "x" * 50_000, "en")]
    rows += [(20, "漢字 ÉÀ <|endoftext|> \x85  'll 12", "zz"), (21, "One two. " * 60, "en"), (22, "\u0000 \U0001f916 ՘", "en")]
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
