"""Toxicity of documents: a recurrent network scores all overlapping windows, the highest one decides."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import size_blocks, text_column, texts_of
from starward.llm.gru import (
    Adam,
    Features,
    Parameters,
    features_of,
    fresh_parameters,
    inputs_of,
    logits,
    loss_and_gradients,
    windows_of,
    word_ids,
)
from starward.llm.perplexity import Words, words_of

#: Words in a window, and from one window's begin to the next.
WINDOW, STRIDE = 16, 12
#: The network learns from at most so many documents of each label, those with the smallest hash of their id, and of texts
#: up to so many bytes; what it learns of one text is at most so many of its windows, spread evenly.
SAMPLE, SAMPLE_BYTES, SAMPLE_WINDOWS = 2000, 1 << 15, 256
THRESHOLD = 0.7
BLOCK = 4 << 20
#: A window is learned from as toxic only if its probability is at least this, once the first pass is over.
LIKELY = 0.3
#: Windows of a clean document that are learned from in each further round: those that look worst, and some at random.
WORST, OTHERS = 3, 3
#: Documents of the sample that a word or an n-gram must be in to be learned; others stay at zero, so no text is learned by heart.
WORD_DOCUMENTS, GRAM_DOCUMENTS = 8, 20
#: Share of clean documents that scores are calibrated for; the sample's own share depends on its bound.
CLEAN_SHARE = 0.75
_ROUNDS, _STEP_WINDOWS, _RATE = 2, 256, 0.01
#: Steps of a round; few windows are gone through several times.
_LEAST_STEPS = 60
#: ASCII letters in lower case, other ASCII characters as spaces, the rest as it is.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def tokens(texts: list[bytes]) -> Words:
    """Runs of letters; everything beyond ASCII counts as one."""
    return words_of([t.translate(_LETTERS) for t in texts])


# --- learning -----------------------------------------------------------------------------------


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 0) -> Parameters:
    """The network's parameters, with ``scale`` and ``shift`` from its highest output to a document's log odds.

    Labels are of documents, so in a first pass every window has its document's.  In the rounds after it a toxic document's windows
    that the network itself holds likely, the highest one at least if it is, stand for it, against the worst and some other windows of clean documents.
    Documents of one label alone teach nothing but its share.
    """
    p = fresh_parameters(seed)
    y = np.asarray(toxic, np.float32)
    words = tokens(texts)
    text, first, sizes = windows_of(words.per_text, WINDOW, STRIDE)
    spread = _spread(text, SAMPLE_WINDOWS)
    text, first, sizes = text[spread], first[spread], sizes[spread]
    if not len(text) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return p | {"scale": np.zeros(1, np.float32), "shift": np.array([odds], np.float32)}
    features = features_of(words.distinct)
    taught = _taught(features, words, len(p["words"]), len(p["grams"]))
    rng, adam = np.random.default_rng(seed), Adam(p, _RATE)
    mine = y[text] > 0

    def learn(chosen: np.ndarray) -> None:
        weight = np.where(mine[chosen], 1.0, mine[chosen].sum() / max((~mine[chosen]).sum(), 1)).astype(np.float32)
        for _ in range(max(1, _LEAST_STEPS * _STEP_WINDOWS // max(len(chosen), 1))):
            order = rng.permutation(len(chosen))
            for i in range(0, len(order), _STEP_WINDOWS):
                step(chosen[order[i : i + _STEP_WINDOWS]], weight[order[i : i + _STEP_WINDOWS]])

    def step(at: np.ndarray, weight: np.ndarray) -> None:
        ids, mask = word_ids(words.codes, first[at], sizes[at], WINDOW, len(words.distinct))
        used, local = np.unique(ids, return_inverse=True)
        used = used[used < len(words.distinct)]
        _, g = loss_and_gradients(p, features.take(used), local.reshape(ids.shape), mask, y[text[at]], weight)
        for name, allowed in taught.items():
            rows, d = g[name]
            g[name] = rows[allowed[rows]], d[allowed[rows]]
        adam.apply(p, g)

    def outputs() -> np.ndarray:
        return logits(p, inputs_of(p, features), words.codes, first, sizes, WINDOW)

    clean = np.flatnonzero(~mine)
    learn(np.concatenate((np.flatnonzero(mine), rng.choice(clean, min(len(clean), 2 * int(mine.sum())), replace=False))))
    for _ in range(_ROUNDS):
        z = outputs()
        rank = _rank_in_text(text, -z)
        likely = mine & (z >= np.log(LIKELY / (1 - LIKELY)))
        worst = ~mine & (rank < WORST)
        others = rng.random(len(text)) < OTHERS * np.bincount(text, minlength=len(y)).astype(float)[text] ** -1
        learn(np.flatnonzero(likely | worst | (~mine & others)))
    z = outputs()
    has = np.unique(text)
    highest = np.maximum.reduceat(z, np.searchsorted(text, has))
    scale, shift = _calibrated(highest, y[has])
    return p | {"scale": np.array([scale], np.float32), "shift": np.array([shift], np.float32)}


def _taught(features: Features, words: Words, word_rows: int, gram_rows: int) -> dict[str, np.ndarray]:
    """Which rows of the two tables stand in enough documents."""
    pairs = np.unique(words.owner * max(len(words.distinct), 1) + words.codes)
    which, owner = pairs % max(len(words.distinct), 1), pairs // max(len(words.distinct), 1)
    by_word = np.bincount(features.word[which], minlength=word_rows)
    each = features.take(which)
    in_text = np.unique(np.repeat(owner, each.sizes) * gram_rows + each.gram)
    by_gram = np.bincount(in_text % gram_rows, minlength=gram_rows)
    return {"words": by_word >= WORD_DOCUMENTS, "grams": by_gram >= GRAM_DOCUMENTS}


def _spread(text: np.ndarray, most: int) -> np.ndarray:
    """Places of at most ``most`` windows of each text, evenly spread; ``text`` is ascending."""
    counts = np.bincount(text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    many = counts[text] if len(text) else number
    step = np.maximum(many / most, 1.0)
    return np.flatnonzero(np.floor(number / step) != np.floor((number - 1) / step))


def _rank_in_text(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    order = np.lexsort((value, text))
    counts = np.bincount(text)
    rank = np.empty(len(text), np.int64)
    rank[order] = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rank


def _calibrated(z: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Logistic regression of labels on outputs, as if ``CLEAN_SHARE`` were clean, with a little ridge; a higher output is never less toxic."""
    weight = np.where(y > 0, (1 - CLEAN_SHARE) / max(y.sum(), 1), CLEAN_SHARE / max((1 - y).sum(), 1))
    middle, spread = float(z.mean()), float(z.std()) or 1.0
    x = np.column_stack(((z - middle) / spread, np.ones(len(z)))).astype(np.float64)
    b, ridge = np.zeros(2), 1e-3
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (q - y)) + ridge * b
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(2)
        move = np.linalg.solve(curve, slope)
        b = b - move / max(1.0, float(np.abs(move).max()))
    scale = max(float(b[0]), 1e-3) / spread
    return scale, float(b[1]) - scale * middle


def sample_of(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SAMPLE) -> DataFrame:
    """``id, text, toxic``: the labelled documents to learn from, of each label those with the smallest hash of their id.

    Ids whose checksum leaves 1 in three parts are left out.  An id with several labels counts as toxic if any says so; of several texts
    the smallest is taken.
    """
    key = F.col("id").cast("string")
    told = (
        labels.select(text_column(labels, "doc_id").alias("id"), text_column(labels, "toxic").cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (F.pmod(F.crc32(key), F.lit(3)) != 1))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    docs = df.select(text_column(df, doc_id).alias("id"), text_column(df, text).alias("text")).where(
        F.octet_length("text") <= SAMPLE_BYTES
    )
    found = told.join(docs.groupBy("id").agg(F.count("*")).select("id"), "id", "left_semi")
    few = [found.where(F.col("toxic") == label).orderBy(F.xxhash64(key), "id").limit(size) for label in (0, 1)]
    chosen = few[0].unionByName(few[1])
    return docs.join(chosen, "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("id", "text", "toxic")


def trained(sample: DataFrame) -> Parameters:
    """The network learned in one task from a bounded sample; only its parameters come back."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: r[0])
        p = train([t.encode() for _, t, _ in rows], np.array([x for _, _, x in rows], np.float32))
        packed = io.BytesIO()
        np.savez(packed, **p)
        yield pa.RecordBatch.from_arrays([pa.array([packed.getvalue()])], ["p"])

    row = sample.repartition(1).mapInArrow(learn, "p binary").first()
    if row is None:  # Spark runs no task over no rows
        return train([], np.zeros(0, np.float32))
    return dict(np.load(io.BytesIO(bytes(row.p))))


# --- scoring ------------------------------------------------------------------------------------


def scores(p: Parameters, texts: list[bytes]) -> np.ndarray:
    """Probability of each text's most toxic window, from 0 to 1; 0 without a word."""
    words = tokens(texts)
    text, first, sizes = windows_of(words.per_text, WINDOW, STRIDE)
    out = np.zeros(len(texts))
    if not len(text):
        return out
    z = logits(p, inputs_of(p, features_of(words.distinct)), words.codes, first, sizes, WINDOW)
    has = np.unique(text)
    highest = np.maximum.reduceat(z, np.searchsorted(text, has)).astype(np.float64)
    out[has] = 1 / (1 + np.exp(-np.clip(p["scale"][0] * highest + p["shift"][0], -30, 30)))
    return out


def toxicity(text: Column, parameters) -> Column:
    """The score of a text column, to six places; null counts as empty.  ``parameters`` is a broadcast."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            yield pa.array(np.round(scores(parameters.value, texts_of(block)), 6))

    return score.asNondeterministic()(text)


def judge_toxicity(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row for each row.

    The network learns from the sample of ``sample_of`` and scores every window of every whole text.

    Null texts and those without a letter score 0.  Rows without an id are never learned from and are held out.  Repeated rows score
    alike.  Without labels of both kinds every text with a word scores their share.  An empty table gives no rows.  Further
    columns are ignored.
    """
    parameters = df.sparkSession.sparkContext.broadcast(trained(sample_of(df, labels, doc_id, text)))
    key = text_column(df, doc_id)
    held_out = F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(True))
    scored = df.select(key.alias("doc_id"), held_out.alias("held_out"), toxicity(text_column(df, text), parameters).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
