"""Token counts of whole texts by a public tokenizer."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import size_blocks, text_column

#: Characters that one call of the encoder gets; what it holds of a text is many times the text.
CALL_CHARS = 256 << 10
#: Characters after which a text is split at the next safe boundary.
PART_CHARS = 32 << 10
#: One space between two other characters.  A byte-level BPE's words end before such a space, whatever
#: follows, so both sides encode as they do together; special strings hold no space.
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: How a byte-level BPE splits a text into words.  Fixed value, part of the public vocabulary's definition.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def parts_of(text: str, limit: int = PART_CHARS) -> list[str]:
    """``text`` cut at safe boundaries, each part about ``limit`` characters; whole where there are none."""
    parts, start = [], 0
    while len(text) - start > limit:
        found = SAFE.search(text, start + limit)
        if not found:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    parts.append(text[start:])
    return parts


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, and the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a ``tokenizers`` JSON file, as the library gives them without special tokens added.

    A plain byte-level BPE whose ids follow its merges is encoded by rank with tiktoken, which takes a
    quarter of the library's time.  That needs all characters' classes to be beyond dispute: texts with
    characters younger than Unicode 3.2, about which the two libraries' tables differ, go to the library
    itself, as do all texts of another kind of model.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.fast = None
        if self._plain(spec):
            import tiktoken

            letters = byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, spec: dict) -> bool:
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        vocab = model.get("vocab")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        odd = ("lstrip", "rstrip", "single_word", "normalized")
        return (
            model["type"] == "BPE"
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", False)
            and not split.get("add_prefix_space")
            and not any(spec[k] for k in ("normalizer", "post_processor"))
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t[k] for t in spec["added_tokens"] for k in odd)
            and len(self.special) <= 1
            and all(vocab.get("".join(m)) == 256 + i for i, m in enumerate(merges))
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.fast:
            return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        known, special = settled(), next(iter(self.special), None)
        out, slow = [], []
        for i, text in enumerate(texts):
            if not text.isascii() and not known.issuperset(text):
                slow.append(i)
                out.append([])
            elif special and special in text:
                ids: list[int] = []
                for k, part in enumerate(text.split(special)):
                    ids += [self.special[special]] * (k > 0) + self.fast.encode_ordinary(part)
                out.append(ids)
            else:
                out.append(self.fast.encode_ordinary(text))
        if slow:
            found = self.library.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)
            for i, x in zip(slow, found, strict=True):
                out[i] = x.ids
        return out


@cache
def settled() -> frozenset[str]:
    """Characters assigned since Unicode 3.2, whose class every table agrees on."""
    kind = unicodedata.ucd_3_2_0.category
    return frozenset(c for c in map(chr, range(0x110000)) if kind(c) not in ("Cn", "Cs"))


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each file in a process."""
    return Encoder(path)


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, for a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file.

    Special strings in a text are handled as the library does by default; none are added.
    """
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    return lambda texts: list(map(len, encoder(path).encode(texts)))


def counts_of(texts: list[str], count: Callable, part_chars: int | None = PART_CHARS, call_chars: int = CALL_CHARS) -> np.ndarray:
    """Token count of each text; calls get about ``call_chars`` each, however long the texts are."""
    parts: list[str] = []
    owner: list[int] = []
    totals = np.zeros(len(texts), np.int64)

    def call():
        np.add.at(totals, owner, count(parts))
        parts.clear()
        owner.clear()

    waiting = 0
    for i, text in enumerate(texts):
        for part in parts_of(text, part_chars) if part_chars and len(text) > part_chars else [text]:
            if waiting and waiting + len(part) > call_chars:
                call()
                waiting = 0
            parts.append(part)
            owner.append(i)
            waiting += len(part)
    if parts:
        call()
    return totals


def splits_safely(path: str) -> bool:
    """Whether texts may be cut at single spaces: only where words of the model end before them."""
    return path.endswith(".json") and encoder(path).fast is not None


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text column as a long; null counts as empty."""

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, part = counter(path), PART_CHARS if splits_safely(path) else None
        for (block,) in size_blocks((b,) for b in batches):
            yield pa.array(counts_of([x or "" for x in block.to_pylist()], count, part), pa.int64())

    return counted.asNondeterministic()(text)


def token_counts(df: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, a row for each row of ``df``; no shuffle.

    ``path`` is the vocabulary file, which every executor must have.  Null and empty texts have no
    bytes and no tokens.  Very long texts are encoded in parts cut at safe boundaries (byte-level
    BPE; texts of other models stay whole).  Null ids and repeated rows stay; further columns are
    ignored.  An empty table gives no rows.
    """
    body = text_column(df, text)
    return df.select(
        text_column(df, doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(body), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_count(body, path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
