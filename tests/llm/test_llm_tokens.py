import hashlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from cases import awkward, documents

from starward.llm.bpe import decoded, encode_and_decode, encoded, word_table, words_of
from starward.llm.tokens import counts_of, encoder, parts_of, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def ids_of(text, library=LIBRARY):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_as_the_library(spark):
    rows = awkward()
    got = sorted((tuple(r) for r in token_counts(documents(spark, rows), PATH).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(ids_of(t)), len(ids_of(t)) > 512) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    assert token_counts(documents(spark, []), PATH).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_models(spark, name):
    path = public_tokenizers.path(name)
    rows = [r for r in awkward() if len(r[1] or "") < 5000]
    got = {tuple(r)[1:3] for r in token_counts(documents(spark, rows), path).collect()}
    if name.endswith(".json"):
        other = tokenizers.Tokenizer.from_file(path)
        want = {(len((t or "").encode()), len(ids_of(t, other))) for _, t, _ in rows}
    else:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {(len((t or "").encode()), len(model.encode(t or ""))) for _, t, _ in rows}
    assert got == want


def test_every_piece_of_the_vocabulary_is_its_own_encoding():
    """Encoding by rank equals encoding by merges if every token, taken alone, comes out whole."""
    known = encoder(PATH)
    texts, ids = zip(*((known.fast.decode_single_token_bytes(i), i) for i in range(50_256)))
    assert all(known.fast.encode_single_token(t) == i for t, i in zip(texts, ids))
    merged = tokenizers.Tokenizer.from_file(PATH).model
    vocab = LIBRARY.get_vocab(with_added_tokens=False)
    assert all([t.id for t in merged.tokenize(token)] == [i] for token, i in vocab.items())


def test_parts_join_and_count_alike():
    text = awkward()[17][1] + " <|endoftext|> é  \n x"
    parts = parts_of(text, 100)
    assert "".join(parts) == text and len(parts) > 100
    count = lambda xs: [len(x) for x in encoder(PATH).encode(xs)]
    assert counts_of([text, ""], count, 50, 300).tolist() == [len(ids_of(text)), 0]


def test_words_join_again():
    for text in ["", " ", "  ", "a b", " a  b ", "a\n b", "a b ", " x", "<|endoftext|> a"]:
        assert "".join(words_of(text)) == text


@pytest.mark.parametrize("entries", [1 << 20, 50])
def test_round_trip_as_the_library(spark, entries):
    rows = awkward()
    got = sorted((tuple(r) for r in encode_and_decode(documents(spark, rows), PATH, entries=entries).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        ids = ids_of(t)
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert encode_and_decode(documents(spark, []), PATH).collect() == []


def test_lists_of_ids_and_their_texts(spark):
    df = documents(spark, awkward())
    lists = df.select("text", encoded(df.text, PATH, word_table(df, PATH)).alias("ids"))
    for r in lists.select("text", "ids", decoded(lists.ids, PATH).alias("back")).collect():
        assert list(r.ids) == ids_of(r.text)
        assert r.back == (r.text or "")
