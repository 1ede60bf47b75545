"""The recurrent network: gradients, windows, held-out accuracy, awkward rows."""

import random
import zlib

import numpy as np
import pytest
from cases import awkward, documents, prose

from starward.llm import gru as G
from starward.llm import toxicity as T


def small(seed=1):
    rng = np.random.default_rng(seed)
    p = {k: v.astype(np.float64) for k, v in G.fresh_parameters(seed, 3, 2, 2, 16, 16).items()}
    return p | {k: rng.standard_normal(p[k].shape) for k in ("words", "grams")}


def test_gradients_by_differences():
    p, words = small(), [b"ab", b"abcd", b"x", "héllo".encode()]
    f = G.features_of(words, 16, 16)
    ids, mask = G.word_ids(np.array([0, 1, 2, 3, 1, 0, 2]), np.array([0, 2, 5]), np.array([4, 4, 2]), 4, 4)
    y, w = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    _, g = G.loss_and_gradients(p, f, ids, mask, y, w)
    for k in ("words", "grams"):
        rows, d = g[k]
        g[k] = np.zeros_like(p[k])
        g[k][rows] = d
    for k, value in p.items():
        for i in range(min(value.size, 40)):
            at, step = np.unravel_index(i, value.shape), 1e-6
            kept = value[at]
            losses = []
            for s in (step, -step):
                value[at] = kept + s
                losses.append(G.loss_and_gradients(p, f, ids, mask, y, w)[0])
            value[at] = kept
            assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(g[k][at], abs=1e-7), k


def plain_logit(p, x):
    """The network by its definition, for one window of word vectors."""
    hidden = p["Uf"].shape[0]

    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    def run(W, b, U, xs):
        h, out = np.zeros(hidden), []
        for v in xs:
            a, u = v @ p[W] + p[b], h @ p[U]
            z, r = sigmoid(a[:hidden] + u[:hidden]), sigmoid(a[hidden : 2 * hidden] + u[hidden : 2 * hidden])
            h = (1 - z) * np.tanh(a[2 * hidden :] + r * u[2 * hidden :]) + z * h
            out.append(h)
        return out

    states = [np.concatenate(s) for s in zip(run("Wf", "bf", "Uf", x), run("Wb", "bb", "Ub", x[::-1])[::-1])]
    e = np.array([np.tanh(h @ p["A"] + p["a"]) @ p["v"] for h in states])
    weight = np.exp(e) / np.exp(e).sum()
    return sum(w * h for w, h in zip(weight, states)) @ p["w"] + p["c"][0]


def test_every_window_by_definition():
    p, words = small(2), [f"w{i}x".encode() for i in range(9)]
    vectors = G.inputs_of(p, G.features_of(words, 16, 16))
    rng = np.random.default_rng(3)
    per_text = np.array([0, 3, 16, 17, 40])
    codes = rng.integers(0, 9, per_text.sum())
    text, first, sizes = G.windows_of(per_text, 16, 12)
    got = G.logits(p, vectors, codes, first, sizes, 16)
    want = [plain_logit(p, vectors[codes[a : a + n]]) for a, n in zip(first, sizes)]
    assert got == pytest.approx(want, abs=1e-5)
    assert [(int(t), int(a - np.concatenate(([0], np.cumsum(per_text)))[t]), int(n)) for t, a, n in zip(text, first, sizes)] == [
        (1, 0, 3), (2, 0, 16), (3, 0, 16), (3, 1, 16), (4, 0, 16), (4, 12, 16), (4, 24, 16)
    ]


def test_windows_overlap_and_cover():
    for n in (1, 15, 16, 17, 28, 29, 100, 1000):
        _, first, sizes = G.windows_of(np.array([n]), T.WINDOW, T.STRIDE)
        seen = np.zeros(n, bool)
        for a, k in zip(first, sizes):
            seen[a : a + k] = True
        assert seen.all() and (np.diff(first) <= T.STRIDE).all() and T.STRIDE < T.WINDOW


BAD = ["vilefoo", "vilebar", "vilebaz", "nastyqux"]


def text_of(i, toxic):
    rng = random.Random(i)
    words = prose(5000 + i, rng.randrange(30, 200)).split()
    if toxic:
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
    return " ".join(words)


def labelled(spark, rows):
    return spark.createDataFrame([(i, 1, t, "x") for i, t in rows], "doc_id bigint, quality int, toxic int, text string")


def test_held_out_documents_and_awkward_rows(spark):
    truth = {1000 + i: int(i % 3 == 0) for i in range(1200)}
    rows = awkward() + [(i, text_of(i, t), "en") for i, t in truth.items()]
    labels = [*truth.items(), (1000, None), (None, 1), (12, 0), (1001, 2), (999_999, 1)]
    out = T.judge_toxicity(documents(spark, rows), labelled(spark, labels))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 300 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    blank = {r.doc_id: r.score for r in got if r.doc_id in (12, 13, 14, 16)}
    assert blank == {12: 0.0, 13: 0.0, 14: 0.0, 16: 0.0}
    # One word at the end of a long text is found.
    p = T.trained(T.sample_of(documents(spark, rows), labelled(spark, labels)))
    clean = text_of(1, False) + " " + prose(77, 3000)
    assert T.scores(p, [clean.encode(), f"{clean} {BAD[0]} more words".encode()]).round().tolist() == [0, 1]


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows = [(i, text_of(i, i % 2), "en") for i in range(60)]
    out = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, *_ in rows}
    truth = [(i, i % 2) for i in out]
    turned = [(i, 1 - t if out[i] else t) for i, t in truth]
    a, b = (sorted(tuple(r) for r in T.sample_of(documents(spark, rows), labelled(spark, x)).collect()) for x in (truth, turned))
    assert a == b and {r[0] for r in a} == {i for i in out if not out[i]}


def test_without_labels_of_both_kinds(spark):
    docs = documents(spark, [(i, text_of(i, 0), "en") for i in range(6)])
    assert {r.score for r in T.judge_toxicity(docs, labelled(spark, [])).collect()} == {0.000001}
    assert {r.predicted for r in T.judge_toxicity(docs, labelled(spark, [(i, 1) for i in range(6)])).collect()} == {1}
    assert T.judge_toxicity(documents(spark, []), labelled(spark, [(1, 1)])).collect() == []


def test_the_sample_is_bounded_and_whole(spark):
    rows = [(i, text_of(i, i % 2), "en") for i in range(60)] * 2 + [(100, "x " * T.SAMPLE_BYTES, "en")]
    got = T.sample_of(documents(spark, rows), labelled(spark, [(i, i % 2) for i in range(60)] * 2 + [(100, 1)]), size=7).collect()
    assert len(got) == 14 and sum(r.toxic for r in got) == 7 and 100 not in {r.id for r in got}
    assert all(r.text == text_of(r.id, r.toxic) for r in got)
