import math
from collections import Counter, defaultdict

import pytest
from cases import awkward, documents, prose

from starward.llm.language import identify, in_a_language, trigrams
from starward.llm.perplexity import END, START, judge, kept_documents, train


def plain_counts(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    n, r = len(words), len(repeated)
    chars = sum(len(w.decode()) for w in words)
    return n, chars, sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def plain_kneser_ney(texts, order):
    """Modified Kneser-Ney over the characters of words, as a function from (context, letter) to its probability."""
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        for w in (text or "").split():
            padded = START * (order - 1) + w + END
            for i in range(order - 1, len(padded)):
                counts[order][padded[i - order + 1 : i + 1]] += 1
    raw = [Counter() for _ in range(order + 1)]
    raw[order] = counts[order]
    for n in range(order - 1, 0, -1):
        for g, c in raw[n + 1].items():
            raw[n][g[1:]] += c
        different = Counter(g[1:] for g in counts[n + 1])
        counts[n] = Counter({g: raw[n][g] if g.startswith(START) else different[g] for g in raw[n]})

    def off(n, c):
        of = Counter(counts[n].values())
        usual = (0.5, 1.0, 1.5)[min(c, 3) - 1]
        k = min(c, 3)
        if not of[1] or not of[k]:
            return usual
        y = of[1] / (of[1] + 2 * of[2])
        d = k - (k + 1) * y * of[k + 1] / of[k]
        return d if 0 <= d <= k else usual

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        n = len(gram)
        inside = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not inside:
            return lower
        total = sum(inside.values())
        stored = {g: c for g, c in inside.items() if n < 3 or c >= 2}
        kept = sum(c - off(n, c) for c in stored.values())
        c = stored.get(gram, 0)
        return (c - off(n, c) if c else 0) / total + (1 - kept / total) * lower

    return p


def test_counts_and_base_rules(spark):
    rows = awkward() + [(30, "a b c d e a b c d e f g h i j k", "en"), (31, "x\nx\n x\nx\r\n\n\n#|*", "en")]
    got = sorted((tuple(r)[:7] for r in judge(documents(spark, rows)).collect()), key=repr)
    assert got == sorted(((i, *plain_counts(t)) for i, t, _ in rows), key=repr)
    assert judge(documents(spark, [])).collect() == []


def test_perplexity_by_definition(spark):
    rows = [(i, prose(i, 25, 40), "en" if i % 2 else None) for i in range(8)]
    got = {r.doc_id: r.perplexity for r in judge(documents(spark, rows)).collect()}
    for odd in (0, 1):
        p = plain_kneser_ney([t for i, t, _ in rows if i % 2 == odd], 5)
        for i, t, _ in rows[odd::2]:
            logs = [math.log(p((START * 4 + w + END)[k : k + 5])) for w in t.split() for k in range(len(w) + 1)]
            assert got[i] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-4)


def test_probabilities_sum_to_one(spark):
    import numpy as np

    rows = [(prose(i, 60, 60), "en") for i in range(5)]
    ((langs, model),) = train(spark.createDataFrame(rows, "text string, lang string"), order=3)
    assert langs == ["en"]
    letters = sorted({c for t, _ in rows for w in t.split() for c in w + END})
    for context in ("wa", START * 2, "zz"):
        grams = np.array([[ord(x) for x in context + c] for c in letters], np.uint32)
        total = np.exp(model.log_probability(["en"], np.zeros(len(letters), np.int64), grams)).sum()
        assert total == pytest.approx(1, abs=0.05)  # the rest is for letters never seen


def test_languages_dealt_to_several_models_are_judged_alike(spark):
    rows = awkward() + [(100 + i, prose(i, 50, 60 + i % 3), ("en", "fr", "de")[i % 3]) for i in range(30)]
    df = documents(spark, rows)
    whole, dealt = (sorted((tuple(r) for r in judge(df, entries=n).collect()), key=repr) for n in (1 << 20, 1))
    assert whole == dealt
    kept = [sorted((r.doc_id for r in kept_documents(df, entries=n).collect()), key=repr) for n in (1 << 20, 1)]
    assert kept[0] == kept[1]


def test_far_texts_are_rejected_and_stages_agree(spark):
    import random

    rng = random.Random(3)
    odd = " ".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(8)) for _ in range(40))
    rows = [(i, prose(i, 60), "en") for i in range(60)] + [(100, odd, "en")]
    df = documents(spark, rows)
    kept = {r.doc_id for r in judge(df).where("kept").collect()}
    assert kept == set(range(60))
    out = kept_documents(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == kept
    assert kept_documents(documents(spark, [])).collect() == []


def test_both_edges_follow_the_spread(spark):
    import random

    rng = random.Random(4)
    low = " ".join("q" * 20 + rng.choice("abcdef") for _ in range(150))  # hardly any surprise in it, but no repeated window
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(8)]
    high = f"{prose(70, 32)} {' '.join(noise)}"  # a fifth of the words is noise
    rows = [(i, prose(i, 60), "en") for i in range(60)] + [(100, low, "en"), (101, high, "en"), (102, prose(71, 60), "alone")]
    got = {r.doc_id: r for r in judge(documents(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    usual = got[0].perplexity
    assert 1 < usual / got[100].perplexity < math.exp(1.5) and 1 < got[101].perplexity / usual < math.exp(1.4)
    assert {i for i, r in got.items() if r.kept} == set(range(60)) | {102}
    assert {r.doc_id for r in kept_documents(documents(spark, rows)).collect()} == set(range(60)) | {102}


# --- languages --------------------------------------------------------------------------------

WORDS = {"en": "the thing shows other words", "fr": "été où ça façon leurs eaux", "de": "für über straße wörter schön"}


def spoken(lang, seed):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(12))


def test_trigrams_stay_in_words():
    grams, of, n = trigrams(["ab C1d", None, "..", "é"])
    shown = ["".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in grams.tolist()]
    assert shown == [" ab", "ab ", " c ", " d ", " é "] and of.tolist() == [0, 0, 0, 0, 3] and n.tolist() == [4, 0, 0, 1]


def test_held_out_accuracy_and_awkward_rows(spark):
    rows = [(i, spoken(lang, i), lang) for i, lang in enumerate(list(WORDS) * 40)]
    odd = [(500, None, "en"), (501, "", "fr"), (502, "12 ..", "de"), (None, spoken("en", 7), "en"), (503, spoken("fr", 8), None)] + rows[:2]
    got = identify(documents(spark, rows + odd)).collect()
    assert len(got) == len(rows + odd)
    truth = {i: lang for i, _, lang in rows}
    tried = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tried) > 10 and all(r.lang_pred == truth[r.doc_id] for r in tried)
    und = {r.doc_id: r.score for r in got if r.lang_pred == "und"}
    assert und == {500: 0.0, 501: 0.0, 502: 0.0}
    assert all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got if r.doc_id == 503] == ["fr"]
    assert [(r.held_out, r.lang_pred) for r in got if r.doc_id is None] == [(False, "en")]


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    import zlib

    rows = [(i, spoken("en" if i % 2 else "fr", i), "en" if i % 2 else "fr") for i in range(80)]
    out = [zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows]
    other = [(i, t, "xx" if o else lang) for (i, t, lang), o in zip(rows, out)]
    a, b = (sorted(tuple(r) for r in identify(documents(spark, x)).collect()) for x in (rows, other))
    assert a == b and [r[1] for r in a] == out


def test_stage_keeps_whole_rows(spark):
    rows = [(i, spoken("de", i), "de") for i in range(20)] + [(50, "123", "de"), (51, "漢字 漢字", None)]
    df = documents(spark, rows)
    out = in_a_language(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == set(range(20))
    assert in_a_language(documents(spark, [])).collect() == []
    assert {r.lang_pred for r in identify(documents(spark, [(1, "abc", None)])).collect()} == {"und"}


def test_more_languages_than_bits_in_a_word(spark):
    rows = [(1000 * k + i, f"{chr(97 + k % 26)}{chr(0x3B1 + k % 24)}{chr(0x430 + k % 32)} " * 5, f"l{k:03}") for k in range(70) for i in range(4)]
    got = identify(documents(spark, rows)).collect()
    right = [r.lang_pred == f"l{r.doc_id // 1000:03}" for r in got]
    assert sum(right) / len(right) > 0.9
