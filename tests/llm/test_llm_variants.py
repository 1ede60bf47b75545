"""Spelling variants against all pairs of words."""

import random
import zlib
from collections import Counter

from cases import SCHEMA, awkward, documents

from starward.llm.variants import SHOWN_LETTERS, neighbours, spelling_variants


def plain_words(rows):
    counts = Counter()
    for i, text, _ in rows:
        run = ""
        for ch in (text or "") + " ":
            if "a" <= ch <= "z" or "A" <= ch <= "Z" or "À" <= ch <= "ÿ":
                run += ch.lower() if ch < "\x80" else ch
            elif run:
                h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
                if h % 199 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                counts[run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    counts = plain_words(rows)
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def typed(seed, words, changes):
    """Words that stand many times, each also with single letters changed, lost, doubled or added."""
    rng = random.Random(seed)
    text = []
    for w in words:
        text += [w] * rng.choice((6, 40, 200))
        for _ in range(changes):
            at, how = rng.randrange(len(w)), rng.randrange(4)
            v = [w[:at] + rng.choice("abcé") + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + w[at] + w[at:], w[:at] + "ö" + w[at:]][how]
            text += [v] * rng.choice((5, 6, 8))
    rng.shuffle(text)
    return " ".join(text)


def rows():
    long = ["x" * (SHOWN_LETTERS - 1), "xy" * (SHOWN_LETTERS // 2), "ab" * SHOWN_LETTERS, "n" * 300]
    texts = [typed(k, ["mississippi", "aaaaaa", "Straße", "letters", "better", "letter", "ÀÉÖ÷öö"], 8) for k in range(3)]
    texts += [typed(9, long, 6), "banana " * 5 + "bananna, " * 25 + "BANNANNA " * 125, "lonely " * 7]
    return awkward() + [(100 + i, t, "en") for i, t in enumerate(texts)]


def test_against_all_pairs(spark):
    given = rows()
    got = sorted((tuple(r) for r in spelling_variants(documents(spark, given)).collect()), key=repr)
    want = plain(given)
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of forms
    assert any(len(r[0]) > 64 and r[4] for r in want) and any(len(r[0]) == 64 and r[4] for r in want)


def test_noise_comes_from_the_id_and_rows_without_one_stay_whole(spark):
    given = [(i, "variants of words " * 3, "en") for i in range(400)] + [(None, "variants", "en")] * 300
    got = {r.word: r.n for r in spelling_variants(documents(spark, given)).collect()}
    assert got == plain_words(given) and got["variants"] > 1400


def test_empty_tables_and_texts(spark):
    assert spelling_variants(documents(spark, [])).collect() == []
    assert spelling_variants(documents(spark, [(1, None, None), (2, "", "en"), (3, "short words", "en")])).collect() == []
    assert "word" in SCHEMA  # a column of the input with a name of the output


def test_sorted_rotations_are_not_shuffled_again(spark):
    words = spark.range(50).selectExpr("id AS place", "concat('word', id, 'end') AS word", "id + 5 AS n")
    plan = neighbours(words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning(key" not in plan


def test_a_very_long_word_takes_space_in_proportion(spark):
    word = "".join(random.Random(1).choice("abcdefghij") for _ in range(20_000))
    given = [(1, " ".join([word] * 30 + [word[:500] + word[501:]] * 5), "en")]
    got = spelling_variants(documents(spark, given)).collect()
    assert sorted((len(r.word), r.n, r.n_near, len(r.root)) for r in got) == [(19_999, 5, 1, 20_000), (20_000, 30, 1, 20_000)]
