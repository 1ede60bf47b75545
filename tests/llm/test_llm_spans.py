from cases import awkward, documents, prose

from starward.llm.spans import SPAN_WORDS, drop_repeated_spans, remaining, sentences


def pieces(text):
    raw = text.encode()
    ends = sentences(raw).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def plain_spans(parts):
    """Every run of enough words, however long: the operator hashes the shortest ones only, which must remove the same."""
    words = [p.split() for p in parts]
    for i in range(len(parts)):
        for j in range(i + 1, min(len(parts), i + 2 * SPAN_WORDS) + 1):
            if sum(map(len, words[i:j])) >= SPAN_WORDS:
                yield i, j, tuple(b" ".join(w) for w in words[i:j])


def plain(rows):
    """By definition: a sentence goes if a span over it stands earlier in its text or under a smaller id."""
    first = {}
    for i, t, _ in rows:
        if i is not None and t is not None:
            for *_, key in plain_spans(pieces(t)):
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t, _ in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        parts, gone, seen = pieces(t), set(), set()
        for a, b, key in sorted(plain_spans(parts), key=lambda s: s[0]):
            if key in seen or (i is not None and first[key] < i):
                gone.update(range(a, b))
            seen.add(key)
        out.append((i, b"".join(p for k, p in enumerate(parts) if k not in gone).decode(), len(gone)))
    return sorted(out, key=repr)


def shared():
    passage = "The quick one went over the hill and far away. Then it came back. Nobody saw it on the way, not even the keeper of the gate."
    short = " ".join(f"{w}!!" for w in prose(77, 40).replace(".", "").split())
    single = " ".join(prose(78, 60).replace(".", "").split()) + "."
    rows = [(200 + i, f"{prose(300 + i, 20)}\n{p}\n{prose(400 + i, 15)}", "en") for i, p in enumerate([passage, short, single] * 6)]
    return rows + [(300, f"Stop. Go.\n{passage}\n{passage}", "en"), (301, "A. B. C.", "en"), (302, "A. B. C.", "en")]


def test_against_the_definition(spark):
    rows = [r for r in awkward() if len(r[1] or "") < 60_000] + shared()
    got = drop_repeated_spans(documents(spark, rows))
    assert got.columns[:2] == ["doc_id", "text"] and got.columns[-2:] == ["n_sentences", "_n_removed"]
    assert sorted(((r.doc_id, r.text, r["_n_removed"]) for r in got.collect()), key=repr) == plain(rows)


def test_first_copies_stay_and_others_go(spark):
    rows = shared()
    left = {r.doc_id: r.text for r in drop_repeated_spans(documents(spark, rows)).collect()}
    for k in range(3):
        passage = rows[k][1].split("\n")[1]
        assert passage in left[200 + k]
        assert not any(passage in left[200 + i] for i in range(k + 3, 18, 3))
    assert left[301] == left[302] == "A. B. C."


def test_emptied_rows_go_and_blank_ones_stay(spark):
    text = prose(1, 80)
    df = documents(spark, [(1, text, "en"), (2, text, "en"), (3, " ", "en"), (4, None, "en"), (None, text, "en")])
    kept = remaining(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, 4, None]
    assert remaining(documents(spark, [])).collect() == []


def test_passages_inside_other_sentences_go(spark):
    import random

    def passage(seed, n):
        rng = random.Random(seed)
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]

    whole = [passage(k, 80) for k in range(20)]  # no full stop in it
    own = lambda k, n: " ".join(passage(k, n))
    rows = [(k, f"{own(100 + k, 9)} {' '.join(p)} {own(200 + k, 14)}.", "en") for k, p in enumerate(whole)]
    rows += [(100 + k, f"{own(300 + k, 21)} {' '.join(p)} {own(400 + k, 5)}. {own(500 + k, 7)}.", "en") for k, p in enumerate(whole)]
    cut = passage(900, 51)  # 15, 12, 12 and 12 words, the first and last run into others
    stops = " ".join(w + ("." if i in (14, 26, 38) else "") for i, w in enumerate(cut))
    rows += [(300, f"{own(901, 6)} {stops} {own(902, 9)}.", "en"), (301, f"{own(903, 8)} {stops} {own(904, 4)}.", "en")]
    left = {r.doc_id: (r.text or "").replace(".", "").split() for r in drop_repeated_spans(documents(spark, rows)).collect()}
    for k, p in enumerate(whole):
        assert len(left[k]) == 103
        assert sum(w in set(p) for w in left[100 + k]) < 50  # no run of 50 words stays
        assert len(left[100 + k]) - sum(w in set(p) for w in left[100 + k]) == 33
    assert sum(w in set(cut) for w in left[301]) <= 27  # both whole sentences went
    assert len(left[301]) - sum(w in set(cut) for w in left[301]) == 12


def test_cuts_cover_the_text_and_depend_on_words_alone():
    for t in ("", "a", " ", "  a b", prose(5, 300).replace(".", ""), "\tx" * 40, "x" * 99, " y " * 30):
        ends = sentences(t.encode()).tolist()
        assert ends == sorted(set(ends)) and (ends[-1:] == [len(t)] if t else not ends)
    words = prose(6, 200).replace(".", "").split()
    for text in (" ".join(words), "  ".join(words), " " + "\t".join(words)):
        assert [p.split() for p in pieces(text)] == [p.split() for p in pieces(" ".join(words))]
