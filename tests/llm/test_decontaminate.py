import random

import pytest

from corpusloom.llm import decontaminate as D


def brute(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    best = min(row)
    return best, row.index(best)


@pytest.mark.parametrize("seed", range(60))
def test_myers_is_the_edit_distance(seed):
    r = random.Random(seed)
    pattern = "".join(r.choice("ab ") for _ in range(r.randint(1, 80)))
    text = "".join(r.choice("ab c") for _ in range(r.randint(0, 120)))
    assert D.myers(pattern, text) == brute(pattern, text)


WORDS = [f"{a}{b}{c}" for a in ("ba", "lo", "tri", "mu") for b in ("no", "sta", "pel") for c in ("ra", "vi", "ku", "ded")]


def sentence(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(r, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = r.randrange(len(chars))
        what = r.randrange(3)
        if what == 0:
            chars[i] = r.choice("xyz")
        elif what == 1:
            chars.insert(i, r.choice("xyz"))
        elif len(chars) > 1:
            del chars[i]
    return "".join(chars)


def held(items, text):
    """Distance of each item that the text holds, by the whole table of edit distances."""
    words, want = f" {D.plain(text)} ", {}
    for i, t in items:
        if own := D.plain(t):
            distance, _ = brute(f" {own} ", words)
            if distance <= len(own) // D.CHARS_PER_EDIT:
                want[i] = distance
    return want


def test_matches_the_brute_force():
    r = random.Random(5)
    items = [(i, sentence(r, r.randint(4, 30))) for i in range(12)]
    matcher = D.Matcher(items)
    for _ in range(60):
        item = r.choice(items)[1]
        text = f"{sentence(r, 9)}, {edited(r, item, r.randint(0, 14)).upper()}! {sentence(r, 5)}"
        assert {i: d for i, d, _, _ in matcher.match(text)} == held(items, text)


def test_short_items_match_the_brute_force():
    r = random.Random(6)
    items = [(n, "".join(r.choice("ab c") for _ in range(n))) for n in range(1, 20) for _ in range(3)]
    items = list(enumerate([*(t for _, t in items), "the cat sat on mat", "x", "é", "a b"]))
    matcher = D.Matcher(items)
    texts = ["intro the cat sat on mat outro", "The bat, sat on mat", "x", "xx", "", None, "É", *(" ".join(edited(r, r.choice(items)[1] or "a", r.randint(0, 2)) for _ in range(3)) for _ in range(150))]
    found = matcher.match_all(texts)
    for text, own in zip(texts, found, strict=True):
        assert {i: d for i, d, _, _ in own} == held(items, text or ""), text
    assert {items[i][1] for i, *_ in found[0]} >= {"the cat sat on mat"}


def test_spans():
    item = "Alpha beta, gamma delta epsilon zeta eta theta."
    matcher = D.Matcher([(1, item), (2, "so short"), (3, item.upper()), (4, ""), (5, None), (6, "..")])
    text = f"İntro; {item}\nOutro"
    found = matcher.match(text)
    assert {(i, d) for i, d, _, _ in found} == {(1, 0), (3, 0)}
    s, e = found[0][2:]
    assert text[s:e] == item[:-1]
    for text in ("So, SHORT!", "it is so  short a text"):
        (name, distance, s, e), = matcher.match(text)
        assert (name, distance, D.plain(text[s:e])) == (2, 0, "so short")
    assert not matcher.match("also shorts") and not matcher.match(None)
    assert D.Matcher([]).match("a text") == []


def test_long_texts_and_small_slices(monkeypatch):
    r = random.Random(7)
    items = [(i, sentence(r, 20)) for i in range(30)] + [(99, "common words " + sentence(r, 3))]
    texts = [sentence(r, 40_000) + " " + items[4][1] + " " + sentence(r, 9), *(f"{sentence(r, 5)} {t} {sentence(r, 5)}" for _, t in items), "common words " * 30_000]
    want = D.Matcher(items).match_all(texts)
    assert [i for i, *_ in want[0]] == [4] and all(i in [n for n, *_ in w] for (i, _), w in zip(items, want[1:-1], strict=True))
    monkeypatch.setattr(D, "SLICE_CHARS", 10), monkeypatch.setattr(D, "SLICE_PAIRS", 1)
    assert D.Matcher(items).match_all(texts) == want


def test_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"x {item} y", "a"), (2, "clean", "b"), (3, None, "c"), (1, f"x {item} y", "a")], "doc_id long, text string, item_id string")
    tests = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "p q r s t u v w x y z a b c d e")], "item_id long, text string")
    for block in (10**6, 20):
        rows = D.contaminated(docs, tests, block_chars=block).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in rows) == [(1, 7, 0), (1, 7, 0), (1, 8, 0), (1, 8, 0)]
        left = D.decontaminate(docs, tests, block_chars=block)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    assert D.contaminated(docs, tests.limit(0)).count() == 0 and D.decontaminate(docs.limit(0), tests).count() == 0
