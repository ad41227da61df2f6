"""Places of suffixes, for many texts hashed end to end."""

import random

import pytest

from dumptables.llm import suffixes


def places_of(words):
    """The same for one text, window by window."""
    if len(words) < suffixes.PASSAGE:
        return [], []
    each = suffixes.word_hashes(words)
    grams = suffixes.run_hashes(each, suffixes.GRAM).tolist()
    width = suffixes.SPAN - suffixes.GRAM + 1
    chosen = set()
    for at in range(len(grams) - width + 1):
        window = grams[at : at + width]
        chosen |= {at + i for i, gram in enumerate(window) if gram == min(window)}
    ahead = suffixes.run_hashes(each, suffixes.AHEAD).tolist()
    found = sorted(p for p in chosen if p < len(ahead))
    return found, [ahead[p] for p in found]


@pytest.mark.parametrize("together", [1, 300, 1 << 15])
def test_no_run_reaches_into_the_next_text(monkeypatch, together):
    rng = random.Random(7)
    texts = [
        [f"w{rng.randrange(variety)}".encode() for _ in range(size)]
        for size in (0, 1, 39, 49, 50, 51, 90, 0, 200, 17, 400, 49)
        for variety in (1, 3, 500)
    ]
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    for some in (texts, texts[::-1], texts[:1], [], [texts[9]]):
        found = [(a.tolist(), b.tolist()) for a, b in suffixes.places(some)]
        assert found == [places_of(words) for words in some]


def test_texts_are_hashed_together(monkeypatch):
    calls, real = [], suffixes.run_hashes
    monkeypatch.setattr(suffixes, "run_hashes", lambda *a: calls.append(a) or real(*a))
    assert len(list(suffixes.places([[b"a"] * 60] * 100))) == 100
    assert len(calls) == 2
