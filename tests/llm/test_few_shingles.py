"""Items of few shingles are found in every document that holds them."""

import random

from quire.llm import decontaminate as dc


def test_no_pair_is_missed():
    rng = random.Random(12)
    word = lambda: f"z{rng.getrandbits(40)}"
    items = [(k, " ".join(word() for _ in range(5 + k % 7))) for k in range(4000)] + [(9000, "again " * 9)]
    index = dc.ItemIndex(items, 5)
    missed = 0
    for k, text in items:
        before, after = ([word() for _ in range(60)] for _ in range(2))
        n = len(set(zip(*[text.split()[j:] for j in range(5)], strict=False)))
        missed += index.contained(" ".join(before + [text] + after), 80) != [(k, n, n)]
    assert missed == 0
    assert index.contained(" ".join(items[0][1].split()[:4]), 80) == []
