import random

from grantlens.llm.edits import distance, script_cost, within


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_against_plain():
    rng = random.Random(4)
    for _ in range(600):
        a = [rng.choice(["ab", "b", "ca", "dda", ""]) for _ in range(rng.randint(0, 12))]
        b = [w for w in a if rng.random() > 0.15] + [rng.choice(["x", "ab"])] * rng.randint(0, 2)
        x, y = " ".join(a), " ".join(b)
        d = plain(x, y)
        assert distance(x, y) == d and script_cost(x, y, 10**9) >= d
        assert all(within(x, y, m) == (d <= m) for m in range(0, 12))
