"""Pairs of rare words that are harmless alone are learned beneath many commoner words."""

import numpy as np

from wayweave.llm import toxicity


def texts(rng, n, share):
    """Words 0 to 999 in a fiftieth of the texts each; 1500 tells label 1; 2000 and 2001, in
    ``share`` of the texts each, tell it where both are."""
    label, sets, kinds = [], [], []
    for i in range(n):
        kind = int(i / n / share * 2) if i / n < 1.5 * share else 3
        own = [[2000, 2001], [2000], [2001], [1500] if i % 2 else []][kind]
        label.append(float(own in ([2000, 2001], [1500])))
        sets.append(np.unique([*own, *rng.integers(0, 1000, 20)]))
        kinds.append(kind)
    return np.array(label), sets, np.array(kinds)


def logit(m, s):
    row = m.slot[s]
    row = row[row >= 0]
    v = m.vector[row]
    return m.bias + m.weight[row].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()


def test_rare_pairs():
    rng = np.random.default_rng(6)
    label, sets, _ = texts(rng, 12_000, 0.002)
    m = toxicity.train_machine(label, sets, 4_096, 0.5)
    label, sets, kinds = texts(rng, 6_000, 0.2)
    right = (np.array([logit(m, s) for s in sets]) >= 0) == label
    assert all(right[kinds == k].mean() >= 0.9 for k in range(4))
