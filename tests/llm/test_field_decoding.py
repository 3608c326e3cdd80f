"""The field's Viterbi decoding against every sequence of labels."""

import itertools

import numpy as np

from tidemark.llm import pii


def best_by_trying(field, run):
    e = field.scores(run)
    scored = {}
    for labels in itertools.product(range(len(pii.LABELS)), repeat=len(run)):
        score = field.move[-1, labels[0]] + sum(e[t, k] for t, k in enumerate(labels))
        scored[labels] = score + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))
    return scored, max(scored.values())


def test_decoding_finds_a_best_sequence_of_each_run():
    rng = np.random.default_rng(61)
    traits = {f"t{i}": i for i in range(7)}
    for _ in range(6):
        move = pii._legal() + rng.normal(0, 1, (len(pii.LABELS) + 1, len(pii.LABELS)))
        field = pii.Field(traits, rng.normal(0, 1, (7, len(pii.LABELS))), move)
        # runs of mixed lengths are decoded in one call; unknown traits count nothing
        runs = [[(0, 1, rng.choice([*traits, "new"], 2).tolist()) for _ in range(n)] for n in (1, 3, 2, 4, 3, 1)]
        for run, labels in zip(runs, field.decode(runs)):
            scored, best = best_by_trying(field, run)
            assert np.isclose(scored[tuple(labels.tolist())], best)
    assert field.decode([]) == []


def test_fitted_field_never_starts_inside_a_kind():
    field = pii.fit(pii.labelled_examples(150, seed=8), rounds=15)
    texts = [t for t, _ in pii.labelled_examples(80, seed=9)]
    for text in texts:
        for labels in field.decode(pii.segments(text)):
            names = [pii.LABELS[k] for k in labels]
            assert all(n[0] != "I" or (i and names[i - 1][2:] == n[2:]) for i, n in enumerate(names))
