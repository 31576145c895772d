"""Viterbi over chains that settled places part, against one that goes through every place."""

import numpy as np

from tidemark.llm import crf


def test_parted_chains_have_the_same_best_paths():
    rng = np.random.default_rng(5)
    for scale in (0.3, 1.0, 3.0, 10.0):
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 60, 200))])
        emission, move, start = rng.normal(size=(first[-1], 3)) * scale, rng.normal(size=(3, 3)), rng.normal(size=3)
        emission[:, 0] += scale
        for forbidden in (None, -30.0):
            if forbidden:
                move[0, 2] = start[2] = forbidden
            plain = crf._decoded(emission, first, move, start)
            assert (crf.viterbi(emission, first, move, start) == plain).all()
            sure = crf.settled(emission, first, move, start)
            assert not plain[sure].any() and (scale < 3 or forbidden or sure.any())


def test_only_stretches_in_doubt_are_gone_through(monkeypatch):
    longest = []

    class Steps(crf.Steps):
        def __init__(self, first):
            super().__init__(first)
            longest.append(self.longest)

    monkeypatch.setattr(crf, "Steps", Steps)
    emission = np.tile([20.0, 0.0, 0.0], (20000, 1))
    emission[[700, 701, 9000]] = [[0, 20, 0], [0, 0, 20], [0, 20, 0]]
    move, start = np.zeros((3, 3)), np.zeros(3)
    move[0, 2] = start[2] = -30.0
    best = crf.viterbi(emission, np.array([0, 20000]), move, start)
    assert np.flatnonzero(best).tolist() == [700, 701, 9000] and best[[700, 701, 9000]].tolist() == [1, 2, 1]
    assert sum(longest) < 20


def test_no_places():
    none = crf.viterbi(np.zeros((0, 3)), np.array([0, 0]), np.zeros((3, 3)), np.zeros(3))
    assert none.shape == (0,) and none.dtype == np.int8
