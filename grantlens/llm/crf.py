"""A linear-chain conditional random field with two labels, in numpy.

A sequence has a row of features per place and the kind of each step from the place before.
The score of labels is the sum of the weights of the features where the label is 1, and of a weight
for each step by its kind and both labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Kinds of steps between neighbouring places.
KINDS = 2
ROUNDS, RATE, DECAY = 120, 0.15, 0.002


@dataclass
class Chain:
    """Weights of the features by name, of the steps, and of the label at the first place."""

    weights: dict[str, float]
    steps: np.ndarray
    first: np.ndarray


def _added(a: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the sum of exponentials over an axis of two."""
    left, right = np.take(a, 0, axis), np.take(a, 1, axis)
    return np.logaddexp(left, right)


@dataclass
class Sequences:
    """Places of many sequences one after the other; each has ``count`` of the numbers in ``features``.

    ``place`` (sequences x longest) holds place numbers, -1 past the end of a sequence.
    """

    features: np.ndarray
    count: np.ndarray
    labels: np.ndarray
    kinds: np.ndarray
    place: np.ndarray


def likelihood(found: Sequences, width: int, parameters: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean log-likelihood per sequence and its gradient.

    The parameters are ``width`` feature weights, the steps by kind, label before and label, and the first label.
    """
    steps, first = parameters[width : width + 4 * KINDS].reshape(KINDS, 2, 2), parameters[-2:]
    place, (count, longest) = found.place, found.place.shape
    used = place >= 0
    owner = np.repeat(np.arange(len(found.count)), found.count)
    scores = np.bincount(owner, parameters[found.features], len(found.count))
    local = np.zeros((count, longest, 2))
    local[..., 1] = np.where(used, scores[place], 0.0)
    kind, truth = found.kinds[place], found.labels[place]
    step = steps[kind]
    ahead, behind = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
    ahead[:, 0] = first + local[:, 0]
    for t in range(1, longest):
        moved = _added(ahead[:, t - 1, :, None] + step[:, t], 1) + local[:, t]
        ahead[:, t] = np.where(used[:, t, None], moved, ahead[:, t - 1])
    total = _added(ahead[:, -1], 1)
    for t in range(longest - 2, -1, -1):
        moved = _added(step[:, t + 1] + (local[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(used[:, t + 1, None], moved, behind[:, t + 1])
    share = np.exp(ahead + behind - total[:, None, None])
    gradient = np.zeros_like(parameters)
    # in row-major order the places used are 0, 1, 2, ...
    gradient[:width] = np.bincount(found.features, (truth - share[..., 1])[used][owner], width)
    value = (local[..., 1] * truth * used).sum() + first[truth[:, 0]].sum() - total.sum()
    inside = used[:, 1:]
    pair = np.exp(ahead[:, :-1, :, None] + step[:, 1:] + (local + behind)[:, 1:, None, :] - total[:, None, None, None])
    slope = np.zeros((KINDS, 2, 2))
    for k in range(KINDS):
        on = inside & (kind[:, 1:] == k)
        slope[k] = np.bincount(2 * truth[:, :-1][on] + truth[:, 1:][on], minlength=4).reshape(2, 2)
        value += (steps[k] * slope[k]).sum()
        slope[k] -= pair[on].sum(0)
    gradient[width : width + 4 * KINDS] = slope.ravel()
    gradient[-2:] = np.bincount(truth[:, 0], minlength=2) - share[:, 0].sum(0)
    return value / count, gradient / count


def gathered(sequences: Sequence[tuple[list[set[str]], list[int], list[int]]]) -> tuple[Sequences, list[str]]:
    """Sequences (features, kinds of steps, labels per place) as arrays, and the names of the features."""
    names = sorted({name for features, _, _ in sequences for place in features for name in place})
    column = {name: k for k, name in enumerate(names)}
    rows = [sorted(column[name] for name in place) for features, _, _ in sequences for place in features]
    lengths = np.array([len(features) for features, _, _ in sequences])
    place = np.where(np.arange(lengths.max()) < lengths[:, None], np.arange(lengths.max()) + (lengths.cumsum() - lengths)[:, None], -1)
    return (
        Sequences(
            np.array([k for row in rows for k in row]), np.array([len(row) for row in rows]),
            np.array([label for _, _, found in sequences for label in found]), np.array([kind for _, found, _ in sequences for kind in found]), place,
        ),
        names,
    )


def fit(sequences: Sequence[tuple[list[set[str]], list[int], list[int]]]) -> Chain:
    """Weights of most likelihood, drawn towards zero; sequences without a place are left out."""
    found, names = gathered([sequence for sequence in sequences if sequence[0]])
    width = len(names)
    parameters = np.zeros(width + 4 * KINDS + 2)
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for turn in range(1, ROUNDS + 1):  # Adam over all sequences
        slope = likelihood(found, width, parameters)[1] - DECAY * parameters
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        parameters += RATE * (1 - (turn - 1) / ROUNDS) * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return Chain(dict(zip(names, parameters[:width].tolist(), strict=True)), parameters[width : width + 4 * KINDS].reshape(KINDS, 2, 2), parameters[-2:])


def decode(scores: Sequence[float], kinds: Sequence[int], chain: Chain) -> list[int]:
    """The best labels (Viterbi) for the scores of label 1 per place; ties go to label 0."""
    if not scores:
        return []
    steps = chain.steps.tolist()
    none, some = float(chain.first[0]), float(chain.first[1]) + scores[0]
    back: list[tuple[int, int]] = []
    for score, kind in zip(scores[1:], kinds[1:], strict=True):
        (nn, ns), (sn, ss) = steps[kind]
        to_none, to_some = (none + nn, some + sn), (none + ns, some + ss)
        back.append((int(to_none[1] > to_none[0]), int(to_some[1] > to_some[0])))
        none, some = max(to_none), max(to_some) + score
    label = int(some > none)
    labels = [label]
    for pointers in reversed(back):
        label = pointers[label]
        labels.append(label)
    return labels[::-1]
