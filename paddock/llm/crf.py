"""A linear-chain conditional random field in numpy: training by penalised maximum
likelihood, decoding by Viterbi, both over batches of sequences.

Tokens enter as rows of feature numbers for three roles: a token's own features,
those it gives its successor and those it gives its predecessor. A label's score at a
place is the sum of the three roles' weights there, plus the transition's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FORBIDDEN = -1e4


@dataclass
class Model:
    """``own``, ``before`` and ``after``: (feature, label) weights of the three roles;
    ``start``, ``step``: scores of first labels and of (label, next label)."""
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    start: np.ndarray
    step: np.ndarray


def _padded(sequences: list, width: int, fill: int) -> np.ndarray:
    out = np.full((len(sequences), width), fill, np.int64)
    for i, s in enumerate(sequences):
        out[i, :len(s)] = s
    return out


def emissions(types: np.ndarray, lengths: np.ndarray, own: np.ndarray, before: np.ndarray,
              after: np.ndarray) -> np.ndarray:
    """(sequence, place, label) scores for padded type numbers; the tables hold one row
    a type and a last row for the sequence's border."""
    n, width = types.shape
    border = len(own) - 1
    inside = np.arange(width)[None, :] < lengths[:, None]
    t = np.where(inside, types, border)
    left = np.concatenate([np.full((n, 1), border), t[:, :-1]], axis=1)
    right = np.concatenate([t[:, 1:], np.full((n, 1), border)], axis=1)
    return own[t] + before[left] + after[right]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sequences: list[list[int]], labels: list[list[int]], features: np.ndarray,
          n_labels: int, allowed: np.ndarray, first: np.ndarray, steps: int = 150,
          rate: float = 0.1, penalty: float = 0.02) -> Model:
    """``features``: 0/1 matrix (type, feature) whose last row is the border's;
    ``sequences``: type numbers. ``allowed``: which (label, next label) may occur,
    ``first``: which labels may come first. Gradient ascent with adaptive rates."""
    lengths = np.array([len(s) for s in sequences])
    width = int(lengths.max())
    border = len(features) - 1
    types = _padded(sequences, width, border)
    gold = _padded(labels, width, 0)
    n = len(sequences)
    rows = np.arange(n)
    inside = np.arange(width)[None, :] < lengths[:, None]
    left = np.concatenate([np.full((n, 1), border), types[:, :-1]], axis=1)
    right = np.concatenate([types[:, 1:], np.full((n, 1), border)], axis=1)
    shape = (features.shape[1], n_labels)
    params = [np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(n_labels),
              np.zeros((n_labels, n_labels))]
    ban_step, ban_first = np.where(allowed, 0, FORBIDDEN), np.where(first, 0, FORBIDDEN)
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    hot = np.eye(n_labels)[gold] * inside[:, :, None]
    seen_step = np.zeros((n_labels, n_labels))
    pair = inside[:, 1:]
    np.add.at(seen_step, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    for k in range(1, steps + 1):
        own, before, after = (features @ p for p in params[:3])
        e = emissions(types, lengths, own, before, after)
        start, step = params[3] + ban_first, params[4] + ban_step
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = start + e[:, 0]
        for t in range(1, width):
            new = _lse(alpha[:, t - 1, :, None] + step[None], 1) + e[:, t]
            alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
        total = _lse(alpha[:, -1], 1)
        for t in range(width - 2, -1, -1):
            new = _lse(step[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1, None], new, 0.0)
        p = np.exp(alpha + beta - total[:, None, None]) * inside[:, :, None]
        joint = (alpha[:, :-1, :, None] + step[None, None]
                 + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
        expected = (np.exp(joint) * pair[:, :, None, None]).sum(axis=(0, 1))
        d = hot - p
        grads = []
        for role in (types, left, right):
            by_type = np.zeros((len(features), n_labels))
            np.add.at(by_type, role.ravel(), d.reshape(-1, n_labels))
            grads.append(features.T @ by_type)
        grads += [(hot[:, 0] - p[:, 0]).sum(axis=0), seen_step - expected]
        for i, g in enumerate(grads):
            g = g - penalty * params[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] + rate * (m[i] / (1 - 0.9 ** k)) / (
                np.sqrt(v[i] / (1 - 0.999 ** k)) + 1e-8)
    assert rows.size == n
    return Model(*params[:3], params[3] + ban_first, params[4] + ban_step)


def viterbi(e: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best labels of every padded sequence; ties go to the smaller label."""
    n, width, _ = e.shape
    score = start + e[:, 0]
    back = np.zeros(e.shape, np.int16)
    for t in range(1, width):
        options = score[:, :, None] + step[None]
        back[:, t] = options.argmax(axis=1)
        new = options.max(axis=1) + e[:, t]
        score = np.where((t < lengths)[:, None], new, score)
    out = np.zeros((n, width), np.int64)
    label = score.argmax(axis=1)
    for t in range(width - 1, -1, -1):
        live = t < lengths
        out[live, t] = label[live]
        label = np.where(live & (t > 0), back[np.arange(n), t, label], label)
    return out


def quiet_margin(model_tables: tuple[np.ndarray, np.ndarray, np.ndarray], start: np.ndarray,
                 step: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Per role and type the least lead of label 0 over any other, and the lead a token
    needs so that no path through another label can win: each such place touches at
    most two transitions. Where all tokens' summed leads exceed it, label 0 throughout
    is the best path, without decoding."""
    leads = [t[:, 0] - t[:, 1:].max(axis=1) for t in model_tables]
    gain = max(0.0, float(step.max() - step[0, 0]), float(start.max() - start[0]))
    return leads, 2 * gain
