"""A linear-chain conditional random field over shape numbers, in numpy.

A position's score for a label is a sum of weights for the shapes around it; a pair of
neighbours adds a weight for their labels. Training climbs the likelihood of a small
labelled set; decoding finds the best path for many sequences at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

AROUND = (-2, -1, 0, 1, 2)  # positions whose shapes a score looks at
BATCH_CELLS = 1 << 18  # positions decoded at once, padding included


def padded(sequences: list[np.ndarray], fill: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    out = np.full((len(sequences), int(lengths.max())), fill, dtype=np.int64)
    for row, s in zip(out, sequences, strict=True):
        row[: len(s)] = s
    return out, lengths


def _views(shapes: np.ndarray) -> list[np.ndarray]:
    """Shapes at each of the places around; beyond the ends the shape is 0."""
    reach = max(AROUND)
    wide = np.pad(shapes, ((0, 0), (reach, reach)))
    return [wide[:, reach + k : reach + k + shapes.shape[1]] for k in AROUND]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Crf:
    emit: np.ndarray  # place around, shape, label
    step: np.ndarray  # label, next label

    @classmethod
    def trained(
        cls,
        sequences: list[np.ndarray],
        labels: list[np.ndarray],
        n_shapes: int,
        n_labels: int,
        rounds: int = 400,
        rate: float = 0.1,
        decay: float = 0.02,
    ) -> Crf:
        """Weights that maximise the labelled likelihood less ``decay`` times their squares.

        Shapes count from 1, as 0 is what lies beyond the ends. All starts at zero and
        every round sees all sequences, so training the same set gives the same weights.
        """
        shapes, lengths = padded(sequences, 0)
        golden, _ = padded(labels, 0)
        rows, steps = shapes.shape
        there = np.arange(steps) < lengths[:, None]
        views = _views(shapes)
        emit = np.zeros((len(AROUND), n_shapes + 1, n_labels))
        step = np.zeros((n_labels, n_labels))
        real = np.eye(n_labels)[golden] * there[..., None]
        real_step = np.zeros_like(step)
        pairs = there[:, 1:]
        np.add.at(real_step, (golden[:, :-1][pairs], golden[:, 1:][pairs]), 1)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (emit, step)]
        for turn in range(1, rounds + 1):
            scores = sum(emit[k][v] for k, v in enumerate(views))
            ahead = np.zeros((rows, steps, n_labels))
            ahead[:, 0] = scores[:, 0]
            for t in range(1, steps):
                moved = _log_sum(ahead[:, t - 1, :, None] + step, 1) + scores[:, t]
                ahead[:, t] = np.where(there[:, t, None], moved, ahead[:, t - 1])
            total = _log_sum(ahead[:, -1], 1)
            back = np.zeros((rows, steps, n_labels))
            expected_step = np.zeros_like(step)
            for t in range(steps - 2, -1, -1):
                onward = scores[:, t + 1] + back[:, t + 1]
                moved = _log_sum(step + onward[:, None, :], 2)
                both = ahead[:, t, :, None] + step + onward[:, None, :] - total[:, None, None]
                live = there[:, t + 1]
                expected_step += np.exp(both[live]).sum(axis=0)
                back[:, t] = np.where(live[:, None], moved, 0.0)
            chance = np.exp(ahead + back - total[:, None, None]) * there[..., None]
            slope = np.zeros_like(emit)
            for k, v in enumerate(views):
                np.add.at(slope[k], v[there], (real - chance)[there])
            slopes = (slope - decay * emit, real_step - expected_step - decay * step)
            for weights, grad, (mean, square) in zip((emit, step), slopes, moments, strict=True):
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                scale = np.sqrt(square / (1 - 0.999**turn)) + 1e-8
                weights += rate * (mean / (1 - 0.9**turn)) / scale
        return cls(emit, step)

    def _best(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        shapes, lengths = padded(sequences, 0)
        rows, steps = shapes.shape
        n_labels = len(self.step)
        scores = np.zeros((n_labels, steps, rows))
        for k, v in enumerate(_views(shapes)):
            scores += np.take(np.ascontiguousarray(self.emit[k].T), v.T, axis=1)
        came = np.zeros((steps, n_labels, rows), dtype=np.int8)
        best = scores[:, 0]
        for t in range(1, steps):
            moved, source = best[0] + self.step[0][:, None], came[t]
            for before in range(1, n_labels):
                path = best[before] + self.step[before][:, None]
                better = path > moved  # of equal paths the first label stays
                np.copyto(moved, path, where=better)
                np.copyto(source, np.int8(before), where=better)
            moved += scores[:, t]
            over = t >= lengths
            if over.any():  # a path that has ended stays where it is
                source[:, over] = np.arange(n_labels, dtype=np.int8)[:, None]
                moved = np.where(over, best, moved)
            best = moved
        found = np.zeros((steps, rows), dtype=np.int8)
        found[-1] = best.argmax(axis=0)
        every = np.arange(rows)
        for t in range(steps - 1, 0, -1):
            found[t - 1] = came[t, found[t], every]
        return [column[:n] for column, n in zip(found.T, lengths, strict=True)]

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence, by Viterbi; sequences of like length share a batch."""
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        out: list[np.ndarray] = [np.empty(0, dtype=np.int8)] * len(sequences)
        batch: list[int] = []
        for place, k in enumerate(order):
            if len(sequences[k]):
                batch.append(k)
            following = len(sequences[order[place + 1]]) if place + 1 < len(order) else 0
            if batch and (not following or following * (len(batch) + 1) > BATCH_CELLS):
                for j, labels in zip(batch, self._best([sequences[j] for j in batch]), strict=True):
                    out[j] = labels
                batch = []
        return out
