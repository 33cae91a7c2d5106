"""A bidirectional LSTM in numpy that labels every element of a sequence, and its training."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PATHS, WORDS = 2048, 1024  # hash buckets
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 8, 16


@dataclass
class Batch:
    """Padded sequences: numbers (T, B, F), mean word and path vectors' indices, and a mask (T, B)."""

    numbers: np.ndarray
    path_at: np.ndarray  # (n, 2): element of T * B, bucket
    word_at: np.ndarray
    mask: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    def __init__(self, numbers: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + numbers
        self.weights = {
            "path": rng.normal(0, 0.3, (PATHS, PATH_SIZE)), "word": rng.normal(0, 0.1, (WORDS, WORD_SIZE)),
            **{f"{d}_in": rng.normal(0, size ** -0.5, (size, 4 * HIDDEN)) for d in "fb"},
            **{f"{d}_own": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)) for d in "fb"},
            **{f"{d}_bias": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN) for d in "fb"},
            "out": rng.normal(0, 0.2, (2 * HIDDEN + size, 1)), "out_bias": np.zeros(1)}
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _means(self, at: np.ndarray, table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        count = np.maximum(np.bincount(at[:, 0], minlength=n), 1).astype(np.float32)
        total = np.zeros((n, table.shape[1]), np.float32)
        rows = table[at[:, 1]]
        start = np.flatnonzero(np.diff(at[:, 0], prepend=-1))  # elements rise
        if len(start):
            total[at[start, 0]] = np.add.reduceat(rows, start, axis=0)
        return total / count[:, None], count

    def inputs(self, batch: Batch) -> tuple[np.ndarray, tuple]:
        steps, width = batch.mask.shape
        path, n_path = self._means(batch.path_at, self.weights["path"], steps * width)
        word, n_word = self._means(batch.word_at, self.weights["word"], steps * width)
        x = np.concatenate([path, word], 1).reshape(steps, width, -1)
        return np.concatenate([x, batch.numbers], 2), (n_path, n_word)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        w = self.weights
        steps, width, _ = x.shape
        gates = x @ w[f"{d}_in"] + w[f"{d}_bias"]
        h = c = np.zeros((width, HIDDEN), np.float32)
        out, saved = np.zeros((steps, width, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ w[f"{d}_own"]
            i, f, o = (sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                saved.append((t, i, f, o, g, c, squashed, h, m))
            c = new * m + c * (1 - m)
            h = o * squashed * m + h * (1 - m)
            out[t] = h
        return out, saved

    def forward(self, batch: Batch, keep: bool = False):
        x, counts = self.inputs(batch)
        ahead, saved_f = self._run(x, batch.mask, "f", keep)
        back, saved_b = self._run(x, batch.mask, "b", keep)
        joined = np.concatenate([ahead, back, x], 2)
        logits = (joined @ self.weights["out"])[..., 0] + self.weights["out_bias"]
        return logits, (x, counts, joined, saved_f, saved_b)

    def gradients(self, batch: Batch, labels: np.ndarray) -> dict[str, np.ndarray]:
        logits, (x, counts, joined, saved_f, saved_b) = self.forward(batch, True)
        steps, width, _ = x.shape
        w = self.weights
        error = ((sigmoid(logits) - labels) * batch.mask / max(batch.mask.sum(), 1)).astype(np.float32)
        out = {"out": np.einsum("tbk,tb->k", joined, error)[:, None], "out_bias": np.array([error.sum()])}
        to_joined = error[..., None] * w["out"][:, 0]
        to_x = to_joined[..., 2 * HIDDEN:].copy()
        for d, saved, part in (("f", saved_f, 0), ("b", saved_b, HIDDEN)):
            dz_all = np.zeros((steps, width, 4 * HIDDEN), np.float32)
            own = np.zeros_like(w[f"{d}_own"])
            dh, dc = np.zeros((width, HIDDEN), np.float32), np.zeros((width, HIDDEN), np.float32)
            for t, i, f, o, g, c, squashed, h, m in reversed(saved):
                dh = dh + to_joined[t][:, part:part + HIDDEN]
                live = dh * m
                dnew = dc * m + live * o * (1 - squashed ** 2)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f),
                                     live * squashed * o * (1 - o), dnew * i * (1 - g ** 2)], 1)
                dz_all[t] = dz
                own += h.T @ dz
                dh = dh * (1 - m) + dz @ w[f"{d}_own"].T
                dc = dc * (1 - m) + dnew * f
            out[f"{d}_in"] = np.einsum("tbi,tbj->ij", x, dz_all)
            out[f"{d}_own"], out[f"{d}_bias"] = own, dz_all.sum((0, 1))
            to_x += dz_all @ w[f"{d}_in"].T
        flat = to_x.reshape(steps * width, -1)
        for name, at, low, size, n in (("path", batch.path_at, 0, PATH_SIZE, counts[0]),
                                       ("word", batch.word_at, PATH_SIZE, WORD_SIZE, counts[1])):
            change = np.zeros_like(w[name])
            np.add.at(change, at[:, 1], (flat[:, low:low + size] / n[:, None])[at[:, 0]])
            out[name] = change
        return out

    def fit(self, batches: list[tuple[Batch, np.ndarray]], rounds: int, rate: float = 0.01, seed: int = 5) -> None:
        """Adam over the batches in shuffled order, its rate falling to a tenth."""
        rng = np.random.default_rng(seed)
        one = {k: np.zeros_like(v) for k, v in self.weights.items()}
        two = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for turn in range(rounds):
            now = rate * 0.1 ** (turn / rounds)
            for n in rng.permutation(len(batches)):
                step += 1
                for k, g in self.gradients(*batches[n]).items():
                    one[k] = 0.9 * one[k] + 0.1 * g
                    two[k] = 0.99 * two[k] + 0.01 * g * g
                    change = now * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - change).astype(np.float32)
