"""A character-level bidirectional LSTM with CRF transitions, in numpy: training, scores and decoding."""

from dataclasses import dataclass

import numpy as np

EMBEDDED = 16
HIDDEN = 16
FORBIDDEN = -1e4
ALPHABET = 132
"""ASCII, then letters, digits and other characters beyond it, and the padding, which is 131."""
PADDING = 131


def codes(text: str) -> np.ndarray:
    """The number of each character in the alphabet."""
    made = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    for i in np.flatnonzero(made >= 128):
        c = text[i]
        made[i] = 128 if c.isalpha() else 129 if c.isdigit() else 130
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Parameters by name: embedding, one LSTM for each direction, output layer, and transitions between tags."""

    kinds: int
    weights: dict[str, np.ndarray]

    @staticmethod
    def new(kinds: int, seed: int = 1) -> "Tagger":
        drawn = np.random.default_rng(seed)
        tags = 1 + 2 * kinds
        weights = {"embedding": drawn.normal(0, 0.3, (ALPHABET, EMBEDDED))}
        for way in ("forward", "backward"):
            weights[f"{way}_in"] = drawn.normal(0, EMBEDDED**-0.5, (EMBEDDED, 4 * HIDDEN))
            weights[f"{way}_state"] = drawn.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            weights[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        weights |= {"out": drawn.normal(0, 0.2, (2 * HIDDEN, tags)), "out_bias": np.zeros(tags), "moves": np.zeros((tags, tags))}
        return Tagger(kinds, weights)

    @property
    def allowed(self) -> np.ndarray:
        """0 for moves between tags that can be, FORBIDDEN for the rest: a span goes on only in its own kind."""
        tags = 1 + 2 * self.kinds
        made = np.zeros((tags, tags))
        for kind in range(self.kinds):
            going_on = 2 + 2 * kind
            made[:, going_on] = FORBIDDEN
            made[[going_on - 1, going_on], going_on] = 0
        return made

    def _lstm(self, way: str, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction, (rows, length, HIDDEN), in the order of the text."""
        w = self.weights
        table = w["embedding"] @ w[f"{way}_in"] + w[f"{way}_bias"]
        rows, length = ids.shape
        h, c = np.zeros((rows, HIDDEN)), np.zeros((rows, HIDDEN))
        out = np.empty((rows, length, HIDDEN))
        for t in range(length) if way == "forward" else range(length - 1, -1, -1):
            z = table[ids[:, t]] + h @ w[f"{way}_state"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, last = c, h
            c = f * c + i * g
            tanh_c = np.tanh(c)
            h = o * tanh_c
            out[:, t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before, tanh_c, last))
        return out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Scores of each tag at each character, (rows, length, tags)."""
        states = np.concatenate([self._lstm("forward", ids), self._lstm("backward", ids)], 2)
        return states @ self.weights["out"] + self.weights["out_bias"]

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences, and its gradients."""
        w, grads = self.weights, {name: np.zeros_like(x) for name, x in self.weights.items()}
        kept: dict[str, list] = {"forward": [], "backward": []}
        states = np.concatenate([self._lstm(way, ids, kept[way]) for way in kept], 2)
        emitted = states @ w["out"] + w["out_bias"]
        loss, by_emission, grads["moves"] = crf(emitted, w["moves"] + self.allowed, tags)
        grads["out"] = np.einsum("rth,rtk->hk", states, by_emission)
        grads["out_bias"] = by_emission.sum((0, 1))
        by_state = by_emission @ w["out"].T
        for way, part in (("forward", by_state[:, :, :HIDDEN]), ("backward", by_state[:, :, HIDDEN:])):
            dh, dc = np.zeros((len(ids), HIDDEN)), np.zeros((len(ids), HIDDEN))
            by_table = np.zeros((ALPHABET, 4 * HIDDEN))
            for t, i, f, o, g, before, tanh_c, last in reversed(kept[way]):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - tanh_c**2)
                dz = np.concatenate(
                    [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)], 1
                )
                np.add.at(by_table, ids[:, t], dz)
                grads[f"{way}_state"] += last.T @ dz
                dh, dc = dz @ w[f"{way}_state"].T, dc * f
            grads[f"{way}_bias"] = by_table.sum(0)
            grads[f"{way}_in"] = w["embedding"].T @ by_table
            grads["embedding"] += by_table @ w[f"{way}_in"].T
        return loss, grads


def _summed(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def crf(emitted: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of tag sequences, and its gradients by emissions and moves."""
    rows, length, kinds = emitted.shape
    ahead, back = np.empty_like(emitted), np.zeros_like(emitted)
    ahead[:, 0] = emitted[:, 0]
    for t in range(1, length):
        ahead[:, t] = _summed(ahead[:, t - 1, :, None] + moves, 1) + emitted[:, t]
    for t in range(length - 2, -1, -1):
        back[:, t] = _summed(moves + (emitted[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = _summed(ahead[:, -1], 1)
    by_emission = np.exp(ahead + back - total[:, None, None])
    both = ahead[:, :-1, :, None] + moves + (emitted[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    by_move = np.exp(both).sum((0, 1))
    spot = np.arange(rows)[:, None], np.arange(length)[None, :]
    score = emitted[(*spot, tags)].sum(1) + moves[tags[:, :-1], tags[:, 1:]].sum(1)
    by_emission[(*spot, tags)] -= 1
    np.subtract.at(by_move, (tags[:, :-1], tags[:, 1:]), 1)
    return float((total - score).mean()), by_emission / rows, by_move / rows


def train(kinds: int, ids: np.ndarray, tags: np.ndarray, steps: int, rows: int = 64, rate: float = 0.01) -> Tagger:
    """A tagger fitted by Adam to `steps` batches of `rows` windows, drawn alike on every call."""
    tagger, drawn = Tagger.new(kinds), np.random.default_rng(2)
    first = {name: np.zeros_like(x) for name, x in tagger.weights.items()}
    second = {name: np.zeros_like(x) for name, x in tagger.weights.items()}
    for step in range(1, steps + 1):
        some = drawn.integers(0, len(ids), min(rows, len(ids)))
        _, grads = tagger.gradients(ids[some], tags[some])
        norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))  # constant at first, then falling to nothing
        for name, g in grads.items():
            first[name] = 0.9 * first[name] + 0.1 * g * scale
            second[name] = 0.999 * second[name] + 0.001 * (g * scale) ** 2
            tagger.weights[name] -= now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return tagger


def best_paths(emitted: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The likeliest tag sequence of each row."""
    rows, length, _ = emitted.shape
    score, came = emitted[:, 0], np.empty(emitted.shape, np.int8)
    for t in range(1, length):
        both = score[:, :, None] + moves
        came[:, t] = both.argmax(1)
        score = both.max(1) + emitted[:, t]
    path = np.empty((rows, length), np.int64)
    path[:, -1] = score.argmax(1)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = came[np.arange(rows), t, path[:, t]]
    return path
