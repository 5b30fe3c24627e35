"""A gated recurrent word model in numpy.

The softmax is factored: words, by frequency, form classes of ``CLASS_WORDS``; a word's
probability is that of its class times that of the word within it. Word 0 stands for the end
of a text (and for what is before its first word), word 1 for all words outside the
vocabulary. Training is truncated backpropagation: gradients end at windows of ``WINDOW``
words, the state goes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

END, OTHER = 0, 1
N_HIDDEN = 16
N_CLASSES = 32
CLASS_WORDS = 64
N_WORDS = N_CLASSES * CLASS_WORDS
WINDOW = 32
SCORE_BATCH = 1024
TRAIN_BATCH = 128
RATE = 0.2
_SHAPES = {
    "inputs": (N_WORDS, 3 * N_HIDDEN),
    "gates": (N_HIDDEN, 2 * N_HIDDEN),
    "candidate": (N_HIDDEN, N_HIDDEN),
    "classes": (N_HIDDEN, N_CLASSES),
    "class_bias": (N_CLASSES,),
    "words": (N_CLASSES, N_HIDDEN, CLASS_WORDS),
    "word_bias": (N_CLASSES, CLASS_WORDS),
}
Parameters = dict[str, np.ndarray]


def initial(counts: np.ndarray, seed: int = 7) -> Parameters:
    """Small random weights; biases that give each word its share of ``counts`` (N_WORDS of them)."""
    rng = np.random.default_rng(seed)
    weights = {name: (rng.standard_normal(shape) * 0.1).astype(np.float32) for name, shape in _SHAPES.items()}
    # A little mass for words never seen, so that every word has a probability.
    share = (counts + 0.01).reshape(N_CLASSES, CLASS_WORDS)
    weights["class_bias"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    weights["word_bias"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return weights


def pack(weights: Parameters) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in _SHAPES])


def unpack(flat: np.ndarray) -> Parameters:
    weights, at = {}, 0
    for name, shape in _SHAPES.items():
        size = int(np.prod(shape))
        weights[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(w: Parameters, words: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """State after reading one word per row, and what backpropagation needs."""
    given = w["inputs"][words]
    gates = _sigmoid(given[:, : 2 * N_HIDDEN] + state @ w["gates"])
    update, reset = gates[:, :N_HIDDEN], gates[:, N_HIDDEN:]
    new = np.tanh(given[:, 2 * N_HIDDEN :] + (reset * state) @ w["candidate"])
    return state + update * (new - state), update, reset, new


def _by_class(targets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each class that occurs."""
    classes = targets // CLASS_WORDS
    order = np.argsort(classes, kind="stable")
    bounds = np.searchsorted(classes[order], np.arange(N_CLASSES + 1))
    for c in range(N_CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, order[bounds[c] : bounds[c + 1]]


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def log_probabilities(w: Parameters, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target after each state."""
    classes = _log_softmax(states @ w["classes"] + w["class_bias"])
    result = classes[np.arange(len(targets)), targets // CLASS_WORDS].astype(np.float64)
    for c, rows in _by_class(targets):
        within = _log_softmax(states[rows] @ w["words"][c] + w["word_bias"][c])
        result[rows] += within[np.arange(len(rows)), targets[rows] % CLASS_WORDS]
    return result


def score(w: Parameters, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each text, a sequence of words that ends with END.

    Texts of similar length are read in step; the state goes through the whole text.
    """
    totals = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for at in range(0, len(order), SCORE_BATCH):
        members = order[at : at + SCORE_BATCH]
        lengths = np.array([len(texts[i]) for i in members])
        state = np.zeros((len(members), N_HIDDEN), dtype=np.float32)
        before = np.full(len(members), END)
        for start in range(0, int(lengths[0]), WINDOW):
            going = int(np.searchsorted(-lengths, -start))  # longest first: those with words left
            window = np.zeros((going, WINDOW), dtype=np.int64)
            for row in range(going):
                piece = texts[members[row]][start : start + WINDOW]
                window[row, : len(piece)] = piece
            state, before = state[:going], before[:going]
            steps = min(WINDOW, int(lengths[0]) - start)
            states = np.empty((steps, going, N_HIDDEN), dtype=np.float32)
            for t in range(steps):
                state = _step(w, before, state)[0]
                states[t], before = state, window[:, t]
            inside = (start + np.arange(steps))[:, None] < lengths[None, :going]
            found = log_probabilities(w, states[inside], window.T[:steps][inside])
            row_of = np.broadcast_to(np.arange(going), inside.shape)[inside]
            totals[members[:going]] += np.bincount(row_of, weights=found, minlength=going)
    return totals


class Trainer:
    """Adagrad over batches of segments."""

    def __init__(self, weights: Parameters):
        self.w = {name: value.copy() for name, value in weights.items()}
        self.squares = {name: np.full(value.shape, 1e-6, dtype=np.float32) for name, value in weights.items()}
        self.n_targets = 0

    def train(self, segments: list[tuple[int, np.ndarray]]) -> None:
        """One pass over segments: the word before, and the words."""
        segments = sorted(segments, key=lambda segment: -len(segment[1]))
        for at in range(0, len(segments), TRAIN_BATCH):
            batch = segments[at : at + TRAIN_BATCH]
            lengths = np.array([len(words) for _, words in batch])
            padded = np.full((len(batch), int(lengths[0])), -1, dtype=np.int64)
            for row, (_, words) in enumerate(batch):
                padded[row, : len(words)] = words
            state = np.zeros((len(batch), N_HIDDEN), dtype=np.float32)
            before = np.array([word for word, _ in batch])
            for start in range(0, padded.shape[1], WINDOW):
                going = int(np.searchsorted(-lengths, -start))
                window = padded[:going, start : start + WINDOW]
                state = self._window(state[:going], before[:going], window)
                before = np.maximum(window[:, -1], END)

    def _window(self, state: np.ndarray, before: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Forward, backward and one update; returns the state after the window."""
        w, steps = self.w, window.shape[1]
        inputs = np.concatenate([before[:, None], np.maximum(window[:, :-1], END)], axis=1).T
        trace, states = [], np.empty((steps, len(state), N_HIDDEN), dtype=np.float32)
        for t in range(steps):
            previous = state
            state, update, reset, new = _step(w, inputs[t], state)
            trace.append((previous, update, reset, new))
            states[t] = state
        inside = window.T >= 0
        grads = {name: np.zeros_like(value) for name, value in w.items() if name != "inputs"}
        from_output = np.zeros_like(states)
        from_output[inside] = self._output_gradient(states[inside], window.T[inside], grads)
        given = np.empty((steps, len(state), 3 * N_HIDDEN), dtype=np.float32)
        back = np.zeros_like(state)
        for t in range(steps - 1, -1, -1):
            previous, update, reset, new = trace[t]
            back = back + from_output[t]
            d_new = back * update * (1 - new * new)
            d_product = d_new @ w["candidate"].T
            d_gates = np.concatenate(
                [back * (new - previous) * update * (1 - update), d_product * previous * reset * (1 - reset)], axis=1
            )
            grads["candidate"] += (reset * previous).T @ d_new
            grads["gates"] += previous.T @ d_gates
            given[t, :, : 2 * N_HIDDEN], given[t, :, 2 * N_HIDDEN :] = d_gates, d_new
            back = back * (1 - update) + d_product * reset + d_gates @ w["gates"].T
        n = max(1, int(inside.sum()))
        self.n_targets += n
        for name, grad in grads.items():
            self._update(name, slice(None), grad / n)
        words = inputs.ravel()
        order = np.argsort(words, kind="stable")
        used, starts = np.unique(words[order], return_index=True)
        self._update("inputs", used, np.add.reduceat(given.reshape(-1, 3 * N_HIDDEN)[order], starts, axis=0) / n)
        return state

    def _output_gradient(self, states: np.ndarray, targets: np.ndarray, grads: Parameters) -> np.ndarray:
        """Gradient of the loss in the states; adds that of the output weights to ``grads``."""
        w, rows = self.w, np.arange(len(targets))
        error = np.exp(_log_softmax(states @ w["classes"] + w["class_bias"]))
        error[rows, targets // CLASS_WORDS] -= 1
        grads["classes"] += states.T @ error
        grads["class_bias"] += error.sum(axis=0)
        result = error @ w["classes"].T
        for c, members in _by_class(targets):
            own = states[members]
            error = np.exp(_log_softmax(own @ w["words"][c] + w["word_bias"][c]))
            error[np.arange(len(members)), targets[members] % CLASS_WORDS] -= 1
            grads["words"][c] += own.T @ error
            grads["word_bias"][c] += error.sum(axis=0)
            result[members] += error @ w["words"][c].T
        return result

    def _update(self, name: str, where, grad: np.ndarray) -> None:
        self.squares[name][where] += grad * grad
        self.w[name][where] -= RATE * grad / np.sqrt(self.squares[name][where])
