"""A gated recurrent language model with a class-factored softmax, in numpy.

Token 0 is any rare word, token 1 the end of a text, the others are frequent words by falling
frequency. Words are cut into classes of neighbouring frequency; the probability of a word is that of
its class times that of the word in its class. Texts lie one after the other in lanes; the state goes
on from window to window and starts anew with each text, so a text is scored as a whole. Training
stops gradients at window borders (truncated backpropagation); there lanes are of one length, so a text
that crosses a lane's end goes on in the next lane with an empty state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RARE, END = 0, 1


def classes(counts: np.ndarray, number: int, largest: int) -> np.ndarray:
    """First token of each class, and the number of tokens at the end. Tokens 0 and 1 are classes of
    their own; the others share the square roots of their counts evenly, in classes of a bounded size."""
    roots = np.sqrt(np.maximum(counts[2:], 1).astype(np.float64))
    level = np.floor(np.cumsum(roots) / max(roots.sum(), 1e-9) * (number - 1e-6)).astype(np.int64)
    starts = [0, 1]
    for k in range(len(roots)):
        if k == 0 or level[k] != level[k - 1] or k + 2 - starts[-1] >= largest:
            starts.append(k + 2)
    return np.array([*starts, len(counts)], np.int64)


@dataclass
class Model:
    starts: np.ndarray
    weights: dict[str, np.ndarray]
    _class: np.ndarray | None = None

    @classmethod
    def initial(cls, counts: np.ndarray, hidden: int, number: int, largest: int) -> Model:
        """Starts as the unigram distribution of ``counts``; the other weights are small and random."""
        rng = np.random.default_rng(12345)
        starts = classes(counts, number, largest)
        c = counts.astype(np.float64) + 1.0
        of_class = np.add.reduceat(c, starts[:-1])
        word = np.log(c) - np.log(np.repeat(of_class, np.diff(starts)))
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        gates = small(len(c), 3 * hidden)
        gates[:, hidden : 2 * hidden] += 1.0
        return cls(
            starts,
            {
                "gates": gates,
                "state": (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32),
                "class": small(hidden, len(starts) - 1) * 0.1,
                "class_bias": (np.log(of_class) - np.log(of_class.sum())).astype(np.float32),
                "word": small(len(c), hidden) * 0.1,
                "word_bias": word.astype(np.float32),
            },
        )

    @property
    def hidden(self) -> int:
        return self.weights["state"].shape[0]

    def states(self, steps: Steps, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The states after each row of some steps, and for training those before, the gates, the fresh
        parts and what the reset gate was multiplied by; ``h`` is the state before the first step."""
        n = self.hidden
        # The gates are 1 / (1 + exp(-x)), the fresh part is 1 - 2 / (1 + exp(2 x)).
        scale = np.repeat(np.array([-1, 2], np.float32), [2 * n, n])
        a, state = self.weights["gates"].take(steps.tokens, axis=0), self.weights["state"] * scale
        a *= scale
        gates, last = np.ascontiguousarray(a[:, : 2 * n]), np.ascontiguousarray(a[:, 2 * n :])
        after, before, rec_last = np.empty_like(last), np.empty_like(last), np.empty_like(last)
        # Where an exponential overflows, the gate is 0 and the fresh part 1, as they should be.
        with np.errstate(over="ignore"):
            for start, stop, fresh in steps.rows():
                old = before[start:stop]
                old[:] = h[: stop - start]
                if len(fresh):
                    old[fresh] = 0
                rec = old @ state
                rz = gates[start:stop]
                rz += rec[:, : 2 * n]
                np.exp(rz, out=rz)
                rz += 1.0
                np.reciprocal(rz, out=rz)
                rec_new = rec_last[start:stop]
                rec_new[:] = rec[:, 2 * n :]
                new = last[start:stop]
                new += rz[:, :n] * rec_new
                np.exp(new, out=new)
                new += 1.0
                np.divide(-2.0, new, out=new)
                new += 1.0
                h = np.subtract(old, new, out=after[start:stop])
                h *= rz[:, n:]
                h += new
        return after, (before, gates[:, :n], gates[:, n:], last, rec_last)

    def outputs(self, h: np.ndarray, targets: np.ndarray, train: bool = False):
        """Natural log-probabilities of the targets; for training also the gradients of their sum."""
        w = self.weights
        if self._class is None:
            self._class = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)).astype(np.uint16)
        of = self._class[targets]
        order = np.argsort(of, kind="stable")
        # Rows of one class lie together from here on.
        h, of = h[order], of[order].astype(np.intp)
        inside = targets[order] - self.starts[of]
        bounds = np.searchsorted(of, np.arange(len(self.starts)))
        p, log_p = _softmax(h @ w["class"] + w["class_bias"], of, train)
        if train:
            np.negative(p, out=p)
            p[np.arange(len(of)), of] += 1.0
            # Words of classes that are not met have no gradient.
            words, biases = np.zeros_like(w["word"]), np.zeros_like(w["word_bias"])
            grads = {"class": h.T @ p, "class_bias": _ones(len(p)) @ p, "word": words, "word_bias": biases}
            dh = p @ w["class"].T
        for k in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(self.starts) > 1)):
            among, rows = slice(self.starts[k], self.starts[k + 1]), slice(bounds[k], bounds[k + 1])
            p, log_word = _softmax(h[rows] @ w["word"][among].T + w["word_bias"][among], inside[rows], train)
            log_p[rows] += log_word
            if train:
                np.negative(p, out=p)
                p[np.arange(len(p)), inside[rows]] += 1.0
                words[among] = p.T @ h[rows]
                biases[among] = _ones(len(p)) @ p
                dh[rows] += p @ w["word"][among]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return (log_p[back], grads, dh[back]) if train else log_p[back]


#: Logits within these bounds neither overflow nor vanish in a softmax.
BOUND = 60.0


def _ones(n: int) -> np.ndarray:
    return np.ones(n, np.float32)


def _softmax(logits: np.ndarray, picked: np.ndarray, whole: bool) -> tuple[np.ndarray | None, np.ndarray]:
    """Probabilities, if the ``whole`` distribution is asked for, and log-probabilities of the picked ones."""
    if max(logits.max(), -logits.min()) > BOUND:
        logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[np.arange(len(picked)), picked].astype(np.float64)
    np.exp(logits, out=logits)
    # Sums of short rows are faster as a product.
    total = logits @ _ones(logits.shape[1])
    if whole:
        logits *= np.reciprocal(total)[:, None]
    return logits if whole else None, chosen - np.log(total)


@dataclass
class Lanes:
    """Texts dealt over lanes: for each step and lane the token, the one before, and the text."""

    before: np.ndarray
    token: np.ndarray
    text: np.ndarray
    active: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray], lanes: int) -> Lanes:
        """Each text ends with END, which also stands before its first token. Long texts first, each
        to the shortest lane; lanes are then ordered by length, so the active ones come first."""
        lengths = np.array([len(x) for x in texts])
        lanes = max(1, min(lanes, len(texts)))
        load, dealt = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
        for k in np.argsort(-lengths, kind="stable"):
            lane = int(load.argmin())
            dealt[lane].append(k)
            load[lane] += lengths[k]
        order = np.argsort(-load, kind="stable")
        steps = int(load.max(initial=0))
        token = np.zeros((steps, lanes), np.int32)
        before = np.full((steps, lanes), -1, np.int32)
        text = np.zeros((steps, lanes), np.int32)
        for place, lane in enumerate(order):
            at = 0
            for k in dealt[lane]:
                n = lengths[k]
                token[at : at + n, place] = texts[k]
                before[at + 1 : at + n, place] = texts[k][:-1]
                text[at : at + n, place] = k
                at += n
        active = np.searchsorted(-load[order], -np.arange(steps), side="left")
        return cls(before, token, text, active)

    @classmethod
    def even(cls, texts: list[np.ndarray], lanes: int) -> Lanes:
        """One stream of all texts, cut into lanes of one length; only the last one may be shorter."""
        lengths = np.array([len(x) for x in texts], np.int64)
        stream = np.concatenate(texts) if len(texts) else np.zeros(0, np.int64)
        steps = max(1, -(-len(stream) // lanes))
        lanes = -(-len(stream) // steps)
        earlier = np.concatenate([[-1], stream[:-1]])[: len(stream)]
        earlier[(np.cumsum(lengths) - lengths)[lengths > 0]] = -1
        of = lambda x, fill: np.append(x, np.full(lanes * steps - len(x), fill)).astype(np.int32).reshape(lanes, steps).T.copy()
        active = lanes - (np.arange(steps) >= len(stream) - (lanes - 1) * steps)
        return cls(of(earlier, -1), of(stream, 0), of(np.repeat(np.arange(len(texts)), lengths), 0), active)


class Steps:
    """Some steps of lanes, one after the other: their inputs, targets, and the rows at which texts begin.

    A text's first token follows END and the empty state.
    """

    def __init__(self, packed: Lanes, start: int, stop: int):
        sizes = packed.active[start:stop]
        shown = np.arange(packed.token.shape[1]) < sizes[:, None]
        self.tokens, self.targets, self.texts = (x[start:stop][shown] for x in (packed.before, packed.token, packed.text))
        self.ends = np.cumsum(sizes)
        self.fresh = np.flatnonzero(self.tokens < 0)
        self.tokens[self.fresh] = END

    def rows(self) -> list[tuple[int, int, np.ndarray]]:
        """First row and end of each step, and which of its rows begin a text."""
        starts = np.append(0, self.ends[:-1])
        cuts = np.searchsorted(self.fresh, [*starts, self.ends[-1]])
        return [
            (first, end, self.fresh[i:j] - first)
            for first, end, i, j in zip(starts.tolist(), self.ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]


def score(model: Model, texts: list[np.ndarray], lanes: int = 512, window: int = 32) -> np.ndarray:
    """Natural log-probability of each text, its tokens taken as they are."""
    packed = Lanes.of(texts, lanes)
    total = np.zeros(len(texts))
    h = np.zeros((packed.token.shape[1], model.hidden), np.float32)
    start = 0
    while start < len(packed.token):
        # Where few lanes are left, more steps go together.
        stop = min(len(packed.token), start + window * max(1, lanes // max(1, int(packed.active[start]))))
        steps = Steps(packed, start, stop)
        states, _ = model.states(steps, h)
        h, start = states[len(states) - packed.active[stop - 1] :], stop
        total += np.bincount(steps.texts, model.outputs(states, steps.targets), len(texts))
    return total


class Trainer:
    """Adagrad on windows of a few steps."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate = model, np.float32(rate)
        self.squares = {k: np.full_like(v, 1e-3) for k, v in model.weights.items()}

    def train(self, texts: list[np.ndarray], lanes: int = 256, window: int = 16) -> int:
        """One pass over the texts; gives the number of tokens. Little text takes fewer lanes, so that
        there are some windows, and so steps, in each."""
        fewer = sum(len(x) for x in texts) // (8 * window)
        packed = Lanes.even(texts, max(1, min(lanes, fewer)))
        h = np.zeros((packed.token.shape[1], self.model.hidden), np.float32)
        for start in range(0, len(packed.token), window):
            h = self._window(Steps(packed, start, min(start + window, len(packed.token))), h)
        return int(packed.active.sum())

    def _window(self, steps: Steps, h: np.ndarray) -> np.ndarray:
        model, n = self.model, self.model.hidden
        states, (before, r, z, new, rec_new) = model.states(steps, h)
        _, grads, dh_all = model.outputs(states, steps.targets, train=True)
        tokens, state = steps.tokens, np.ascontiguousarray(model.weights["state"].T)
        # What the gradients are multiplied by at each step does not depend on later steps.
        of_new = (1 - z) * (1 - new * new)
        # The recurrent part came doubled.
        of_r = 0.5 * rec_new * r * (1 - r)
        of_z = (before - new) * z * (1 - z)
        dh_all = dh_all.astype(np.float32, copy=False)
        drec, d_new_all = np.empty((len(tokens), 3 * n), np.float32), np.empty_like(z)
        later = np.zeros((0, n), np.float32)
        for first, end, fresh in reversed(steps.rows()):
            at = slice(first, end)
            dh, own = dh_all[at], drec[at]
            dh[: len(later)] += later
            d_new = np.multiply(dh, of_new[at], out=d_new_all[at])
            np.multiply(d_new, of_r[at], out=own[:, :n])
            np.multiply(dh, of_z[at], out=own[:, n : 2 * n])
            np.multiply(d_new, r[at], out=own[:, 2 * n :])
            later = own @ state
            later += dh * z[at]
            later[fresh] = 0
        grads["state"] = before.T @ drec
        drec[:, 2 * n :] = d_new_all
        order = np.argsort(tokens.astype(np.uint16) if len(model.weights["gates"]) < 1 << 16 else tokens, kind="stable")
        rows = tokens[order]
        starts = np.append(0, np.flatnonzero(np.diff(rows)) + 1)
        self._climb("gates", np.add.reduceat(drec[order], starts, axis=0), rows[starts])
        for name, grad in grads.items():
            self._climb(name, grad, slice(None))
        return states[steps.ends[-2] if len(steps.ends) > 1 else 0 :]

    def _climb(self, name: str, grad: np.ndarray, rows) -> None:
        np.minimum(np.maximum(grad, -5, out=grad), 5, out=grad)
        squares = self.squares[name][rows]
        squares += grad * grad
        self.squares[name][rows] = squares
        grad *= self.rate
        grad /= np.sqrt(squares)
        self.model.weights[name][rows] += grad


def average(models: list[dict[str, np.ndarray]], sizes: list[float]) -> dict[str, np.ndarray]:
    """Weights of models trained apart, averaged by the number of tokens they saw."""
    whole = sum(sizes)
    return {k: (sum(m[k] * np.float32(s / whole) for m, s in zip(models, sizes, strict=True))).astype(np.float32) for k in models[0]}
