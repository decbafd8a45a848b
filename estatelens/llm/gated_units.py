"""A gated recurrent network over token symbols, with a softmax in two steps, in numpy.

A symbol is one of the frequent words or the class of a rare one. The network reads a document symbol by
symbol; its state gives the class of the next token and, where that is a class of frequent words, the word in
it. Training goes back through windows of bounded length, and the state goes on from window to window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The symbol that ends a document and stands before its first token; the state is zero when it is read.
END = 0

#: Rows whose classes are worked out at once: what they need stays in a core's cache.
_BLOCK_ROWS = 2_048

#: Documents that take a step at once, for the same reason.
_STEP_ROWS = 1_024

#: Up to here exponentials and their sums are far from the ends of a float's range.
_FAR = 60

#: As arrays: a Python number costs a small step more than its arithmetic.
_ONE, _TWO = (np.full((), x, np.float32) for x in (1, 2))


@dataclass(frozen=True)
class Shape:
    """``words`` frequent ones in classes of ``class_words``, then ``rare`` classes; ``width`` of the state."""

    words: int
    class_words: int
    rare: int
    width: int

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.class_words)

    @property
    def symbols(self) -> int:
        return self.words + self.rare

    @property
    def classes(self) -> int:
        return self.word_classes + self.rare

    def arrays(self) -> dict[str, tuple[int, ...]]:
        w = self.width
        return {
            "embed": (self.symbols, w),
            "inward": (w, 3 * w),
            "inward_bias": (3 * w,),
            "gates": (w, 2 * w),
            "recall": (w, w),
            "class_out": (w, self.classes),
            "class_bias": (self.classes,),
            "word_out": (self.words, w),
            "word_bias": (self.words,),
        }

    def size(self) -> int:
        return sum(int(np.prod(x)) for x in self.arrays().values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The network's arrays as parts of one."""
        found, at = {}, 0
        for name, dims in self.arrays().items():
            n = int(np.prod(dims))
            found[name] = flat[at : at + n].reshape(dims)
            at += n
        return found

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.words, symbols // self.class_words, symbols - self.words + self.word_classes)


def first_parameters(shape: Shape, counts: np.ndarray, seed: int = 11) -> np.ndarray:
    """Small random weights, and biases that say how often each symbol occurs: at first, a unigram model."""
    draw = np.random.default_rng(seed)
    flat = (draw.standard_normal(shape.size()) * 0.1).astype(np.float32)
    at = shape.views(flat)
    at["inward_bias"][:] = 0
    at["inward_bias"][: shape.width] = 1.0
    smooth = counts + 1.0
    by_class = np.bincount(shape.class_of(np.arange(shape.symbols)), smooth, shape.classes)
    at["class_bias"][:] = np.log(by_class / by_class.sum())
    at["word_bias"][:] = np.log(smooth[: shape.words])
    at["class_out"][:] *= 0.3
    at["word_out"][:] *= 0.3
    return flat


def _exponentials(logits: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log probability of each row's picked column, and the rows' sums of exponentials, which replace ``logits``."""
    if max(logits.max(initial=0), -logits.min(initial=0)) > _FAR:
        logits -= logits.max(1, keepdims=True)
    found = logits[np.arange(len(logits)), picked]
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], logits.dtype)
    return found - np.log(sums), sums


def _errors(logits: np.ndarray, picked: np.ndarray, real: np.ndarray | None) -> float:
    """The loss of the picked columns; its slope, zero for rows that are not ``real``, replaces ``logits``."""
    found, sums = _exponentials(logits, picked)
    logits *= (1.0 / sums)[:, None]
    logits[np.arange(len(logits)), picked] -= 1
    if real is None:
        return -float(found.sum())
    logits *= real[:, None]
    return -float((found * real).sum())


def _in_order(values: np.ndarray, most: int) -> np.ndarray:
    """A stable order of numbers below ``most``; short ones are sorted faster."""
    return np.argsort(values.astype(np.uint16) if most <= 1 << 16 else values, kind="stable")


def _by_class(shape: Shape, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, int, int]]]:
    """The rows whose next token is a frequent word, class by class, and ``part of them, first word, end of words``."""
    order = _in_order(classes, shape.classes)
    ends = np.searchsorted(classes[order], np.arange(shape.word_classes + 1)).tolist()
    parts = [
        (slice(ends[c], ends[c + 1]), c * shape.class_words, min((c + 1) * shape.class_words, shape.words))
        for c in range(shape.word_classes)
        if ends[c + 1] > ends[c]
    ]
    return order[: ends[-1]], parts


@dataclass(frozen=True)
class _Recurrence:
    """The weights of a step, gate by gate: negative for keep and reset and twice that for the proposed state, so that
    a sigmoid is one over one plus one exponential and a tanh two over it less one; an exponential costs numpy half a
    tanh. ``table`` holds what each symbol adds to keep, reset and the proposed state.

    Exponentials may overflow to infinity, which gives the right end; callers keep numpy from warning.
    """

    table: np.ndarray
    gates: np.ndarray
    recall: np.ndarray

    @classmethod
    def of(cls, at: dict[str, np.ndarray]) -> _Recurrence:
        w = at["recall"].shape[0]
        table = (at["embed"] @ at["inward"] + at["inward_bias"]).reshape(-1, 3, w).transpose(1, 0, 2).copy()
        table[:2] *= -1
        table[2] *= -2
        return cls(table, -at["gates"].reshape(w, 2, w).transpose(1, 0, 2), at["recall"] * np.float32(-2))

    def step(self, inward: np.ndarray, state: np.ndarray, gate=None, proposed=None, after=None):
        """One token: the gates, the proposed state and the next one, in the arrays given for them."""
        gate = np.matmul(state, self.gates, out=gate)
        gate += inward[:2]
        np.exp(gate, out=gate)
        gate += _ONE
        np.reciprocal(gate, out=gate)
        keep, reset = gate
        proposed = np.matmul(reset * state, self.recall, out=proposed)
        proposed += inward[2]
        np.exp(proposed, out=proposed)
        proposed += _ONE
        np.divide(_TWO, proposed, out=proposed)
        proposed -= _ONE
        after = np.subtract(state, proposed, out=after)
        after *= keep
        after += proposed
        return keep, reset, proposed, after


def next_log_probabilities(shape: Shape, at: dict[str, np.ndarray], states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each next symbol: of its class, and of a frequent word in its class."""
    classes = shape.class_of(symbols)
    found = np.empty(len(symbols))
    for low in range(0, len(symbols), _BLOCK_ROWS):
        own = slice(low, low + _BLOCK_ROWS)
        logits = states[own] @ at["class_out"]
        logits += at["class_bias"]
        found[own] = _exponentials(logits, classes[own])[0]
    order, parts = _by_class(shape, classes)
    seen, wanted, inside = states[order], symbols[order], np.empty(len(order))
    for own, low, high in parts:
        logits = seen[own] @ at["word_out"][low:high].T
        logits += at["word_bias"][low:high]
        inside[own] = _exponentials(logits, wanted[own] - low)[0]
    found[order] += inside
    return found


def log_likelihoods(
    shape: Shape, flat: np.ndarray, symbols: np.ndarray, lengths: np.ndarray, window_rows: int = 32_768
) -> np.ndarray:
    """Natural log likelihood of each whole document; ``symbols`` has them one after another.

    Documents go side by side, the longest first, each with its own state from its first token to its last.
    Outputs are taken for a window of ``window_rows`` states at a time, which bounds memory, not results.
    """
    at, w = shape.views(flat), shape.width
    units = _Recurrence.of(at)
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    total = np.zeros(len(lengths))
    side = int((lengths > 0).sum())
    gates, proposed = (np.empty((*x, min(side, _STEP_ROWS), w), np.float32) for x in ((2,), ()))
    states = np.empty((window_rows + side, w), np.float32)
    state, read = np.zeros((side, w), np.float32), np.full(side, END)
    wanted: list[np.ndarray] = []
    waiting = 0

    most = int(sorted_lengths[0]) if len(lengths) else 0
    left = (len(lengths) - np.searchsorted(sorted_lengths[::-1], np.arange(most), "right")).tolist() if most else []
    with np.errstate(over="ignore"):
        for step, n in enumerate(left):
            after = states[waiting : waiting + n]
            for low in range(0, n, _STEP_ROWS):
                own = slice(low, min(low + _STEP_ROWS, n))
                m = own.stop - low
                units.step(units.table.take(read[own], 1), state[own], gates[:, :m], proposed[:m], after[own])
            state, read = after, symbols[starts[:n] + step]
            wanted.append(read)
            waiting += n
            if waiting >= window_rows or step == most - 1:
                owners = np.concatenate([np.arange(len(x)) for x in wanted])
                logs = next_log_probabilities(shape, at, states[:waiting], np.concatenate(wanted))
                total[:side] += np.bincount(owners, logs, side)
                state, wanted, waiting = state.copy(), [], 0
    out = np.zeros(len(lengths))
    out[order] = total
    return out


def gradients(
    shape: Shape,
    flat: np.ndarray,
    read: np.ndarray,
    wanted: np.ndarray,
    state: np.ndarray,
    real: np.ndarray | None = None,
    room: dict[str, np.ndarray] | None = None,
) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean loss of a window of ``steps x lanes`` tokens, its gradient, and the state after it.

    Where ``real`` is zero, and not one, there is no token: the place adds nothing. ``room`` keeps arrays for the next
    window.
    """
    at, slope = shape.views(flat), np.zeros_like(flat)
    to, units = shape.views(slope), _Recurrence.of(at)
    steps, lanes = read.shape
    w, n = shape.width, steps * lanes
    room = {} if room is None else room

    def space(name: str, *dims: int) -> np.ndarray:
        if name not in room or room[name].size < np.prod(dims):
            room[name] = np.empty(dims, np.float32)
        return room[name].ravel()[: int(np.prod(dims))].reshape(dims)

    reading = np.ascontiguousarray(read).ravel()
    inward = units.table.take(reading, 1, space("inward", 3, n, w), "clip").reshape(3, steps, lanes, w)
    going = (read != END).astype(np.float32)[:, :, None]
    before, proposals, states = (space(x, steps, lanes, w) for x in ("before", "proposals", "states"))
    both = space("gates", steps, 2, lanes, w)
    with np.errstate(over="ignore"):
        for t in range(steps):
            np.multiply(state, going[t], out=before[t])
            *_, state = units.step(inward[:, t], before[t], both[t], proposals[t], states[t])
    # The arrays are used again.
    state = state.copy()

    flat_states, symbols, ones = states.reshape(n, w), wanted.ravel(), np.ones(n, np.float32)
    classes = shape.class_of(symbols)
    real = None if real is None else real.ravel().astype(np.float32)
    loss, back = 0.0, space("back", n, w)
    for low in range(0, n, _BLOCK_ROWS):
        own = slice(low, min(low + _BLOCK_ROWS, n))
        error = np.matmul(flat_states[own], at["class_out"], out=space("classes", own.stop - low, shape.classes))
        error += at["class_bias"]
        loss += _errors(error, classes[own], None if real is None else real[own])
        to["class_out"] += (error.T @ flat_states[own]).T
        to["class_bias"] += ones[own] @ error
        np.matmul(error, at["class_out"].T, out=back[own])
    order, parts = _by_class(shape, classes)
    seen = flat_states.take(order, 0, space("seen", len(order), w), "clip")
    inside, picked = space("inside", len(order), w), symbols[order]
    for own, low, high in parts:
        error = seen[own] @ at["word_out"][low:high].T
        error += at["word_bias"][low:high]
        loss += _errors(error, picked[own] - low, None if real is None else real[order[own]])
        to["word_out"][low:high] = error.T @ seen[own]
        to["word_bias"][low:high] = ones[own] @ error
        np.matmul(error, at["word_out"][low:high], out=inside[own])
    back[order] += inside

    back = back.reshape(steps, lanes, w)
    # What was read of a step is not needed after its slopes: they take its place.
    d_inward = inward
    later = np.zeros((lanes, w), np.float32)
    recall, gates = np.ascontiguousarray(at["recall"].T), -units.gates.transpose(0, 2, 1)
    for t in reversed(range(steps)):
        d, (keep, reset), proposed, old = back[t], both[t], proposals[t], before[t]
        d += later
        kept = d * keep
        d -= kept
        d_keep, d_reset, d_proposed = d_inward[:, t]
        np.subtract(old, proposed, out=d_keep)
        d_keep *= keep
        d_keep *= d
        np.multiply(proposed, proposed, out=d_proposed)
        d_proposed *= d
        np.subtract(d, d_proposed, out=d_proposed)
        through = d_proposed @ recall
        through *= reset
        np.subtract(1, reset, out=d_reset)
        d_reset *= through
        d_reset *= old
        later = d_keep @ gates[0]
        later += d_reset @ gates[1]
        later += kept
        later += through
        later *= going[t]
        # What the proposed state was of, for its weights' slope.
        np.multiply(reset, old, out=proposed)
    old, d_inward = before.reshape(n, w), d_inward.reshape(3, n, w)
    for k in range(2):
        to["gates"][:, k * w : (k + 1) * w] = old.T @ d_inward[k]
    to["recall"][:] = proposals.reshape(n, w).T @ d_inward[2]
    # Slopes are added up by the symbol that was read, and then go through the weights of symbols.
    order = _in_order(reading, shape.symbols)
    found, firsts = np.unique(reading[order], return_index=True)
    for k in range(3):
        own = slice(k * w, (k + 1) * w)
        sums = np.add.reduceat(d_inward[k].take(order, 0, back.reshape(n, w), "clip"), firsts)
        to["inward"][:, own] = at["embed"][found].T @ sums
        to["inward_bias"][own] = sums.sum(0)
        to["embed"][found] += sums @ at["inward"][:, own].T
    total = n if real is None else max(float(real.sum()), 1.0)
    slope /= total
    return loss / total, slope, state


def trained(
    shape: Shape, flat: np.ndarray, stream: np.ndarray, lanes: int, window: int, rate: float, least_windows: int = 16
) -> np.ndarray:
    """The parameters after one pass over a stream of documents, each ended by ``END``.

    The stream is cut into lanes that go side by side, and all its tokens are learned from; short streams are cut
    into fewer, so that there are some ``least_windows`` windows. Adam's averages begin anew in each call.
    """
    lanes = int(np.clip(len(stream) // (window * least_windows), 1, lanes))
    steps = -(-len(stream) // lanes)
    spare = steps * lanes - len(stream)
    stream = np.concatenate([[END], stream, np.full(spare, END)]).astype(np.int64)
    read, wanted = (x.reshape(lanes, steps).T for x in (stream[:-1], stream[1:]))
    real = (np.arange(steps * lanes) < steps * lanes - spare).reshape(lanes, steps).T
    flat = flat.astype(np.float32).copy()
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    state, room = np.zeros((lanes, shape.width), np.float32), {}
    for i, at in enumerate(range(0, steps, window), 1):
        here = slice(at, at + window)
        there = None if real[here].all() else real[here]
        _, slope, state = gradients(shape, flat, read[here], wanted[here], state, there, room)
        norm = float(np.sqrt((slope * slope).sum()))
        slope *= min(1.0, 1.0 / max(norm, 1e-9))
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        flat -= rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.99**i)) + 1e-6)
    return flat
