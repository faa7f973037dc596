"""A character-level bidirectional LSTM with a linear-chain CRF, in numpy.

Both directions run as one batch: direction 1 sees every window reversed. Training minimises the
CRF's negative log-likelihood by back-propagation through time and Adam steps; decoding is
Viterbi. Everything is seeded, so equal training windows give an equal model.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Characters are ASCII as such; the rest are letters, digits, blanks or other.
SYMBOLS = 132


def symbols(codes: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Input symbol of each code point; ``letter`` tells which code points are letters."""
    blank = (codes == 0x85) | (codes == 0xA0) | ((codes >= 0x2000) & (codes <= 0x200A)) | (codes == 0x3000)
    other = np.where(letter[codes], 128, np.where(blank, 129, 130))
    return np.where(codes < 128, codes, other).astype(np.int16)


PADDING = 131


class Tagger(NamedTuple):
    embed: np.ndarray  # [symbol, width]
    inputs: np.ndarray  # [2, width, 4 * hidden]
    recur: np.ndarray  # [2, hidden, 4 * hidden]
    bias: np.ndarray  # [2, 1, 4 * hidden]
    emit: np.ndarray  # [2 * hidden, tag]
    emit_bias: np.ndarray  # [tag]
    trans: np.ndarray  # [from, to]
    first: np.ndarray  # [tag]


def new_tagger(tags: int, hidden: int, width: int, rng: np.random.Generator) -> Tagger:
    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[-2]), shape)

    bias = np.zeros((2, 1, 4 * hidden))
    bias[:, :, hidden : 2 * hidden] = 1  # remember by default
    return Tagger(
        rng.normal(0, 0.3, (SYMBOLS, width)), drawn(2, width, 4 * hidden), drawn(2, hidden, 4 * hidden), bias,
        drawn(2 * hidden, tags), np.zeros(tags), np.zeros((tags, tags)), np.zeros(tags),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _run(model: Tagger, windows: np.ndarray, keep: bool):
    """Hidden states [window, place, 2 * hidden]; with ``keep`` what back-propagation needs."""
    n, length = windows.shape
    hidden = model.recur.shape[1]
    # Projections of all symbols once, instead of one product per character.
    table = np.matmul(model.embed[None], model.inputs) + model.bias
    both = np.stack([windows, windows[:, ::-1]])
    state, cell = np.zeros((2, n, hidden), table.dtype), np.zeros((2, n, hidden), table.dtype)
    out = np.empty((2, length, n, hidden), table.dtype)
    kept = []
    for t in range(length):
        gates = np.stack([table[0][both[0, :, t]], table[1][both[1, :, t]]]) + np.matmul(state, model.recur)
        opened = _sigmoid(gates[:, :, : 3 * hidden])
        new = np.tanh(gates[:, :, 3 * hidden :])
        let, forget, show = opened[:, :, :hidden], opened[:, :, hidden : 2 * hidden], opened[:, :, 2 * hidden :]
        before, past = cell, state
        cell = forget * cell + let * new
        tanh = np.tanh(cell)
        state = show * tanh
        out[:, t] = state
        if keep:
            kept.append((let, forget, show, new, before, past, tanh))
    joined = np.concatenate([out[0], out[1, ::-1]], 2)  # [place, window, 2 * hidden]
    return joined.transpose(1, 0, 2), kept, both


def emissions(model: Tagger, windows: np.ndarray) -> np.ndarray:
    states, _, _ = _run(model, windows, keep=False)
    return states @ model.emit + model.emit_bias


def decode(model: Tagger, windows: np.ndarray) -> np.ndarray:
    """The best tag sequence of every window."""
    scores = emissions(model, windows)
    n, length, tags = scores.shape
    value = scores[:, 0] + model.first
    back = np.empty((length, n, tags), np.int8)
    for t in range(1, length):
        paths = value[:, :, None] + model.trans
        back[t] = paths.argmax(1)
        value = paths.max(1) + scores[:, t]
    path = np.empty((n, length), np.int8)
    path[:, -1] = value.argmax(1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = back[t][rows, path[:, t]]
    return path


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def gradients(model: Tagger, windows: np.ndarray, tags: np.ndarray) -> tuple[float, Tagger]:
    """Mean loss of the windows and its gradient."""
    n, length = windows.shape
    count, hidden = len(model.first), model.recur.shape[1]
    states, kept, both = _run(model, windows, keep=True)
    scores = states @ model.emit + model.emit_bias
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = model.first + scores[:, 0]
    for t in range(1, length):
        alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + model.trans, 1) + scores[:, t]
    for t in range(length - 2, -1, -1):
        beta[:, t] = _log_sum(model.trans + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    total = _log_sum(alpha[:, -1], 1)
    onehot = np.eye(count)[tags]
    off = np.exp(alpha + beta - total[:, None, None]) - onehot
    pairs = alpha[:, :-1, :, None] + model.trans + (scores[:, 1:] + beta[:, 1:])[:, :, None, :]
    expected = np.exp(pairs - total[:, None, None, None]).sum((0, 1))
    seen = np.einsum("nti,ntj->ij", onehot[:, :-1], onehot[:, 1:])
    gold = (scores * onehot).sum() + (model.trans * seen).sum() + model.first[tags[:, 0]].sum()
    loss = (total.sum() - gold) / n
    off /= n
    slope_emit = np.einsum("nth,ntk->hk", states, off)
    toward = (off @ model.emit.T).transpose(1, 0, 2)
    toward = np.stack([toward[:, :, :hidden], toward[::-1, :, hidden:]])  # [2, place, window, hidden]
    recur = np.zeros_like(model.recur)
    table = np.zeros((2, SYMBOLS, 4 * hidden))
    next_state, next_cell = np.zeros((2, n, hidden)), np.zeros((2, n, hidden))
    for t in range(length - 1, -1, -1):
        let, forget, show, new, before, past, tanh = kept[t]
        state = toward[:, t] + next_state
        cell = next_cell + state * show * (1 - tanh**2)
        gates = np.concatenate(
            [
                cell * new * let * (1 - let),
                cell * before * forget * (1 - forget),
                state * tanh * show * (1 - show),
                cell * let * (1 - new**2),
            ],
            2,
        )
        next_cell = cell * forget
        next_state = np.matmul(gates, model.recur.transpose(0, 2, 1))
        recur += np.matmul(past.transpose(0, 2, 1), gates)
        for side in (0, 1):
            np.add.at(table[side], both[side, :, t], gates[side])
    return loss, Tagger(
        sum(table[side] @ model.inputs[side].T for side in (0, 1)),
        np.matmul(model.embed.T[None], table), recur, table.sum(1, keepdims=True),
        slope_emit, off.sum((0, 1)), (expected - seen) / n, off[:, 0].sum(0),
    )


def train(
    windows: np.ndarray, tags: np.ndarray, count: int, hidden: int, width: int,
    batches: int, batch: int = 64, rate: float = 0.01, seed: int = 7,
) -> Tagger:
    rng = np.random.Generator(np.random.PCG64(seed))
    model = new_tagger(count, hidden, width, rng)
    moment, square = [np.zeros_like(x) for x in model], [np.zeros_like(x) for x in model]
    for turn in range(1, batches + 1):
        drawn = rng.integers(0, len(windows), batch)
        _, slope = gradients(model, windows[drawn], tags[drawn])
        norm = np.sqrt(sum((x**2).sum() for x in slope))
        scale = min(1.0, 5.0 / (norm + 1e-9))
        step = rate * (1 - turn / (batches + 1))
        changed = []
        for i, (value, by) in enumerate(zip(model, slope)):
            by = by * scale
            moment[i] = 0.9 * moment[i] + 0.1 * by
            square[i] = 0.999 * square[i] + 0.001 * by**2
            ahead = (moment[i] / (1 - 0.9**turn)) / (np.sqrt(square[i] / (1 - 0.999**turn)) + 1e-8)
            changed.append(value - step * ahead)
        model = Tagger(*changed)
    return Tagger(*[x.astype(np.float32) for x in model])
