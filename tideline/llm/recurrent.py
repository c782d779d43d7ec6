"""A gated recurrent network with a class-factored softmax, in numpy: steps, losses and training.

The probability of a token is that of its class given the state, times that of the token in its
class: a softmax over the class's words for frequent words, and a fixed share (by counts) for all
others. Texts run side by side in lanes; a lane takes the next text when one ends, and its state
starts anew there. States are carried from window to window, so a text of any length is scored whole
in bounded memory, while training goes back through one window only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 24
WINDOW = 32
LANES = 384
TRAIN_LANES, TRAIN_WINDOW = 96, 20
RATE = 0.004
#: a block of lanes has at most about so many cells, filled or not
CELLS = 8_000_000
#: the gradients of symbols that stand so often in a window are added in one go for all symbols
FEW = 4
#: up to here exponentials and their sums are finite and not zero
SAFE = 60


@dataclass
class Network:
    """Weights by name: inputs (symbol x 3H: candidate, reset, update), gates (H x 3H: reset, update,
    candidate), classes and words of classes, the last row of these being biases.

    Those of reset and update have the other sign, as their sigmoid wants it."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, class_log: np.ndarray, word_log: np.ndarray, symbols: int) -> Network:
        """Starts as the unigram model: biases are log probabilities, other weights are small."""
        draw = np.random.default_rng(7)
        groups, size = word_log.shape

        def small(*shape: int, by: float) -> np.ndarray:
            return draw.normal(0, by, shape).astype(np.float32)

        z, r, n = np.split(small(symbols, 3 * HIDDEN, by=0.3), 3, 1)
        inputs = np.concatenate([n, -r, -z], 1)
        z, r, n = np.split(small(HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5), 3, 1)
        gates = np.concatenate([-r, -z, n], 1)
        class_out = small(HIDDEN, len(class_log), by=0.05)
        word_out = small(groups, HIDDEN, size, by=0.05)
        return cls(
            {
                "inputs": inputs,
                "gates": gates,
                "class_out": np.concatenate([class_out, class_log[None]]).astype(np.float32),
                "word_out": np.concatenate([word_out, word_log[:, None]], 1).astype(np.float32),
            }
        )

    def step(self, h: np.ndarray, symbol: np.ndarray):
        """The next state of each lane, and what the way back needs."""
        return forward(self, h, symbol[None], np.zeros((1, len(h)), bool))[1:]

    def token_logs(self, states: np.ndarray, group: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log probabilities; `word` is -1 where the class alone counts."""
        x = with_one(states)
        logs, _, _ = log_shares(x @ self.weights["class_out"], group)
        order, ends = by_group(group, word, len(self.weights["word_out"]))
        x, out = x[order], self.weights["word_out"]
        of_words = np.empty((len(order), out.shape[2]), x.dtype)
        for c, start, end in ends:
            np.dot(x[start:end], out[c], out=of_words[start:end])
        logs[order] += log_shares(of_words, word[order])[0]
        return logs


def with_one(states: np.ndarray) -> np.ndarray:
    """States as rows, and a one behind each that takes the bias."""
    x = np.ones((states.size // HIDDEN, HIDDEN + 1), states.dtype)
    x[:, :HIDDEN] = states.reshape(-1, HIDDEN)
    return x


def log_shares(x: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log softmax of each row at one place; the exponentials, which take the place of x, and their sums."""
    at = x[np.arange(len(x)), taken]
    if x.size and not -SAFE < x.max() < SAFE or x.size and at.min() < -SAFE:
        most = x.max(-1)
        at -= most
        x -= most[:, None]
    np.exp(x, out=x)
    sums = x @ np.ones(x.shape[1], x.dtype)
    return at - np.log(sums), x, sums


def by_group(group: np.ndarray, word: np.ndarray, groups: int):
    """Places of tokens that are words of a class, sorted by class, and where each class stands there."""
    inner = np.flatnonzero(word >= 0)
    of = group[inner].astype(np.uint16)
    sizes = np.bincount(of, minlength=groups)
    ends = np.cumsum(sizes)
    found = np.flatnonzero(sizes)
    stands = zip(found.tolist(), (ends - sizes)[found].tolist(), ends[found].tolist(), strict=True)
    return inner[np.argsort(of, kind="stable")], list(stands)


def forward(net: Network, h: np.ndarray, symbol: np.ndarray, new: np.ndarray):
    """States before each token of a window, the state after it, and what the way back needs."""
    a, gates = net.weights["inputs"].take(symbol, 0), net.weights["gates"]
    states = np.empty((len(symbol) + 1, *h.shape), a.dtype)
    g, rz, cand = np.empty_like(a), np.empty_like(a[:, :, HIDDEN:]), np.empty_like(states[1:])
    starting = new.any(1).tolist()
    states[0] = h
    for t in range(len(symbol)):
        h, after, x, c, gt = states[t], states[t + 1], rz[t], cand[t], g[t]
        if starting[t]:
            h[new[t]] = 0
        np.dot(h, gates, out=gt)
        np.add(a[t, :, HIDDEN:], gt[:, : 2 * HIDDEN], out=x)
        np.exp(x, out=x)
        x += 1
        np.reciprocal(x, out=x)
        np.multiply(x[:, :HIDDEN], gt[:, 2 * HIDDEN :], out=c)
        c += a[t, :, :HIDDEN]
        np.tanh(c, out=c)
        np.subtract(h, c, out=after)
        after *= x[:, HIDDEN:]
        after += c
    return states[:-1], states[-1], (rz[:, :, :HIDDEN], rz[:, :, HIDDEN:], cand, g[:, :, 2 * HIDDEN :])


def lanes(lengths: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, list[list[int]]]]:
    """Texts dealt to lanes, longest first and each to the shortest lane: lane lengths and texts.

    More than one block if lanes of very different lengths would leave too many empty cells.
    """
    order = np.argsort(-lengths, kind="stable")
    start = 0
    while start < len(order):
        longest = max(int(lengths[order[start]]), 1)
        width = int(min(most, max(1, CELLS // longest), len(order) - start))
        # a block takes texts until its lanes are as long as its longest text, or all of them
        free = longest * width
        stop, used = start, 0
        while stop < len(order) and (stop < start + width or width == most or used < free):
            used += int(lengths[order[stop]])
            stop += 1
        total, rows = np.zeros(width, np.int64), [[] for _ in range(width)]
        heap = [(0, k) for k in range(width)]
        for i in order[start:stop]:
            _, k = heapq.heappop(heap)
            rows[k].append(int(i))
            total[k] += lengths[i]
            heapq.heappush(heap, (int(total[k]), k))
        by = np.argsort(-total, kind="stable")
        yield total[by], [rows[k] for k in by]
        start = stop


@dataclass
class Texts:
    """Token arrays of some texts, one after the other, and where each text begins."""

    symbol: np.ndarray
    group: np.ndarray
    word: np.ndarray
    starts: np.ndarray

    def laid(self, most: int):
        """Blocks: lane lengths and for each cell (time x lane) the token's place, -1 if empty."""
        lengths = np.diff(self.starts)
        for total, rows in lanes(lengths, most):
            place = np.full((int(total[0]) if len(total) else 0, len(total)), -1, np.int64)
            fresh = np.zeros(place.shape, bool)
            for k, texts in enumerate(rows):
                t = 0
                for i in texts:
                    n = int(lengths[i])
                    place[t : t + n, k] = np.arange(self.starts[i], self.starts[i + 1])
                    fresh[t, k] = True
                    t += n
            yield total, place, fresh


def score(net: Network, texts: Texts) -> np.ndarray:
    """Natural log probability of every token."""
    logs = np.zeros(len(texts.symbol), np.float64)
    for total, place, fresh in texts.laid(LANES):
        h = np.zeros((place.shape[1], HIDDEN), np.float32)
        for t0 in range(0, len(place), WINDOW):
            active = int(np.searchsorted(-total, -t0, side="left"))
            span = min(WINDOW, len(place) - t0)
            h = h[:active]
            at = place[t0 : t0 + span, :active]
            # an empty cell takes the last symbol; its state is not used
            states, h, _ = forward(net, h, texts.symbol[at], fresh[t0 : t0 + span, :active])
            full = at >= 0
            where = at[full]
            logs[where] = net.token_logs(states[full], texts.group[where], texts.word[where])
    return logs


class Adam:
    """Moves weights by their gradients; of the inputs only the rows of some symbols have one."""

    def __init__(self, inputs: np.ndarray, others: np.ndarray, rate: float) -> None:
        self.rate, self.count, self.inputs, self.others = rate, 0, inputs, others
        # sums of gradients, and roots of those of their squares, which rows without a gradient need
        # no root for; the averages of Adam are a tenth and a thousandth of the sums
        self.first, self.root = np.zeros_like(others), np.zeros_like(others)
        self.rows_first, self.rows_root = np.zeros_like(inputs), np.zeros_like(inputs)
        self.step, self.rows_step = np.empty_like(others), np.empty_like(inputs)

    def move(self, rows: np.ndarray, of_rows: np.ndarray, slopes: np.ndarray) -> None:
        self.count += 1
        ratio = 1000**0.5 / 10
        scale = self.rate * (1 - 0.999**self.count) ** 0.5 / (1 - 0.9**self.count) * ratio
        for weights, first, root, step in (
            (self.inputs, self.rows_first, self.rows_root, self.rows_step),
            (self.others, self.first, self.root, self.step),
        ):
            first *= 0.9
            root *= 0.999**0.5
            if weights is self.inputs:
                some_first, some_root = first[rows], root[rows]
                added(some_first, some_root, of_rows)
                first[rows], root[rows] = some_first, some_root
            else:
                added(first, root, slopes)
            np.add(root, 1e-6 * 1000**0.5, out=step)
            np.divide(first, step, out=step)
            step *= scale
            weights -= step


def added(first: np.ndarray, root: np.ndarray, slopes: np.ndarray) -> None:
    """Adds gradients to the sums of Adam."""
    np.maximum(slopes, -1, out=slopes)
    np.minimum(slopes, 1, out=slopes)
    first += slopes
    root *= root
    root += np.square(slopes, out=slopes)
    np.sqrt(root, out=root)


def joined(weights: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A copy of all weights, one after the other, and views of it by name."""
    flat, views, at = np.concatenate([v.ravel() for v in weights.values()]), {}, 0
    for k, v in weights.items():
        views[k] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    return flat, views


def slopes(net: Network, h: np.ndarray, at: np.ndarray, new: np.ndarray, texts: Texts):
    """Gradients of the mean loss of one window, the state after it, and its loss and tokens."""
    out = {k: np.zeros_like(v) for k, v in net.weights.items()}
    found, sums, *rest = window(net, h, at, new, texts, out)
    out["inputs"][found] = sums
    return out, *rest


def window(net: Network, h: np.ndarray, at: np.ndarray, new: np.ndarray, texts: Texts, out: dict):
    """As `slopes`, but the gradients of the inputs by symbol, the others in `out`."""
    w, shape = net.weights, at.shape
    symbol = texts.symbol[at]
    before, after, (r, z, cand, gn) = forward(net, h, symbol, new)
    full = (at >= 0).ravel()
    n = max(int(full.sum()), 1)
    where = at.ravel()
    group, word = texts.group[where], np.where(full, texts.word[where], -1)
    x = with_one(before)
    logs, d, sums = log_shares(x @ w["class_out"], group)
    loss = -float(logs @ full)
    d *= (full / (sums * n)).astype(d.dtype)[:, None]
    d[np.arange(len(d)), group] -= full.astype(d.dtype) / n
    np.dot(x.T, d, out=out["class_out"])
    d_states = d @ w["class_out"][:HIDDEN].T
    order, ends = by_group(group, word, len(w["word_out"]))
    inner, word = x[order], word[order]
    d = np.empty((len(order), w["word_out"].shape[2]), x.dtype)
    for c, start, end in ends:
        np.dot(inner[start:end], w["word_out"][c], out=d[start:end])
    logs, d, sums = log_shares(d, word)
    loss -= float(logs.sum())
    sums *= n
    d /= sums[:, None]
    d[np.arange(len(d)), word] -= 1 / n
    out["word_out"][...] = 0
    back = np.empty((len(order), HIDDEN), x.dtype)
    for c, start, end in ends:
        np.dot(inner[start:end].T, d[start:end], out=out["word_out"][c])
        np.dot(d[start:end], w["word_out"][c, :HIDDEN].T, out=back[start:end])
    d_states[order] += back
    d_states = d_states.reshape(*shape, HIDDEN)
    # what the gradient of a state is multiplied by on its way to the candidate and the gates
    less = z - 1
    to_update = before - cand
    to_update *= z
    to_update *= less
    cand *= cand
    cand -= 1
    cand *= less
    to_reset = r - 1
    to_reset *= r
    to_reset *= gn
    gates = w["gates"].T.copy()
    d = np.empty((*shape, 4 * HIDDEN), x.dtype)  # candidate, reset, update, candidate behind its reset
    dh, through = np.zeros((shape[1], HIDDEN), x.dtype), np.empty((shape[1], HIDDEN), x.dtype)
    d_cand, d_reset, d_update, d_behind = (d[:, :, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
    starting = new.any(1).tolist()
    for t in reversed(range(len(at))):
        dc = np.multiply(dh, cand[t], out=d_cand[t])
        np.multiply(dh, to_update[t], out=d_update[t])
        np.multiply(dc, to_reset[t], out=d_reset[t])
        np.multiply(dc, r[t], out=d_behind[t])
        dh *= z[t]
        dh += d_states[t]
        dh += np.dot(d[t, :, HIDDEN:], gates, out=through)
        if starting[t]:
            dh[new[t]] = 0
    d = d.reshape(-1, 4 * HIDDEN)
    np.dot(x[:, :HIDDEN].T, d[:, HIDDEN:], out=out["gates"])
    found, sums = row_sums(symbol.ravel(), d)
    return found, sums[:, : 3 * HIDDEN], after, loss, int(full.sum())


def row_sums(symbol: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols, each once, and the sums of their rows."""
    order = np.argsort(symbol.astype(np.uint16) if symbol.max() < 1 << 16 else symbol, kind="stable")
    symbol = symbol[order]
    first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    times = np.diff(first, append=len(symbol))
    sums = d[order[first]]
    for k in range(1, FEW):
        more = np.flatnonzero((times > k) & (times <= FEW))
        sums[more] += d[order[first[more] + k]]
    many = times > FEW
    often = times[many]
    if len(often):
        sums[many] = np.add.reduceat(d[order[np.repeat(many, times)]], np.cumsum(often) - often, axis=0)
    return symbol[first], sums


def train(net: Network, texts: Texts, rate: float = RATE) -> tuple[float, int]:
    """One way through the texts by truncated backpropagation; changes the weights."""
    names = ("gates", "class_out", "word_out")
    flat, views = joined({k: net.weights[k] for k in names})
    net.weights = {"inputs": net.weights["inputs"].copy(), **views}
    flat_slopes, out = joined(views)
    adam, loss, tokens = Adam(net.weights["inputs"], flat, rate), 0.0, 0
    for total, place, fresh in texts.laid(TRAIN_LANES):
        h = np.zeros((place.shape[1], HIDDEN), np.float32)
        for t0 in range(0, len(place), TRAIN_WINDOW):
            active = int(np.searchsorted(-total, -t0, side="left"))
            span = slice(t0, t0 + TRAIN_WINDOW)
            found, sums, h, more, n = window(net, h[:active], place[span, :active], fresh[span, :active], texts, out)
            adam.move(found, sums, flat_slopes)
            loss, tokens = loss + more, tokens + n
    return loss, tokens
