"""A small causal self-attention language model on subword ids, in numpy.

A position sees itself and what is before it in its window: embeddings, one attention layer, a residual, and a softmax
over classes of tokens. Within its class a token has the share that it has in the training corpus after a token of the
context's kind. Frequent tokens are a class each, the others share classes with tokens of similar neighbours; kinds of
context are finer classes made in the same way, and the embeddings are principal directions of what classes stand after a token.
Probabilities of all tokens add up to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Inputs of a window, and how far the next one is from it: it scores so many tokens with the others as context.
WINDOW = 48
STRIDE = 36
DIM = 24
#: Classes, and how many of them are shared by tokens that are no class of their own; the same for kinds of context.
CLASSES, SHARED = 64, 24
CONTEXTS, SHARED_CONTEXTS = 256, 56
#: So many counts of a class go by its tokens' frequency everywhere, beside those after a kind of context.
PRIOR = 5.0
#: Windows of one batch, and of one that is only scored.
BATCH, SCORED = 64, 128
#: Steps below which the fit meets its windows again, and how often at most; it meets each at least once.
STEPS, AGAIN = 1_500, 8
#: Tokens whose places beside another describe it.
BESIDE = CONTEXTS - SHARED_CONTEXTS
#: So many of the classes after a token go by what is everywhere; components of embeddings, of size 1 in the mean, are cut.
FEW = 20.0
_FAR = 12.0
#: Scores and logits are cut at ``_MOST``, far above what training reaches, and scores of positions not seen below all.
_MOST = np.float32(60)
_SEEN = np.where(np.tri(WINDOW, dtype=bool), _MOST, np.float32(-np.inf))
_ONES = np.ones(max(WINDOW, CLASSES), np.float32)
_SCALE = np.float32(DIM**-0.5)


def windows(tokens: np.ndarray, offsets: np.ndarray, start: int, stride: int = STRIDE, batch: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of (inputs, targets, which targets count, text of each window); every token of a text counts once.

    Text i has the tokens ``offsets[i]`` to ``offsets[i + 1]``. The input before its first token is ``start``; a window
    after the first begins ``WINDOW - stride`` tokens before those it scores.
    """
    sizes = np.diff(offsets)
    many = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // stride)), 0)
    text = np.repeat(np.arange(len(sizes)), many)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    if stride < WINDOW:  # texts' first windows come first: those after them score fewer positions
        order = np.argsort(rank > 0, kind="stable")
        text, rank = text[order], rank[order]
    first = rank * stride
    at = np.arange(WINDOW)
    for lo in range(0, len(text), batch):
        t, f, r = text[lo : lo + batch], first[lo : lo + batch], rank[lo : lo + batch]
        place = f[:, None] + at[None, :]
        there = place < sizes[t][:, None]
        source = np.minimum(offsets[t][:, None] + place, max(len(tokens) - 1, 0))
        targets = np.where(there, tokens[source], start)
        inputs = np.empty_like(targets)
        inputs[:, 1:] = targets[:, :-1]
        inputs[:, 0] = np.where(f > 0, tokens[np.maximum(offsets[t] + f - 1, 0)], start)
        counts = there & ((at[None, :] >= WINDOW - stride) | (r[:, None] == 0))
        yield inputs, targets, counts, t


@dataclass
class Weights:
    embedding: np.ndarray  # token, DIM
    place: np.ndarray  # WINDOW, DIM
    mix: np.ndarray  # DIM, 3 * DIM: queries, keys, values
    back: np.ndarray  # DIM, DIM
    out: np.ndarray  # DIM, class
    bias: np.ndarray  # class

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.place, self.mix, self.back, self.out, self.bias]


def fresh(vocabulary: int, classes: int, seed: int = 11) -> Weights:
    draw = np.random.default_rng(seed)
    made = lambda *shape, by=1.0: (draw.standard_normal(shape) * by).astype(np.float32)
    width = DIM**-0.5
    return Weights(made(vocabulary, DIM, by=0.3), made(WINDOW, DIM, by=0.1), made(DIM, 3 * DIM, by=width), made(DIM, DIM, by=width), made(DIM, classes, by=width), np.zeros(classes, np.float32))


def _folded(w: Weights) -> np.ndarray:
    """The products of what an input passes through in a row: queries and keys, and values and ``back``."""
    both = np.empty((DIM, 2 * DIM), np.float32)
    np.matmul(w.mix[:, :DIM] * _SCALE, w.mix[:, DIM : 2 * DIM].T, out=both[:, :DIM])
    np.matmul(w.mix[:, 2 * DIM :], w.back, out=both[:, DIM:])
    return both


def _shares(asked: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much the last positions of windows see of all, and the sums of that."""
    width = h.shape[1]
    e = np.matmul(asked, h.transpose(0, 2, 1))
    np.minimum(e, _SEEN[width - asked.shape[1] : width, :width], out=e)
    np.exp(e, out=e)
    return e, np.matmul(e, _ONES[:width])[:, :, None]


def features(w: Weights, inputs: np.ndarray, begin: int = 0) -> np.ndarray:
    """What the softmax sees, per window and position from ``begin`` on."""
    both = _folded(w)
    h = w.embedding.take(inputs, axis=0)
    h += w.place[: inputs.shape[1]]
    value = (h.reshape(-1, DIM) @ both[:, DIM:]).reshape(h.shape)
    f = h[:, begin:].copy()
    e, total = _shares((f.reshape(-1, DIM) @ both[:, :DIM]).reshape(f.shape), h)
    seen = np.matmul(e, value)
    seen /= total
    f += seen
    return f


def class_log_of(w: Weights, f: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log-probability of one class per row of features."""
    z = f @ w.out
    z += w.bias
    np.minimum(z, _MOST, out=z)
    got = z[np.arange(len(z)), wanted]
    np.exp(z, out=z)
    return got - np.log(z @ _ONES[: z.shape[1]])


def class_log(w: Weights, f: np.ndarray) -> np.ndarray:
    """Natural log-probabilities of all classes."""
    z = f @ w.out
    z += w.bias
    z -= z.max(axis=-1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=-1, keepdims=True))
    return z


def gradient(w: Weights, inputs: np.ndarray, wanted: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Of the mean negative log-probability of the wanted classes at the positions that count, by part of the weights."""
    dh, rest = _slopes(w, inputs, wanted, counts)
    embedding = np.zeros_like(w.embedding)
    np.add.at(embedding, inputs, dh)
    return [embedding, *rest]


def _slopes(w: Weights, inputs: np.ndarray, wanted: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The same gradient, at every position instead of by its embedding.

    Scores and what is seen go through the folded products, whose slopes are then dealt to their factors.
    """
    both = _folded(w)
    windowed = lambda x: x.reshape(*inputs.shape, -1)
    h = w.embedding.take(inputs.ravel(), axis=0)
    np.add(windowed(h), w.place[: inputs.shape[1]], out=windowed(h))
    made = windowed(h @ both)
    asked, value = made[:, :, :DIM], made[:, :, DIM:]
    e, total = _shares(asked, windowed(h))
    total = total.reshape(-1, 1)
    seen = np.matmul(e, value).reshape(-1, DIM)
    seen /= total
    f = h + seen

    p = f @ w.out
    p += w.bias
    np.minimum(p, _MOST, out=p)
    np.exp(p, out=p)
    share = counts.ravel() / np.float32(max(1, counts.sum()))
    p *= (share / (p @ _ONES[: p.shape[1]]))[:, None]
    p[np.arange(len(p)), wanted.ravel()] -= share
    out, bias = f.T @ p, np.ones(len(p), np.float32) @ p
    df = p @ w.out.T

    g = df / total
    da = np.matmul(windowed(g), value.transpose(0, 2, 1))
    da -= windowed(np.vecdot(g, seen))
    da *= e
    dmade = np.empty_like(made)
    np.matmul(da, windowed(h), out=dmade[:, :, :DIM])
    np.matmul(e.transpose(0, 2, 1), windowed(g), out=dmade[:, :, DIM:])
    dkey = np.matmul(da.transpose(0, 2, 1), asked)
    dmade = dmade.reshape(-1, 2 * DIM)
    dboth = h.T @ dmade
    dscore, dinto = dboth[:, :DIM] * _SCALE, dboth[:, DIM:]
    query, key, into = w.mix[:, :DIM], w.mix[:, DIM : 2 * DIM], w.mix[:, 2 * DIM :]
    mix = np.concatenate([dscore @ key, dscore.T @ query, dinto @ w.back.T], axis=1)
    df += dmade @ both.T
    dh = windowed(df)
    dh += dkey
    return dh, [dh.sum(axis=0), mix, into.T @ dinto, out, bias]


class Learner:
    """Adagrad over windows. Learners of many tasks begin with the same weights, and what they came to is averaged: an
    embedding by how often a task ``met`` its token, all else by how many tokens it has ``seen``."""

    def __init__(self, w: Weights, squares: list[np.ndarray], rate: float = 0.1):
        self.w = Weights(*[x.copy() for x in w.parts()])
        self.squares, self.rate, self.seen = [x.copy() for x in squares], rate, 0
        self.near, self.met = np.full_like(w.embedding, 1e-4), np.zeros(len(w.embedding), np.int64)

    def step(self, inputs: np.ndarray, wanted: np.ndarray, counts: np.ndarray) -> None:
        n = int(counts.sum())
        if not n:
            return
        dh, rest = _slopes(self.w, inputs, wanted, counts)
        for x, g, s in zip(self.w.parts()[1:], rest, self.squares):
            s += g * g
            x -= np.float32(self.rate) * g / np.sqrt(s)
        order = np.argsort(inputs, axis=None, kind="stable")
        tokens = inputs.ravel()[order]
        begin = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] + 1))
        rows = tokens[begin].astype(np.intp)
        g = np.add.reduceat(dh.reshape(-1, DIM).take(order, axis=0), begin, axis=0)
        near = self.near.take(rows, axis=0) + g * g
        self.near[rows] = near
        g *= np.float32(self.rate)
        g /= np.sqrt(near, out=near)
        self.w.embedding[rows] -= g
        self.met[rows] += np.diff(begin, append=len(tokens))
        self.seen += n

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in [*self.w.parts()[1:], *self.squares]]).astype(np.float64)


def no_squares(w: Weights) -> list[np.ndarray]:
    return [np.full_like(x, 1e-4) for x in w.parts()[1:]]


def unflat(w: Weights, flat: np.ndarray) -> tuple[Weights, list[np.ndarray]]:
    """The weights and squares that ``Learner.flat`` wrote, of the shapes of ``w``."""
    shapes, parts, at = [x.shape for x in w.parts()[1:]] * 2, [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        parts.append(flat[at : at + size].reshape(shape).astype(np.float32))
        at += size
    return Weights(w.embedding, *parts[: len(parts) // 2]), parts[len(parts) // 2 :]


def pairs(tokens: np.ndarray, offsets: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Every token, and the one before it; before the first of a text stands ``start``."""
    tokens = tokens.astype(np.int64)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1][np.diff(offsets) > 0]] = start
    return before, tokens


def frequent(counts: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` most frequent tokens."""
    return np.argsort(-counts, kind="stable")[:many]


def classes(counts: np.ndarray, beside: np.ndarray, size: int = CLASSES, shared: int = SHARED) -> np.ndarray:
    """The class of every token: by its count if it is frequent, else by what stands around it.

    ``beside`` counts, per token, which of the ``BESIDE`` most frequent ones stand before it, and then which after it.
    """
    single = frequent(counts, size - shared)
    of = np.full(len(counts), size - 1)  # tokens that stand beside none of them
    of[single] = np.arange(len(single))
    table = np.concatenate([beside[:, : len(single)], beside[:, BESIDE : BESIDE + len(single)]], axis=1)
    table[single] = 0
    known = np.flatnonzero(table.any(axis=1))
    if not len(known):
        return of
    rows = table[known]
    del table
    rows /= rows.sum(axis=1, keepdims=True)
    np.sqrt(rows, out=rows)
    weight = counts[known].astype(np.float64) + 1
    k = min(shared - 1, len(known))
    centres = rows[np.argsort(-weight, kind="stable")[:k]]
    for _ in range(8):
        near = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros(centres.shape)
        for c in range(k):
            sums[c] = weight[near == c] @ rows[near == c]
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres).astype(np.float32)
    of[known] = size - shared + np.argmax(rows @ centres.T, axis=1)
    return of


def begin(w: Weights, follows: np.ndarray) -> Weights:
    """Embeddings, softmax and bias that the fit begins with. ``follows`` counts which class stands after each token.

    An embedding has the principal directions of the log-probabilities of the next class, against those everywhere, and
    the softmax turns them into these again, so the attention layer begins with what the last token alone says.
    """
    n = follows.sum(axis=1, dtype=np.float64)
    share = (follows.sum(axis=0, dtype=np.float64) + 0.5) / (n.sum() + 0.5 * follows.shape[1])
    log = np.log((follows + FEW * share) / (n + FEW)[:, None]) - np.log(share)
    weight = n / max(1.0, n.sum())
    mean = weight @ log
    log = (log - mean) * (n > 0)[:, None]
    value, vector = np.linalg.eigh(log.T @ (log * weight[:, None]))
    value, vector = np.maximum(value[::-1][:DIM], 0), vector[:, ::-1][:, :DIM]
    vector = vector * np.where(vector[np.argmax(np.abs(vector), axis=0), np.arange(DIM)] < 0, -1, 1)
    there = value > 1e-9 * max(float(value[0]), 1e-30)
    scale = np.where(there, 1 / np.sqrt(np.maximum(value, 1e-30)), 0)
    embedding = np.clip(log @ (vector * scale), -_FAR, _FAR).astype(np.float32)
    out = (vector * np.where(there, np.sqrt(value), 0)).T.astype(np.float32)
    return Weights(embedding, w.place * np.float32(0.2), w.mix, w.back * np.float32(0.1), out, (np.log(share) + mean).astype(np.float32))


def inside_log(after: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Per kind of context, each token's natural log-probability within its class. ``after``: counts, context by token."""
    everywhere = after.sum(axis=0, dtype=np.float64) + 1
    share = everywhere / np.bincount(of, everywhere, minlength=CLASSES)[of]
    out = np.empty(after.shape, np.float32)
    for kind, row in enumerate(after):
        whole = np.bincount(of, row, minlength=CLASSES)
        out[kind] = np.log((row + PRIOR * share) / (whole[of] + PRIOR))
    return out


@dataclass
class Model:
    weights: Weights
    of: np.ndarray  # class of every token
    kind: np.ndarray  # kind of context that every token is
    inside: np.ndarray  # kind of context, token
    start: int

    def log10(self, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log10 probability of each text, its last token included."""
        out = np.zeros(len(offsets) - 1)
        for inputs, targets, counts, text in windows(tokens, offsets, self.start, batch=SCORED):
            begin = 0 if counts[:, 0].any() else WINDOW - STRIDE  # no first window of a text is among them
            seen = counts[:, begin:]
            wanted = targets[:, begin:][seen]
            got = class_log_of(self.weights, features(self.weights, inputs, begin)[seen], self.of[wanted])
            got = got.astype(np.float64) + self.inside[self.kind[inputs[:, begin:][seen]], wanted]
            out += np.bincount(np.repeat(text, seen.sum(axis=1)), got, minlength=len(out))
        return out / np.log(10)
