"""A linear-chain conditional random field over words, in numpy.

Each word has hashed features: prefixes, suffixes, character n-grams, and itself if it is in the lexicon. Their weights
sum up to a score for each label, transitions between neighbouring labels have scores of their own, and all are fitted
by maximum likelihood. Forward and backward sums give each word's label probabilities; they run over many documents at
once, one word position at a time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex

#: Words are runs of letters, lower-cased. Longer runs, as in scripts without blanks, are consecutive words of this length.
LONGEST_WORD = 40
WORD = regex.compile(rf"\p{{L}}{{1,{LONGEST_WORD}}}")
#: Features are hashed to so many weights per label.
BUCKETS = 1 << 16
AFFIXES, GRAMS = (1, 2, 3), (2, 3, 4)
#: Label scores of distinct words that a worker remembers. Beyond it, it starts anew: a bound on memory.
REMEMBERED = 300_000
#: Words whose features are held at once when they are scored.
SCORED = 20_000
#: Positions held at once by forward-backward, and the steps between scalings of its factors.
POSITIONS, SCALED = 250_000, 4


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _hash(codes: np.ndarray, kind: int) -> np.ndarray:
    """A 64-bit hash of each row of codes."""
    h = np.full(len(codes), np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64)))
    for k in range(codes.shape[1]):
        h = _mix(h + codes[:, k])
    return h


def features(words: list[str], lexicon: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of word: where such words stand in the list, and a row of feature buckets for each."""
    lengths = np.array([len(w) for w in words])
    out = []
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        codes = np.array([words[i] for i in at], dtype=f"<U{length}").view(np.uint32).reshape(len(at), length).astype(np.uint64)
        edge = np.ones((len(at), 1), dtype=np.uint64)
        padded = np.hstack((edge, codes, edge * np.uint64(2)))
        columns = []
        for n in AFFIXES:
            if n <= length:
                columns += [_hash(codes[:, :n], 10 + n), _hash(codes[:, length - n :], 20 + n)]
        for n in GRAMS:
            columns += [_hash(padded[:, k : k + n], 30 + n) for k in range(length + 3 - n)]
        buckets = [(c % np.uint64(BUCKETS)).astype(np.int64) + 1 for c in columns]
        whole = _hash(codes, 1)
        # Bucket 0 has no weight: the word is not in the lexicon.
        buckets.append(np.where(np.isin(whole, lexicon), (whole % np.uint64(BUCKETS)).astype(np.int64) + 1, 0))
        out.append((at, np.stack(buckets, axis=1)))
    return out


@dataclass
class Model:
    labels: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Label scores of each word."""
        out = np.zeros((len(words), len(self.labels)), dtype=np.float32)
        for start in range(0, len(words), SCORED):
            part = out[start : start + SCORED]
            for at, buckets in features(words[start : start + SCORED], self.lexicon):
                part[at] = self.weights[buckets].sum(axis=1)
        return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities (step, sequence, label), and the forward, backward and emission factors they come from.

    ``scores`` is (step, sequence, label); sequences are in ascending order of length, so that those still going are the
    last ones at every step. What follows a sequence's end is 0. Factors are scaled to their sum every few steps.
    """
    steps, n, labels = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max()).astype(emit.dtype)
    ended = np.searchsorted(lengths, np.arange(steps), side="right")
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    for t in range(steps):
        k = ended[t]
        now = emit[t, k:] if t == 0 else (ahead[t - 1, k:] @ move) * emit[t, k:]
        if t % SCALED == 0:
            now = now / (now @ np.ones((labels, 1), dtype=emit.dtype))
        ahead[t, k:] = now
    for t in range(steps - 1, -1, -1):
        k = ended[t + 1] if t + 1 < steps else n
        behind[t, ended[t] : k] = 1
        if k < n:
            back = (behind[t + 1, k:] * emit[t + 1, k:]) @ move.T
            if t % SCALED == 0:
                back /= back @ np.ones((labels, 1), dtype=emit.dtype)
            behind[t, k:] = back
    chance = ahead * behind
    chance /= np.maximum(chance.sum(axis=2, keepdims=True), 1e-37)
    return chance, ahead, behind, emit


def expected_moves(ahead: np.ndarray, behind: np.ndarray, emit: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """How often each label is expected to follow each other one, from the factors of ``forward_backward``."""
    move = np.exp(transitions - transitions.max())
    after = behind[1:] * emit[1:]
    # Each step's moves are scaled to sum up to 1; after a sequence's end they are 0.
    total = np.einsum("tni,tni->tn", ahead[:-1] @ move, after)
    weight = np.where(total > 0, 1 / np.where(total > 0, total, 1), 0)
    return np.einsum("tni,tnj->ij", ahead[:-1] * weight[:, :, None], after) * move


def spliced(texts: list[list[str]], labels: list[int], rng: np.random.Generator, steps: int = 64) -> list[tuple[list[str], list[int]]]:
    """Training sequences: every text whole, in pieces, every third piece continued with words of another text."""
    pieces = [(words[i : i + steps], label) for words, label in zip(texts, labels, strict=True) for i in range(0, len(words), steps)]
    order = rng.permutation(len(pieces))
    out = []
    for i, at in enumerate(order.tolist()):
        words, label = pieces[at]
        if i % 3 == 0 and len(words) > 8:
            other, other_label = pieces[order[(i + 1) % len(order)]]
            cut = int(rng.integers(4, len(words) - 3))
            take = other[: len(words) - cut]
            out.append((words[:cut] + take, [label] * cut + [other_label] * len(take)))
            # What was cut off stays a sequence of its own.
            words = words[cut:]
        out.append((words, [label] * len(words)))
    return out


def fit(texts: list[list[str]], labels: list[str], rounds: int = 60, rate: float = 0.1, decay: float = 1e-6, seed: int = 7) -> Model:
    """Fits weights and transitions to texts of one label each, by Adam over all sequences at once."""
    names = sorted(set(labels))
    number = {name: i for i, name in enumerate(names)}
    rng = np.random.default_rng(seed)
    sequences = sorted(spliced(texts, [number[label] for label in labels], rng), key=lambda s: len(s[0]))
    counts = Counter(w for words, _ in sequences for w in words)
    vocabulary = list(counts)
    at_word = {w: i for i, w in enumerate(vocabulary)}
    frequent = [w for w in vocabulary if counts[w] >= 5]
    lexicon = np.array(
        [_hash(np.array([w], dtype=f"<U{len(w)}").view(np.uint32).reshape(1, -1).astype(np.uint64), 1)[0] for w in frequent], dtype=np.uint64
    )
    found = features(vocabulary, lexicon)
    width, n, steps = len(names), len(sequences), max((len(w) for w, _ in sequences), default=1)
    ids, truth = np.zeros((steps, n), dtype=np.int64), np.zeros((steps, n), dtype=np.int64)
    lengths = np.array([len(w) for w, _ in sequences], dtype=np.int64)
    for i, (words, label) in enumerate(sequences):
        ids[: len(words), i] = [at_word[w] for w in words]
        truth[: len(words), i] = label
    inside = np.arange(steps)[:, None] < lengths[None, :]
    real = np.zeros((steps, n, width), dtype=np.float32)
    np.put_along_axis(real, truth[:, :, None], 1.0, axis=2)
    real *= inside[:, :, None]
    both = inside[1:]
    real_pairs = np.zeros((width, width))
    np.add.at(real_pairs, (truth[:-1][both], truth[1:][both]), 1.0)
    weights, transitions = np.zeros((BUCKETS + 1, width), dtype=np.float32), np.zeros((width, width))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (weights, transitions)]
    total = max(1, int(lengths.sum()))
    for step in range(1, rounds + 1):
        model = Model(names, lexicon, weights, transitions)
        table = np.zeros((len(vocabulary), width), dtype=np.float32)
        for at, buckets in found:
            table[at] = weights[buckets].sum(axis=1)
        chance, *factors = forward_backward(table[ids], lengths, transitions)
        moves = expected_moves(*factors, transitions)
        wrong = (real - chance).reshape(-1, width)
        by_word = np.stack([np.bincount(ids.ravel(), weights=wrong[:, k], minlength=len(vocabulary)) for k in range(width)], axis=1)
        slope = np.zeros_like(weights)
        for at, buckets in found:
            for k in range(width):
                slope[:, k] += np.bincount(buckets.ravel(), weights=np.repeat(by_word[at, k], buckets.shape[1]), minlength=BUCKETS + 1)
        slope[0] = 0
        for x, g, (mean, square) in ((weights, slope / total - decay * weights, state[0]), (transitions, (real_pairs - moves) / total, state[1])):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(names, lexicon, weights, transitions)


class Labeller:
    """Label shares of whole texts, with the scores of repeated words remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(model.labels)), dtype=np.float32)

    def _learn(self, texts: list[list[str]]) -> None:
        seen = {w for words in texts for w in words}
        new = list(seen - self.known.keys())
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.table, new = {}, self.table[:0], list(seen)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.table = np.vstack((self.table, self.model.scores(new))) if new else self.table

    def word_chances(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The label probabilities of every word of each text."""
        self._learn(texts)
        out: list[np.ndarray] = [np.zeros((0, len(self.model.labels)))] * len(texts)
        order = sorted((i for i, words in enumerate(texts) if words), key=lambda i: len(texts[i]))
        while order:
            # The longest first, as many as fit in.
            steps = len(texts[order[-1]])
            some = order[-max(1, POSITIONS // steps) :]
            del order[-len(some) :]
            lengths = np.array([len(texts[i]) for i in some])
            ids = np.zeros((steps, len(some)), dtype=np.int64)
            for k, i in enumerate(some):
                ids[: lengths[k], k] = [self.known[w] for w in texts[i]]
            chance = forward_backward(self.table[ids], lengths, self.model.transitions)[0]
            for k, i in enumerate(some):
                out[i] = chance[: lengths[k], k]
        return out

    def shares(self, texts: list[list[str]]) -> np.ndarray:
        """The share of each label in each text's letters; zeros for a text without words."""
        out = np.zeros((len(texts), len(self.model.labels)))
        for k, (words, chances) in enumerate(zip(texts, self.word_chances(texts), strict=True)):
            if words:
                letters = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
                out[k] = letters @ chances / letters.sum()
        return out
