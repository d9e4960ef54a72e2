"""Five-word shingles as 64-bit hashes, ProbMinHash signatures over weighted shingles, and exact similarities."""

from __future__ import annotations

import numpy as np

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = x + _STEP
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hash of each word, remembered for at most `most` words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return h


def shingles(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the shingles of a lower-cased text, in order; a shorter text is one shingle, an empty one none."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, U)
    h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, U(min(width, len(h))))
    for i in range(min(width, len(h))):
        out = mix(out ^ h[i : i + n])
    return out


def weighted(text: str | None, width: int, hashes: WordHashes, weighting: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and their weights: 1 (presence), 1 + ln(count) (log), or the count (count)."""
    s, c = np.unique(shingles(text, width, hashes), return_counts=True)
    return s, {"presence": np.ones(len(c)), "log": 1 + np.log(c), "count": c.astype(float)}[weighting]


def prob_minhash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """Signatures (sets x registers) of weighted sets: two registers agree with the probability Jaccard of their sets.

    Each element is a Poisson process whose rate is its weight; every arrival falls on a random register, which keeps the
    earliest. Elements take turns, one arrival each; one that is later than all registers of its set has no more to say,
    and a set is done when no element is left. Times and places come from the element's hash, so equal elements with
    equal weights arrive alike everywhere. Empty sets have the signature 0.
    """
    sizes = np.array([len(s) for s, _ in sets], np.int64)
    best = np.zeros(len(sets) * registers, U)
    if not sizes.sum():
        return best.reshape(len(sets), registers)
    e = np.concatenate([s for s, _ in sets])
    w = np.concatenate([x for _, x in sets])
    d = np.repeat(np.arange(len(sets)), sizes)
    first = np.full(len(sets) * registers, np.inf)
    t, turn = np.zeros(len(e)), 0
    while len(e):
        with np.errstate(over="ignore"):
            r = mix(e ^ mix(U([turn + 1])))
        t = t - np.log(((r >> U(11)).astype(float) + 0.5) * 2.0**-53) / w
        place = d * registers + (mix(r) % U(registers)).astype(np.int64)
        np.minimum.at(first, place, t)
        won = first[place] == t
        best[place[won]] = e[won]
        live = np.unique(d)
        latest = np.zeros(len(sets))
        latest[live] = first.reshape(-1, registers)[live].max(1)
        stay = t < latest[d]
        e, w, d, t, turn = e[stay], w[stay], d[stay], t[stay], turn + 1
    return best.reshape(len(sets), registers)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` registers (sets x bands), with the band's number in it."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows)
    out = np.broadcast_to(np.arange(1, m // rows + 1, dtype=U), parts.shape[:2]).copy()
    for i in range(rows):
        out = mix(out ^ parts[:, :, i])
    return out.view(np.int64)


def similarities(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(Jaccard of the sets, probability Jaccard of the weighted sets), both exact; 0 if either is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0, 0.0
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    both = (x > 0) & (y > 0)
    plain = both.sum() / len(every)
    # sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i): sort j by x_j / y_j, then either side is a running sum
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    below = np.concatenate([[0.0], np.cumsum(y[order])])
    above = x.sum() - np.concatenate([[0.0], np.cumsum(x[order])])
    at = np.searchsorted(ratio[order], ratio[both], side="left")
    return float(plain), float((1 / (above[at] / x[both] + below[at] / y[both])).sum())
