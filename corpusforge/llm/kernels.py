"""NumPy kernels over batches of whole texts: words, shingles, grouped streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text that one vectorised step takes on; a longer text is a step of its own.
STEP = 1 << 20

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_blank = np.zeros(256, dtype=bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers of the words in a shingle.
_place = np.array([pow(0xD1342543DE82EF95, 2 * i + 3, 1 << 64) for i in range(64)], dtype=U)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.cumprod(np.full(size, BASE, dtype=U)), np.cumprod(np.full(size, INVERSE, dtype=U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**(i+1)`` and its inverse modulo 2**64, for at least ``n`` values of i."""
    size = STEP + (1 << 16)
    while size < n:
        size *= 2
    return _powers(size)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ U((seed * 0xA0761D6478BD642F + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any slice follows: see ``slice_hash``."""
    out = np.zeros(len(codes) + 1, dtype=U)
    np.cumsum((codes.astype(U) + U(1)) * powers(len(codes))[0][: len(codes)], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of ``codes[start:end]`` that does not depend on the place."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def steps(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts as UTF-8, by first index; null is empty."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if run and size + len(b) > STEP:
            yield first, run
            first, run, size = i, [], 0
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, run


def word_hashes(run: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run of texts, and the index of each text's first word (plus the end)."""
    buf = np.frombuffer(b" ".join(run) + b" ", dtype=np.uint8)
    gap = _blank[buf]
    edge = np.flatnonzero(np.diff(gap, prepend=True))  # starts and ends alternate, as the buffer ends in a blank
    starts, ends = edge[0::2], edge[1::2]
    sums = prefix_hash(_lower[buf] if lower else buf)
    at = np.cumsum([0] + [len(b) + 1 for b in run])
    return mix(slice_hash(sums, starts, ends)), np.searchsorted(starts, at)


def shingles(run: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word ``n``-grams of each text in order, and each text's first index (plus the end).

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    w, at = word_hashes(run)
    count = np.diff(at)
    kept = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(kept)])
    full = np.zeros(max(len(w) - n + 1, 0), dtype=U)
    for k in range(n):
        full += w[k : k + len(full)] * _place[k]
    owner = np.repeat(np.arange(len(run)), kept)
    index = at[owner] + (np.arange(out_at[-1]) - out_at[owner])
    out = np.zeros(out_at[-1], dtype=U)
    whole = count[owner] >= n
    out[whole] = full[index[whole]]
    for i in np.flatnonzero(~whole):
        words = w[at[owner[i]] : at[owner[i] + 1]]
        out[i] = (words * _place[: len(words)]).sum(dtype=U) + U(len(words))
    return mix(out), out_at


def shingle_sets(texts: list[str | None], n: int = 5) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    for _, run in steps(texts):
        flat, at = shingles(run, n)
        for i in range(len(run)):
            yield np.unique(flat[at[i] : at[i + 1]])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str], size: str | None = None, most: int = 1 << 24) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a stream sorted by ``keys`` (integers).

    Groups arrive in one piece: a group that spans batches is held back until its end has come.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        last = np.ones(batch.num_rows, dtype=bool)
        for c in cols:
            last &= c == c[-1]
        cutoff = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cutoff:
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, cutoff)])
            held = [batch.slice(cutoff)]
        elif len(held) > 1 and any(held[-2].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held[:-1])
            held = [batch]
    if held:
        yield pa.Table.from_batches(held)


def bounds(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row indexes at which the groups of a sorted table start, plus its end."""
    change = np.zeros(t.num_rows, dtype=bool)
    change[:1] = True
    for k in keys:
        c = t.column(k).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def arrow_map(fn: Callable[[pa.RecordBatch], dict[str, pa.Array]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from one on batches; ``fn`` returns columns in the schema's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))

    return run
