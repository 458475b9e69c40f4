"""md5 of many short messages at once, for the bootstrap's draws (STA-1/2).

A draw is the first eight hexadecimal digits of md5(``boot<rep>|<id>``).  The
digest's 64 steps run on arrays of 32-bit words, one entry a row, so a
replicate's draws of some thousand rows cost a few hundred array operations.
The replicate's number changes two words of the first block only; all other
words are laid out once for a chunk of rows.  Ids of any length: rows are
taken by their number of 64-byte blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 1 << 14  # rows at once: a step's arrays stay in the processor's cache
SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
WORDS = ([i for i in range(16)] + [(5 * i + 1) % 16 for i in range(16)] + [(3 * i + 5) % 16 for i in range(16)]
         + [7 * i % 16 for i in range(16)])
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _block(state: Sequence[np.ndarray], words: Sequence[np.ndarray], space: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The state after one block; ``words`` holds for each step its word plus the step's constant.  Sums wrap at 32 bits."""
    f, high, *four = space
    for mine, given in zip(four, state):
        np.copyto(mine, given)
    a, b, c, d = four
    for i in range(64):
        if i < 16:  # d ^ (b & (c ^ d))
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif i < 32:  # c ^ (d & (b ^ c))
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:  # c ^ (b | ~d)
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f), np.add(f, words[i], out=f)
        np.right_shift(f, 32 - SHIFTS[i], out=high), np.left_shift(f, SHIFTS[i], out=f)
        np.bitwise_or(f, high, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    return [np.add(x, y) for x, y in zip((a, b, c, d), state)]


def _laid_out(ids: Sequence[bytes], prefix: int, blocks: int) -> np.ndarray:
    """Message words (block, word, row) with ``prefix`` bytes left free before every id."""
    room = 64 * blocks
    size = np.array([len(x) for x in ids], dtype=np.int64) + prefix
    text = b"".join(x.ljust(room - prefix, b"\0") for x in ids)
    out = np.zeros((len(ids), room), dtype=np.uint8)
    out[:, prefix:] = np.frombuffer(text, dtype=np.uint8).reshape(len(ids), room - prefix)
    out[np.arange(len(ids)), size] = 0x80
    out[:, -8:] = (size * 8).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(out.view("<u4").T).reshape(blocks, 16, len(ids))


def _blocks(size: int) -> int:
    return (size + 9 + 63) // 64


def first_words(ids: Sequence[bytes], tag: bytes, reps: Sequence[int]) -> Iterator[tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
    """Parts of the rows, in their order, each with (rep, the first 32 bits of md5(``<tag><rep>|<id>``)) for some of the
    replicates; together every row with every replicate.  A part's draws are read before the next part is asked for."""
    for digits in sorted({len(str(r)) for r in reps}):
        prefix, some = len(tag) + digits + 1, [r for r in reps if len(str(r)) == digits]
        need = np.array([_blocks(prefix + len(x)) for x in ids], dtype=np.int64)
        for blocks in np.unique(need):
            of = np.flatnonzero(need == blocks)
            for rows in np.split(of, range(CHUNK, len(of), CHUNK)):
                yield rows, _of_layout(_laid_out([ids[i] for i in rows], prefix, int(blocks)), tag, some)


def _of_layout(made: np.ndarray, tag: bytes, reps: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    n = made.shape[2]
    space = [np.empty(n, dtype=np.uint32) for _ in range(6)]
    heads = [np.full(n, x, dtype=np.uint32) for x in START]
    head = len(tag) + len(str(reps[0])) + 1
    touched = set(range(-(-head // 4)))  # words of the first block that hold the replicate
    with np.errstate(over="ignore"):
        steps = []
        for block in made:
            # A word that all rows share stays a number.
            words = [w[0] if (w == w[0]).all() else w for w in block]
            steps.append([words[WORDS[i]] + np.uint32(SINES[i]) for i in range(64)])
        for rep in reps:
            front = np.frombuffer((tag + str(rep).encode() + b"|").ljust(4 * len(touched), b"\0"), dtype="<u4")
            first = [w + front[WORDS[i]] if WORDS[i] in touched else w for i, w in enumerate(steps[0])]
            state = _block(heads, first, space)
            for more in steps[1:]:
                state = _block(state, more, space)
            yield rep, state[0].byteswap()


def poisson1(words: np.ndarray, cuts: Sequence[int]) -> np.ndarray:
    """The number of ``cuts`` (rising) that are not above the word."""
    out = np.zeros(len(words), dtype=np.uint8)
    for c in cuts:
        out += words >= np.uint32(c) if c < 2**32 else np.uint8(0)
    return out


def cell_counts(ids: Sequence[bytes | None], cells: np.ndarray, n_cells: int, tag: bytes, replicates: int,
                cuts: Sequence[int]) -> np.ndarray:
    """(replicates + 1, cells): row 0 counts the rows of each cell, the others sum the rows' drawn weights.
    Rows without an id share the draw of md5(``<tag><rep>``)."""
    out = np.zeros((replicates + 1, n_cells), dtype=np.int64)
    out[0] = np.bincount(cells, minlength=n_cells)
    reps = range(1, replicates + 1)
    none = np.array([x is None for x in ids], dtype=bool)
    if none.any():
        count = np.bincount(cells[none], minlength=n_cells)
        for rep in reps:
            word = int.from_bytes(hashlib.md5(tag + str(rep).encode()).digest()[:4], "big")
            out[rep] += count * sum(word >= c for c in cuts)
    known = np.flatnonzero(~none)
    known = known[np.argsort(cells[known], kind="stable")]
    ids, cells = [ids[i] for i in known], cells[known]
    for rows, draws in first_words(ids, tag, reps) if ids else ():
        first = np.flatnonzero(np.diff(cells[rows], prepend=-1))  # rows stay in the order of their cells
        names = cells[rows][first]
        for rep, words in draws:
            out[rep, names] += np.add.reduceat(poisson1(words, cuts), first, dtype=np.int64)
    return out
