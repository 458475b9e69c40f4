"""Token counts: linear longest-match automaton over a word-piece vocabulary.

Words are cut greedily into the longest vocabulary pieces, and only the
number of pieces is wanted.  The vocabulary is a trie; every node has a
failure link (where matching goes on once the pieces that the node's string
must give up are popped) and the precomputed number of popped pieces.  A
word costs one step for each byte plus at most as many failures, however
its pieces overlap, and no piece is ever built.

A word's last byte is a symbol of its own (byte + 256), so a piece that
ends a word and the same bytes inside a word are different pieces, as the
vocabulary's end-of-word mark says.

Defined results: a null text gives null counts, a text without words 0;
repeated rows are counted one by one; an empty table gives no rows; texts
and words of any length are counted whole; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import ship

CACHE = 400_000  # remembered words of one Python worker; emptied when full
LONG = 64        # longer words are not remembered
WIDTH = 512      # symbols: a byte inside a word, or 256 + a word's last byte

# Fixed value: how the public vocabulary splits white-space-free text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str, suffix: str = "</w>") -> list[list[int]]:
    """Pieces as symbol lists, of a vocabulary file in the tokenizers library's format."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, out = byte_letters(), []
    for piece in model["vocab"]:
        last = piece.endswith(suffix)
        body = piece.removesuffix(suffix) if last else piece
        if body and all(c in letters for c in body):
            symbols = [letters[c] for c in body]
            if last:
                symbols[-1] += 256
            out.append(symbols)
    return out


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[list[int]]):
        step: dict[int, int] = {}
        accepts, children = [False], [[]]
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = step.get(node * WIDTH + c)
                if nxt is None:
                    nxt = step[node * WIDTH + c] = len(accepts)
                    accepts.append(False)
                    children[node].append(c)
                    children.append([])
                node = nxt
            accepts[node] = True
        missing = [c for c in range(WIDTH) if c not in set(children[0]) or not accepts[step[c]]]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single symbols")
        fail, pops = [-1] * len(accepts), [0] * len(accepts)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for c in children[u]:
                v = step[u * WIDTH + c]
                queue.append(v)
                if accepts[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, n = fail[u], pops[u]
                while (to := step.get(z * WIDTH + c)) is None:
                    n += pops[z]
                    z = fail[z]
                fail[v], pops[v] = to, n
        total = [0] * len(accepts)  # pieces popped on the way back to the root
        for u in sorted(range(1, len(accepts)), key=lambda u: u):
            n, z = 0, u
            while z > 0:
                n, z = n + pops[z], fail[z]
            total[u] = n
        self.step, self.fail, self.pops, self.total = step, fail, pops, total

    def count(self, word: bytes) -> int:
        if not word:
            return 0
        step, fail, pops, u, n = self.step, self.fail, self.pops, 0, 0
        for c in [*word[:-1], word[-1] + 256]:
            to = step.get(u * WIDTH + c)
            while to is None:
                n += pops[u]
                u = fail[u]
                to = step.get(u * WIDTH + c)
            u = to
        return n + self.total[u]


class Counter:
    """(words, pieces) of texts; what stands between spaces is looked up if seen before."""

    def __init__(self, path: str):
        import regex
        self.automaton, self.word, self.known = Automaton(read_vocabulary(path)), regex.compile(WORD), {"": (0, 0)}

    def _chunk(self, chunk: str) -> tuple[int, int]:
        chunk = unicodedata.normalize("NFC", chunk)
        chunk = chunk.lower() if chunk.isascii() else "".join(map(str.lower, chunk))
        words = self.word.findall(chunk)
        return len(words), sum(self.automaton.count(w.encode()) for w in words)

    def count(self, text: str) -> tuple[int, int]:
        words = pieces = 0
        known = self.known
        for chunk in text.replace("\n", " ").split(" "):
            got = known.get(chunk)
            if got is None:
                got = self._chunk(chunk)
                if len(chunk) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[chunk] = got
            words += got[0]
            pieces += got[1]
        return words, pieces


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words and n_tokens of every row: one pass, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path).count
        for batch in batches:
            got = [(None, None) if t is None else count(t) for t in batch["text"]]
            out = pd.DataFrame(got, columns=["n_words", "n_tokens"], dtype="Int64")
            out.insert(0, id_column, batch["id"].to_numpy())
            out[id_column] = out[id_column].astype("Int64")
            yield out

    ship(docs.sparkSession)
    chosen = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    return chosen.mapInPandas(run, f"`{id_column}` long, n_words long, n_tokens long")
