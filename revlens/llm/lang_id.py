"""Language ID: multilingual mixture inference.

A document is a mixture of languages.  Its letters give hashed trigrams
(word borders included); each language has a smoothed trigram distribution
learned from labelled texts; expectation-maximisation estimates the
document's language proportions, and a penalised likelihood chooses how
many of the languages (in order of their proportion) the document has.

Learning counts trigrams inside each task and sums (language, trigram,
count) rows over all labelled documents; the model is a table of
``SLOTS`` x languages, whatever the size of the corpus.

Defined results: a null text and a text without letters give ``und`` with
score 0 and no languages; without any labelled text every text is ``und``;
a null label is not learned from; repeated rows are learned from and
predicted as often as they occur; ties between languages go to the smaller
name; an empty table gives no rows; texts are used whole; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

SLOTS = 1 << 18   # hashed trigrams
ROUNDS = 12       # steps of expectation-maximisation
SMOOTH = 0.02     # share of the pooled and the uniform distribution in each language's
PENALTY = 3.0     # times log(trigrams) that one more language must gain in log-likelihood

_ALPHA: list[np.ndarray] = []


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams around each letter; anything but letters is a border."""
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(0x10000)]))
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _ALPHA[0][np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        letter = letter.copy()
        letter[high] = [chr(p).isalpha() for p in points[high]]
    points = np.where(letter, points, 0).astype(np.uint32)
    padded = np.concatenate(([0], points, [0])).astype(np.uint32)
    h = (padded[:-2] * np.uint32(0x9E3779B1)) ^ (padded[1:-1] * np.uint32(0x85EBCA77)) ^ (padded[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(14))[letter]


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # SLOTS x languages


def _mixture(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of the mixture of ``p``'s columns."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    n = c.sum()
    for _ in range(ROUNDS if p.shape[1] > 1 else 0):
        share = share * ((c / (p @ share)) @ p) / n
    return share, float(c @ np.log(p @ share))


def infer(model: Model, text: str | None) -> tuple[str, float, dict[str, float]]:
    """(main language, its proportion, proportions of the chosen languages)."""
    grams = trigrams(text) if text and model.languages else np.empty(0, np.uint32)
    if not len(grams):
        return "und", 0.0, {}
    ids, c = np.unique(grams, return_counts=True)
    p, c = model.likelihood[ids], c.astype(np.float64)
    order = np.argsort(-_mixture(p, c)[0], kind="stable")
    price = PENALTY * np.log(c.sum() + 1)
    best = None
    for k in range(1, len(order) + 1):
        chosen = np.sort(order[:k])
        share, ll = _mixture(p[:, chosen], c)
        if best is not None and ll - price * k <= best[0]:
            break
        best = (ll - price * k, chosen, share)
    _, chosen, share = best
    top = int(np.argmax(share))
    return (model.languages[chosen[top]], float(min(1.0, share[top])),
            {model.languages[i]: float(s) for i, s in zip(chosen, share, strict=True)})


def learn(labelled: DataFrame) -> Model:
    """Model of ``labelled(text, lang)``; rows with a null are not used."""
    ship(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = sums.get(lang)
                if own is None:
                    own = sums[lang] = np.zeros(SLOTS, np.int64)
                ids, c = np.unique(trigrams(text), return_counts=True)
                own[ids] += c
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "gram": at.astype(np.int32), "n": own[at]})

    rows = (labelled.select(labelled["text"].alias("text"), labelled["lang"].alias("lang")).dropna()
            .mapInPandas(count, "lang string, gram int, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())  # at most SLOTS rows a language
    languages = sorted(rows["lang"].unique())
    freq = np.zeros((SLOTS, len(languages)))
    for i, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        freq[own["gram"].to_numpy(), i] = own["n"].to_numpy() / own["n"].sum()
    if languages:
        pooled = (freq.mean(axis=1, keepdims=True) + 1 / SLOTS) / 2
        freq = (1 - SMOOTH) * freq + SMOOTH * pooled
    return Model(languages, freq)


def predict(docs: DataFrame, model: Model) -> tuple[DataFrame, Column]:
    """(docs, column): the column is struct(lang_pred, score, languages) of ``docs.text``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.likelihood))

    @F.pandas_udf("lang_pred string, score double, languages map<string,double>")
    def mixture(texts: pd.Series) -> pd.DataFrame:
        own = Model(*shared.value)
        return pd.DataFrame([infer(own, t) for t in texts], columns=["lang_pred", "score", "languages"])

    return docs, mixture(docs["text"])


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a null id is in the learning folds."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Learn from the labelled learning folds of ``docs``, then infer every row."""
    model = learn(docs.where(~held_out(docs["doc_id"])).select(docs["text"], docs["lang"]))
    return predict(docs, model)
