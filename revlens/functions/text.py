"""Text cleaning as Spark column expressions (TXT-*).

Every function takes and returns a ``Column``; nothing leaves the JVM, so
the expressions inline into whole-stage codegen next to the scan.
Sequential loops of the original tool are rewritten as closed forms over
token arrays (``transform`` / ``filter`` / ``slice``), see the notes on
``negation_tag``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _lit_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    An outer expression referenced inside a higher-order-function lambda is
    re-evaluated on every lambda call; binding it through a one-element
    array makes per-token look-backs O(n) instead of O(n²) on long texts.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens_ws(c: Column) -> Column:
    """Whitespace tokens of an already cleaned string (no empty tokens)."""
    return F.filter(F.split(c, " "), lambda t: t != F.lit(""))


def token_count(c: Column) -> Column:
    """TXT-5: ``len(text.split())`` of a cleaned string."""
    return F.size(tokens_ws(c))


def raw_token_count(c: Column) -> Column:
    """``len(text.split())`` of a raw string (any ASCII whitespace)."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), K.WS_CLASS, " "))
    return F.size(tokens_ws(t))


def strip_urls(c: Column) -> Column:
    """TXT-2: replace ``http…`` / ``www.…`` runs by a space."""
    return F.regexp_replace(c, K.URL_PATTERN, " ")


def abbrev_pattern(mapping=K.ABBREVIATIONS) -> str:
    keys = [re.escape(k) for k, _ in mapping]
    # Java regex: (?U) makes \b Unicode-aware like Python's str patterns.
    return r"(?U)\b(" + "|".join(keys) + r")\b"


def normalize_abbrev(c: Column, mapping=K.ABBREVIATIONS) -> Column:
    """TXT-3: single-pass, leftmost, first-alternative-wins expansion.

    The string is cut by the alternation (``split`` keeps the pieces
    between matches, ``regexp_extract_all`` the matches themselves); piece
    i is followed by the replacement of match i.  This is exactly one
    left-to-right pass, for any mapping.  Input must be lower case.
    """
    if not mapping:
        return c
    pat = abbrev_pattern(mapping)
    lookup = F.create_map(*[x for k, v in mapping for x in (F.lit(k), F.lit(v))])
    pieces = F.split(c, pat, -1)

    def glue(hits):
        return F.array_join(F.transform(
            pieces,
            lambda p, i: F.concat(
                p,
                F.coalesce(F.try_element_at(lookup, F.try_element_at(hits, i + 1)),
                           F.try_element_at(hits, i + 1), F.lit("")),
            ),
        ), "")

    return let(F.regexp_extract_all(c, F.lit(pat), 0), glue)


def _is_boundary(t: Column, boundaries: Sequence[str]) -> Column:
    return t.isin(*boundaries)


def negation_tag(c: Column, window: int = K.DEFAULT_NEGATION_WINDOW,
                 cues: Sequence[str] = K.TAGGER_NEGATION_CUES) -> Column:
    """TXT-4: prefix ``NOT_`` to the ``window`` tokens after a cue.

    Closed form of the count-down loop: a token is tagged iff the latest
    cue-or-punctuation token among the previous ``window`` tokens exists
    and is a cue (a cue restarts the count, punctuation zeroes it, every
    other token consumes one slot).  Punctuation tokens are dropped.
    """
    cue_arr = _lit_array(cues)
    return let(F.regexp_extract_all(F.lower(c), F.lit(K.TAGGER_TOKEN_PATTERN), 0),
               lambda toks: _negation_tag_tokens(toks, window, cue_arr))


def _negation_tag_tokens(toks: Column, window: int, cue_arr: Column) -> Column:
    def tag(x, i):
        start = F.greatest(F.lit(1), i - F.lit(window) + 1)
        look = F.slice(toks, start, F.least(i, F.lit(window)))
        events = F.filter(look, lambda y: _is_boundary(y, K.TAGGER_BOUNDARIES)
                          | F.array_contains(cue_arr, y))
        last = F.try_element_at(events, F.lit(-1))
        negated = F.coalesce(F.array_contains(cue_arr, last), F.lit(False))
        return (F.when(_is_boundary(x, K.TAGGER_BOUNDARIES), F.lit(None))
                .when(F.array_contains(cue_arr, x), x)
                .when(negated, F.concat(F.lit("NOT_"), x))
                .otherwise(x))

    out = F.filter(F.transform(toks, tag), lambda x: x.isNotNull())
    return F.array_join(out, " ")


def clean_text(c: Column, abbrev: bool = False, negation: bool = False,
               window: int = K.DEFAULT_NEGATION_WINDOW,
               abbrev_map=K.ABBREVIATIONS) -> Column:
    """TXT-1: null → "", lower, URLs → space, optional abbreviations and
    negation tags, ASCII punctuation (not ``_``) → space, collapse, trim."""
    t = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    t = strip_urls(t)
    if abbrev:
        t = normalize_abbrev(t, abbrev_map)
    if negation:
        t = negation_tag(t, window)
    t = F.regexp_replace(t, K.PUNCT_CLASS, " ")
    return F.trim(F.regexp_replace(t, K.WS_CLASS, " "))


def first_marker_index(toks: Column, markers: Sequence[str]) -> Column:
    """1-based index of the first token that is a marker, 0 if none."""
    arr = _lit_array(markers)
    return F.array_position(F.transform(toks, lambda t: F.array_contains(arr, t)), True)


def contrast_split(clean: Column, markers: Sequence[str] = K.TAGGER_CONTRAST_MARKERS) -> Column:
    """TXT-6: struct(left, right) split at the first contrast marker."""
    toks = tokens_ws(clean)
    idx = first_marker_index(toks, markers)
    n = F.size(toks)
    left = F.when(idx == 0, F.trim(clean)).otherwise(
        F.array_join(F.slice(toks, F.lit(1), F.greatest(idx - 1, F.lit(0))), " "))
    right = F.when(idx == 0, F.lit("")).otherwise(
        F.array_join(F.slice(toks, idx + 1, F.greatest(n - idx, F.lit(0))), " "))
    return F.struct(left.alias("left"), right.alias("right"))


def contrast_flags(clean: Column, markers: Sequence[str] = K.TAGGER_CONTRAST_MARKERS) -> list[Column]:
    """TXT-7: one 0/1 column per marker, named ``has_<marker>``."""
    toks = tokens_ws(clean)
    return [F.array_contains(toks, F.lit(m)).cast("int").alias(f"has_{m}") for m in markers]


def snippet(c: Column, n: int = 180) -> Column:
    """TXT-9: newlines → space, trim, cut to ``n`` characters with ``...``."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\n", " "))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n - 3), F.lit("..."))).otherwise(t)


def normalize_id(c: Column) -> Column:
    """TXT-11: ``"10.0"`` → ``"10"``, blank/NULL → ``""``, other text kept.

    Integral finite numbers print without a fraction; ``inf`` / ``nan``
    and non-numeric ids stay as trimmed text.
    """
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    d = t.try_cast("double")
    integral = d.isNotNull() & (F.abs(d) < F.lit(9.0e15)) & (d == F.floor(d))
    return F.when(t == "", F.lit("")).when(integral, F.floor(d).cast("bigint").cast("string")).otherwise(t)


def natural_id_key(norm_id: Column) -> list[Column]:
    """TXT-12: sort keys (kind, number, case-folded text) of a normalized id."""
    as_int = norm_id.try_cast("bigint")
    kind = F.when(norm_id == "", 2).when(as_int.isNotNull(), 0).otherwise(1)
    num = F.when(as_int.isNotNull(), as_int).otherwise(F.lit(0))
    txt = F.when(as_int.isNotNull(), norm_id).when(norm_id == "", F.lit("")).otherwise(F.lower(norm_id))
    return [kind.alias("_k_kind"), num.alias("_k_num"), txt.alias("_k_txt")]


def keyword_padded(c: Column) -> Column:
    """`` text.lower() `` used by the substring keyword scans."""
    return F.concat(F.lit(" "), F.lower(F.coalesce(c, F.lit(""))), F.lit(" "))
