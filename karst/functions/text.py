"""Text normalisation for postings: tokenizing in the JVM, stemming in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Tokenizer names and their patterns.
TOKEN_PATTERNS = {
    "simple": r"[\p{L}\p{N}]+",
    "whitespace": r"\S+",
    "raw": r"(?s)^.+$",
}

# Languages with stop words, as Spark's StopWordsRemover names them.
LANGUAGES = ("danish", "dutch", "english", "finnish", "french", "german", "hungarian", "italian",
             "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish")


def tokens(text: Column, tokenizer: str = "simple", lowercase: bool = True) -> Column:
    """Array of tokens of a text column."""
    if tokenizer not in TOKEN_PATTERNS:
        raise ValueError(f"unknown tokenizer {tokenizer!r}; use one of {', '.join(TOKEN_PATTERNS)}")
    value = F.lower(text) if lowercase else text
    return F.regexp_extract_all(value, F.lit(TOKEN_PATTERNS[tokenizer]), F.lit(0))


# Letters that Unicode does not decompose, and their plain spelling.
PLAIN_LETTERS = {
    "Æ": "AE", "æ": "ae", "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ł": "L", "ł": "l",
    "Ø": "O", "ø": "o", "Œ": "OE", "œ": "oe", "ẞ": "SS", "ß": "ss", "Þ": "TH", "þ": "th", "Ŧ": "T", "ŧ": "t",
}
_PLAIN = str.maketrans(PLAIN_LETTERS)


@lru_cache(maxsize=200_000)
def fold(token: str) -> str:
    """Token without diacritics, in plain letters where there are any."""
    if token.isascii():
        return token
    parts = unicodedata.normalize("NFD", token).translate(_PLAIN)
    return unicodedata.normalize("NFC", "".join(c for c in parts if not unicodedata.combining(c)))


# The five steps below follow the suffix-stripping algorithm published by
# M. F. Porter (1980); the suffix tables are fixed values of that paper.
_STEP_2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
           ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
           ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
           ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
_STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
           "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """The word as a string of v(owel) and c(onsonant)."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _closed(word: str) -> bool:
    return len(word) > 2 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _swap(word: str, table, least: int) -> str:
    """Replace the longest matching suffix if what remains measures more than ``least``."""
    for suffix, new in sorted(table, key=lambda p: -len(p[0])):
        if word.endswith(suffix):
            stem = word[:len(word) - len(suffix)]
            return stem + new if _measure(stem) > least else word
    return word


@lru_cache(maxsize=200_000)
def porter_stem(word: str) -> str:
    """English stem of a lower-case token."""
    if len(word) < 3 or not (word.isascii() and word.isalpha()):
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            stem = word[:-len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                if stem.endswith(("at", "bl", "iz")) or (_measure(stem) == 1 and _closed(stem)):
                    stem += "e"
                elif _double(stem) and stem[-1] not in "lsz":
                    stem = stem[:-1]
                word = stem
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(word, _STEP_2, 0)
    word = _swap(word, _STEP_3, 0)
    for suffix in sorted(_STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[:-len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _closed(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


#: tokens whose terms are counted at a time; a longer row is counted by itself
COUNTED = 1 << 20


def _terms(values: pa.Array, ascii_folding: bool, stem: bool) -> pa.Array:
    out = []
    for token in values.to_pylist():
        if ascii_folding:
            token = fold(token)
        out.append(porter_stem(token) if stem else token)
    return pa.array(out, values.type)


def term_counts(ascii_folding: bool, stem: bool):
    """Arrow kernel: rows ``(field, key ..., tokens)`` become rows ``(field, term, key ..., tf)``, each term of a row once.

    A distinct token of a batch is folded and stemmed once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                base = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, base + COUNTED, side="right")))
                part = batch.slice(first, last - first)
                row = np.repeat(np.arange(last - first), np.diff(ends[first:last], prepend=base))
                first = last
                if not len(row):
                    continue
                coded = part.column(part.num_columns - 1).flatten().dictionary_encode()
                terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if ascii_folding or stem:
                    merged = _terms(terms, ascii_folding, stem).dictionary_encode()
                    terms, code = merged.dictionary, merged.indices.to_numpy(zero_copy_only=False).astype(np.int64)[code]
                pairs, counts = np.unique(row * len(terms) + code, return_counts=True)
                at = pa.array(pairs // len(terms))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), terms.take(pa.array(pairs % len(terms))),
                     *(part.column(i).take(at) for i in range(1, part.num_columns - 1)), pa.array(counts.astype(np.int64))],
                    ["field", "term", *part.schema.names[1:-1], "tf"])

    return run
