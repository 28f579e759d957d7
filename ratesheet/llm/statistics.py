"""Statistics of whole texts that the quality operators share, and bounded training samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratesheet.llm.common import over_texts

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\v\f\r"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_DIGITS, _STOPS = b"0123456789", b"!?"
_HIGH = bytes(range(128, 256))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "word_length", "symbols_a_char", "dup_lines", "repeat_words", "upper_share",
    "digits_a_char", "stops_a_word", "letters_share", "distinct_words", "same_as_next", "words_a_line",
]


def _repeated(ids: np.ndarray) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def describe(text: str | None) -> tuple:
    """``COUNTS`` then ``FEATURES`` of one text; a null text is an empty one.

    Words are runs without ASCII white space. Shares of nothing are 0.
    """
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    repeated = _repeated(ids)
    among = lambda letters: len(raw) - len(raw.translate(None, letters))
    upper, lower, digits, stops = among(_UPPER), among(_LOWER), among(_DIGITS), among(_STOPS)
    beyond = len(text) - (len(raw) - among(_HIGH))  # code points outside ASCII
    letters = upper + lower + beyond
    chars, n1 = max(word_chars, 1), max(n, 1)
    return (
        n, word_chars, symbols, dup_lines, repeated,
        float(np.log1p(n)), word_chars / n1, symbols / chars, dup_lines / max(len(lines), 1), repeated / n1,
        upper / max(upper + lower, 1), digits / chars, stops / n1, letters / chars, len(numbers) / n1,
        float((ids[1:] == ids[:-1]).sum()) / n1, n / max(len(lines), 1),
    )


def described(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([describe(t) for t in texts], columns=COUNTS + FEATURES)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, allowed: Column, rows: int) -> pd.DataFrame:
    """``FEATURES`` and ``target`` of at most ``rows`` labelled documents, for training.

    The labelled ids with the smallest hashes are taken, which any cluster repeats; the sample
    is bounded, so it may go to every task. ``allowed`` restricts the ids to learn from.
    """
    known = labels.where(allowed & F.col(target).isNotNull() & F.col("doc_id").isNotNull())
    picked = (
        known.groupBy("doc_id").agg(F.max(target).alias("_target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def features(batch: pd.DataFrame) -> pd.DataFrame:
        return described(batch["text"])[FEATURES].assign(target=batch["_target"], doc_id=batch["doc_id"])

    schema = ", ".join(f"{c} double" for c in FEATURES) + ", target int, doc_id bigint"
    found = over_texts(texts, ["doc_id", "text", "_target"], schema, features)
    # Each id's rows agree on their label; repeated ids could exceed the bound, so it is stated again.
    return found.orderBy("doc_id", *FEATURES).limit(rows).drop("doc_id").toPandas()
