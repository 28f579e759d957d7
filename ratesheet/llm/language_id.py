"""Language by hierarchy: first the family, then linear support vector machines within it.

Texts become root frequencies of hashed letter n-grams (one to three letters, words kept apart)
over the whole text, in Unicode lower case. A linear machine for each family is trained against
the other families; inside a family each pair of languages has a machine of its own, and the
language with the most votes wins. Machines are fitted by stochastic subgradient steps on the hinge
loss with averaging, each by one task, on a bounded sample: at most ``TRAIN_EACH`` documents of a
language, those with the smallest hashes of their ids, and for a family at most ``FAMILY_SIDE`` of
each side. Any number of languages can be learned: the driver holds 32 KB a machine.

A family's margins become shares by a softmax. A language's share is the mean over its relatives of
the logistic of their machine's margin; the product of both is the score. Ties of votes go to the
larger sum of margins, then to the first name.

A null text and a text without letters are ``und`` with score 0. Without anything to learn from,
all texts are. Rows that share a doc_id and a language are all learned from if the id is; repeated
rows get equal predictions. Only doc_id and text are inputs of a prediction; lang is read for
training alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesheet.llm.common import bucket_of, importable, over_texts, written

UNKNOWN = "und"
HELD_OUT_OF, HELD_OUT = 4, 2
#: Documents of each language to learn from, at most, and of each side of a family's machine.
TRAIN_EACH, FAMILY_SIDE = 800, 1_600
WIDTH = 4_096
STEPS, REGULARISE = 20, 1e-4
#: Code points counted at a time, which bounds the memory a very long text takes.
PART = 1 << 16
# Branches of languages by ISO 639-1 code. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"],
    "romance": ["es", "fr", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl", "be", "mk", "bs"],
    "uralic": ["fi", "hu", "et"],
    "turkic": ["tr", "az", "kk", "uz", "tk"],
    "indic": ["hi", "bn", "ur", "mr", "gu", "pa", "ne"],
}


def family(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def features(text: str) -> np.ndarray | None:
    """Unit vector of the text, or None if it has no letter."""
    if not any(map(str.isalpha, text)):
        return None
    total = np.zeros(WIDTH)
    lowered = text.lower()
    for at in range(0, len(lowered), PART):
        part = lowered[max(0, at - 2) : at + PART]  # two more, for the n-grams across the cut
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        kept = np.where(code > 0x60, code, np.uint64(0x20))  # digits and ASCII marks are word ends
        fresh = 0 if at == 0 else 2
        one = kept[fresh:] * np.uint64(0x9E3779B1)
        two = (kept[:-1] * np.uint64(0x85EBCA6B) + kept[1:] * np.uint64(0x27D4EB2F) + np.uint64(7))[max(0, fresh - 1) :]
        three = (
            kept[:-2] * np.uint64(0xC2B2AE35) + kept[1:-1] * np.uint64(0x165667B1)
            + kept[2:] * np.uint64(0x2545F491) + np.uint64(13)
        )
        grams = np.concatenate([one, two, three])
        grams ^= grams >> np.uint64(15)
        total += np.bincount((grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(np.int64), minlength=WIDTH)
    root = np.sqrt(total)
    return root / np.sqrt(total.sum())


def _with_offset(vectors: Sequence[np.ndarray]) -> np.ndarray:
    """The vectors as rows in single precision, with a one behind each."""
    rows = np.ones((len(vectors), WIDTH + 1), dtype=np.float32)
    for k, x in enumerate(vectors):
        rows[k, :-1] = x
    return rows


def _machine(rows: np.ndarray, sign: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the offset) of a linear machine; both sides weigh the same."""
    rng = np.random.default_rng(seed)
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)) * len(rows)
    w, mean, t = np.zeros(rows.shape[1]), np.zeros(rows.shape[1]), 0
    for _ in range(STEPS):
        order = rng.permutation(len(rows))
        for at in np.array_split(order, max(1, len(order) // 32)):
            t += 1
            rate = 1 / (REGULARISE * (t + 100))
            short = sign[at] * (rows[at] @ w) < 1
            pull = (sign[at] * share[at] * short) @ rows[at] / len(at)
            w = (1 - rate * REGULARISE) * w + rate * pull
            w *= min(1.0, 1 / np.sqrt(REGULARISE) / max(np.sqrt(w @ w), 1e-12))
            mean += (w - mean) * 2 / (t + 1)
    return mean


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -60, 60)))


@dataclass
class Hierarchy:
    """Machines of the families, by name, and of pairs of languages (first, second): positive margins
    are votes for the first."""

    languages: dict[str, list[str]]
    families: dict[str, np.ndarray]
    pairs: dict[tuple[str, str], np.ndarray]

    def _family_shares(self, x: np.ndarray) -> np.ndarray:
        if len(self.languages) == 1:
            return np.ones((len(x), 1))
        w = np.stack([self.families[name] for name in self.languages])
        return _softmax(2 * (x @ w[:, :-1].T + w[:, -1]))

    def _votes(self, names: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the winner among the names, its share) of each row."""
        if len(names) == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        votes, margins, shares = np.zeros((3, len(x), len(names)))
        for i, j in combinations(range(len(names)), 2):
            w = self.pairs[names[i], names[j]]
            margin = x @ w[:-1] + w[-1]
            for k, own in ((i, margin), (j, -margin)):
                votes[:, k] += (own > 0) if k == i else (own >= 0)
                margins[:, k] += own
                shares[:, k] += _logistic(4 * own)
        most = votes == votes.max(axis=1, keepdims=True)
        winner = np.where(most, margins, -np.inf).argmax(axis=1)
        return winner, shares[np.arange(len(x)), winner] / (len(names) - 1)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of each row."""
        shares = self._family_shares(x)
        which = shares.argmax(axis=1)
        lang, score = np.empty(len(x), dtype=object), shares.max(axis=1)
        for k, names in enumerate(self.languages.values()):
            at = np.nonzero(which == k)[0]
            if len(at):
                winner, share = self._votes(names, x[at])
                lang[at] = np.array(names, dtype=object)[winner]
                score[at] *= share
        return lang, score


def by_family(langs: list[str]) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for lang in sorted(set(langs), key=lambda v: (family(v), v)):
        found.setdefault(family(lang), []).append(lang)
    return found


def _roles(languages: dict[str, list[str]]) -> list[tuple[str, str, str, int, int]]:
    """(machine, second, lang, sign, most): the rows of a language up to its rank ``most`` in its
    family, and their side, in a family's machine (second is empty) or in that of a pair."""
    out, every = [], [v for names in languages.values() for v in names]
    other = max(1, FAMILY_SIDE // max(1, len(languages) - 1))
    for name, own in languages.items():
        if len(languages) > 1:
            out += [(name, "", v, 1, FAMILY_SIDE) if v in own else (name, "", v, -1, other) for v in every]
        for a, b in combinations(own, 2):
            out += [(a, b, a, 1, 1 << 30), (a, b, b, -1, 1 << 30)]
    return out


def _trained(group: pd.DataFrame) -> pd.DataFrame:
    first = group[["machine", "second"]].iloc[0].tolist()
    group = group.sort_values(["doc_id", "x"])
    sign = group["sign"].to_numpy(dtype=float)
    rows = _with_offset([np.frombuffer(v, dtype=np.float16) for v in group.pop("x")])
    w = _machine(rows, sign)
    return pd.DataFrame([(*first, w.astype(np.float64).tobytes())], columns=["machine", "second", "w"])


def _sample(docs: DataFrame, allowed: Column | None, each: int) -> DataFrame:
    """(doc_id, lang, family, rank, x): vectors of the documents to learn from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    ids = known.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64("doc_id").alias("_h"))
    # Hashes are even, so the smallest ``each`` lie below twice their share: a language with a third
    # of all documents passes on about as many ids as any other.
    many = ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_many"))
    share = (F.col("_h") / float(1 << 63) + 1) / 2
    few = ids.join(F.broadcast(many), "_lang").where(share * F.col("_many") <= 2 * each + 64)
    order = Window.partitionBy("_lang").orderBy("_h", "_id")
    picked = few.select("_id", "_lang", "_h").distinct()
    picked = picked.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each).drop("_h")
    texts = docs.select("doc_id", "text", F.col("lang").alias("_own"))
    # At most ``each`` ids a language: 16 bytes each.
    sample = texts.join(F.broadcast(picked), (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_lang")))

    def vectors(batch: pd.DataFrame) -> pd.DataFrame:
        found = [(i, v, family(v), n, features(t)) for i, v, n, t in zip(batch["doc_id"], batch["_lang"], batch["_n"], batch["text"])]
        kept = [(i, v, kin, n, x.astype(np.float16).tobytes()) for i, v, kin, n, x in found if x is not None]
        return pd.DataFrame(kept, columns=["doc_id", "lang", "family", "n", "x"])

    schema = "doc_id bigint, lang string, family string, n int, x binary"
    rows = written(over_texts(sample, ["doc_id", "text", "_lang", "_n"], schema, vectors), "language_sample")
    # Relatives take turns, so that a family's side has as many of each.
    turn = Window.partitionBy("family").orderBy("n", "lang", "doc_id", "x")
    ranks = rows.withColumn("rank", F.row_number().over(turn))
    return ranks.select("doc_id", "lang", "rank", "x")


def train(docs: DataFrame, allowed: Column | None = None, each: int = TRAIN_EACH) -> Hierarchy | None:
    """Learns from at most ``each`` documents of each language. Each machine is fitted by a task."""
    sample = _sample(docs, allowed, each)
    languages = by_family([r.lang for r in sample.select("lang").distinct().collect()])
    if not languages:
        return None
    roles = _roles(languages)
    if not roles:
        return Hierarchy(languages, {}, {})
    schema = "machine string, second string, lang string, sign int, most int"
    sides = docs.sparkSession.createDataFrame(roles, schema)
    rows = sample.join(F.broadcast(sides), "lang").where("rank <= most").drop("rank", "most", "lang")
    fitted = importable(rows).groupBy("machine", "second").applyInPandas(
        _trained, "machine string, second string, w binary"
    )
    families, pairs = {}, {}
    for r in fitted.collect():
        w = np.frombuffer(r.w, dtype=np.float64)
        if r.second:
            pairs[r.machine, r.second] = w
        else:
            families[r.machine] = w
    return Hierarchy(languages, families, pairs)


def predicted(docs: DataFrame, model: Hierarchy | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        lang, score = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch))
        texts = batch["text"].tolist()
        for k in range(0, len(texts) if model else 0, 256):  # bounded stacks of vectors
            found = [features(t) if isinstance(t, str) else None for t in texts[k : k + 256]]
            some = [k + i for i, x in enumerate(found) if x is not None]
            if some:
                lang[some], score[some] = model.predict(np.stack([x for x in found if x is not None]))
        ids = batch["doc_id"].astype("Int64").to_numpy()
        return pd.DataFrame({"doc_id": ids, "lang_pred": lang, "score": score})

    return over_texts(docs, ["doc_id", "text"], "doc_id bigint, lang_pred string, score double", run)


def held_out() -> Column:
    return F.coalesce(bucket_of("doc_id", HELD_OUT_OF) == HELD_OUT, F.lit(False))
