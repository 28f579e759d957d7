"""MinHash near-duplicates: many universal hash minima, banding, exact check, components.

A document's set holds its distinct five-word shingles (as 64-bit hashes). ``BANDS`` x ``ROWS``
minima are taken under universal hashes ``a * x + b``; documents that agree in a whole band are
candidates, links are confirmed on full sets, and components come from alternating large-star
and small-star. At a similarity of 0.85 a pair escapes all bands with a chance of 4e-7.

Documents with equal sets form one class before banding, so thousands of copies cost one
representative. A document without words has an empty set and no links. Rows that share a
``doc_id`` count as one document; a row without ``doc_id`` stays, takes no part, and gets a null
component. Extra columns of any name pass through ``near_duplicates`` untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesheet.llm.common import over_texts, with_maybe, written
from ratesheet.llm.graph import linked_components

WIDTH = 5
BANDS, ROWS = 25, 5
PERCENT = 85
#: Words whose hashes a task remembers; then it starts anew.
WORD_CACHE = 400_000
#: Shingles hashed at a time, which bounds the memory a very long text takes.
CHUNK = 1_024


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


_WEIGHTS = [_mix(np.array([i + 1], dtype=np.uint64))[0] | np.uint64(1) for i in range(WIDTH)]


def hashes_in_order(tokens: list[bytes], words: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles of a word list, in order; all words as one if there are fewer."""
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    n = max(1, len(h) - width + 1)
    width = min(width, len(h))
    with np.errstate(over="ignore"):
        total = np.full(n, width, dtype=np.uint64)
        for i in range(width):
            total = _mix(total + h[i : i + n] * _WEIGHTS[i])
    return total


def shingle_hashes(text: str | None, words: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.unique(hashes_in_order(tokens, words, width))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_607)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, n, dtype=np.uint64)[:, None]


def band_keys(shingles: np.ndarray, bands: int, rows: int, fns: tuple) -> np.ndarray:
    """One key a band, from the minima of its rows."""
    a, b = fns
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), CHUNK):
            np.minimum(least, (a * shingles[at : at + CHUNK] + b).min(axis=1), out=least)
        key = np.arange(bands, dtype=np.uint64)
        for column in least.reshape(bands, rows).T:
            key = _mix(key * np.uint64(31) + column)
    return key.view(np.int64)


def signatures(docs: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, keys): s1 and s2 are 128 bits of the whole set."""

    def sign(batch: pd.DataFrame) -> pd.DataFrame:
        words, fns = WordHashes(), _functions(bands * rows)
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            s = shingle_hashes(text, words, width)
            digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64)
            out.append((doc_id, len(s), *map(int, digest), band_keys(s, bands, rows, fns) if len(s) else None))
        return pd.DataFrame(out, columns=["doc_id", "n_shingles", "s1", "s2", "keys"])

    return over_texts(
        docs, ["doc_id", "text"],
        "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, keys array<bigint>", sign,
    )


def _full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the given documents; others are passed over by a bitmap first."""

    def gather(batch: pd.DataFrame) -> pd.DataFrame:
        words = WordHashes()
        sets = [shingle_hashes(t, words, width).view(np.int64) for t in batch["text"]]
        return pd.DataFrame({"node": batch["doc_id"], "shingles": sets})

    texts = with_maybe(docs.select("doc_id", "text"), "doc_id", nodes).where("_maybe")
    texts = texts.join(nodes, texts.doc_id == nodes.node, "left_semi")
    return over_texts(texts, ["doc_id", "text"], "node bigint, shingles array<bigint>", gather)


def _ranges(sets: DataFrame, percent: int) -> DataFrame:
    """(node, low, high, size, apart): how large a set a node's set can be similar enough to.

    Shingles that no other candidate has can't be shared. With ``c`` others at most, a link needs
    100 c >= percent * (size + other - c); in a large family of copies edited in many places this
    leaves out the members that are too far from all others, before any pair is made.
    """
    each = sets.select("node", F.explode("shingles").alias("g"))
    own = each.groupBy("g").agg(F.min("node").alias("node"), F.max("node").alias("hi")).where("node = hi")
    own = own.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return (
        sets.select("node", F.size("shingles").cast("bigint").alias("size"))
        .join(own, "node", "left")
        .select(
            "node",
            F.expr(f"(size * {percent} + 99) div 100").alias("low"),
            F.expr(f"(size - coalesce(own, 0)) * {100 + percent} div {percent} - size").alias("high"),
            "size",
            F.coalesce("own", F.lit(0)).alias("apart"),
        )
    )


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, width: int = WIDTH
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links of at least ``percent`` Jaccard
    similarity; ``kept`` is true where it is the document's own, and where doc_id is null.
    """
    signed = written(signatures(docs, bands, rows, width), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    doc_class = written(
        full.join(classes, ["s1", "s2"]).select(
            "doc_id", "n_shingles", "node", F.when(F.col("doc_id") == F.col("node"), F.col("keys")).alias("keys")
        ),
        "classes",
    )
    banded = doc_class.where("keys is not null").select("node", F.explode("keys").alias("key"))
    crowded = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = written(banded.join(crowded.select("key"), "key").distinct(), "members")
    # A doc_id that occurs with several sets is one node: it also ties the classes together.
    nodes = members.select("node").distinct()
    sets = written(_full_sets(docs, nodes, width), "sets")
    ranged = members.join(_ranges(sets, percent), "node")

    def verify(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        met = F.size(F.array_intersect("x", "y"))
        return (
            pairs.join(a, "a").join(b, "b")
            .where(100 * met >= percent * (F.size("x") + F.size("y") - met))
            .select("a", "b").distinct()
        )

    found = linked_components(ranged, verify)
    placed = (
        doc_class.join(found, "node", "left")
        .groupBy("doc_id", "n_shingles")
        .agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    )
    alone = signed.join(placed, ["doc_id", "n_shingles"], "left")
    return alone.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        (F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all its columns, without documents that repeat one with a smaller id."""
    dropped = near_duplicates(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_gone"], "left_anti")


