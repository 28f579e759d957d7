"""Benchmark decontamination: size-partitioned MinHash containment, verified on exact shingles.

Test items are short, documents long, so similarity of whole sets says little; what counts is the
share of an item's shingles that a document holds. Items are partitioned by shingle width (five
words; an item with fewer words is one shingle of its own width) and by size, in powers of two.
An item of n shingles is represented by its smallest hash values, n - ceil(t * n) + 1 of them: a
document that holds a share t of the item must hold at least one of these. So documents are only
searched for the minima of each partition, and no pair at or over the threshold is missed. The
candidates are then verified on the shingles themselves.

The items are the stated query set. They go to the tasks in blocks of about ``BLOCK`` shingles, and
the documents are read once for each block, so memory is bounded for any number of items.

Words are lower-cased (A-Z) runs of ASCII letters and digits and of code points beyond ASCII. Null
or wordless items match nothing, null or wordless documents hold nothing. Items with equal ids are
reported once for each text; repeated documents are each reported. Empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ratesheet.llm.common import importable, over_texts, plain_words as words, written
from ratesheet.llm.minhash_dedup import WIDTH, WordHashes, hashes_in_order

PERCENT = 80
BLOCK = 400_000


def shingles(tokens: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(tokens[i : i + width]) for i in range(len(tokens) - width + 1)}


def sketch_size(n: int, percent: int) -> int:
    """How many of ``n`` shingles must be looked for so that ``percent`` of them can't avoid all."""
    return n - -(-percent * n // 100) + 1


class Block:
    """Some items: their shingles, and by partition the minima that stand for them."""

    def __init__(self, items: pd.DataFrame, percent: int):
        self.percent = percent
        self.ids = [None if pd.isna(i) else int(i) for i in items["item_id"]]
        self.sets: list[set[bytes]] = []
        self.widths: list[int] = []
        found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        hashes = WordHashes()
        for k, text in enumerate(items["text"]):
            tokens = words(text)
            width = min(WIDTH, len(tokens))
            own = shingles(tokens, width)
            self.sets.append(own)
            self.widths.append(width)
            minima = np.unique(hashes_in_order(tokens, hashes, width))[: sketch_size(len(own), percent)]
            found[width, len(own).bit_length()] += [(int(v), k) for v in minima]
        self.partitions = []
        for (width, _), pairs in sorted(found.items()):
            pairs.sort()
            minima, owners = zip(*pairs)
            self.partitions.append((width, np.array(minima, dtype=np.uint64), np.array(owners)))

    def matches(self, text: str | None, hashes: WordHashes) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the text holds."""
        tokens = words(text)
        by_width: dict[int, np.ndarray] = {}
        sets: dict[int, set[bytes]] = {}
        out = []
        for width, minima, owners in self.partitions:
            if len(tokens) < width:
                continue
            if width not in by_width:
                by_width[width] = hashes_in_order(tokens, hashes, width)
            own = by_width[width]
            at = np.searchsorted(minima, own)
            hit = np.unique(own[minima[np.minimum(at, len(minima) - 1)] == own])
            if not len(hit):
                continue
            low, high = np.searchsorted(minima, hit, "left"), np.searchsorted(minima, hit, "right")
            for k in sorted({int(k) for a, b in zip(low, high) for k in owners[a:b]}):
                if width not in sets:
                    sets[width] = shingles(tokens, width)
                shared = len(self.sets[k] & sets[width])
                if 100 * shared >= self.percent * len(self.sets[k]):
                    out.append((k, shared))
        return out


def _usable(items: DataFrame) -> DataFrame:
    """Distinct items with words, with about how many shingles they have."""

    def size(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(n=[len(words(t)) for t in batch["text"]]).astype({"item_id": "Int64"})

    sized = over_texts(items.select("item_id", "text").distinct(), ["item_id", "text"], "item_id bigint, text string, n bigint", size)
    return sized.where("n > 0")


def blocks(items: DataFrame, percent: int = PERCENT, block: int = BLOCK):
    """The items in blocks, one at a time."""
    sized = written(_usable(items), "items")
    total = sized.agg(F.sum("n")).first()[0] or 0
    n_blocks = total // block + 1
    dealt = sized.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    for k in range(n_blocks):
        part = dealt.where(F.col("_block") == k).orderBy("item_id", "text").select("item_id", "text").toPandas()
        if len(part):
            yield Block(part, percent)


def contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of each item that a document holds to ``percent``."""
    schema = "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint"

    def search(part: Block):
        def run(batch: pd.DataFrame) -> pd.DataFrame:
            hashes = WordHashes()
            out = [
                (doc_id, part.ids[k], len(part.sets[k]), shared)
                for doc_id, text in zip(batch["doc_id"], batch["text"])
                for k, shared in part.matches(text, hashes)
            ]
            frame = pd.DataFrame(out, columns=["doc_id", "item_id", "n_item", "n_shared"])
            return frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        return over_texts(docs, ["doc_id", "text"], schema, run)

    found = None
    for part in blocks(items, percent, block):
        found = search(part) if found is None else found.unionByName(search(part))
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def _holds(part: Block):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        hashes = WordHashes()
        return pd.Series([bool(part.matches(t, hashes)) for t in texts], dtype=bool)

    return holds


def clean(docs: DataFrame, items: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``docs`` with all their columns, without those that hold an item."""
    for part in blocks(items, percent, block):
        docs = importable(docs).where(~_holds(part)("text"))
    return docs
