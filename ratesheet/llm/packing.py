"""Best-fit packing by patterns: non-negative least squares over a histogram of lengths.

Documents become pieces of at most ``capacity`` ids (a longer document's first piece takes the
remainder, the others are full). Only the histogram of lengths, at most ``capacity`` numbers
whatever the data's size, reaches the driver. There patterns of up to ``PARTS`` lengths that fill
a sequence exactly are fitted to it by non-negative least squares, their repeats are rounded
down, and what is left is packed best fit first, still as counts. The plan is a list of
(pattern, repeats); each piece finds its place from its rank among the pieces of its length.

Null and empty texts are a piece of the end id alone. A null doc_id and repeated rows are packed
like any other row. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ratesheet.llm.common import over_texts, written
from ratesheet.llm.tokens import encoder, vocabulary

CAPACITY = 1024
END_ID = 2
PARTS = 3
#: Rounds of the fit and patterns tried in each; both only trade driver time for fit.
ROUNDS, BATCH = 8, 64
#: Pieces of one length that one task numbers.
RANKED_TOGETHER = 100_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
Plan = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, how many), ...), repeats


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Tokenised whole texts, cut; the ids themselves are stated by their checksum."""
    path, end = vocabulary(tokenizer), int(END_ID).to_bytes(4, "little")

    def tokenise(batch: pd.DataFrame) -> pd.DataFrame:
        ids_of, out = encoder(path).ids, []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids = memoryview(ids_of(text) + end)
            out += [
                (None if pd.isna(doc_id) else int(doc_id), i, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]))
                for i, (at, n) in enumerate(cut(len(ids) // 4, capacity))
            ]
        frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        return frame.astype({"doc_id": "Int64"})

    return over_texts(docs, ["doc_id", "text"], PIECES, tokenise)


def _exact_patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a >= b >= c) of present lengths with a + b + c = capacity; c may be 0 (a pair)."""
    there = counts > 0
    there[0] = PARTS > 2
    a, b = np.meshgrid(np.nonzero(counts[:capacity])[0], np.nonzero(counts[:capacity])[0], indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = capacity - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    usable = (c == 0) | (there[c] & (PARTS > 2))
    return np.stack([a, b, c], axis=1)[usable]


def _columns(patterns: np.ndarray, capacity: int) -> np.ndarray:
    m = np.zeros((capacity + 1, len(patterns)))
    np.add.at(m, (patterns.T, np.arange(len(patterns))[None, :]), 1.0)
    m[0] = 0
    return m


def fit_repeats(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """min |counts - M x|, x >= 0, by an active set of patterns.

    It starts with all pairs, so that long pieces find their complements, and takes in a batch
    of patterns a round, those that explain most of the residual.
    """
    patterns = _exact_patterns(counts, capacity)
    target = counts.astype(float)
    target[0] = 0
    rest, x = target, np.empty(0)
    chosen = np.nonzero(patterns[:, 2] == 0)[0]
    for _ in range(ROUNDS if len(patterns) else 0):
        while len(chosen):
            m = _columns(patterns[chosen], capacity)
            x = np.linalg.solve(m.T @ m + 1e-6 * np.eye(len(chosen)), m.T @ target)
            if (x > 0).all():
                break
            chosen = chosen[x > 0]
        rest = target - (m @ x if len(chosen) else 0)
        gain = rest[patterns].sum(axis=1)  # the gradient; length 0 has none left
        gain[chosen] = 0
        used: Counter = Counter()
        batch = []
        for p in np.argsort(-gain, kind="stable")[: 40 * BATCH]:
            if gain[p] < 1 or len(batch) == BATCH:
                break
            if max(used[v] for v in patterns[p]) < 2:
                batch.append(p)
                used.update(int(v) for v in patterns[p] if v)
        if not batch:
            break
        last = chosen, x
        chosen = np.append(chosen, batch)
    else:
        chosen, x = last if len(patterns) else (chosen, x)
    return [(tuple(int(v) for v in p if v), float(r)) for p, r in zip(patterns[chosen], x)]


def _best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Longest first, each into the fullest open sequence that takes it; equal ones together."""
    open_: dict[int, list] = defaultdict(list)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            space = next((s for s in range(length, capacity) if open_[s]), None)
            if space is None:
                each = capacity // length
                if left // each:
                    open_[capacity - each * length].append((((length, each),), left // each))
                if left % each:
                    open_[capacity - left % each * length].append((((length, left % each),), 1))
                break
            parts, n = open_[space].pop()
            each = space // length
            take = min(n, left // each)
            if take:
                open_[space - each * length].append(((*parts, (length, each)), take))
                left -= take * each
            if take < n:
                if left:
                    open_[space - left * length].append(((*parts, (length, left)), 1))
                    take, left = take + 1, 0
                if take < n:
                    open_[space].append((parts, n - take))
    return [group for groups in open_.values() for group in groups]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns and repeats that use up ``counts`` (index: length)."""
    left, out = counts.astype(np.int64).copy(), []
    for pattern, repeats in sorted(fit_repeats(counts, capacity), key=lambda p: (-p[1], p[0])):
        parts = Counter(pattern)
        n = min(int(repeats), *(int(left[v]) // k for v, k in parts.items()))
        if n > 0:
            out.append((tuple(parts.items()), n))
            for v, k in parts.items():
                left[v] -= n * k
    return out + _best_fit(left, capacity)


def _slots(steps: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (first rank, first sequence, offset) of each run of slots, by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: Counter = Counter()
    base = 0
    for parts, repeats in steps:
        offset = 0
        for length, many in parts:
            for _ in range(many):
                runs[length].append((taken[length], base, offset))
                taken[length] += repeats
                offset += length
        base += repeats
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for length, r in runs.items()}


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a stable table of (doc_id, piece, start, length, ids_crc32)."""
    hashed = F.xxhash64("doc_id", "piece", "ids_crc32")
    n = cut_pieces.count()
    dealt = cut_pieces.withColumn("_part", F.pmod(hashed, F.lit(n // RANKED_TOGETHER + 1)))
    sizes = written(dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, many in sizes.groupBy("length").agg(F.sum("_n")).collect():  # capacity rows at most
        counts[length] = many
    slots = _slots(plan(counts, capacity))

    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = W.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(order) - 1).join(starts, ["length", "_part"])

    def place(batch: pd.DataFrame) -> pd.DataFrame:
        rank = (batch.pop("_rank") + batch.pop("_before")).to_numpy()
        sequence, offset = np.empty((2, len(batch)), dtype=np.int64)
        lengths = batch["length"].to_numpy()
        for length in np.unique(lengths):
            at = np.nonzero(lengths == length)[0]
            first, base, where = slots[int(length)]
            run = np.searchsorted(first, rank[at], side="right") - 1
            sequence[at] = base[run] + rank[at] - first[run]
            offset[at] = where[run]
        return batch.assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "_rank", "_before"]
    return over_texts(ranked, columns, PIECES + ", sequence_id bigint, offset bigint", place)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """All documents as pieces with their sequence and their place in it."""
    return pack(written(pieces(docs, capacity, tokenizer), "pieces"), capacity)
