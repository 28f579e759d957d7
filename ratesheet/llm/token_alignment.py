"""How two tokenizers cut the same texts: groups between common cuts, links, corpus-wide counts.

Both tokenizers cover a text's bytes from end to end (with a leading space). Offsets where a token
of each ends cut both lists into groups; two tokens are linked if their bytes overlap. A pair of ids
counts once for each document that holds it linked. Each document is then described by how often
its links are the most common ones of their first id.

The first pass aligns the documents; tasks sum their pairs before they pass them on. Distinct pairs
are cut into 256 shards and get a minimal perfect hash each (``perfect_hash``). Tasks sum the counts
into dense vectors indexed by it, and pieces of these vectors are added up in a tree of 64 branches.
The second pass aligns the documents again and looks the counts up, by slot and checked by key.
A block of at most ``BLOCK`` pairs (or one shard) is in memory at a time: with more pairs there are
as many second passes as blocks, and their sums are added.

Texts are cut into parts at single spaces between visible characters, which no token of either
vocabulary crosses. Parts repeat: a task aligns each once, thousands at a time, numbers it and keeps
its links and groups; a text is then the row of its parts' numbers. Texts with other spaces are parts
by themselves.

Rules: a null or empty text, and one that the tokens of either side do not spell out byte by byte
(such as one holding U+2581), has no tokens. Its numbers are 0 and its digest is empty. Rows are
documents, so repeated rows count each. Ties for the highest count are all best. A very long text
takes memory in proportion to itself in one task. An empty table has no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from ratesheet.llm import tokens
from ratesheet.llm.common import importable, written
from ratesheet.llm.perfect_hash import PerfectHash, build, shard_of

#: Parts of texts that a task keeps, and links of them; beyond either it starts anew.
PART_CACHE, KEPT_LINKS = 500_000, 8_000_000
#: Characters of texts that are aligned at once (or a single text).
AT_ONCE = 2_000_000
#: Distinct pairs of a block: 64 MB of keys and counts.
BLOCK = 4_000_000
#: Pairs a task holds before it passes them on.
HELD = 2_000_000
#: Slots of a piece of a count vector; vectors added by one task of the tree.
PIECE, BRANCHES = 1 << 14, 64
_ODD_SPACE = re.compile(r" \s|\s ")
_MARK = "▁"

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
RESULT = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in COLUMNS)


def piece_model(path: str | None = None) -> str:
    return path or public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Aligned:
    """Texts aligned together. Counts are by text; links stand by text in no order within it."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    links: np.ndarray
    text_of_link: np.ndarray
    groups: list[bytes]


class _Numbers(dict):
    """A number for each part, given when it is first looked up."""

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        return number


def _joined(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids behind each other, and how many each list has."""
    ids = np.frombuffer(b"".join(lists), dtype=np.uint32).astype(np.int64)
    return ids, np.array([len(x) // 4 for x in lists], dtype=np.int64)


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a = tokens.encoder(a_path).encoding
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.a_length = np.array(list(map(len, a_bytes)), dtype=np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), dtype=np.int64)
        self.by_parts = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        # What stands behind a token: another of its side, the other side, the next group, nothing.
        marks = (b",", b"|", b";", b"")
        self.told = [b"%d%s" % (i, mark) for n in (len(a_bytes), len(pieces)) for i in range(n) for mark in marks]
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.counts = np.empty((3, 0), dtype=np.int64)  # A tokens, B tokens, groups; 0 where there are none
        self.links, self.link_at = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.groups: list[bytes] = []

    # --- parts -------------------------------------------------------------------------

    def _cut(self, text: str) -> list[str]:
        if not self.by_parts or text[-1] == " " or _ODD_SPACE.search(" " + text):
            return [text]
        return text.split(" ")

    def _spelt(self, text: str, ids: list[int]) -> bytes:
        """The ids as 32-bit integers, none if their bytes are not a space and the text."""
        told = b"".join(map(self.b_bytes.__getitem__, ids))
        same = told == (" " + text).encode("utf-8", "surrogatepass")
        return array("I", ids).tobytes() if same else b""

    def _alone(self, text: str) -> tuple[bytes, bytes]:
        a = array("I", self.a.encode_ordinary(" " + text)).tobytes()
        return a, self._spelt(text, self.b.encode(text))

    def _together(self, parts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """A and B ids of parts without spaces that end in a visible character, encoded in one call each."""
        text = " " + " ".join(parts)
        raw = text.encode("utf-8", "surrogatepass")
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        a = np.array(self.a.encode_ordinary(text), dtype=np.uint32)
        at = np.cumsum(self.a_length[a])
        cut = np.minimum(np.searchsorted(at, ends), len(at) - 1)
        lists = self.b.encode(parts)
        b = list(chain.from_iterable(lists))
        if (at[cut] != ends).any() or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return tuple(map(list, zip(*map(self._alone, parts))))
        a_ids, b_ids = a.tobytes(), array("I", b).tobytes()
        cut_a, cut_b = (4 * (cut + 1)).tolist(), (4 * np.cumsum(list(map(len, lists)))).tolist()
        return (
            [a_ids[i:j] for i, j in zip([0, *cut_a], cut_a)],
            [b_ids[i:j] for i, j in zip([0, *cut_b], cut_b)],
        )

    def _learn(self, parts: list[str]) -> None:
        """Aligns parts that are new and keeps what comes of them, in the order of their numbers."""
        odd = [k for k, p in enumerate(parts) if p[-1].isspace() or " " in p]
        a_each, b_each = [b""] * len(parts), [b""] * len(parts)
        plain = sorted(set(range(len(parts))) - set(odd)) if odd else range(len(parts))
        if plain:
            for k, a, b in zip(plain, *self._together([parts[k] for k in plain])):
                a_each[k], b_each[k] = a, b
        for k in odd:
            a_each[k], b_each[k] = self._alone(parts[k])
        found = self._align(parts, a_each, b_each)
        counts = np.stack([found.n_a, found.n_b, found.n_groups])
        order = np.argsort(found.text_of_link, kind="stable")
        ends = np.cumsum(np.bincount(found.text_of_link, minlength=len(parts)))
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.link_at = np.concatenate([self.link_at, len(self.links) + ends])
        self.links = np.concatenate([self.links, found.links[order]])
        self.groups += found.groups

    def _align(self, parts: list[str], a_each: list[bytes], b_each: list[bytes]) -> Aligned:
        """Alignments of parts by their ids. One whose tokens do not spell it out has none.

        A tokens stand for the bytes they were cut from, so their lengths tell whether all are there.
        """
        size = np.array([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts], dtype=np.int64)
        a, n_a = _joined(a_each)
        whole = np.bincount(np.repeat(np.arange(len(parts)), n_a), self.a_length[a], len(parts)) == size
        sound = whole & np.array(list(map(bool, b_each)))
        if not sound.all():
            a_each, b_each = ([x if ok else b"" for x, ok in zip(each, sound)] for each in (a_each, b_each))
            a, n_a = _joined(a_each)
        b, n_b = _joined(b_each)
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        at_b, at_a = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)
        a_last, b_last = b_end[at_b] == a_end, a_end[at_a] == b_end
        # Each stretch between two ends of either side lies in one token of A and one of B.
        part_a, part_b = (np.repeat(np.arange(len(parts)), n) for n in (n_a, n_b))
        inner = ~b_last
        links = np.concatenate([a << 32 | b[at_b], a[at_a[inner]] << 32 | b[inner]])
        n_groups = np.bincount(part_a[a_last], minlength=len(parts))
        groups = self._groups(a, b, a_last, b_last, np.cumsum(n_a), np.cumsum(n_b))
        return Aligned(n_a, n_b, n_groups, links, np.concatenate([part_a, part_b[inner]]), groups)

    def _groups(self, a, b, a_last, b_last, cuts_a, cuts_b) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each part: A and B tokens of a group, then the next group."""
        group_a, group_b = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        b_start = np.concatenate([[0], np.flatnonzero(b_last) + 1])
        a_stop = np.flatnonzero(a_last) + 1
        told = np.empty(len(a) + len(b), dtype=np.int64)
        told[np.arange(len(a)) + b_start[group_a]] = 4 * a + a_last
        behind_b = 2 * b_last
        behind_b[cuts_b[np.diff(cuts_b, prepend=0) > 0] - 1] = 3
        told[np.arange(len(b)) + a_stop[group_b]] = 4 * (len(self.a_length) + b) + behind_b
        cuts = [0, *(cuts_a + cuts_b).tolist()]
        words = list(map(self.told.__getitem__, told.tolist()))
        return [b"".join(words[low:high]) for low, high in zip(cuts, cuts[1:])]

    # --- texts -------------------------------------------------------------------------

    def _texts(self, texts: list[str], told: bool) -> tuple[np.ndarray, Aligned]:
        """(whether it has tokens, alignment) of texts, none of which is empty."""
        cut = list(map(self._cut, texts))
        if len(self.numbers) > PART_CACHE or len(self.links) > KEPT_LINKS:
            self.forget()
        known, sizes = len(self.numbers), np.array(list(map(len, cut)), dtype=np.int64)
        each = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, sizes.sum())
        if len(self.numbers) > known:
            self._learn(list(islice(self.numbers, known, None)))
        starts = np.cumsum(sizes) - sizes
        n_a, n_b, n_groups = np.add.reduceat(self.counts[:, each], starts, axis=1)
        sound = np.logical_and.reduceat(self.counts[0, each] > 0, starts)
        if not sound.all():
            each = each[np.repeat(sound, sizes)]
            n_a, n_b, n_groups, sizes = n_a[sound], n_b[sound], n_groups[sound], sizes[sound]
        low = self.link_at[each]
        many = self.link_at[each + 1] - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        text_of_link = np.repeat(np.repeat(np.arange(len(sizes)), sizes), many)
        groups = []
        if told:
            words = list(map(self.groups.__getitem__, each.tolist()))
            cuts = [0, *np.cumsum(sizes).tolist()]
            groups = [b";".join(words[i:j]) for i, j in zip(cuts, cuts[1:])]
        return sound, Aligned(n_a, n_b, n_groups, self.links[at], text_of_link, groups)

    def over(self, texts: list[str | None], told: bool = True) -> Iterator[tuple[np.ndarray, Aligned]]:
        """(positions, alignment) of the texts that have tokens, some megabytes at a time. The
        groups are written out if they are to be ``told``."""
        held, size = [], 0
        for at, text in enumerate(texts):
            if text:
                held.append(at)
                size += len(text)
            if held and (size >= AT_ONCE or at + 1 == len(texts)):
                sound, found = self._texts([texts[k] for k in held], told)
                if sound.any():
                    yield np.array(held)[sound], found
                held, size = [], 0


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker process and pair of files."""
    return Aligner(a_path, b_path)


def _distinct_links(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, texts that hold them)."""
    order = np.lexsort((found.text_of_link, found.links))
    links, texts = found.links[order], found.text_of_link[order]
    new = np.ones(len(links), dtype=bool)
    new[1:] = (links[1:] != links[:-1]) | (texts[1:] != texts[:-1])
    return np.unique(links[new], return_counts=True)


def _added(keys: np.ndarray, counts: np.ndarray, more: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    both, at = np.unique(np.concatenate([keys, *[k for k, _ in more]]), return_inverse=True)
    weight = np.concatenate([counts, *[c for _, c in more]])
    return both, np.bincount(at, weight, len(both)).astype(np.int64)


def pairs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(shard, keys, counts): linked pairs with the documents of a task that hold them."""

    def rows(keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        shard = shard_of(keys)
        order = np.argsort(shard, kind="stable")
        ids, starts = np.unique(shard[order], return_index=True)
        cut = [np.split(v[order], starts[1:]) for v in (keys, counts)]
        return pd.DataFrame({"shard": ids, "keys": cut[0], "counts": cut[1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        align, held, many = aligner(a_path, b_path), [], 0
        keys = counts = np.empty(0, dtype=np.int64)
        for batch in batches:
            for _, found in align.over(batch["text"].tolist(), told=False):
                held.append(_distinct_links(found))
                many += len(held[-1][0])
                if many >= HELD:
                    keys, counts = _added(keys, counts, held)
                    held, many = [], 0
                    if len(keys) >= HELD:
                        yield rows(keys, counts)
                        keys = counts = np.empty(0, dtype=np.int64)
        keys, counts = _added(keys, counts, held)
        if len(keys):
            yield rows(keys, counts)

    schema = "shard int, keys array<bigint>, counts array<bigint>"
    return importable(docs).select("text").mapInPandas(run, schema)


def hashes(partial: DataFrame) -> DataFrame:
    """(shard, n, sizes, words, keys): the perfect hash of each shard's distinct pairs."""

    def make(group: pd.DataFrame) -> pd.DataFrame:
        sizes, words, keys = build(group["key"].to_numpy())
        row = int(group["shard"].iloc[0]), len(keys), sizes, words.tobytes(), keys.tobytes()
        return pd.DataFrame([row], columns=["shard", "n", "sizes", "words", "keys"])

    distinct = partial.select("shard", F.explode("keys").alias("key")).distinct()
    schema = "shard int, n bigint, sizes array<bigint>, words binary, keys binary"
    return importable(distinct).groupBy("shard").applyInPandas(make, schema)


def _blocks(built: DataFrame) -> list[list[int]]:
    """Shards whose pairs are looked up together."""
    blocks: list[list[int]] = []
    room = 0
    for shard, n in sorted(built.select("shard", "n").collect()):
        if not blocks or n > room:
            blocks.append([])
            room = BLOCK
        blocks[-1].append(shard)
        room -= n
    return blocks


def _hash_of(built: DataFrame, shards: list[int]) -> PerfectHash:
    rows = built.where(F.col("shard").isin(shards)).collect()
    return PerfectHash.of(
        {r.shard: (list(r.sizes), np.frombuffer(r.words, np.uint64), np.frombuffer(r.keys, np.int64)) for r in rows}
    )


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(PIECE, dtype=np.int64)
    for counts in group["counts"]:
        total += np.frombuffer(counts, dtype=np.int64)
    first = group[["piece", "part"]].iloc[0].tolist()
    return pd.DataFrame([(*first, total.tobytes())], columns=["piece", "part", "counts"])


def _counts(partial: DataFrame, shards: list[int], index: Broadcast) -> np.ndarray:
    """Documents of each pair, by slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup: PerfectHash = index.value
        whole = -(-len(lookup.keys) // PIECE)
        dense = np.zeros(whole * PIECE, dtype=np.int64)
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"]):
                dense[lookup.slots(np.asarray(keys))] += np.asarray(counts)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        used = [(k, part, v.tobytes()) for k, v in enumerate(dense.reshape(whole, PIECE)) if v.any()]
        for row in used:
            yield pd.DataFrame([row], columns=["piece", "part", "counts"])

    schema = "piece int, part int, counts binary"
    dealt = importable(partial.where(F.col("shard").isin(shards))).mapInPandas(run, schema)
    vectors = written(dealt, "vectors")
    most = vectors.agg(F.max("part")).first()[0] or 0
    while True:
        most //= BRANCHES
        branch = vectors.withColumn("part", F.expr(f"int(part div {BRANCHES})"))
        vectors = branch.groupBy("piece", "part").applyInPandas(_add, schema)
        if not most:
            break
        vectors = written(vectors, "vectors")
    pieces = sorted(vectors.select("piece", "counts").collect())
    return np.concatenate([np.frombuffer(r.counts, dtype=np.int64) for r in pieces])


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    a_path, b_path = tokens.vocabulary(a_path), piece_model(b_path)
    context = docs.sparkSession.sparkContext
    partial = written(pairs(docs, a_path, b_path), "pairs")
    built = written(hashes(partial), "hashes")
    tables = []
    best = np.zeros(len(aligner(a_path, b_path).a_length), dtype=np.int64)
    blocks = _blocks(built) or [[]]
    for shards in blocks:
        lookup = _hash_of(built, shards)
        index = context.broadcast(lookup)
        counts = _counts(partial, shards, index) if shards else np.zeros(0, dtype=np.int64)
        np.maximum.at(best, lookup.keys >> 32, counts[: len(lookup.keys)])
        tables.append((index, context.broadcast(counts)))
    highest = context.broadcast(best)
    seen = [_looked_up(docs, a_path, b_path, *table, highest) for table in tables]
    return seen[0] if len(seen) == 1 else _over_blocks(seen)


def _looked_up(
    docs: DataFrame, a_path: str, b_path: str, index: Broadcast, counted: Broadcast, highest: Broadcast
) -> DataFrame:
    """The second pass over one block: n_best and count_sum are of its pairs only."""

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        align, n = aligner(a_path, b_path), batch.num_rows
        n_a, n_b, n_groups, lengths, n_best, count_sum = np.zeros((6, n), dtype=np.int64)
        digests = [""] * n
        for at, found in align.over(batch.column("text").to_pylist()):
            slots = index.value.slots(found.links)
            here = slots >= 0
            counts = np.zeros(len(slots), dtype=np.int64)
            counts[here] = counted.value[slots[here]]
            top = here & (counts == highest.value[found.links >> 32])
            n_a[at], n_b[at], n_groups[at] = found.n_a, found.n_b, found.n_groups
            lengths[at] = np.bincount(found.text_of_link, minlength=len(at))
            n_best[at] = np.bincount(found.text_of_link[top], minlength=len(at))
            sums = np.zeros(len(at), dtype=np.int64)
            np.add.at(sums, found.text_of_link, counts)
            count_sum[at] = sums
            for k, told in zip(at.tolist(), found.groups):
                digests[k] = hashlib.sha256(told).hexdigest()
        columns = [batch.column("doc_id"), n_a, n_b, n_groups, lengths, n_best, count_sum, digests]
        kinds = [pa.int64()] * 7 + [pa.string()]
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield look(batch)

    return importable(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def _over_blocks(seen: list[DataFrame]) -> DataFrame:
    """Sums over the blocks. Rows that are equal in a block are so in all: they are counted."""
    same = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    each = None
    for k, found in enumerate(seen):
        rows = written(found, "looked_up").groupBy(*same).agg(
            F.count(F.lit(1)).alias("rows"), F.max("n_best").alias("n_best"), F.max("count_sum").alias("count_sum")
        )
        each = rows if each is None else each.unionByName(rows)
    total = each.groupBy(*same).agg(
        F.max("rows").alias("rows"), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return total.withColumn("_copy", F.explode(F.sequence(F.lit(1), "rows"))).select(*COLUMNS)
