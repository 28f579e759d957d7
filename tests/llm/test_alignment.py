"""Token alignment against a plain version by the libraries themselves, and perfect hashing."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratesheet.llm import perfect_hash, token_alignment
from ratesheet.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"
ODD = [
    "a  b", " a", "a ", " ", "  ", "\n a\n", "tab\t b", "a▁b", "▁", "<|endoftext|> x", "<s> </s> <unk> <0x41>",
    "　wide nbsp", "ﬁ é é", "emoji 😀😀 x", "a\x00b", "x" * 3000, "ab " * 700, "日本語 テスト 漢字", "don't I'll", "123 4567\r\n89",
    "﻿bom", "a​b", "\x1c x", "end\n", "\n", "mixed ДАА̶",
]


def offsets(parts: list[bytes]) -> list[tuple[int, int]]:
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        """(a ids, b ids, groups, links) by overlap of byte ranges."""
        if not text:
            return None
        found = self.a.encode(" " + text, add_special_tokens=False)
        a, b = found.ids, self.b.encode(text)
        a_parts = [bytes(self.letters[c] for c in t) for t in found.tokens]
        b_parts = [self.b_bytes(i) for i in b]
        raw = (" " + text).encode()
        if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
            return None
        a_at, b_at = offsets(a_parts), offsets(b_parts)
        cuts = sorted({e for _, e in a_at} & {e for _, e in b_at})
        groups = [([], []) for _ in cuts]
        for side, (ids, at) in enumerate(((a, a_at), (b, b_at))):
            for i, (_, e) in zip(ids, at):
                groups[bisect_left(cuts, e)][side].append(i)
        links, lo = [], 0
        for i, (s, e) in zip(a, a_at):
            while b_at[lo][1] <= s:
                lo += 1
            k = lo
            while k < len(b_at) and b_at[k][0] < e:
                links.append((i, b[k]))
                k += 1
        return a, b, groups, links


def plain(rows):
    tool = Plain()
    found = [(i, tool.align(text)) for i, text in rows]
    counts = Counter(p for _, f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (i, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def ours(df):
    return sorted(map(tuple, token_alignment.aligned(df).collect()), key=repr)


def test_documents_against_plain(spark, sf_dir, docs):
    found = sorted(map(tuple, QUERIES["op11_cross_tokenizer_alignment"](spark, sf_dir).collect()), key=repr)
    assert found == plain([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_rows(edge, clashing):
    expected = plain([tuple(r) for r in edge.select("doc_id", "text").collect()])
    assert ours(edge) == expected
    assert ours(clashing) == expected


def test_odd_texts_and_large_ids(spark):
    rows = [(2**62 + k, t) for k, t in enumerate(ODD)] + [(None, "a b"), (None, None), (1, ODD[0]), (1, ODD[0])]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


def test_empty_table(empty):
    assert ours(empty) == []


@pytest.mark.parametrize(("block", "copies"), [(8, 2), (700, 60)])
def test_blocks_and_tree(spark, monkeypatch, block, copies):
    """Small blocks, some of a single shard, and a tree of two branches."""
    rows = [(k % 9, f"word{k % 7} number {k} stands éhere {k * k}") for k in range(copies)] + [(1, None)]
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    monkeypatch.setattr(token_alignment, "BRANCHES", 2)
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(9)) == plain(rows)


def test_perfect_hash():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(2**62), 2**62, 20_000))
    shard = perfect_hash.shard_of(keys)
    built = {int(s): perfect_hash.build(keys[shard == s]) for s in np.unique(shard)}
    table = perfect_hash.PerfectHash.of(built)
    slots = table.slots(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (table.keys[slots] == keys).all()
    bits = 64 * len(table.words) / len(keys)
    assert bits < 6
    with pytest.raises(KeyError):
        table.slots(np.array([2**62 + 1]))
    part = perfect_hash.PerfectHash.of({k: v for k, v in built.items() if k < 10})
    assert ((part.slots(keys) >= 0) == (shard < 10)).all()


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        perfect_hash.build(np.array([3, 3]))


def test_totals_agree_with_tokens(spark, docs):
    found = token_alignment.aligned(docs).where("n_a > 0")
    assert found.where(F.expr("n_links <> n_a + n_b - n_groups")).count() == 0
