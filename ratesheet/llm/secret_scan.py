"""Secret scan: grammars inferred from labelled credentials judge all candidates by their format.

Base rules find assignments, access keys and hexadecimal strings. What they find in
all documents are credentials labelled by kind, and a bounded number of each is learned from. Each kind's strings build a prefix tree with
counts; states whose futures are statistically compatible (Hoeffding bound on the shares of ending
and of each next class of characters, and on all that follows) are merged and folded, in the order
of the tree, which leaves a probabilistic automaton. Ordinary words of the same documents give one
more automaton, of what is no credential.

Every run of credential characters of at least ``SHORTEST`` with a letter and a digit is a
candidate. Its likelihood under
each kind's automaton, against that of ordinary words, must exceed ``MARGIN`` nats; it is then a
``format`` span unless a base span covers part of it.

A null text is an empty one and holds nothing. Without labelled credentials there are no automata
and the base rules stand alone. Positions count code points. Rows are scanned one by one, so
repeated rows get equal results; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ratesheet.llm.common import over_texts, written

#: The base patterns, in the order of their kinds; the shortest match (or value).
BASE = {
    "assign": re.compile(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
SHORTEST_VALUE = {"assign": 6, "access": 20, "hex": 24}
KINDS = [*BASE, "format"]

#: Strings of each kind to learn from, at most, and the longest of them.
TRAIN_EACH, LONGEST = 400, 256
#: Significance of the merge test; states seen less often than this are merged with any.
ALPHA, LEAST_SEEN = 0.05, 8
SHORTEST, MARGIN = 16, 12.0
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{6,}")

# Classes of characters, with the size of each: an automaton reads classes, and a class spreads
# its chance evenly over its characters.
_CLASSES = {"d": "0123456789", "h": "abcdef", "l": "ghijklmnopqrstuvwxyz", "H": "ABCDEF", "U": "GHIJKLMNOPQRSTUVWXYZ"}
_CLASS_OF = {c: k for k, members in _CLASSES.items() for c in members}
_SPREAD = {k: math.log(len(members)) for k, members in _CLASSES.items()}
END = ""
#: Share given to what a state never saw.
UNSEEN = 1e-3


def classes(text: str) -> str:
    return "".join([_CLASS_OF.get(c, c) for c in text])


@dataclass
class Automaton:
    """By state: symbol -> (next state, log share); the end symbol leads nowhere."""

    moves: list[dict[str, tuple[int, float]]]

    def log_likelihood(self, text: str) -> float:
        state, total, unseen = 0, 0.0, math.log(UNSEEN)
        for symbol in classes(text):
            nxt, share = self.moves[state].get(symbol, (0, unseen))
            total += share - _SPREAD.get(symbol, 0.0)
            state = nxt
        return total + self.moves[state].get(END, (0, unseen))[1]


class _Tree:
    """Prefix tree with counts; a merged automaton lives in the same arrays."""

    def __init__(self, strings: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[Counter] = [Counter()]
        for s in strings:
            at = 0
            for symbol in s:
                self.seen[at][symbol] += 1
                if symbol not in self.next[at]:
                    self.next[at][symbol] = len(self.next)
                    self.next.append({})
                    self.seen.append(Counter())
                at = self.next[at][symbol]
            self.seen[at][END] += 1

    def compatible(self, a: int, b: int) -> bool:
        pending = [(a, b)]
        bound = math.sqrt(0.5 * math.log(2 / ALPHA))
        while pending:
            a, b = pending.pop()
            na, nb = self.seen[a].total(), self.seen[b].total()
            if na < LEAST_SEEN or nb < LEAST_SEEN:
                continue
            limit = bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            for symbol in self.seen[a].keys() | self.seen[b].keys():
                if abs(self.seen[a][symbol] / na - self.seen[b][symbol] / nb) > limit:
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pending.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to state ``a``."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            self.seen[a].update(self.seen[b])
            for symbol, child in self.next[b].items():
                if symbol in self.next[a]:
                    pending.append((self.next[a][symbol], child))
                else:
                    self.next[a][symbol] = child


def infer(strings: list[str]) -> Automaton:
    """Merges compatible states, those near the root first."""
    tree = _Tree([classes(s) for s in strings])
    red = [0]
    while True:
        fringe = [(r, s, c) for r in red for s, c in sorted(tree.next[r].items()) if c not in red]
        if not fringe:
            break
        parent, symbol, blue = min(fringe, key=lambda e: e[2])
        for state in red:
            if tree.compatible(state, blue):
                tree.next[parent][symbol] = state
                tree.fold(state, blue)
                break
        else:
            red.append(blue)
    number = {state: k for k, state in enumerate(red)}
    moves = []
    for state in red:
        seen = tree.seen[state]
        room = seen.total() + UNSEEN * seen.total()
        moves.append(
            {s: (0 if s == END else number[tree.next[state][s]], math.log(n / room)) for s, n in seen.items()}
        )
    return Automaton(moves)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, leftmost and without overlap in each kind."""
    spans = []
    for kind, pattern in BASE.items():
        if kind == "access" and "AKIA" not in text or kind == "assign" and not (":" in text or "=" in text):
            continue
        for m in pattern.finditer(text):
            value = m[2] if kind == "assign" else m[0]
            if len(value) >= SHORTEST_VALUE[kind]:
                spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def format_spans(text: str, automata: dict[str, Automaton], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates outside the base spans that look like a credential."""
    if "" not in automata or len(automata) < 2:
        return []
    out = []
    for m in _CANDIDATE.finditer(text):
        if not (_LETTER.search(m[0]) and _DIGIT.search(m[0])):
            continue
        if any(a < m.end() and m.start() < b for a, b, _ in base):
            continue
        plain = automata[""].log_likelihood(m[0])
        if max(a.log_likelihood(m[0]) for kind, a in automata.items() if kind) - plain > MARGIN:
            out.append((m.start(), m.end(), "format"))
    return out


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def labelled(texts: Iterable[str], words: int) -> set[tuple[str, str]]:
    """(kind, value) of all credentials the base rules find; of ordinary words outside of them, under
    the empty kind, those with the smallest crc32, ``words`` at most."""
    out: set[tuple[str, str]] = set()
    least: set[tuple[int, str]] = set()
    bound = 1 << 32
    for text in texts:
        if not isinstance(text, str):
            continue
        spans = base_spans(text)
        for start, end, kind in spans:
            value = BASE[kind].fullmatch(text[start:end])
            value = value[2] if kind == "assign" else value[0]
            if len(value) <= LONGEST:
                out.add((kind, value))
        inside = lambda m: any(a < m.end() and m.start() < b for a, b, _ in spans)
        found = {m[0] for m in _WORD.finditer(text) if not inside(m)} if spans else set(_WORD.findall(text))
        for word in found:
            if (crc := zlib.crc32(word.encode())) <= bound and len(word) <= LONGEST:
                least.add((crc, word))
        if len(least) > 2 * words:
            least = set(sorted(least)[:words])
            bound = max(least)[0]
    return out | {("", word) for _, word in sorted(least)[:words]}


def train(docs: DataFrame, each: int = TRAIN_EACH) -> dict[str, Automaton]:
    """Automata by kind, that of ordinary words under the empty name.

    The base rules label all documents in one pass. Of each kind the ``each`` distinct strings with
    the smallest hashes are used, of ordinary words five times as many.
    """

    def label(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(sorted(labelled(batch["text"], 5 * each)), columns=["kind", "value"])

    found = over_texts(docs, ["text"], "kind string, value string", label).distinct()
    found = written(found, "labelled")
    automata = {}
    for kind in ["", *BASE]:
        some = found.where(F.col("kind") == kind).orderBy(F.xxhash64("value") if kind else F.crc32(F.col("value").cast("binary")), "value")
        some = some.limit(each if kind else 5 * each)
        values = [r[0] for r in some.select("value").collect()]
        if values:
            automata[kind] = infer(values)
    return automata


def scanned(docs: DataFrame, automata: dict[str, Automaton]) -> DataFrame:
    """(doc_id, counts by base kind, checksum of the base spans, all spans) of every row."""

    def scan(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in batch["text"]:
            text = text if isinstance(text, str) else ""
            base = base_spans(text)
            both = base + format_spans(text, automata, base)
            both.sort(key=lambda s: (s[0], KINDS.index(s[2])))
            many = Counter(kind for *_, kind in base)
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            out.append((*[many[k] for k in BASE], digest, _joined(both)))
        frame = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
        frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
        return frame

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return over_texts(docs, ["doc_id", "text"], schema, scan)
