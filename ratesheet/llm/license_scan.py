"""License scan: ordered signature rules behind a keyword prefilter, overlaps resolved.

A text is looked at for a rule only if it holds the rule's gate and its keyword; the gates are few
and most texts hold none. Detections are taken in the order of priority, then of length; one that
lies within a detection already taken is suppressed, so "GNU General Public License, version 3"
is not also a plain mention of that license. What overlaps only in part stays. Rules read the text
with white space, and comment marks at the starts of lines, folded to one space, so lines may wrap
anywhere between words; positions are those of the text itself.

Three base phrases are found besides, as words that stand consecutively. Words are lower-cased
(A-Z only) runs of ASCII letters and digits and of code points beyond ASCII. A null text is an
empty one: no words, no places, no labels, score 0. Rows are scanned one by one, so repeated rows
get equal results; only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame

from ratesheet.llm.common import over_texts, plain_words
from ratesheet.llm.license_rules import RULES, Rule

#: Phrase, label: fixed values.
BASE = [
    (["cc", "by"], "cc-by"),
    (["general", "public", "license"], "gpl"),
    (["all", "rights", "reserved"], "reserved"),
]
_BY_GATE = {
    gate: list(rules) for gate, rules in groupby(sorted(RULES, key=lambda r: r.gate), key=lambda r: r.gate)
}
#: White space that is not one plain space, with the comment marks of wrapped lines. Nothing in it
#: is tried twice, so it is linear.
_GAP = re.compile(
    r"[^\S\n]*+(?:\n[^\S\n]*+(?:(?://+|/\*+|\*+(?!/)|#+|;+|--+|%+|>+|!+|(?:dnl|rem)(?=\s))[^\S\n]*+)?)++|\s{2,}+|[^\S ]"
)


def lower_ascii(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def base_places(tokens: list[bytes]) -> list[tuple[int, str]]:
    """(word number, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE:
        want, at = [w.encode() for w in phrase], -1
        while True:
            try:
                at = tokens.index(want[0], at + 1)
            except ValueError:
                break
            if tokens[at : at + len(want)] == want:
                out.append((at, label))
    return out


def folded(text: str) -> tuple[str, list[int], list[int]]:
    """The text with each gap as one space, and where its pieces start: there, and in the text.

    A gap is a run of white space, together with comment marks at the starts of its lines.
    """
    pieces, here, there, at, size = [], [0], [0], 0, 0
    for m in _GAP.finditer(text):
        pieces += [text[at : m.start()], " "]
        size += m.start() - at + 1
        at = m.end()
        here.append(size)
        there.append(at)
    return "".join([*pieces, text[at:]]), here, there


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of what stays, by start; found in the folded text, placed in ``text``."""
    lowered, here, there = folded(text)

    def place(at: int) -> int:
        k = bisect_right(here, at) - 1
        return there[k] + at - here[k]

    return [(place(a), place(b - 1) + 1, rule) for a, b, rule in _detected(lowered)]


def _detected(lowered: str) -> list[tuple[int, int, Rule]]:
    found = []
    for gate, rules in _BY_GATE.items():
        if gate not in lowered:
            continue
        known: dict[str, bool] = {}
        for rule in rules:
            if rule.keyword not in known:
                known[rule.keyword] = rule.keyword in lowered
            if known[rule.keyword]:
                found += [(*m.span(rule.pattern.groups), rule) for m in rule.pattern.finditer(lowered)]
    found.sort(key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].label))
    taken: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of the widest intervals taken; none lies in another, so their
    ends: list[int] = []  # ends rise with their starts
    for start, end, rule in found:
        k = bisect_right(starts, start)
        if k and ends[k - 1] >= end:
            continue
        taken.append((start, end, rule))
        low = k - 1 if k and starts[k - 1] == start else k
        high = bisect_right(ends, end)
        starts[low : max(low, high)], ends[low : max(low, high)] = [start], [end]
    return sorted(taken, key=lambda d: d[:2])


def scanned(docs: DataFrame) -> DataFrame:
    """One row a document: counts and labels of the base, all labels, score, spans of the rules."""

    def scan(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in batch["text"]:
            lowered = lower_ascii(text) if isinstance(text, str) else ""
            tokens = plain_words(text)
            places = base_places(tokens)
            taken = detections(lowered)
            base = {label for _, label in places}
            at = [k for k, _ in places]
            out.append(
                (
                    len(tokens), len(places), min(at, default=None), max(at, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {r.label for *_, r in taken})),
                    max([0.9 if base else 0.0, *(r.score for *_, r in taken)]),
                    ",".join(f"{r.label}:{a}:{b}" for a, b, r in taken),
                )
            )
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        frame = pd.DataFrame(out, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})
        frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
        return frame

    schema = (
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double, spans string"
    )
    return over_texts(docs, ["doc_id", "text"], schema, scan)
