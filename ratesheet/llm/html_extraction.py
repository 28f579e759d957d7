"""Main text of web pages by the templates that pages of a host share.

A page is a row of tokens: start and end tags of elements that make blocks, and block texts, told
apart by the path of elements they stand in (``page_tokens``). Tokens that occur equally often on
every page of a host have the same occurrence vector and form an equivalence class. Classes of three
or more tokens, on three or more pages and on over half of the host's, are its template: the class
that occurs once a page is the skeleton, others are nested in one of its gaps. What lies between
template tokens are slots. On each page a class is valid if its tokens stand in the class's order
and, for nested ones, in one gap; other classes are not applied there.

The text is that of the slots in the template's article, or, where the host has none, of all slots
but those in elements aside (menus, headers, footers, sidebars, notices, adverts, forms, comments,
by name, class, id or role) and in lists of links. Texts of the template itself are left out only
where there is no article: inside an article all text stays. Pages of hosts with fewer than three
pages, and pages that do not follow their host's template, are read by their own elements.

Vectors are never written out: each token carries two sums of 31-bit hashes of (page, count), which
tasks add up before and after one shuffle, so a host with a third of all pages is no heavy key. A
host's template holds less than twice the tokens of its mean page. Templates go to all tasks if they
measure ``BROADCAST_BYTES`` at most, and are joined by host otherwise.

Rules: null and empty pages give an empty text, and so do pages without text in their main part.
Pages without a host in their url share one. Repeated pages count as pages and give equal texts. A
very long page takes memory in proportion to itself in one task. Nothing of a kept block is cut.
Ties (two articles) are all kept in page order. An empty table has no rows. Other columns are
ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ratesheet.llm.common import importable, written
from ratesheet.llm.page_tokens import Page, read

#: Tokens of a class, and pages it is on, at least; its pages are over half of the host's.
LEAST_TOKENS, LEAST_PAGES = 3, 3
#: Templates up to this size are sent to all tasks.
BROADCAST_BYTES = 32 << 20
#: Roles a task sums up before it passes them on.
HELD = 200_000
_PART = (1 << 31) - 1

_SUMS = ["pages", "total", "lo", "hi", "at", "chars", "links"]
_STATISTICS = "host string, role bigint, kind string, main int, " + ", ".join(f"{c} bigint" for c in _SUMS)


def host(url: str = "url") -> Column:
    """The host of an address in lower case, without user and port; empty where there is none."""
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def _on_page(source: str, page: Page) -> dict[int, list]:
    """role -> [kind, main, count, first place, chars, chars in links] of one page's tokens."""
    seen: dict[int, list] = {}
    for place, (kind, role, node, _) in enumerate(page.tokens):
        entry = seen.get(role)
        if entry is None:
            entry = seen[role] = [kind, 0, 0, place, 0, 0]
        entry[2] += 1
        if kind == "<":
            n = page.nodes[node]
            entry[4] += n.chars
            entry[5] += n.links
            if n.main and not any(page.nodes[k].aside for k in page.chain(node)):
                entry[1] = n.main
    return seen


def token_statistics(pages: DataFrame) -> DataFrame:
    """Sums over all pages for each host and role. A host's pages are counted at role 0, kind "h"."""

    names = ["host", "role", "kind", "main", *_SUMS]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * len(_SUMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows() -> pa.RecordBatch:
            columns = zip(*[(*key, *sums) for key, sums in held.items()])
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def add(key: tuple, *values: int) -> None:
            sums = held.setdefault(key, [0] * len(_SUMS))
            for k, value in enumerate(values):
                sums[k] += value

        for batch in batches:
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                add((name, 0, "h", 0), 1)
                if not source:
                    continue
                seed = xxhash.xxh3_64_intdigest(source.encode("utf-8", "surrogatepass"))
                for role, (kind, main, count, place, chars, links) in _on_page(source, read(source)).items():
                    mark = xxhash.xxh3_64_intdigest(count.to_bytes(8, "little"), seed=seed)
                    lo, hi = mark & _PART, mark >> 31 & _PART
                    add((name, role, kind, main), 1, count, lo, hi, place, chars, links)
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    by_task = importable(pages).select(host().alias("host"), "html").mapInArrow(run, _STATISTICS)
    return by_task.groupBy("host", "role", "kind").agg(
        F.max("main").alias("main"), *[F.sum(c).alias(c) for c in _SUMS]
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the classes of each host that has any, as JSON.

    ``classes``: roles in order, the skeleton first; ``main``: the roles of its articles;
    ``menus``: elements that hold links for the most part; ``texts``: roles of recurring texts.
    """

    schema = pa.schema([("host", pa.string()), ("template", pa.string())])

    def deduce(table: pa.Table) -> pa.Table:
        group, classes = table.to_pandas(), []
        for _, same in group.groupby(["pages", "total", "lo", "hi"]):
            if len(same) >= LEAST_TOKENS:
                once = bool((same["pages"] == same["total"]).all())
                everywhere = int(same["pages"].iloc[0])
                ordered = same.assign(place=same["at"] / same["pages"]).sort_values(["place", "role"])
                classes.append((not once, -everywhere, -len(same), [int(r) for r in ordered["role"]], same))
        if not classes:
            return schema.empty_table()
        classes.sort(key=lambda c: c[:3])
        known = pd.concat([c[4] for c in classes])
        tags = known[known["kind"] == "<"]
        most = tags["main"].max() if len(tags) else 0
        template = {
            "classes": [[c[0], c[3]] for c in classes],
            "main": [int(r) for r in tags[(tags["main"] == most) & (most > 0)]["role"]],
            "menus": [int(r) for r in tags[2 * tags["links"] > tags["chars"]]["role"]],
            "texts": [int(r) for r in known[known["kind"] == "x"]["role"]],
        }
        row = {"host": group["host"].iloc[0], "template": json.dumps(template)}
        return pa.Table.from_pylist([row], schema=schema)

    found = written(token_statistics(pages), "page_tokens")
    many = found.where("kind = 'h'").select("host", F.col("pages").alias("of"))
    shared = found.where(f"kind <> 'h' and pages >= {LEAST_PAGES}").join(many, "host").where("2 * pages > of")
    return importable(shared).groupBy("host").applyInArrow(deduce, "host string, template string")


class Template:
    """What a host's template says of a page."""

    def __init__(self, told: str):
        content = json.loads(told)
        self.classes = [(nested, {role: k for k, role in enumerate(roles)}) for nested, roles in content["classes"]]
        self.main, self.menus = set(content["main"]), set(content["menus"])
        self.texts = set(content["texts"])

    def valid(self, page: Page) -> set[int]:
        """The roles of classes that hold on the page: in order, and nested ones in a single gap."""
        places: dict[int, list[int]] = {}
        for at, (_, role, _, _) in enumerate(page.tokens):
            places.setdefault(role, []).append(at)
        found: set[int] = set()
        skeleton: list[int] = []
        for nested, ranks in self.classes:
            at = [places.get(role, []) for role in ranks]
            if nested:
                flat = sorted(p for each in at for p in each)
                if not flat or len({len(each) for each in at}) > 1:
                    continue
                if sum(flat[0] < p < flat[-1] for p in skeleton):
                    continue
            else:
                if any(len(each) != 1 for each in at) or any(a > b for a, b in zip(at, at[1:])):
                    continue
                if not skeleton:
                    skeleton = [each[0] for each in at]
            found.update(ranks)
        return found


@lru_cache(maxsize=512)
def _template(told: str | None) -> Template | None:
    return Template(told) if told else None


def _asides(page: Page, menus: set[int]) -> list[bool]:
    """For each node whether it, or an element around it, holds no main text."""
    found: list[bool] = []
    for n in page.nodes:
        found.append((n.parent >= 0 and found[n.parent]) or n.aside or n.role in menus)
    return found


def _within(page: Page, inside: set[int]) -> list[bool]:
    found: list[bool] = []
    for k, n in enumerate(page.nodes):
        found.append((n.parent >= 0 and found[n.parent]) or k in inside)
    return found


def main_blocks(source: str | None, told: str | None = None) -> list[str]:
    """The blocks of a page's main text in page order, by the template of its host if it has one."""
    page = read(source)
    template = _template(told)
    valid = template.valid(page) if template else set()
    aside = _asides(page, set())
    inside = {k for k, n in enumerate(page.nodes) if template and n.role in template.main & valid and not aside[k]}
    if not inside:
        most = max([n.main for k, n in enumerate(page.nodes) if not aside[k] and n.chars], default=0)
        inside = {k for k, n in enumerate(page.nodes) if most and n.main == most and not aside[k]}
    if inside:
        kept = _within(page, inside)
        return [text for kind, _, node, text in page.tokens if kind == "x" and kept[node] and not aside[node]]
    menus = template.menus & valid if template else _link_lists(page)
    aside = _asides(page, menus)
    blocks = [(role, text) for kind, role, node, text in page.tokens if kind == "x" and not aside[node]]
    slots = [text for role, text in blocks if not (template and role in template.texts and role in valid)]
    return slots or [text for _, text in blocks]


def _link_lists(page: Page) -> set[int]:
    """Lists that hold links for the most part, on pages without a template."""
    return {n.role for n in page.nodes if n.name in ("ul", "ol", "dl") and 2 * n.links > n.chars}


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    found = written(templates(pages), "templates")
    measured = found.agg(F.sum(F.length("host") + F.length("template"))).first()[0] or 0
    known = F.broadcast(found) if measured <= BROADCAST_BYTES else found
    rows = pages.select("page_id", "url", "html").withColumn("host", host()).join(known, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())
            texts = ["\n".join(main_blocks(source, told)) for source, told in pairs]
            arrays = [
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    dealt = importable(rows).select(F.col("page_id").cast("bigint"), "url", "html", "template")
    return dealt.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
