"""Operators that judge or scan texts one by one, against plain versions and held-out rows."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import plain
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from ratesheet.llm import (
    decontamination,
    expected,
    language_id,
    license_rules,
    license_scan,
    quality_classifier,
    quality_rules,
    queries,
    secret_scan,
    statistics,
)

HARD = [
    None, "", " \n", "CC-BY cc\tby, Cc..BY!", "All rights\nreserved all rights reserved", "ALL RIGHTS RESERVEDx",
    "GNU General Public License, version 3", "password: 'hunter22' TOKEN=abc apikey = x.y-z=/_+", "ſecret=abcdefgh toKen: K2345678",
    "AKIA" + "B" * 15, "AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 14, "f" * 23 + " " + "0a" * 12 + "G", "token: secret: abcdef12",
    "a b c a b c\n\na b c\na b c", "x # * $ % & | < >", "é è ê\x1cü", "q" * 70_000, "one two three four " * 9_000,
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string").repartition(2)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def sampled(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_quality_counts_match_plain(hard, docs):
    for frame in (hard, docs):
        got = by_id(quality_rules.judged(frame, None))
        for doc_id, text in sampled(frame):
            want = plain.quality_counts(text)
            assert {k: got[doc_id][k] for k in want} == want
            failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
            assert got[doc_id].base_failed == failed and (got[doc_id].kept is not failed)


def test_trees_learn_and_keep_their_directions():
    rng = np.random.default_rng(4)
    x = rng.random((3_000, 4))
    good = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) < 0.6) & (x[:, 1] > 0.2)).astype(float)
    falling = np.array([True, False, False, False])
    forest = quality_rules.fit(x[:2_000], good[:2_000], falling)
    assert ((forest.score(x[2_000:]) > 0.5) == good[2_000:]).mean() > 0.95
    for row in x[:50]:
        line = np.tile(row, (200, 1))
        line[:, 0] = np.linspace(0, 1, 200)
        assert (np.diff(forest.score(line)) <= 1e-12).all()

    def walk(row):
        total = forest.start
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:100]), [walk(r) for r in x[:100]])


def labels_of(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


def test_quality_rules_follow_the_labels(spark, learn_dir):
    labels = labels_of(spark, learn_dir)
    got = queries.QUERIES["op7_quality_rules"](spark, learn_dir).join(labels, "doc_id").where("not base_failed")
    judged = got.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert judged > 0.97


def test_discriminant_against_plain_densities():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (300, 3))])
    y = np.repeat([0.0, 1.0], [400, 300])
    model = quality_classifier.fit(x, y)
    z = (x - model.centre) / model.scale
    logs = []
    for mean, factor in zip(model.means, model.factors):
        lower = np.linalg.inv(factor)
        cov = lower @ lower.T
        d = z - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.difference(x), logs[1] - logs[0])
    assert ((model.score(x) > 0.5) == y).mean() > 0.75


def test_quality_classifier_on_held_out_rows(spark, learn_dir):
    labels = labels_of(spark, learn_dir)
    got = queries.QUERIES["op3_quality_classifier"](spark, learn_dir)
    rows = got.join(labels.select("doc_id", "quality"), "doc_id", "left").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    known = [r for r in rows if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in known]) > 0.9


def test_language_on_held_out_rows(spark, learn_dir):
    docs = spark.read.parquet(f"{learn_dir}/documents.parquet")
    got = queries.QUERIES["op2_language_id"](spark, learn_dir).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.9


def words_of(rng, letters, n=60):
    return " ".join("".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(n))


def test_votes_of_pairs_against_plain(spark):
    """Five relatives and a stranger: machines, votes and ties as a plain one-versus-one has them."""
    rng = np.random.default_rng(4)
    letters = {"en": "abcdefgh", "de": "cdefghij", "nl": "efghijkl", "sv": "ghijklmn", "da": "ijklmnop", "pl": "uvwxyz"}
    rows = [(k, words_of(rng, letters[v]), v) for k, v in enumerate(v for v in letters for _ in range(24))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.train(docs)
    vectors = {k: language_id.features(t).astype(np.float16) for k, t, _ in rows}
    machines = {}
    for a, b in itertools.combinations(sorted(set(letters) - {"pl"}), 2):
        some = [(k, 1.0 if v == a else -1.0) for k, _, v in rows if v in (a, b)]
        machines[a, b] = language_id._machine(
            language_id._with_offset([vectors[k] for k, _ in some]), np.array([s for _, s in some])
        )
    assert set(model.pairs) == set(machines) and set(model.families) == {"germanic", "slavic"}
    assert all(np.allclose(model.pairs[p], machines[p]) for p in machines)
    fresh = [(1000 + k, words_of(rng, letters[v], 4), v) for k, v in enumerate(v for v in letters for _ in range(30))]
    got = {r.doc_id: r for r in language_id.predicted(spark.createDataFrame(fresh, "doc_id long, text string, lang string"), model).collect()}
    right = 0
    for k, text, lang in fresh:
        x = language_id.features(text)
        shares = [x @ model.families[f][:-1] + model.families[f][-1] for f in ("germanic", "slavic")]
        if shares[1] > shares[0]:
            assert got[k].lang_pred == "pl"
            continue
        votes, margins = Counter(), Counter()
        for (a, b), w in machines.items():
            margin = x @ w[:-1] + w[-1]
            votes[a if margin > 0 else b] += 1
            margins[a] += margin
            margins[b] -= margin
        most = max(votes.values())
        want = max((v for v in votes if votes[v] == most), key=lambda v: margins[v])
        assert got[k].lang_pred == want and 0 <= got[k].score <= 1
        right += want == lang
    assert right > 100


def test_a_hundred_languages(spark):
    """None is left out, and a language without relatives is a family by itself."""
    rng = np.random.default_rng(9)
    names = [f"x{k:02d}" for k in range(97)] + ["en", "de", "nl"]
    alphabets = {v: rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6, replace=False) for v in names}
    rows = [(k, words_of(rng, alphabets[v], 40), v) for k, v in enumerate(v for v in names for _ in range(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = language_id.train(docs)
    assert sum(map(len, model.languages.values())) == 100 and len(model.families) == 98 and len(model.pairs) == 3
    got = {r.doc_id: r.lang_pred for r in language_id.predicted(docs, model).collect()}
    assert np.mean([got[k] == v for k, _, v in rows]) > 0.9


def test_grams_do_not_depend_on_the_parts(monkeypatch):
    text = "Größe und Länge, très bien! " * 40
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "PART", 37)
    assert np.allclose(language_id.features(text), whole)
    assert language_id.features("12 !?") is None and language_id.features("") is None


def test_license_base_and_labels(hard, docs):
    for frame in (hard, docs):
        got = by_id(license_scan.scanned(frame))
        for doc_id, text in sampled(frame):
            r, want = got[doc_id], plain.license_base(text)
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


FORMS = {
    "licensed under apache-2.0": ["apache-2.0"],
    "licensed under gpl-2.0-only": ["gpl-2.0"],
    "licensed under the apache 2.0 license": ["apache-2.0"],
    "mozilla public license 2.0": ["mpl-2.0"],
    "gnu general public license 3": ["gpl-3.0"],
    "bsd-3-clause": ["bsd-3-clause"],
    "released under mit": ["mit"],
    "a gpl-2.0x b": [],
    "spdx-license-identifier: mit or apache-2.0": ["mit", "apache-2.0"],
    "spdx-license-identifier: (mit or apache-2.0)": ["mit", "apache-2.0"],
    "spdx-license-identifier: ((mit and isc) or (bsd-3-clause and zlib))": ["mit", "isc", "bsd-3-clause", "zlib"],
    "license = gpl-2.0-or-later with classpath-exception-2.0": ["gpl-2.0"],
    "this is free and unencumbered software released into the public domain": ["unlicense"],
    "either version 2 of the license, or (at your option) any later version": ["gpl"],
    "this software is provided 'as-is', without any express or implied warranty": ["zlib"],
}


@pytest.mark.parametrize("text", FORMS)
def test_license_forms_of_today(text):
    for around in ("{}", "x {} y", "// {}\n// next"):
        found = [r.label for *_, r in license_scan.detections(around.format(text))]
        assert found == FORMS[text], (around, found)


def test_gates_hide_nothing(docs):
    """All rules without their gates find what the scan finds."""
    texts = [license_scan.lower_ascii(r.text) for r in docs.select("text").collect() if r.text]
    for text in [*texts, *FORMS]:
        whole = license_scan.folded(text)[0]
        every = {(*m.span(r.pattern.groups), r.label) for r in license_rules.RULES for m in r.pattern.finditer(whole)}
        tried = {
            (*m.span(r.pattern.groups), r.label)
            for r in license_rules.RULES
            if r.gate in whole and r.keyword in whole
            for m in r.pattern.finditer(whole)
        }
        assert every == tried


def test_license_rules_and_their_gates():
    assert len(license_rules.RULES) > 300
    cases = {
        "spdx-license-identifier: apache-2.0": "apache-2.0",
        "released under the mit license": "mit",
        "licensed under the gnu general public license, version 2": "gpl-2.0",
        "this is placed into the public domain": "public-domain",
        "cc by-nc-sa 3.0": "cc-by-nc-sa-3.0",
    }
    for text, label in cases.items():
        assert [r.label for *_, r in license_scan.detections(f"xx {text} yy")] == [label]
    for text in cases:  # the prefilter drops nothing that a rule would find
        for rule in license_rules.RULES:
            assert not rule.pattern.search(text) or (rule.gate in text and rule.keyword in text)


def test_wrapped_licences_are_found():
    """A break, with or without comment marks, or two spaces between any words of a licence's name."""
    cases = {
        "licensed under the gnu general public license, version 2": "gpl-2.0",
        "released under the apache license, version 2.0": "apache-2.0",
        "creative commons attribution 4.0": "cc-by-4.0",
        "all rights reserved": "reserved",
        "redistribution and use in source and binary forms, with or without modification": "bsd-2-clause",
    }
    for text, label in cases.items():
        for gap in ("\n", "  ", "\r\n", "\n * ", "\n# ", "\n// ", "\n  ;; ", "\n\t", "\n *\n * "):
            for k in [i for i, c in enumerate(text) if c == " "]:
                wrapped = f"x\n\n{text[:k]}{gap}{text[k + 1 :]}\ny"
                found = license_scan.detections(wrapped)
                assert [(a, b, r.label) for a, b, r in found] == [(3, len(wrapped) - 2, label)], wrapped
    header = """/*
 * Permission to use, copy, modify, and/or distribute this software for any
 * purpose with or without fee is hereby granted, provided that the above
 * copyright notice appears.
 *
 * This program is distributed under the terms of the GNU Lesser General
 * Public License, version 2.1. Some
 * parts: Mozilla Public
 * License, v. 2.0
 */""".lower()
    found = license_scan.detections(header)
    assert [r.label for *_, r in found] == ["isc", "lgpl-2.1", "mpl-2.0"]
    assert header[found[0][0] : found[0][1]].startswith("permission") and header[: found[0][1]].endswith("purpose")
    assert license_scan.folded("a b\n# c  d\n\n")[0] == "a b c d "
    assert license_scan.folded(" " * 200_000 + "\n" * 200_000)[0] == " "


def test_contained_detections_are_suppressed():
    text = "mit license " * 300 + "licensed under the mit license " * 200
    spans = [(a, b) for a, b, _ in license_scan.detections(text)]
    assert len(spans) == 500
    assert not any(a < x and y <= b or a <= x and y < b for a, b in spans for x, y in spans)


def test_secret_base_matches_plain(hard, docs):
    for frame in (hard, docs):
        got = by_id(secret_scan.scanned(frame, {}))
        for doc_id, text in sampled(frame):
            r = got[doc_id]
            assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == plain.secret_base(text)


def test_inferred_automata_know_their_format(spark):
    rng = random.Random(3)
    pick = lambda letters, n: "".join(rng.choices(letters, k=n))
    keys = ["AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16) for _ in range(300)]
    words = [pick("aeioulnrstdm", rng.randrange(6, 22)) for _ in range(1_500)]
    learned, plain_words = secret_scan.infer(keys), secret_scan.infer(words)
    assert 1 < len(learned.moves) < 300
    judge = lambda t: learned.log_likelihood(t) - plain_words.log_likelihood(t)
    assert all(judge("AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)) > secret_scan.MARGIN for _ in range(50))
    assert all(judge(pick("aeioulnrstdm", 20)) < 0 for _ in range(50))
    rows = [(k, f"see {v} and AKIA{pick('BCD', 16)} there") for k, v in enumerate(keys[:60])]
    rows += [(100 + k, " ".join(words[k * 9 : k * 9 + 9])) for k in range(100)]
    docs = spark.createDataFrame([*rows, (999, "odd one: ASIA" + pick("ABCDEFGHIJKLMNOP234567", 16))], "doc_id bigint, text string")
    got = by_id(secret_scan.scanned(docs, secret_scan.train(docs)))
    assert got[0].spans.startswith("access:4:24") and "format" in got[999].spans
    assert not any(got[100 + k].spans for k in range(100))


def test_rare_credentials_are_learned(spark):
    """A kind that only documents beyond the 20,000 smallest id hashes hold; few ordinary words."""
    docs = spark.range(20_060).select(F.col("id").alias("doc_id"), F.lit("nothing ordinary here").alias("text"))
    last = docs.orderBy(F.xxhash64("doc_id").desc()).limit(40).select("doc_id").collect()
    rng = random.Random(6)
    keys = {r.doc_id: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)) for r in last}
    rare = spark.createDataFrame([(i, f"see {k} there") for i, k in keys.items()], "doc_id bigint, text string")
    automata = secret_scan.train(docs.join(rare, "doc_id", "left_anti").unionByName(rare))
    assert {"", "access"} <= set(automata)
    assert all(zlib.crc32(w) % 64 for w in (b"nothing", b"ordinary"))
    found = secret_scan.format_spans("odd ASIA" + "BCDEFGH234567XYZ" + " one", automata, [])
    assert found == [(4, 24, "format")]


def test_ordinary_words_are_those_with_the_smallest_hashes():
    words = [f"word{k}x" for k in range(500)]
    texts = [" ".join(words[k : k + 5]) + " token=abcdefgh9" for k in range(0, 500, 5)]
    want = set(sorted(words, key=lambda w: zlib.crc32(w.encode()))[:20])
    assert secret_scan.labelled(texts, 20) == {("", w) for w in want} | {("assign", "abcdefgh9")}


def test_contamination_matches_sql_and_plain(spark, sf_dir, hard):
    ours = queries.QUERIES["op5_benchmark_decontamination"](spark, sf_dir)
    assert difference(ours, connect(sf_dir).execute(expected.CONTAMINATED)) is None
    rng = random.Random(8)
    items = [(k, " ".join(f"w{rng.randrange(900)}" for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 14, 30, 200] * 3)]
    items += [(50, None), (51, "!!"), (None, "alpha beta gamma delta epsilon zeta")]
    rows = []
    for k in range(80):
        words = [f"w{rng.randrange(900)}" for _ in range(600)]
        inside = items[k % 30][1].split()
        if k % 3:
            inside[rng.randrange(len(inside))] = "changed"
        words[300:300] = inside
        rows.append((k, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "Alpha, beta-gamma delta EPSILON zeta.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain.containment(rows, items)
    for block in (decontamination.BLOCK, 100):  # one block, and many
        assert {tuple(r) for r in decontamination.contaminated(docs, bench, block=block).collect()} == want
    left = {r.doc_id for r in decontamination.clean(docs, bench, block=100).collect()}
    assert left == {i for i, _ in rows} - {w[0] for w in want}


@pytest.mark.parametrize("which", ["edge", "empty", "clashing"])
def test_edge_cases(request, spark, labels, which):
    docs = request.getfixturevalue(which)
    n = docs.count()
    forest = quality_rules.train(docs, labels)
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven wizards")], "item_id bigint, text string")
    results = [
        quality_rules.judged(docs, forest),
        quality_classifier.scored(docs, quality_classifier.train(docs, labels)),
        license_scan.scanned(docs),
        secret_scan.scanned(docs, secret_scan.train(docs)),
        language_id.predicted(docs, language_id.train(docs)),
    ]
    assert [r.count() for r in results] == [n] * 5
    for kept in (quality_rules.keep_good(docs, forest), decontamination.clean(docs, bench)):
        assert kept.schema == docs.schema and kept.count() <= n
    if n:
        und = results[4].where("lang_pred = 'und'").select("doc_id").collect()
        assert {r.doc_id for r in und} >= {1, 2, 3, 8}
        assert {r.doc_id for r in decontamination.contaminated(docs, bench).collect()} >= {4, 5, 10}


def test_statistics_of_nothing():
    assert statistics.describe(None) == statistics.describe("")
    assert not pd.DataFrame(statistics.described(pd.Series(["", None]))).isna().any().any()
