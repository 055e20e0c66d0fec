from __future__ import annotations

import math
import re
import textwrap

import pytest
from edge_rows import docs, empty

from ordwise.llm import license_scan as ls
from ordwise.llm import queries
from ordwise.llm.license_texts import NONE, TEMPLATES, UNKNOWN


def scan(spark, texts):
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    return {r.doc_id: r for r in ls.scan(docs(spark, rows)).collect()}


def test_labelled_paragraphs_and_unseen_wordings(spark):
    flat = [(c, t) for c, ts in TEMPLATES.items() for t in ts]
    got = scan(spark, [t for _, t in flat])
    assert sum(got[i].family == c for i, (c, _) in enumerate(flat)) >= 0.95 * len(flat)
    assert all(got[i].findings[0].confirmed for i, (c, _) in enumerate(flat) if got[i].family == c)
    unseen = [("apache-2.0", "This file is licensed under the Apache License, Version 2.0, see LICENSE."),
              ("mit", "The code is available under the MIT License."),
              ("gpl-3.0", "This software is licensed under the GNU General Public License version 3 or later."),
              ("cc-by-nc", "All photographs are licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
              ("proprietary", "Copyright 1999 Some Publisher. All rights reserved.")]
    got = scan(spark, [t for _, t in unseen])
    assert [got[i].family for i in range(len(unseen))] == [c for c, _ in unseen]


def test_unknown_and_ordinary_text(spark):
    got = scan(spark, UNKNOWN + NONE + ["The licence of the old pub was sold.", "Licensed under the terms of a private agreement."])
    assert all(got[i].family in ("unknown", None) for i in range(len(UNKNOWN)))
    assert all(got[len(UNKNOWN) + i].family in (None, "unknown") for i in range(len(NONE) + 1))
    assert not any(f.confirmed for r in got.values() for f in r.findings)


PROBES = ["MIT-Lizenz", "Alle Rechte vorbehalten", "Tous droits réservés", "Todos los derechos reservados", "under the MIT/X11 terms",
          'THE SOFTWARE IS PROVIDED "AS IS"', "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR DAMAGES", "Neither the name of the University",
          "You may copy this text for your own use if you keep this notice."]


def test_paragraphs_without_usual_licence_words_are_found(spark):
    got = scan(spark, PROBES + ["So it goes.\n" + p + "\nNothing more." for p in PROBES])
    families = [*["mit"], *["proprietary"] * 3, *["mit"] * 3, "bsd", "unknown"]
    assert [got[i].family for i in range(len(PROBES))] == families
    assert [got[len(PROBES) + i].family for i in range(len(PROBES))] == families
    assert all([f.paragraph for f in got[len(PROBES) + i].findings] == [2] for i in range(len(PROBES)))


def test_wrapped_notice_is_found_as_a_block(spark):
    text = "Intro.\n\n" + "\n".join(textwrap.wrap(TEMPLATES["mit"][1], 60)) + "\n \nSo it goes.\nOn and on."
    row = scan(spark, [text])[0]
    assert row.family == "mit" and [(f.block, f.family, f.confirmed) for f in row.block_findings] == [(2, "mit", True)]


def by_hand(paragraph, model):
    """The class of a paragraph, scored without any gate: plain Python over the model's weights."""
    words = re.findall(r"[^\W_]+(?:\.[0-9]+)*", paragraph.lower())
    grams = dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    z = list(model.bias)
    for g in grams:
        for c, w in enumerate(model.weights.get(g, [])):
            z[c] += w / math.sqrt(len(grams))
    f = len(ls.FAMILIES)
    at = max(range(f), key=lambda c: (z[c], -c))
    if z[-1] > max(z[at], z[-2]):
        return "none"
    odds = -math.log(sum(math.exp(v - z[at]) for c, v in enumerate(z) if c != at))
    return ls.FAMILIES[at] if 1 / (1 + math.exp(-(model.a * odds + model.b))) >= 0.5 else "unknown"


def test_scan_equals_brute_force_over_every_paragraph(spark, sf):
    """Every line and block of the table, scored without the signs, gives the same findings."""
    model = ls.fit(spark)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labelled = [t for ts in TEMPLATES.values() for t in ts] + UNKNOWN + NONE
    texts += ["\n".join(labelled), "\n\n".join("\n".join(textwrap.wrap(t, 50)) for t in labelled), "2.0mit x2mit\n2.0beta 1.2.0\nLICENSE", ""]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        lines = [(k, c) for k, p in enumerate(t.split("\n"), 1) if t and (c := by_hand(p, model)) != "none"]
        blocks = [(k, c) for k, b in enumerate(re.split(r"\n(?:[ \t\r]*\n)+", t), 1)
                  if "\n" in b.strip("\n") and (c := by_hand(b, model)) != "none"]
        assert [(f.paragraph, f.family) for f in got[i].findings] == lines
        assert [(f.block, f.family) for f in got[i].block_findings] == blocks


def test_no_paragraph_without_a_sign_can_win(spark):
    """Adversarial: the best n-grams that avoid the signs, in every number, still score ``none``."""
    model = ls.fit(spark)
    free = [w for g, w in model.weights.items() if not set(g.split(" ")) & set(model.signs)]
    for c in range(len(ls.CLASSES) - 1):
        total = 0.0
        for m, d in enumerate(sorted((w[c] - w[-1] for w in free), reverse=True), 1):
            total += max(d, 0)
            assert model.bias[c] - model.bias[-1] + total / math.sqrt(m) < 0
        assert model.bias[c] < model.bias[-1]


def test_common_beginnings_are_written_once():
    """The pattern matches its words and nothing else, and no place tries two alternatives with one letter."""
    words = {"licence", "license", "licensed", "mit", "rights", "réservés", "v1.0", "v2.0", "a", "all"}
    pattern = ls.either(words)
    assert ls.either({"license", "licensed"}) == "license(?:d)?" and ls.either({"apache", "appear"}) == "ap(?:ache|pear)"
    tried = words | {w[:i] for w in words for i in range(len(w))} | {w + x for w in words for x in "ds0."} | {"v1x0", "it", "ll"}
    assert {t for t in tried if re.fullmatch(pattern, t)} == words


def test_text_is_searched_for_signs_once(spark):
    """One search over the whole text serves lines and blocks; lines and blocks then have one each."""
    pattern = ls.sign_pattern(ls.fit(spark))
    plan = ls.scan(docs(spark, [(1, "All rights reserved.", "en", "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(pattern) == 3


def test_edge_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "a\nReleased under the MIT License.\n\nAll rights reserved.", "en", "a"),
            (3, "a\nReleased under the MIT License.\n\nAll rights reserved.", "en", "a"), (None, "Licensed under CC BY-NC 4.0.", "en", "a"),
            (4, "word " * 50000 + "\nLicensed under the Apache License, Version 2.0.", "en", "a"), (5, "\n\n", "en", "a")]
    got = ls.scan(docs(spark, rows)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert (by[1].n_paragraphs, by[1].findings, by[1].family) == (0, [], None) and by[2].n_paragraphs == 0 and by[5].n_paragraphs == 3
    assert [(f.paragraph, f.family, f.confirmed) for f in by[3].findings] == [(2, "mit", True), (4, "proprietary", True)]
    assert by[None].family == "cc-by-nc" and by[4].family == "apache-2.0" and by[4].findings[0].paragraph == 2
    assert ls.scan(empty(spark)).collect() == []


def test_documents_match_their_licence_lines(spark, sf):
    """The table's licence lines are whole lines; every one is found, and no other line is."""
    lines = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
             "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    got = {r.doc_id: r for r in queries.op1_license_scan(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want = [(k, lines[x]) for k, x in enumerate(r.text.split("\n"), 1) if x in lines]
        assert [(f.paragraph, f.family) for f in got[r.doc_id].findings if f.confirmed] == want
        assert got[r.doc_id].n_paragraphs == len(r.text.split("\n"))
        assert want or not re.search("licen[cs]ed under|all rights reserved", r.text, re.I)


def test_scan_runs_without_python(spark, sf):
    plan = queries.op1_license_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("name", ["op1_license_scan", "op6_source_mixing"])
def test_native_queries_have_no_python_nodes(spark, sf, name):
    plan = queries.registered()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
