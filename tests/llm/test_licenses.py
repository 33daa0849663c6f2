import textwrap

import pytest
from pyspark.ml.functions import vector_to_array

from tarnwork.llm import licenses as lic

SCHEMA = "doc_id long, text string"
PROSE = ["The river ran past the old mill and on to the sea.", "Version 2 of the plan was public by then, under new terms.", "He was a general of the army.", "1 2 3 4", "the the the the"]
NOTICES = {
    "MIT": "This project is published under the MIT License.",
    "Apache-2.0": "The code is licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "this program is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Photos licensed under CC BY-NC 4.0.",
    "BSD": "Released under the 3-Clause BSD License.",
    "proprietary": "All rights reserved.",
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t) for i, t in enumerate(PROSE)] + [(100 + i, "A first line.\n" + t + "\n" + PROSE[0]) for i, t in enumerate(NOTICES.values())]
    rows += [
        (200, "Licensed under the Copper Public License, version 9."), (201, None), (202, ""), (203, "word " * 20_000 + "Released under the MIT License. " + "word " * 5000),
        (204, "RELEASED UNDER THE MIT LICENSE"), (204, "RELEASED UNDER THE MIT LICENSE"), (None, "Released under the MIT License."),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA + ", paragraph int, words string, probability double")
    return lic.scan_licenses(df).collect()


def test_families(found):
    by_doc = {r.doc_id: r for r in found}
    for i, family in enumerate(NOTICES):
        r = by_doc[100 + i]
        assert (r.family, r.paragraph, r.confirmed) == (family, 1, True), family
    assert not set(range(len(PROSE))) & set(by_doc) and not {201, 202} & set(by_doc)
    assert sum(r.doc_id == 204 for r in found) == 2 and by_doc[None].family == "MIT"
    assert all(0 <= r.probability <= 1 and 0 <= r.template_share <= 1 for r in found)


def test_wrapped_notices(spark):
    header = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation{} either version {} of the License, or\n(at your option) any later version."
    texts = {
        "GPL-2.0": header.format(";", 2), "GPL-3.0": header.format(",", 3),
        "MIT": textwrap.fill(lic.SENTENCES["MIT"][0], 80), "Apache-2.0": "\n".join(" * " + x for x in textwrap.wrap(lic.SENTENCES["Apache-2.0"][1], 76)), "BSD": "Released under the 3-Clause\nBSD License.",
    }
    rows = [(i, f"{PROSE[0]}\n\n{t}\n\n{PROSE[0]}") for i, t in enumerate(texts.values())]
    found = {}
    for r in lic.scan_licenses(spark.createDataFrame([*rows, rows[0]], SCHEMA)).collect():
        found.setdefault(list(texts)[r.doc_id], []).append((r.family, r.confirmed))
    assert {k: {f for f, sure in v if sure} for k, v in found.items()} == {k: {k} for k in texts}
    assert len(found["GPL-2.0"]) == 2 * len(found["GPL-3.0"])


def test_every_template_has_a_cue(spark):
    texts = [t for _, t in lic.templates() if len(lic.words_of(t)) > 1] + ["discuss simple steps", "zu mit und", "no Isc here", "it is CC BY"]
    found = [r.cue for r in spark.createDataFrame([(t,) for t in texts], "t string").select(lic.has_cue(lic.F.col("t")).alias("cue")).collect()]
    assert found == [True] * (len(texts) - 4) + [False, False, True, True]


def families(spark, texts):
    found = lic.scan_licenses(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    return [{r.family for r in found if r.doc_id == i and r.confirmed} for i in range(len(texts))], [{r.family for r in found if r.doc_id == i} for i in range(len(texts))]


def test_versions_and_wide_wraps(spark):
    mit = lic.SENTENCES["MIT"][0]
    texts = [
        "You should have received a copy of the GNU General Public License along with this program.", "Licensed under the GNU GPLv3.", lic.SENTENCES["MIT"][3], lic.SENTENCES["Unlicense"][0],
        PROSE[0] + "\n" + textwrap.fill(mit, 14) + "\n\n" + PROSE[0], textwrap.fill(mit, 20), "# " + "\n# ".join(textwrap.wrap(lic.SENTENCES["GPL-2.0"][0], 12)),
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later", textwrap.fill(lic.SENTENCES["BSD"][2], 30) + "\n" + textwrap.fill(lic.SENTENCES["BSD"][3], 30),
    ]
    sure, said = families(spark, texts)
    assert sure[0] <= {"unknown"} and not {"GPL-2.0", "GPL-3.0"} & said[0]
    assert sure[1:] == [{"GPL-3.0"}, {"MIT"}, {"Unlicense"}, {"MIT"}, {"MIT"}, {"GPL-2.0"}, {"GPL-2.0"}, {"GPL-3.0"}, {"BSD"}]


def test_whole_texts_and_licences_it_does_not_know(spark):
    known = {f: "\n\n".join(textwrap.fill(x, 72) for x in lic.SENTENCES[f]) for f in ("MIT", "BSD", "Apache-2.0", "ISC", "Zlib", "Unlicense")}
    others = ["Licensed under the Artistic License 2.0.", "Released under the European Union Public Licence v1.2.", "This work is licensed under the PostgreSQL License."]
    sure, said = families(spark, [*known.values(), *others])
    assert sure[: len(known)] == [{f} for f in known]
    assert all(not x for x in sure[len(known) :])


def test_runs_against_all_pairs_of_lines(spark):
    """Runs of lines, found by plain search: the shortest that hold enough of some template."""
    header = textwrap.fill(lic.SENTENCES["Apache-2.0"][2], 40).split("\n")
    texts = ["\n".join(["first of all", *header, "and so on"]), "\n".join(["***", header[0], "", *header[1:]]), "the mit und die\nmit von der"]
    rows = lic.wrapped(spark.createDataFrame(list(enumerate(texts)), SCHEMA), "doc_id", "text", 0.6).collect()
    for r in rows:
        lines = texts[r.doc_id].split("\n")[r.paragraph : r["last"] + 1]
        assert all(x.strip("* ") for x in lines) and lic.words_of(r.text) == lic.words_of(" ".join(lines))
        own = set(lic.pairs_of(lic.words_of(r.text)))
        assert max(len(own & set(lic.pairs_of(lic.words_of(t)))) / len(lic.pairs_of(lic.words_of(t))) for _, t in lic.templates()) >= 0.6
    spans = {(r.doc_id, r.paragraph, r["last"]) for r in rows}
    assert (0, 1, len(header)) in spans and not any(i == 2 for i, *_ in spans)


def test_an_unknown_licence_is_unknown(found):
    rows = [r for r in found if r.doc_id == 200]
    assert [(r.family, r.confirmed) for r in rows] == [("unknown", False)]


def test_long_lines_are_read_to_their_end(found):
    rows = [r for r in found if r.doc_id == 203]
    assert {r.family for r in rows if r.confirmed} == {"MIT"} and all(r.start <= 100_000 <= r.start + 832 for r in rows)


def test_pieces_cover_the_text(frame):
    text = "ab\n\n" + "é" * 2000 + "\n" + "c" * 800 + "\nz"
    rows = lic.paragraphs(frame([(1, text)], SCHEMA), "doc_id", "text").collect()
    lines = text.split("\n")
    for r in rows:
        assert lines[r.paragraph][r.start : r.start + 800] == r.text
    for i, line in enumerate(lines):
        assert len({k for r in rows if r.paragraph == i for k in range(r.start, r.start + len(r.text))}) == len(line)


def test_temperature_cools_or_heats():
    sure = [([4.0, 0.0], 0)] * 9 + [([4.0, 0.0], 1)]
    assert lic.temperature(sure) == pytest.approx(4 / 2.197, rel=0.1) and lic.temperature([]) == 1.0


def test_empty_table(frame):
    assert lic.scan_licenses(frame([], SCHEMA)).collect() == []


def test_all_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    wanted = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    wanted |= {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "proprietary"}
    lines = {(r.doc_id, i): wanted[x] for r in documents for i, x in enumerate((r.text or "").split("\n")) if x in wanted}
    found = {(r.doc_id, r.paragraph): r.family for r in lic.op4_license_scan(spark, sf_dir).collect()}
    assert lines and {k: found.get(k) for k in lines} == lines
    assert len(found) <= len(lines) + 2


def test_a_filter_on_features_cuts_the_words_once(frame):
    scored = lic.featured(frame([("Licensed under the MIT License.",)], "text string")).where(vector_to_array("features")[0] >= 0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert [r.words for r in scored.collect()] == [["licensed", "under", "the", "mit", "license"]]
