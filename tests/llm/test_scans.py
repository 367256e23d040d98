"""Secret and license scans: candidates and rules by brute force, forest on held-out findings."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses as L
from tessera.llm import secrets as S
from tessera.plans import inspect as pi

KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


@pytest.fixture(scope="module")
def words(spark):
    return S.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def labelled(spark, words):
    return S.seed_findings(spark, words, 3000)


@pytest.fixture(scope="module")
def model(labelled, words):
    return S.train(labelled.filter(F.xxhash64("candidate") % 3 != 0), words)


def test_candidates_match_brute_force(spark, documents):
    texts = [(1, f'token = "{KEY}" and {KEY}\n{"x" * 15} {"y" * 16}.'), (2, KEY), (3, f"é{KEY}é{'-' * 20}"), (4, "a/b=c+d_e-f" * 3 + "!" + "k" * 40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'p' AS source", "1 AS candidate", "2 AS start")
    want = set()
    for i, t in texts:   # the text before and after a candidate reaches to the neighbouring ones
        hits = [m.span() for m in re.finditer(r"[A-Za-z0-9+/=_\-]{16,}", t)]
        for (a, b), last, following in zip(hits, [0] + [e for _, e in hits], [s for s, _ in hits[1:]] + [len(t)]):
            want.add((i, a, t[a:b], t[last:a][-S.CONTEXT:], t[b:following][:S.CONTEXT]))
    rows = S.candidates(frame, path_col="source").collect()
    assert {(r.id, r.start, r.candidate, r.before, r.after) for r in rows} == want and {r.path for r in rows} == {"p"}


def test_features_of_one_candidate(spark, words):
    found = spark.createDataFrame([(1, "docs/a/test.py", 0, "horseABCD12345678", 'password = "', '" next')],
                                  "id long, path string, start long, candidate string, before string, after string")
    odds = S.transition_odds(spark.createDataFrame([("horse", 0), ("12345", 1)], "candidate string, label int"))
    dictionary = spark.createDataFrame([("horse",), ("horses",), ("abcd",)], "word string")
    r = S.features(found, odds, dictionary).first()
    assert (r.n_chars, r.digits, r.upper, r.lower) == (17, 8 / 17, 4 / 17, 5 / 17)
    assert r.covered == pytest.approx(9 / 17) and r.changes == 2 / 16
    assert (r.depth, r.tests, r.assigned, r.quoted, r.word_before, r.word_after) == (3, 1, 1, 1, "password", "next")


def test_forest_on_held_out_findings(labelled, model):
    rows = model.forest.transform(S._vectors(S.features(labelled.filter(F.xxhash64("candidate") % 3 == 0), model.odds, model.dictionary)))
    right = rows.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.95


def test_findings_redaction_and_edge_cases(spark, documents, empty, model):
    texts = [(1, f'say token = "{KEY}" twice {KEY}.'), (1, f'password: "{KEY[::-1]}" ok'), (2, "commit " + KEY), (3, None), (4, ""),
             (5, "unquestionableness internationalization 1234567890123456"), (None, f'secret="{KEY}" x')]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr(
        "*", "'a/b' AS source", "length(text) AS n_chars", "'z' AS candidate", "0 AS start", "1 AS label", "2 AS features")
    got = {(r.doc_id, r.candidate): r.secret for r in model.findings(frame, path_col="source").collect()}
    assert got[1, KEY] == 1 and got[1, KEY[::-1]] == 1 and got[None, KEY] == 1
    assert not any(v for (i, _), v in got.items() if i == 5)
    out = S.redacted(frame, model, path_col="source", length_col="n_chars")
    rows = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    first = f'say token = "{S.MASK}" twice {S.MASK}.'
    assert out.columns == frame.columns and out.count() == len(texts)
    assert (1, first, len(first)) in rows and (1, f'password: "{S.MASK}" ok', len(S.MASK) + 15) in rows
    assert {t for t in rows if t[0] in (3, 4, 5)} == {(i, t, None if t is None else len(t)) for i, t in texts if i in (3, 4, 5)}
    assert model.findings(empty).count() == 0 and S.redacted(documents, model).count() == documents.count()
    assert not pi.runs_python(out)


def test_headers_spdx_tags_and_more_licenses(spark):
    long_text = {i: s.capitalize() for s, i in L.SENTENCES.items()}
    header = "Copyright (c) 1999, The Owners. All rights reserved.\n\n"

    def of(*ids):
        return ".\n".join(long_text[i] for i in ids) + "."
    texts = {
        header + of("BSDgrant", "BSDsource", "BSDbinary", "BSDasis"): "BSD-2-Clause",
        header + of("BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDasis"): "BSD-3-Clause",
        header + of("MITgrant", "MITkeep", "MITasis", "MITliable"): "MIT",
        header + of("Apache2ref", "Apache2use"): "Apache-2.0",
        header + of("ISCgrant"): "ISC",
        of("Unlicense"): "Unlicense", of("BSL1ref"): "BSL-1.0", of("EPL2ref"): "EPL-2.0", of("Zlibasis", "Zlibgrant"): "Zlib", of("CC0ref"): "CC0-1.0",
        "Copyright 2001 Nobody. All rights reserved.\nDo not copy": "Proprietary",
        **{f"// SPDX-License-Identifier: {i}\nint main;": i for i in L.SPDX},
        "# SPDX-License-Identifier: MIT": "MIT", "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan(frame).collect()}
    assert got == dict(enumerate(texts.values()))


def brute_licenses(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ids = []
    for line in re.sub(r"([.!?;])[ \t\r\n]+", r"\1\n", lower).split("\n"):
        s = re.sub("[^a-z0-9]+", " ", line).strip().replace("licence", "license")
        s = re.sub(r"\bv ?([0-9])", r"version \1", s)
        s = "copyright notice" if re.match("copyright( c)? [0-9]{4}", s) else s
        if s in L.SENTENCES:
            ids.append(L.SENTENCES[s])
    rest, hits = "".join(f"<{i}>" for i in ids), []
    for mark, name in L._steps(L.RULES):
        if mark in rest:
            hits += [name] if name and name not in hits else []
            rest = rest.replace(mark, "|")
    return (",".join(hits), ",".join(ids), " ".join(re.findall(r"\w+", rest)), len(ids)) if ids else None


def test_licenses_match_brute_force(spark, documents, empty):
    long_text = {i: s for s, i in L.SENTENCES.items()}
    mit = ". ".join(long_text[i].capitalize() for i in ("MITgrant", "MITkeep", "MITasis"))
    texts = [(1, f"Copyright (c) 2020 A. B.\n{mit}. All rights reserved."), (2, "Licensed under the Apache Licence, v2.0."),
             (3, "Released under the MIT License. x. Released under the MIT License! All rights reserved"), (4, None), (5, "no license here"),
             (6, "// " + long_text["Apache2ref"] + "; " + long_text["GPLsee"] + "\n * " + long_text["Apache2use"]), (7, "word " * 50_000 + "\nLICENSED UNDER CC BY-NC 4.0")]
    frame = spark.createDataFrame(texts + [texts[1]], "doc_id long, text string").selectExpr("*", "'x' AS ids", "1 AS rest", "2 AS hits", "3 AS id")
    got = sorted((r.doc_id, r.licenses, r.sentence_ids, r.unmatched, r.n_sentences) for r in L.scan(frame).collect())
    want = [(i, *b) for i, t in texts + [texts[1]] if (b := brute_licenses(t))]
    assert got == sorted(want) and [g[1] for g in got] == ["MIT", "Apache-2.0", "Apache-2.0", "MIT", "Apache-2.0", "CC-BY-NC-4.0"]
    assert L.scan(documents).count() == 0 and L.scan(empty).count() == 0
    plan = pi.physical_plan(L.scan(frame))
    assert "Exchange" not in plan and not pi.runs_python(L.scan(frame))


def test_every_known_sentence_has_an_anchor():
    assert all(re.search(L.ANCHOR, s) for s in L.SENTENCES if s != "copyright notice")
    assert {i for sequence, _ in L.RULES for i in sequence} <= set(L.SENTENCES.values())


MIT_TEXT = """MIT License

Copyright (c) 2020 Ann Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

(1) Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer.
(2) Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation
    and/or other materials provided with the distribution."""
GPL2_TEXT = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
LGPL3_TEXT = """This library is free software: you can redistribute it and/or modify it
under the terms of the GNU Lesser General Public License as published by the
Free Software Foundation, either version 3 of the License, or (at your option)
any later version."""
MPL_TEXT = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_wrapped_licenses(spark):
    def marked(text, mark):
        return "\n".join((mark + line).rstrip() for line in text.split("\n"))

    mit, apache = "Copyright,MITgrant,MITkeep,MITasis,MITliable", "Apache2ref,Apache2use,Apache2copy,Apache2see"
    gpl = "GNUfree,GPLterms,GNU2later,GPLhope,GPLeven,GPLsee"
    cases = [(MIT_TEXT, "MIT", mit), (MIT_TEXT.replace("\n", "\r\n"), "MIT", mit), (marked(MIT_TEXT, ";; "), "MIT", mit),
             ("/*\n" + marked(MIT_TEXT, " * ") + "\n */\nint x;", "MIT", mit),
             (marked(APACHE_TEXT, "# "), "Apache-2.0", apache), (marked(APACHE_TEXT, "rem "), "Apache-2.0", apache),
             (marked(BSD_TEXT, "// "), "BSD-2-Clause", "BSDgrant,BSDsource,BSDbinary"),
             (marked(GPL2_TEXT, "dnl "), "GPL-2.0-or-later", gpl), (LGPL3_TEXT, "LGPL-3.0-or-later", "LGPL3later"),
             (LGPL3_TEXT.replace("Lesser", "Affero").replace("library", "program"), "AGPL-3.0-or-later", "AGPL3later"),
             (MPL_TEXT, "MPL-2.0", "MPL2ref,MPL2copy"),
             # a blank line, or a line of marks, ends a sentence
             ("Licensed under the\n\nMIT License. All rights reserved", "Proprietary", "AllRights"),
             ("# Licensed under the\n#\n# MIT License. All rights reserved", "Proprietary", "AllRights"),
             ("Licensed under the Apache\nLicense, v\n2.0", "Apache-2.0", "Apache2ref")]
    frame = spark.createDataFrame([(n, t) for n, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.sentence_ids, r.unmatched) for r in L.scan(frame).collect()}
    assert got == {n: (told, ids, "") for n, (_, told, ids) in enumerate(cases)}


def test_sentences_given_need_no_known_anchor(spark):
    frame = spark.createDataFrame([(1, "Do what\nyou like. v2"), (2, "nothing")], "doc_id long, text string")
    got = L.scan(frame, sentences={"do what you like": "Like", "version 2": "Two"}, rules=[(("Like",), "WTF")]).collect()
    assert [(r.doc_id, r.licenses, r.sentence_ids) for r in got] == [(1, "WTF", "Like,Two")]


def test_assigned_secrets_are_candidates_and_found(spark, model):
    cases = [('password = "Summer2024!"', "Summer2024!", "password = \""), ("db_password: hunter2hunter2", "hunter2hunter2", "db_password: "),
             (f"export API_KEY={KEY}", KEY, "export API_KEY="), (f"export COUNT_OF_ROWS={KEY}", KEY, "export COUNT_OF_ROWS="),
             ("pwd = 'Horse7!'", "Horse7!", "pwd = '"), ("auth_token=QWxhZGRpbjpvcGVuMTIzNA==", "QWxhZGRpbjpvcGVuMTIzNA==", "auth_token="),
             ("say QWxhZGRpbjpvcGVuMTIzNA== now", "QWxhZGRpbjpvcGVuMTIzNA==", "say ")]
    frame = spark.createDataFrame([(n, t) for n, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.id: (r.candidate, r.before) for r in S.candidates(frame).collect()}
    assert got == {n: c[1:] for n, c in enumerate(cases)}
    judged = {r.doc_id: r.secret for r in model.findings(frame).collect()}
    assert [judged[n] for n in (0, 1, 2)] == [1, 1, 1]
    plain = spark.createDataFrame([(0, 'password: "changeme"'), (1, "the secret: remember the milk"), (2, "short password: abc")], "doc_id long, text string")
    assert not any(r.secret for r in model.findings(plain).collect())
    out = {r.text for r in S.redacted(frame.filter("doc_id < 3"), model).collect()}
    assert out == {f'password = "{S.MASK}"', f"db_password: {S.MASK}", f"export API_KEY={S.MASK}"}


def test_rows_without_an_id_are_redacted_alone(spark, model):
    rows = [(None, f'token = "{KEY}"'), (None, f"commit {KEY} done"), (4, f'token = "{KEY}"'), (4, f"commit {KEY} done")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.candidate, r.secret) for r in model.findings(frame).collect()}
    assert found == {(KEY, 1), (KEY, 0)}
    got = sorted(((r.doc_id, r.text) for r in S.redacted(frame, model).collect()), key=str)
    assert got == sorted([(i, t.replace(KEY, S.MASK) if "token" in t else t) for i, t in rows], key=str)
