"""License scan: known license sentences, then ordered rules over their identifiers.

A text is normalised: ASCII lower case, everything but letters and digits as one space, "licence"
as "license", "v2" as "version 2", comment marks and list numbers at the start of lines left out.
Sentences end at blank lines (also ones of marks only) and after ``. ! ? ;`` with white space
behind.  A line end may end a sentence, or stand inside a wrapped one as a space: a known sentence
is found wherever it begins and stops at sentence or line ends, the longest first.  A copyright line
is "copyright notice".  The identifiers found, in the order of the text, form a sequence;
the rules are tried in their order, and each takes all places where its identifiers stand next
to one another out of the sequence.  What no rule takes is reported as unmatched.  "All rights reserved" beside
sentences that a license rule took is the header of that license; only elsewhere does it tell a proprietary text.

The whole scan is one projection per document, without a shuffle, join or Python.

Defined cases: a null or empty text, or one without a known sentence, gives no row; repeated
rows each give a row; a sentence that occurs twice counts twice in the sequence and once in
``licenses``; of rules that could take the same place the first does; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licenses, normalised, and their identifiers.
SENTENCES = {
    "copyright notice": "Copyright",
    "all rights reserved": "AllRights",
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITkeep",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITasis",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2use",
    "you may obtain a copy of the license at": "Apache2copy",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2see",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "licensed under the gnu lesser general public license version 3": "LGPL3ref",
    "licensed under the gnu affero general public license version 3": "AGPL3ref",
    "see the gnu general public license for more details": "GPLsee",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPLhope",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDname",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "spdx license identifier mit": "MITref",
    "spdx license identifier apache 2 0": "Apache2ref",
    "spdx license identifier gpl 3 0 only": "GPL3ref",
    "spdx license identifier gpl 2 0 only": "GPL2ref",
    "spdx license identifier mpl 2 0": "MPL2ref",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliable",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "Apache2copy",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDasis",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GPLeven",
    "see the gnu lesser general public license for more details": "LGPLsee",
    "see the gnu affero general public license for more details": "AGPLsee",
    # "v. 2.0" ends a sentence behind the v
    "this source code form is subject to the terms of the mozilla public license v": "MPL2ref",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "MPL2ref",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "MPL2copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "MPL2copy",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GPL2only",
    "either version 2 of the license or at your option any later version": "GNU2later",
    "either version 2 1 of the license or at your option any later version": "GNU2.1later",
    "either version 3 of the license or at your option any later version": "GNU3later",
}
# Identifiers of the SPDX list that a tag line may name, besides those above.
SPDX = ["GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
        "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "Unlicense",
        "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Artistic-2.0", "WTFPL", "MIT-0", "Python-2.0", "PostgreSQL"]
for _id in SPDX:
    SENTENCES["spdx license identifier " + "".join(c if c.isalnum() else " " for c in _id.lower())] = f"SPDX:{_id}"
# Sentences of more public licenses, normalised.
SENTENCES |= {
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "distributed under the boost software license version 1 0": "BSL1ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0": "EPL2ref",
    "this software is provided as is without any express or implied warranty": "Zlibasis",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "Zlibgrant",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CCBYNC4ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0BSDgrant",
    "licensed under the gnu lesser general public license version 2 1": "LGPL2.1ref",
    "use of this source code is governed by a bsd style license that can be found in the license file": "BSDref",
}
_GNU = {"GPL": "general", "LGPL": "lesser general", "AGPL": "affero general"}
for _thing in ("program", "library", "software"):
    SENTENCES[f"this {_thing} is free software"] = "GNUfree"
    SENTENCES[f"this {_thing} is distributed in the hope that it will be useful but without any warranty"] = "GPLhope"
for _short, _long in _GNU.items():
    _terms = f"you can redistribute it and or modify it under the terms of the gnu {_long} public license as published by the free software foundation"
    SENTENCES[_terms] = f"{_short}terms"       # the older notice, cut at its semicolons
    for _thing in ("program", "library", "software"):   # the newer one is one sentence
        SENTENCES[f"this {_thing} is free software {_terms} either version 3 of the license or at your option any later version"] = f"{_short}3later"


def _gnu_rules() -> list[tuple[tuple[str, ...], str]]:
    """The standard notices, with and without the words on warranty behind them."""
    rules = []
    for short, versions in (("GPL", ("2", "3")), ("LGPL", ("2.1", "3")), ("AGPL", ("3",))):
        heads = [((f"{short}3later",), f"{short}-3.0-or-later")]
        if short == "GPL":
            heads += [(("GNUfree", "GPL2only"), "GPL-2.0"), (("GPL2only",), "GPL-2.0")]
        for version in versions:
            told = f"{short}-{version if '.' in version else version + '.0'}-or-later"
            heads += [(("GNUfree", f"{short}terms", f"GNU{version}later"), told), ((f"{short}terms", f"GNU{version}later"), told)]
        rules += [((*head, *tail), told) for head, told in heads for tail in (("GPLhope", "GPLeven", f"{short}see"), ())]
    return rules


#: Ordered rules: identifiers that stand next to one another, and the license they tell.
RULES = [
    (("Copyright", "MITgrant", "MITkeep", "MITasis", "MITliable"), "MIT"),
    (("MITgrant", "MITkeep", "MITasis", "MITliable"), "MIT"),
    (("Copyright", "MITgrant", "MITkeep", "MITasis"), "MIT"),
    (("MITgrant", "MITkeep", "MITasis"), "MIT"),
    (("MITgrant", "MITkeep"), "MIT"),
    (("BSDgrant", "BSDsource", "BSDbinary", "BSDname", "BSDasis"), "BSD-3-Clause"),
    (("BSDgrant", "BSDsource", "BSDbinary", "BSDasis"), "BSD-2-Clause"),
    (("BSDgrant", "BSDsource", "BSDbinary", "BSDname"), "BSD-3-Clause"),
    (("BSDgrant", "BSDsource", "BSDbinary"), "BSD-2-Clause"),
    (("Apache2ref", "Apache2use", "Apache2copy", "Apache2see"), "Apache-2.0"),
    (("Apache2ref", "Apache2use"), "Apache-2.0"),
    (("GPL3ref", "GPLhope", "GPLeven", "GPLsee"), "GPL-3.0"),
    (("GPL3ref", "GPLhope", "GPLsee"), "GPL-3.0"),
    *_gnu_rules(),
    (("MPL2ref", "MPL2copy"), "MPL-2.0"),
    (("MPL2ref",), "MPL-2.0"),
    (("MPL2copy",), "MPL-2.0"),
    (("ISCgrant",), "ISC"),
    (("Zlibasis", "Zlibgrant"), "Zlib"),
    (("Zlibgrant",), "Zlib"),
    (("Unlicense",), "Unlicense"),
    (("BSL1ref",), "BSL-1.0"),
    (("EPL2ref",), "EPL-2.0"),
    (("CC0ref",), "CC0-1.0"),
    (("0BSDgrant",), "0BSD"),
    (("LGPL2.1ref",), "LGPL-2.1"),
    (("BSDref",), "BSD"),
    *[((f"SPDX:{i}",), i) for i in SPDX],
    (("MITref",), "MIT"),
    (("Apache2ref",), "Apache-2.0"),
    (("GPL3ref",), "GPL-3.0"),
    (("GPL2ref",), "GPL-2.0"),
    (("LGPL3ref",), "LGPL-3.0"),
    (("AGPL3ref",), "AGPL-3.0"),
    (("CCBYNC4ref",), "CC-BY-NC-4.0"),
    (("CCBYSA4ref",), "CC-BY-SA-4.0"),
    (("CCBY4ref",), "CC-BY-4.0"),
    (("Copyright", "AllRights"), "Proprietary"),
    (("AllRights",), "Proprietary"),
]

#: What is a license's header where it stands beside sentences that a rule took.
HEADERS = [("Copyright", "AllRights"), ("AllRights",)]


def _steps(rules: list[tuple[tuple[str, ...], str]]) -> list[tuple[str, str]]:
    """(mark, license) in order; headers go, without a license, before the first rule that takes a header by itself."""
    def mark(sequence):
        return "".join(f"<{s}>" for s in sequence)

    own = next((k for k, (sequence, _) in enumerate(rules) if sequence in HEADERS), len(rules))
    beside = [(m, "") for h in HEADERS for m in (mark(h) + "|", "|" + mark(h))]
    return [*((mark(q), told) for q, told in rules[:own]), *beside, *((mark(q), told) for q, told in rules[own:])]


NOTICE = "copyright notice"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def anchor(sentences) -> str:
    """A pattern that the lower-case text of each sentence has: few words, long ones where there are any."""
    left, words = [set(s.split()) for s in sentences], []
    while left:
        # "version" may stand as "v" in a text
        usable = [{w for w in s if w != "version" and w.isalpha()} for s in left]
        if not all(usable):
            return ""
        usable = [{w for w in s if len(w) > 6} or {max(sorted(s), key=len)} for s in usable]
        best = max(sorted(set().union(*usable)), key=lambda w: (sum(w in s for s in usable), len(w)))
        words.append(best)
        left = [s for s in left if best not in s]
    return "|".join(w.replace("license", "licen[cs]e") for w in words)


#: Every known sentence has one of these; texts without any are not normalised.
ANCHOR = anchor(SENTENCES)


def normalised(lower):
    """Normal form of a whole text in ASCII lower case: a line end for a line end, ``|`` for a sentence end."""
    # comment marks that are words or would end a sentence, and list numbers
    s = F.regexp_replace(F.concat(F.lit("\n\n"), lower, F.lit("\n\n")),
                         r"\n[ \t]*+(?:;++|!++|rem|dnl)[ \t]++", "\n")
    s = F.regexp_replace(s, r"(\n[^a-z0-9\n(]{0,8})\(?(?:[0-9]{1,2}|[abd])\)[ \t]+", "$1")
    s = F.regexp_replace(F.regexp_replace(s, "([.!?;])[ \t\r\n]+", "$1\n\n"), "[^a-z0-9\n]+", " ")
    s = F.regexp_replace(F.regexp_replace(s, " ?\n ?", "\n"), "\n\n+", "|")
    s = F.regexp_replace(F.regexp_replace(s, "licence", "license"), r"\bv(?=[0-9])", "version ")
    return F.regexp_replace(s, r"\bv(?=[ \n][0-9])", "version")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None,
         rules: list[tuple[tuple[str, ...], str]] | None = None) -> DataFrame:
    """(id, licenses, sentence_ids, unmatched, n_sentences) of every text with a known sentence.

    ``licenses`` are in the order of the rules, ``sentence_ids`` in the order of the text.
    """
    sentences, rules = sentences or SENTENCES, RULES if rules is None else rules
    known = F.map_from_arrays(F.array(*map(F.lit, sentences)), F.array(*map(F.lit, sentences.values())))
    lower = docs.select(F.col(id_col).alias("id"), F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER).alias("text"))
    forms = [s.replace(" ", "[ \n]") for s in sorted(sentences, key=lambda s: (-len(s), s))]
    year = "copyright(?:[ \n]c)?[ \n][0-9]{4}"
    if NOTICE in sentences:
        forms.insert(0, year + "[^\n|]*")
    found = (lower.filter(F.col("text").rlike(anchor(sentences)))
             .select("id", F.regexp_extract_all(normalised(F.col("text")), F.lit(f"(?<=[\n|])(?:{'|'.join(forms)})(?=[\n|])"), F.lit(0)).alias("hits"))
             .select("id", F.array_compact(F.transform("hits", lambda s: F.try_element_at(known, F.when(
                 s.rlike("^" + year) & F.lit(NOTICE in sentences), F.lit(NOTICE)).otherwise(F.replace(s, F.lit("\n"), F.lit(" ")))))).alias("ids"))
             .filter(F.size("ids") > 0)
             .select("id", "ids", F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">")).alias("rest")))
    # a place that a rule has taken stays marked, so that no later rule reaches across it
    steps = F.array(*[F.struct(F.lit(mark).alias("mark"), F.lit(told).alias("told")) for mark, told in _steps(rules)])
    first = F.struct(F.col("rest"), F.array().cast("array<string>").alias("hits"))
    found = found.select("id", "ids", F.aggregate(steps, first, lambda acc, r: F.when(
        F.contains(acc["rest"], r["mark"]), F.struct(F.replace(acc["rest"], r["mark"], F.lit("|")).alias("rest"),
                                                     F.when(r["told"] == "", acc["hits"]).otherwise(F.array_append(acc["hits"], r["told"])).alias("hits"))
        ).otherwise(acc)).alias("z"))
    found = found.select("id", "ids", "z.rest", "z.hits")
    return found.select(
        F.col("id").alias(id_col), F.array_join(F.array_distinct("hits"), ",").alias("licenses"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.trim(F.regexp_replace("rest", "[<>|]+", " ")).alias("unmatched"), F.size("ids").cast("long").alias("n_sentences"))


def _oracle() -> str:
    """DuckDB SQL of the same scan over ``documents``."""
    known = ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items())
    steps = ["s0 AS (SELECT doc_id, ids, '<' || array_to_string(ids, '><') || '>' AS rest, CAST([] AS VARCHAR[]) AS hits FROM found)"]
    marks = _steps(RULES)
    for n, (mark, license_) in enumerate(marks):
        steps.append(f"s{n + 1} AS MATERIALIZED (SELECT doc_id, ids, replace(rest, '{mark}', '|') AS rest, CASE WHEN contains(rest, '{mark}') "
                     f"AND '{license_}' <> '' AND NOT list_contains(hits, '{license_}') THEN list_append(hits, '{license_}') ELSE hits END AS hits FROM s{n})")
    return rf"""
WITH lines AS (
  SELECT doc_id, pos, unnest(l) AS line, unnest(range(len(l))) AS nr FROM (
    SELECT doc_id, row_number() OVER () AS pos,
           string_split(regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '([.!?;])[ \t\r\n]+', '\1' || chr(10), 'g'), chr(10)) AS l
    FROM documents WHERE text IS NOT NULL)),
normal AS (
  SELECT doc_id, pos, nr, regexp_replace(replace(trim(regexp_replace(line, '[^a-z0-9]+', ' ', 'g')), 'licence', 'license'),
                                         '\bv ?([0-9])', 'version \1', 'g') AS s
  FROM lines),
told AS (
  SELECT doc_id, pos, nr, MAP {{{known}}}[CASE WHEN regexp_matches(s, '^copyright( c)? [0-9]{{4}}') THEN 'copyright notice' ELSE s END] AS id
  FROM normal),
found AS (SELECT doc_id, list(id ORDER BY nr) AS ids FROM told WHERE id IS NOT NULL GROUP BY doc_id, pos),
{", ".join(steps)}
SELECT doc_id, array_to_string(hits, ',') AS licenses, array_to_string(ids, ',') AS sentence_ids,
       trim(regexp_replace(rest, '[<>|]+', ' ', 'g')) AS unmatched, CAST(len(ids) AS BIGINT) AS n_sentences
FROM s{len(marks)}"""


ORACLE = _oracle()
