import re

from tickforge.llm import licenses
from tickforge.llm.license_oracle import ORDERED, PRINTED


def norm(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.sub("[^a-z0-9]+", " ", low).strip()


def brute(text):
    """Sentences of paragraphs, word by word: a known sentence begins at a border and ends at one."""
    known = {tuple(norm(t).split()): i for i, t in PRINTED}
    paragraphs = [[]]
    for line in re.split("\n", text or ""):
        line = re.sub(r"[.!?;](?=[\x20\x09-\x0D]|$)", "\x00", line)
        parts = [norm(x).split() for x in line.split("\x00")]
        if not any(parts) and len(parts) == 1:
            paragraphs.append([])
            continue
        for k, p in enumerate(parts):
            if k:
                paragraphs.append([])
            if p:
                paragraphs[-1].append(p)
    joined: list = []
    for p in filter(None, paragraphs):
        if joined and joined[-1][-1][-1:] == ["at"] and p[0][0].startswith("http"):
            joined[-1] += p
        else:
            joined.append(list(p))
    ids = []
    for lines in joined:
        k = 0
        while k < len(lines):
            best = None
            for skip in (0, 1):
                if skip and (len(lines[k]) < 2 or not re.fullmatch("[0-9a-c]", lines[k][0])):
                    continue
                for to in range(k + 1, len(lines) + 1):
                    words = tuple(w for x in lines[k:to] for w in x)[skip:]
                    if words in known and (best is None or to >= best[0]):
                        best = (to, known[words])
            if best:
                ids.append(best[1])
                k = best[0]
            else:
                k += 1
    line, names = list(ids), []
    for rule in ORDERED.strip().split("\n"):
        seq, name = rule.split(": ")
        seq = seq.split()
        at, hit = 0, False
        while at + len(seq) <= len(line):
            if line[at : at + len(seq)] == seq:
                line[at : at + len(seq)] = [None]
                hit = True
            at += 1
        if hit and name not in names:
            names.append(name)
    return len(ids), ",".join(ids), ",".join(names), ",".join(filter(None, line))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted(licenses.scan_licenses(docs).collect())
    assert [tuple(r[1:5]) for r in rows] == [brute(r["text"]) for r in sorted(docs.select("doc_id", "text").collect())]
    assert sum(r["n_sentences"] for r in rows) > 30


def test_ordered_rules(spark, odd, empty):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n http://www.apache.org/licenses/LICENSE-2.0"
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    texts = [(1, apache), (2, gpl), (3, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (4, "you may not use this file except in compliance with the License."), (5, None), (6, ""), (7, "Released under the MIT License.\nReleased under the MIT License.")]
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert rows[1]["licenses"] == "Apache-2.0" and rows[1]["unclaimed"] == ""
    assert rows[2]["licenses"] == "GPL-3.0" and rows[2]["license_class"] == "copyleft"
    assert rows[3]["licenses"] == "CC-BY-NC-4.0,MIT" and rows[3]["license_class"] == "restricted"
    assert rows[4]["licenses"] == "" and rows[4]["unclaimed"] == "Apache2Comply"
    assert rows[7]["sentence_ids"] == "MitShort,MitShort" and rows[7]["unclaimed"] == ""
    assert rows[5]["n_sentences"] == rows[6]["n_sentences"] == 0 and rows[5]["license_class"] is None
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(empty).count() == 0


APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL.format(";").replace("Foundation, either version 3", "Foundation; either version 2")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
ENDORSE = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


def test_wrapped_licences(spark):
    want = {
        APACHE: ("Apache2Grant,Apache2Comply,Apache2Copy,Apache2AsIs,Apache2See", "Apache-2.0"),
        GPL.format(":"): ("Gpl3Grant,GplHope,GplImplied,GplSee", "GPL-3.0"),
        GPL.format(";"): ("GplFree,Gpl3Terms,GplHope,GplImplied,GplSee", "GPL-3.0"),
        GPL2: ("GplFree,GplTerms,Version2,GplHope,GplImplied,GplSee", "GPL-2.0"),
        LGPL: ("LgplFree,LgplTerms,Version21", "LGPL-2.1"),
        MPL: ("Mpl2Form,Mpl2Copy", "MPL-2.0"),
        ISC: ("IscGrant", "ISC"),
        BSD: ("BsdGrant,BsdSource,BsdBinary", "BSD-2-Clause"),
        BSD + ENDORSE: ("BsdGrant,BsdSource,BsdBinary,BsdEndorse", "BSD-3-Clause"),
        MIT: ("MitGrant,MitCondition", "MIT"),
        MIT.replace("or substantial", "\nor substantial"): ("MitGrant,MitCondition", "MIT"),
        MIT.replace("copies or", "\ncopies or"): ("MitGrant", "MIT"),  # an empty line ends a sentence
        "All-rights-reserved.": ("AllRights", "All-rights-reserved"),
        "=" * 900 + " Released under the MIT License.": ("MitShort", "MIT"),
        "b) Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": ("BsdSource", ""),
        "a licence line\nReleased under the MIT License\nmore text": ("MitShort", "MIT"),
    }
    texts, found = [], []
    for text, ids in want.items():
        for first, mark in (("", ""), ("", "# "), ("", "// "), ("/*\n", " * ")):
            texts.append((len(texts), (first + "\n".join((mark + line).rstrip() for line in text.split("\n"))).replace("\n", "\r\n" if len(texts) % 2 else "\n")))
            found.append(ids)
    rows = sorted(licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert [(r["sentence_ids"], r["licenses"]) for r in rows] == found
    assert [tuple(r[1:5])[:3:1] for r in rows] == [brute(t)[:3] for _, t in texts]
