r"""License scans by sentence recognition.

A text is normalised (A-Z lower-cased, everything but letters, digits and the ends of sentences and lines one blank) and searched for a small
table of known licence sentences, which gives each document a sequence of sentence identifiers.  Ordered rules then match
sequences of identifiers: the first rule that fits claims its sentences, which later rules don't see again.  Identifiers that
no rule claims are reported too.

The tables are fixed and small, so they are literals of the plan; nothing is shuffled.

Sentences begin and end at a line break or at ``.``, ``!``, ``?`` or ``;`` before white space or the end, and may begin with the mark of a
list (a digit, a, b or c).  A known sentence may go on over single line breaks, with or without comment markers, as licence texts are wrapped, but not over an empty line, unless that stands between ``at`` and
a url; of sentences that begin at the same place the longest counts.  Defined results: null and empty texts have no sentence
(empty strings, 0); a licence that occurs again counts once; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentence -> identifier.
SENTENCES = {
    "licensed under the apache license version 2 0": "Apache2Short",
    "licensed under the apache license version 2 0 the license": "Apache2Grant",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2Copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "Apache2Copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2AsIs",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2See",
    "spdx license identifier apache 2 0": "Apache2Spdx",
    "released under the mit license": "MitShort",
    "licensed under the mit license": "MitShort",
    "spdx license identifier mit": "MitSpdx",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitCondition",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "spdx license identifier isc": "IscSpdx",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "spdx license identifier bsd 2 clause": "Bsd2Spdx",
    "spdx license identifier bsd 3 clause": "Bsd3Spdx",
    "this work is licensed under the gnu general public license version 3": "Gpl3Short",
    "licensed under the gnu general public license version 3": "Gpl3Short",
    "spdx license identifier gpl 2 0 only": "Gpl2Spdx",
    "spdx license identifier gpl 2 0 or later": "Gpl2Spdx",
    "spdx license identifier gpl 3 0 only": "Gpl3Spdx",
    "spdx license identifier gpl 3 0 or later": "Gpl3Spdx",
    "spdx license identifier lgpl 2 1 only": "Lgpl21Spdx",
    "spdx license identifier lgpl 2 1 or later": "Lgpl21Spdx",
    "spdx license identifier agpl 3 0 only": "Agpl3Spdx",
    "spdx license identifier agpl 3 0 or later": "Agpl3Spdx",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Agpl3Grant",
    "this program is free software": "GplFree",
    "this library is free software": "LgplFree",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GplTerms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LgplTerms",
    "either version 2 of the license or at your option any later version": "Version2",
    "either version 2 1 of the license or at your option any later version": "Version21",
    "either version 3 of the license or at your option any later version": "Version3",
    "this program is distributed in the hope that it will be useful but without any warranty": "GplHope",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GplImplied",
    "see the gnu general public license for more details": "GplSee",
    "this source code form is subject to the terms of the mozilla public license v": "Mpl2Form",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "Mpl2Copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "Mpl2Copy",
    "spdx license identifier mpl 2 0": "Mpl2Spdx",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "licensed under cc by nc 4 0": "CcByNc4Short",
    "licensed under cc by 4 0": "CcBy4Short",
    "licensed under cc by sa 4 0": "CcBySa4Short",
    "this work is licensed under a creative commons attribution 4 0 international license": "CcBy4Short",
    "all rights reserved": "AllRights",
}
#: Ordered rules (sequence of identifiers, licence, class).  Longer texts come before their parts.
RULES = (
    (("Apache2Grant", "Apache2Comply", "Apache2Copy", "Apache2AsIs", "Apache2See"), "Apache-2.0", "permissive"),
    (("Apache2Grant", "Apache2Comply", "Apache2Copy"), "Apache-2.0", "permissive"),
    (("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"), "BSD-3-Clause", "permissive"),
    (("BsdSource", "BsdBinary", "BsdEndorse"), "BSD-3-Clause", "permissive"),
    (("BsdGrant", "BsdSource", "BsdBinary"), "BSD-2-Clause", "permissive"),
    (("BsdSource", "BsdBinary"), "BSD-2-Clause", "permissive"),
    (("Gpl3Grant", "GplHope", "GplImplied", "GplSee"), "GPL-3.0", "copyleft"),
    (("Gpl3Grant", "GplHope"), "GPL-3.0", "copyleft"),
    (("GplFree", "GplTerms", "Version2", "GplHope", "GplImplied", "GplSee"), "GPL-2.0", "copyleft"),
    (("GplFree", "GplTerms", "Version2"), "GPL-2.0", "copyleft"),
    (("GplFree", "GplTerms", "Version3"), "GPL-3.0", "copyleft"),
    (("GplFree", "Gpl3Terms"), "GPL-3.0", "copyleft"),
    (("LgplFree", "LgplTerms", "Version21"), "LGPL-2.1", "copyleft"),
    (("Agpl3Grant",), "AGPL-3.0", "copyleft"),
    (("Agpl3Spdx",), "AGPL-3.0", "copyleft"),
    (("Lgpl21Spdx",), "LGPL-2.1", "copyleft"),
    (("Gpl3Grant",), "GPL-3.0", "copyleft"),
    (("Gpl3Short",), "GPL-3.0", "copyleft"),
    (("Gpl3Spdx",), "GPL-3.0", "copyleft"),
    (("Gpl2Spdx",), "GPL-2.0", "copyleft"),
    (("Mpl2Form",), "MPL-2.0", "copyleft"),
    (("Mpl2Spdx",), "MPL-2.0", "copyleft"),
    (("CcByNc4Short",), "CC-BY-NC-4.0", "restricted"),
    (("CcBySa4Short",), "CC-BY-SA-4.0", "copyleft"),
    (("CcBy4Short",), "CC-BY-4.0", "permissive"),
    (("Apache2Grant",), "Apache-2.0", "permissive"),
    (("Apache2Short",), "Apache-2.0", "permissive"),
    (("Apache2Spdx",), "Apache-2.0", "permissive"),
    (("MitGrant", "MitCondition"), "MIT", "permissive"),
    (("MitShort",), "MIT", "permissive"),
    (("MitSpdx",), "MIT", "permissive"),
    (("MitGrant",), "MIT", "permissive"),
    (("MitCondition",), "MIT", "permissive"),
    (("IscGrant",), "ISC", "permissive"),
    (("IscSpdx",), "ISC", "permissive"),
    (("Bsd2Spdx",), "BSD-2-Clause", "permissive"),
    (("Bsd3Spdx",), "BSD-3-Clause", "permissive"),
    (("Unlicense",), "Unlicense", "permissive"),
    (("AllRights",), "All-rights-reserved", "restricted"),
)
CLASSES = ("restricted", "copyleft", "permissive")
#: Steps of normalising a lower-cased text.  S stands for the end of a sentence, N for a line break, neither with blanks around it.
STEPS = (
    (r"[.!?;](?=[\x20\x09-\x0D]|$)", "S"),
    (r"\n", "N"),
    (r"[^a-z0-9SN]+", " "),
    (r"\x20?([SN])\x20?", "$1"),
    (r"(?<![a-z0-9])atN+(?=http)", "atN"),
    (r"[SN]*S[SN]*|NN+", "S"),
)


def normalise(text: Column) -> Column:
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for pattern, new in STEPS:
        out = F.regexp_replace(out, pattern, new)
    return F.trim(out)


def needed_words(sentences: dict[str, str]) -> list[str]:
    """A few words of which every sentence has one."""
    left, words = [set(s.split()) for s in sentences], []
    while left:
        often = collections.Counter(w for s in left for w in s)
        words.append(max(often, key=lambda w: (len(w) > 4, often[w], w)))
        left = [s for s in left if words[-1] not in s]
    return words


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in their order.

    Normalising only puts blanks for what isn't a letter or digit, so a text with none of ``needed_words`` holds no sentence, and isn't
    normalised.
    """
    known = F.create_map(*(F.lit(x) for pair in sentences.items() for x in pair))
    longest_first = "|".join(s.replace(" ", "[\\x20N]") for s in sorted(sentences, key=len, reverse=True))
    found = F.regexp_extract_all(normalise(text), F.lit(rf"(?:^|(?<=[SN]))(?:[0-9a-c]\x20)?({longest_first})(?=[SN]|$)"), F.lit(1))
    ids = F.transform(found, lambda s: F.element_at(known, F.translate(s, "N", " ")))
    low = F.lower(text)
    some = functools.reduce(Column.__or__, (low.contains(w) for w in needed_words(sentences)))
    return F.when(some, ids).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple = RULES) -> DataFrame:
    """``id_col, n_sentences, sentence_ids, licenses, unclaimed, license_class`` of each document.

    The lists are joined with commas, licences in the order of the rules; the class is the strictest of the licences, null without one.
    """
    rows = docs.select(F.col(id_col).alias("_id"), sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("_ids"))
    line = F.array_join(F.transform("_ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    # The ordered rules are folded over the line of identifiers; a claimed sequence leaves a gap behind.
    table = F.array(*(F.struct(F.lit("".join(f"|{i}|" for i in ids)).alias("ids"), F.lit(name).alias("name")) for ids, name, _ in rules))
    folded = F.aggregate(
        table,
        F.struct(line.alias("line"), F.array().cast("array<string>").alias("names")),
        lambda acc, r: F.when(
            acc["line"].contains(r["ids"]),
            F.struct(F.replace(acc["line"], r["ids"], F.lit("#")).alias("line"), F.array_append(acc["names"], r["name"]).alias("names")),
        ).otherwise(acc),
    )
    none = F.struct(F.lit("").alias("line"), F.array().cast("array<string>").alias("names"))
    rows = rows.withColumn("_found", F.when(F.size("_ids") > 0, folded).otherwise(none)).withColumn("_names", F.array_distinct("_found.names"))
    kinds = {name: kind for _, name, kind in rules}
    strict = F.coalesce(
        *(F.when(F.arrays_overlap("_names", F.array(*(F.lit(n) for n, k in kinds.items() if k == c)).cast("array<string>")), F.lit(c)) for c in CLASSES)
    )
    return rows.select(
        F.col("_id").alias(id_col),
        F.size("_ids").cast("long").alias("n_sentences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join("_names", ",").alias("licenses"),
        F.array_join(F.filter(F.split("_found.line", r"[|#]"), lambda i: i != ""), ",").alias("unclaimed"),
        strict.alias("license_class"),
    )
