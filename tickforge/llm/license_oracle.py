r"""DuckDB SQL of the licence scan, from tables of its own: the sentences as licences print them, which the SQL normalises."""

from __future__ import annotations

#: Identifier, sentence.
PRINTED = (
    ("Apache2Short", "Licensed under the Apache License, Version 2.0"),
    ("Apache2Grant", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("Apache2Comply", "you may not use this file except in compliance with the License"),
    ("Apache2Copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache2Copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache2AsIs", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("Apache2See", "See the License for the specific language governing permissions and limitations under the License"),
    ("Apache2Spdx", "SPDX-License-Identifier: Apache-2.0"),
    ("MitShort", "Released under the MIT License"),
    ("MitShort", "Licensed under the MIT License"),
    ("MitSpdx", "SPDX-License-Identifier: MIT"),
    ("MitGrant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MitCondition", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("IscGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("IscSpdx", "SPDX-License-Identifier: ISC"),
    ("BsdGrant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BsdSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BsdBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BsdEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("Bsd2Spdx", "SPDX-License-Identifier: BSD-2-Clause"),
    ("Bsd3Spdx", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Gpl3Short", "This work is licensed under the GNU General Public License version 3"),
    ("Gpl3Short", "Licensed under the GNU General Public License, version 3"),
    ("Gpl2Spdx", "SPDX-License-Identifier: GPL-2.0-only"),
    ("Gpl2Spdx", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("Gpl3Spdx", "SPDX-License-Identifier: GPL-3.0-only"),
    ("Gpl3Spdx", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("Lgpl21Spdx", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("Lgpl21Spdx", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("Agpl3Spdx", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("Agpl3Spdx", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("Gpl3Grant", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("Agpl3Grant", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GplFree", "This program is free software"),
    ("LgplFree", "This library is free software"),
    ("Gpl3Terms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GplTerms", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LgplTerms", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("Version2", "either version 2 of the License, or (at your option) any later version"),
    ("Version21", "either version 2.1 of the License, or (at your option) any later version"),
    ("Version3", "either version 3 of the License, or (at your option) any later version"),
    ("GplHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("GplImplied", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("GplSee", "See the GNU General Public License for more details"),
    ("Mpl2Form", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    ("Mpl2Copy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("Mpl2Copy", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("Mpl2Spdx", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CcByNc4Short", "Licensed under CC BY-NC 4.0"),
    ("CcBy4Short", "Licensed under CC BY 4.0"),
    ("CcBySa4Short", "Licensed under CC BY-SA 4.0"),
    ("CcBy4Short", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("AllRights", "All rights reserved"),
)
#: The ordered rules, a line each: identifiers, licence.
ORDERED = """
Apache2Grant Apache2Comply Apache2Copy Apache2AsIs Apache2See: Apache-2.0
Apache2Grant Apache2Comply Apache2Copy: Apache-2.0
BsdGrant BsdSource BsdBinary BsdEndorse: BSD-3-Clause
BsdSource BsdBinary BsdEndorse: BSD-3-Clause
BsdGrant BsdSource BsdBinary: BSD-2-Clause
BsdSource BsdBinary: BSD-2-Clause
Gpl3Grant GplHope GplImplied GplSee: GPL-3.0
Gpl3Grant GplHope: GPL-3.0
GplFree GplTerms Version2 GplHope GplImplied GplSee: GPL-2.0
GplFree GplTerms Version2: GPL-2.0
GplFree GplTerms Version3: GPL-3.0
GplFree Gpl3Terms: GPL-3.0
LgplFree LgplTerms Version21: LGPL-2.1
Agpl3Grant: AGPL-3.0
Agpl3Spdx: AGPL-3.0
Lgpl21Spdx: LGPL-2.1
Gpl3Grant: GPL-3.0
Gpl3Short: GPL-3.0
Gpl3Spdx: GPL-3.0
Gpl2Spdx: GPL-2.0
Mpl2Form: MPL-2.0
Mpl2Spdx: MPL-2.0
CcByNc4Short: CC-BY-NC-4.0
CcBySa4Short: CC-BY-SA-4.0
CcBy4Short: CC-BY-4.0
Apache2Grant: Apache-2.0
Apache2Short: Apache-2.0
Apache2Spdx: Apache-2.0
MitGrant MitCondition: MIT
MitShort: MIT
MitSpdx: MIT
MitGrant: MIT
MitCondition: MIT
IscGrant: ISC
IscSpdx: ISC
Bsd2Spdx: BSD-2-Clause
Bsd3Spdx: BSD-3-Clause
Unlicense: Unlicense
AllRights: All-rights-reserved
"""
#: Licences by class, the strictest class first.
STRICT = (
    ("restricted", "CC-BY-NC-4.0 All-rights-reserved"),
    ("copyleft", "GPL-2.0 GPL-3.0 LGPL-2.1 AGPL-3.0 MPL-2.0 CC-BY-SA-4.0"),
    ("permissive", "Apache-2.0 BSD-2-Clause BSD-3-Clause MIT ISC CC-BY-4.0 Unlicense"),
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _normal(text: str) -> str:
    low = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for pattern, new in ((r"[.!?;]([\x20\x09-\x0D]|$)", r"S\1"), (r"\n", "N"), (r"[^a-z0-9SN]+", " "), (r"\x20?([SN])\x20?", r"\1"), (r"(^|[^a-z0-9])atN+http", r"\1atNhttp"), (r"[SN]*S[SN]*|NN+", "S")):
        low = f"regexp_replace({low}, '{pattern}', '{new}', 'g')"
    return f"trim({low})"


def license_sql() -> str:
    known = ", ".join(f"({_text(t)}, '{i}')" for i, t in PRINTED)
    steps, last = [], "l0"
    for k, line in enumerate(ORDERED.strip().split("\n"), 1):
        ids, name = line.split(": ")
        one = "".join(f"|{i}|" for i in ids.split())
        steps.append(f"l{k} AS MATERIALIZED (SELECT doc_id, r, ids, replace(line, '{one}', '#') AS line, CASE WHEN contains(line, '{one}') THEN list_append(names, '{name}') ELSE names END AS names FROM {last})")
        last = f"l{k}"
    strict = " ".join(f"WHEN list_has_any(names, [{', '.join(map(_text, names.split()))}]) THEN '{c}'" for c, names in STRICT)
    return rf"""WITH printed(sentence, id) AS (VALUES {known}),
known AS (SELECT DISTINCT regexp_replace({_normal('sentence')}, '[SN]', ' ', 'g') AS sentence, id FROM printed),
docs AS (SELECT doc_id, row_number() OVER () AS r, {_normal("coalesce(text, '')")} AS s FROM documents),
atoms AS (SELECT r, s, unnest(string_split_regex(s, '[SN]')) AS atom, generate_subscripts(string_split_regex(s, '[SN]'), 1) AS i FROM docs),
starts AS (SELECT r, s, atom, 1 + coalesce(sum(length(atom) + 1) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM atoms),
places AS (SELECT r, s, p AS b0, p FROM starts UNION ALL SELECT r, s, p, p + 2 FROM starts WHERE regexp_matches(atom, '^[0-9a-c] ')),
cut AS (SELECT r, b0, p, substr(s, CAST(p AS BIGINT), 600) AS rest FROM places),
found AS (SELECT r, b0, p + length(sentence) AS stop, id FROM cut JOIN known ON starts_with(replace(rest, 'N', ' '), sentence) AND substr(rest, length(sentence) + 1, 1) IN ('', 'S', 'N')),
longest AS (SELECT r, b0, max_by(id, stop) AS id, max(stop) AS stop FROM found GROUP BY r, b0),
apart AS (SELECT r, b0, id FROM longest x WHERE NOT EXISTS (SELECT 1 FROM longest y WHERE y.r = x.r AND y.b0 < x.b0 AND x.b0 < y.stop)),
g AS (SELECT r, list(id ORDER BY b0) AS ids FROM apart GROUP BY r),
l0 AS (SELECT doc_id, r, coalesce(ids, []) AS ids, array_to_string(list_transform(coalesce(ids, []), lambda x: '|' || x || '|'), '') AS line, CAST([] AS VARCHAR[]) AS names FROM docs LEFT JOIN g USING (r)),
{', '.join(steps)}
SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids, array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licenses,
  array_to_string(list_filter(string_split_regex(line, '[|#]'), lambda x: x <> ''), ',') AS unclaimed, CASE {strict} END AS license_class FROM {last}"""
