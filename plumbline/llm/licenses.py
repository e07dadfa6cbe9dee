"""Licence scans by sentence rules.

A text is cut into sentences twice, with line breaks as white space (wrapped licence texts) and with each line on its own
(single lines between other text). A sentence is normalised to lower-case letters and digits between single
spaces; if it is a known one, word for word or with a part that varies (a holder's name), it gets its identifier and place. So do, wherever
in a sentence they stand, notices made by rule (licensed, released, ... under ... a known licence's name and version) and the
licences of an SPDX-License-Identifier tag; a place that a known sentence covers is that sentence's. The identifiers in the order of their places are
matched against ordered rules, longest first: a rule matches where its identifiers follow each other with no
other known sentence between, and a sentence serves one match only. Known sentences that no rule takes are
reported as such.

Defined cases: null, empty and blank texts have no sentence; repeated sentences match as often as they stand; repeated rows
each get their row; a null doc_id is kept; an empty table gives no rows; other columns are ignored, whatever their names. Whole texts
are scanned, very long ones too, a text at a time. What is recognised is the licences in SENTENCES, VARYING and NAMES; texts of others, and
reworded ones, are not.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Query, query_rows

#: Normalised sentences of well-known public licence texts and notices, by identifier.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-at": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl-notice-3": "this work is licensed under the gnu general public license version 3",
    "gpl-notice-2": "this work is licensed under the gnu general public license version 2",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-free-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "isc-asis": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "epl-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "gpl-useful": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0": "this work is dedicated to the public domain",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}

#: Sentences of which a part varies, written as *.
VARYING = {
    "bsd-endorse": "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-asis": "this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "isc-grant": "permission to use copy modify and or distribute this * for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
}

_GNU = {"gpl": ("general public license", ("2", "3")), "lgpl": ("lesser general public license", ("2 1", "3")), "agpl": ("affero general public license", ("3",))}


def _gnu_sentences() -> list[tuple[str, str, str]]:
    """(identifier, sentence, licence) of the family's free-software sentences, whole and from their semicolon on."""
    out = []
    for short, (name, versions) in _GNU.items():
        for v in versions:
            words = f"you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation either version {v} of the license or at your option any later version"
            key, licence = f"{short}-free-{v.replace(' ', '.')}", f"{short.upper()}-{v.replace(' ', '.') if ' ' in v else v + '.0'}-or-later"
            out += [(key, x + words, licence) for x in ("", *(f"this {what} is free software " for what in ("program", "library", "software", "file")))]
    return out


#: Licence names as they stand in notices, a space for anything between words, and their SPDX identifiers.
NAMES = (
    (r"(?:MIT(?: X11)?|X11|Expat)", "MIT"),
    (r"Apache(?: Software)?(?: Licen[sc]es?)?(?: version)? v?2(?:\.0)?", "Apache-2.0"),
    (r"(?:BSD (?:2|two) clause|(?:2|two) clause BSD|simplified BSD|FreeBSD)", "BSD-2-Clause"),
    (r"(?:BSD (?:3|three) clause|(?:3|three) clause BSD|(?:new|modified|revised) BSD)", "BSD-3-Clause"),
    (r"ISC", "ISC"),
    (r"(?:Mozilla Public Licen[sc]e|MPL)(?: version)? v?2(?:\.0)?", "MPL-2.0"),
    (r"(?:Eclipse Public Licen[sc]e|EPL)(?: version)? v?2(?:\.0)?", "EPL-2.0"),
    (r"(?:Eclipse Public Licen[sc]e|EPL)(?: version)? v?1(?:\.0)?", "EPL-1.0"),
    (r"Boost Software Licen[sc]e", "BSL-1.0"),
    (r"zlib", "Zlib"),
    (r"Unlicen[sc]e", "Unlicense"),
    (r"CC0(?: 1\.0)?", "CC0-1.0"),
    (r"Artistic Licen[sc]e(?: version)? 2(?:\.0)?", "Artistic-2.0"),
    (r"WTFPL", "WTFPL"),
)

#: Ordered sentence identifiers and the licence they mean, as an SPDX identifier or a reference of its own.
RULES = (
    (("apache-header", "apache-comply", "apache-copy", "apache-asis", "apache-see"), "Apache-2.0"),
    (("apache-notice", "apache-comply", "apache-copy", "apache-asis", "apache-see"), "Apache-2.0"),
    (("apache-header", "apache-comply", "apache-at", "apache-url", "apache-asis", "apache-see"), "Apache-2.0"),
    (("apache-notice", "apache-comply", "apache-at", "apache-url", "apache-asis", "apache-see"), "Apache-2.0"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-asis", "bsd-liability"), "BSD-3-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-asis", "bsd-liability"), "BSD-2-Clause"),
    (("isc-grant", "isc-asis"), "ISC"),
    (("mit-grant", "mit-keep", "mit-asis", "mit-liability"), "MIT"),
    (("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-redistribution", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free-3", "gpl-useful", "gpl-see", "gpl-received"), "GPL-3.0-or-later"),
    (("gpl-free-2", "gpl-useful", "gpl-see", "gpl-received"), "GPL-2.0-or-later"),
    (("gpl-free-3", "gpl-useful"), "GPL-3.0-or-later"),
    (("gpl-free-2", "gpl-useful"), "GPL-2.0-or-later"),
    (("mpl-subject", "mpl-obtain"), "MPL-2.0"),
    (("mit-title", "mit-grant"), "MIT"),
    (("apache-notice",), "Apache-2.0"),
    (("apache-header",), "Apache-2.0"),
    (("mit-notice",), "MIT"),
    (("mit-notice-2",), "MIT"),
    (("mit-grant",), "MIT"),
    (("isc-grant",), "ISC"),
    (("boost-grant",), "BSL-1.0"),
    (("zlib-grant",), "Zlib"),
    (("epl-terms",), "EPL-2.0"),
    (("gpl-notice-3",), "GPL-3.0-only"),
    (("gpl-notice-2",), "GPL-2.0-only"),
    (("gpl-free-3",), "GPL-3.0-or-later"),
    (("gpl-free-2",), "GPL-2.0-or-later"),
    (("mpl-subject",), "MPL-2.0"),
    (("cc-by-nc",), "CC-BY-NC-4.0"),
    (("cc-by-nc-work",), "CC-BY-NC-4.0"),
    (("cc-by-sa",), "CC-BY-SA-4.0"),
    (("cc-by-sa-work",), "CC-BY-SA-4.0"),
    (("cc-by",), "CC-BY-4.0"),
    (("cc-by-work",), "CC-BY-4.0"),
    (("cc0",), "LicenseRef-public-domain"),
    (("unlicense",), "Unlicense"),
    (("reserved",), "LicenseRef-all-rights-reserved"),
)

_SHORT = r"(?<!Inc\.)(?<!Ltd\.)(?<!Co\.)(?<!Corp\.)"  # a holder's name goes on
_ENDS = re.compile(rf"(?<=[.!?;:]){_SHORT}[\"')\]]*\s+|\n[^\w\n]*\n")
_LINES = re.compile(rf"\n|(?<=[.!?;:]){_SHORT}[\"')\]]*[ \t]+")
_OTHER = re.compile(r"[^a-z0-9]+")
_LEAD = re.compile(r"[^a-zA-Z0-9]*([a-zA-Z0-9]+)")


_GAP = r"[^A-Za-z0-9.;:!?]{1,12}"
_VERB = r"(?<![A-Za-z])(?:licen[sc]ed|(?:re)?distributed|released|(?:made )?available|published|provided|covered|governed|offered)"
_LATER = r"(?P<later>\+|,? (?:or|and)(?: at your option)? (?:any )?(?:later|newer|higher)|-or-later)?"
_FAMILY = rf"(?:GNU )?(?:(?P<kind>Affero|Lesser|Library) )?(?:General Public Licen[sc]e|(?P<short>[AL]?)GPL)(?: [AL]?GPL)?,?(?: version)? ?v?(?P<major>[123])(?:\.(?P<minor>[01]))?{_LATER}"
_CC = r"(?:a )?(?:Creative Commons|CC) (?:Attribution|BY)(?P<nc> NC| non ?commercial)?(?P<sa> SA| share ?alike)?(?P<nd> ND| no ?derivatives)?(?: version)? (?P<cc>[1-4]\.[05])"
_NAMED = "|".join(f"(?P<n{i}>{name})" for i, (name, _) in enumerate(NAMES))
_UNDER = r"(?: \w+){0,3}? (?:under|by|with|through)(?: (?:the|a|an|either|both|terms|conditions|and|of)){0,6} "
_NOTICE = re.compile(re.sub(" ", lambda _: _GAP, rf"{_VERB}{_UNDER}(?:{_FAMILY}|{_CC}|{_NAMED})(?![A-Za-z0-9])").replace(rf"{_GAP}?", rf"(?:{_GAP})?"), re.I)
_AFTER = re.compile(r"[^A-Za-z0-9.]{1,12}(?:style )?licen[sc]e", re.I)  # without the word, MIT may be the institute
_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.I)
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
_HINTS = ("licen", "gpl", "spdx", "creative commons", "cc by", "cc-by", "cc0")


def _spdx(m: re.Match) -> str:
    """The licence that a notice names."""
    g = m.groupdict()
    if g["major"]:
        kind = {"affero": "A", "lesser": "L", "library": "L"}.get((g["kind"] or "").lower(), (g["short"] or "").upper())
        return f"{kind}GPL-{g['major']}.{g['minor'] or 0}-{'or-later' if g['later'] else 'only'}"
    if g["cc"]:
        return "CC-BY" + "".join(x for k, x in (("nc", "-NC"), ("sa", "-SA"), ("nd", "-ND")) if g[k]) + f"-{g['cc']}"
    return next(NAMES[i][1] for i in range(len(NAMES)) if g[f"n{i}"])


def normalised(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower().replace("licence", "license").replace("https://", "http://")).strip()


class Scanner:
    def __init__(self, sentences: dict[str, str] | None = None, rules=None):
        gnu = [] if sentences else _gnu_sentences()
        self.known = {x: k for k, x, _ in gnu} | {normalised(s): k for k, s in (sentences or SENTENCES).items()}
        own = {((k,), licence) for k, _, licence in gnu if not rules and ((k,), licence) not in RULES}
        self.rules = sorted([*(rules or RULES), *sorted(own)], key=lambda r: -len(r[0]))  # stable: of equal length, the earlier goes first
        self.varying = [] if sentences else [(re.compile(x.replace("*", r"\w+(?: \w+){0,30}?")), k) for k, x in VARYING.items()]
        self.leads = {s.split(" ", 1)[0] for s in self.known} | {x.split(" ", 1)[0] for x in VARYING.values()} | {"licence", "licenced", "https"}

    def identify(self, sentence: str) -> str | None:
        words = normalised(sentence)
        return self.known.get(words) or next((k for x, k in self.varying if x.fullmatch(words)), None)

    def notices(self, text: str):
        """(start, end, identifier) of notices and tags; the identifier names the licence after a colon."""
        low = text.lower()
        if not any(h in low for h in _HINTS):
            return
        for m in _NOTICE.finditer(text):
            if m["major"] or m["cc"] or "licen" in m[0].lower() or _AFTER.match(text, m.end()):
                yield m.start(), m.end(), f"notice:{_spdx(m)}"
        for m in _TAG.finditer(text):
            exception = False
            for t in _TOKEN.finditer(text, m.start(1), m.end(1)):
                if t[0].upper() not in ("AND", "OR", "WITH") and not exception:
                    yield t.start(), t.end(), f"spdx:{t[0]}"
                exception = t[0].upper() == "WITH"

    def _sentences(self, text: str, ends: re.Pattern):
        at = 0
        for m in ends.finditer(text):
            yield at, m.start()
            at = m.end()
        yield at, len(text)

    def sentences(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, identifier) of the known sentences, by place; of overlapping ones the longest stays."""
        found = set()
        for ends in (_ENDS, _LINES):
            for a, b in self._sentences(text, ends):
                if 8 <= b - a and (lead := _LEAD.match(text, a, b)) and lead[1].lower() in self.leads:
                    a = lead.start(1)
                    if k := self.identify(text[a:b]):
                        found.add((a, b, k))
        return self._apart(self._apart(found) + list(self.notices(text)), len(found))

    @staticmethod
    def _apart(found, first: int = 0) -> list[tuple[int, int, str]]:
        """By place, those that don't overlap: known sentences before notices, then the earlier, then the longer one."""
        out: list[tuple[int, int, str]] = []
        for a, b, k in sorted(found, key=lambda x: (first > 0 and ":" in x[2], x[0], -x[1])):
            at = bisect.bisect(out, (a, b, k))
            if (not at or out[at - 1][1] <= a) and (at == len(out) or b <= out[at][0]):
                out.insert(at, (a, b, k))
        return out

    def scan(self, text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[str, int, int]]]:
        """Known sentences, and matches (licence, start, end)."""
        found = self.sentences(text or "")
        ids, used, out = [k for _, _, k in found], [False] * len(found), []
        for rule, licence in self.rules if found else ():
            n = len(rule)
            for i in range(len(ids) - n + 1):
                if not any(used[i : i + n]) and tuple(ids[i : i + n]) == rule:
                    used[i : i + n] = [True] * n
                    out.append((licence, found[i][0], found[i + n - 1][1]))
        out += [(k.split(":", 1)[1], a, b) for a, b, k in found if ":" in k]
        return found, sorted(out, key=lambda m: (m[1], m[2]))


_MATCH = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules=None) -> DataFrame:
    """One row per document: doc_id, licenses (distinct, sorted), matches (licence and code-point span), sentence_ids."""

    def run(batches):
        f = Scanner(sentences, rules)
        for b in batches:
            rows = [f.scan(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([sorted({x[0] for x in m}) for _, m in rows], pa.list_(pa.string())),
                    pa.array([[{"license": x[0], "start": x[1], "end": x[2]} for x in m] for _, m in rows], _MATCH),
                    pa.array([[k for _, _, k in s] for s, _ in rows], pa.list_(pa.string())),
                ],
                names=["doc_id", "licenses", "matches", "sentence_ids"],
            )

    schema = "doc_id long, licenses array<string>, matches array<struct<license:string,start:long,end:long>>, sentence_ids array<string>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    out = scan(query_rows(spark, sf_dir))
    return out.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"))


QUERIES: dict[str, Query] = {"op6_license_scan": op6_license_scan}
ORACLE: dict[str, str] = {}
