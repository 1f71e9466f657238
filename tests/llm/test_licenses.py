import re
import textwrap

import pytest
from pyspark.sql import functions as F

from framewise.llm.licenses import ANCHORS, PHRASES, RULES, SENTENCES, SPDX_NAMES, normal, scan_licenses


def brute(text):
    text = re.sub(r"(?i)(identifier:)[ \t]+", r"\1", text or "")
    text = re.sub(r"(?<![.!?:;])\r?\n[ \t]*(?=[a-z])", " ", text)
    known = {normal(s): i for i, s in SENTENCES.items()}
    ids = [(n, known[normal(p)]) for n, p in enumerate(re.split(r"(?<=[.!?:;])[ \t\r\n]+|\r?\n", text)) if normal(p) in known]
    names = [i for _, i in ids]

    def inside(short, long):
        return any(long[k : k + len(short)] == short for k in range(len(long) - len(short) + 1))

    words = f" {normal(text)} "
    phrases = {p for p, parts in PHRASES.items() if all(f" {normal(x)} " in words for x in parts)}
    spdx = {SPDX_NAMES.get(w.lower()) for line in re.findall(r"(?i)spdx-license-identifier:[ \t]*([^\r\n]*)", text) for w in re.findall(r"[A-Za-z0-9][A-Za-z0-9.+-]*", line)} - {None}
    hit = {n: list(r.sentences) for n, r in RULES.items() if inside(list(r.sentences), names) and r.phrase in {None, *phrases} and r.unless not in phrases}
    rules = sorted(r for r, x in hit.items() if not (x and any(o != r and inside(x, y) for o, y in hit.items())))
    return ids, rules, sorted({RULES[r].licence for r in rules} | spdx)


def check(docs):
    rows = scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids, rules, licences = brute(r["text"])
        assert [(x["place"], x["sentence"]) for x in r["license_sentences"]] == ids, r["text"]
        assert (r["license_rules"], r["licenses"]) == (rules, licences)
    return rows


def text_of(*names):
    """As in a header: what does not end with a mark stands on a line of its own."""
    return "\n".join(SENTENCES[n] for n in names)


def test_every_rule_is_found(docs_of):
    texts = [f"Some text. {text_of(*r.sentences)}\nMore text {' and '.join(PHRASES.get(r.phrase, []))} here." for r in RULES.values()]
    rows = check(docs_of(texts))
    for r, (name, rule) in zip(sorted(rows, key=lambda r: r["doc_id"]), RULES.items()):
        assert name in r["license_rules"] and rule.licence in r["licenses"]


def test_order_and_case_and_wrapped_lines(docs_of):
    header = text_of(*RULES["apache-2-header"].sentences)
    wrapped = re.sub(r" (?=(software|compliance|the language|agreed))", "\n   ", header)
    swapped = text_of(*reversed(RULES["mit-text"].sentences))
    apart = "\n".join(f"{SENTENCES[n]} An unknown sentence." for n in RULES["bsd-text"].sentences)
    rows = check(docs_of([header.upper(), wrapped, swapped, apart, SENTENCES["mit-notice"] + " " + SENTENCES["gpl-3-notice"], "A licence of license, MIT."]))
    licences = [r["licenses"] for r in sorted(rows, key=lambda r: r["doc_id"])]
    assert licences == [["Apache-2.0"], ["Apache-2.0"], [], ["BSD-2-Clause"], ["GPL-3.0", "MIT"], []]


def test_odd_texts_and_columns(odd_docs):
    check(odd_docs)
    clash = odd_docs.withColumns({"Licenses": F.lit(1), "place": F.lit(2)})
    assert scan_licenses(clash).columns == ["doc_id", "text", "lang", "source", "place", "license_sentences", "license_phrases", "license_spdx", "license_rules", "licenses"]
    assert scan_licenses(clash.limit(0)).collect() == []


def test_whole_texts_are_read(docs_of):
    far = "word " * 50_000 + ".\n" + SENTENCES["mit-notice"]
    assert check(docs_of([far]))[0]["licenses"] == ["MIT"]


def test_anchors_spare_no_known_sentence(docs_of):
    assert all(any(a in normal(s) for a in ANCHORS) for s in SENTENCES.values())
    with pytest.raises(ValueError):
        scan_licenses(docs_of(["x"]), sentences={"x": "Nothing of the kind."})
    with pytest.raises(ValueError):
        scan_licenses(docs_of(["x"]), sentences={"x": "A license. Another one."})


#: As shipped, with their own line breaks.
WRAPPED = {
    "MIT": """\
Copyright (c) 2020 A Holder

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
SOFTWARE.""",
    "GPL-2.0-or-later": """\
This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-3.0-or-later": """\
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "Apache-2.0": """\
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
}
LONGEST = {"MIT": "mit-text", "GPL-2.0-or-later": "gpl-2-terms", "GPL-3.0-or-later": "gpl-3-header", "Apache-2.0": "apache-2-header"}


def commented(text, sign):
    return "\n".join(f"{sign} {line}".rstrip() for line in text.split("\n"))


@pytest.mark.parametrize("sign", ["", "#", "//", " *", ";;", "!", "--"])
def test_wrapped_texts_as_shipped(docs_of, sign):
    texts = [commented(t, sign) if sign else t for t in WRAPPED.values()]
    texts += [t.replace("\n", "\r\n") for t in texts]
    rows = sorted(scan_licenses(docs_of(texts)).collect(), key=lambda r: r["doc_id"])
    for r, name in zip(rows, [*WRAPPED, *WRAPPED], strict=True):
        assert r["licenses"] == [name] and LONGEST[name] in r["license_rules"], r["text"]
        places = [x["place"] for x in r["license_sentences"]]
        assert places == sorted(places) and len(set(x["sentence"] for x in r["license_sentences"])) == len(places)


def test_any_width_gives_the_sentences_of_one_line(docs_of):
    names = [n for n in SENTENCES if not n.startswith("spdx")]
    texts = [textwrap.fill(SENTENCES[n], width, break_long_words=False, break_on_hyphens=False) for n in names for width in (1, 15, 40, 72)]
    rows = sorted(scan_licenses(docs_of(texts)).collect(), key=lambda r: r["doc_id"])
    assert [[(x["place"], x["sentence"]) for x in r["license_sentences"]] for r in rows] == [[(0, n)] for n in names for _ in range(4)]


def test_what_joins_and_what_does_not(docs_of):
    texts = [
        "Released under the\n\nMIT License.",
        "# Released under the\n#\n# MIT License.",
        ";; Released under the\n;;\n;; MIT License.",
        "Released under the terms.\nMIT License.",
        'Licensed under the Apache License, Version 2.0\n(the "License");',
        "A heading\nReleased under the\nMIT License.\nReleased under the MIT License.",
    ]
    rows = sorted(scan_licenses(docs_of(texts)).collect(), key=lambda r: r["doc_id"])
    found = [[(x["place"], x["sentence"]) for x in r["license_sentences"]] for r in rows]
    assert found == [[], [], [], [], [(0, "apache-2-header")], [(1, "mit-notice"), (3, "mit-notice")]]


BSD_2 = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
BSD_3 = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_3_BROKEN = """
3. Neither the name of the
   {} nor
   the names of contributors may be used to endorse or promote products
   derived from this software without specific prior written permission.
"""
BSD_AUTHOR = """
3. The name of the author may not be used to endorse or promote products
   derived from this software without specific prior written permission.
"""
BSD_ADVERTISING = """
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the organization.
"""


@pytest.mark.parametrize("sign", ["", "#", " *", ";;"])
def test_bsd_texts_are_told_apart(docs_of, sign):
    thirds = [BSD_3.format("the copyright holder"), BSD_3.format("Google Inc."), BSD_3.format("Some Firm, Ltd. and Others"), BSD_3_BROKEN.format("University")]
    thirds += [thirds[0].upper(), BSD_AUTHOR]
    texts = [BSD_2 + BSD_END] + [BSD_2 + t + BSD_END for t in thirds] + [BSD_2 + BSD_ADVERTISING + t.replace("3.", "4.") + BSD_END for t in thirds]
    texts = [commented(t, sign) if sign else t for t in texts]
    rows = sorted(scan_licenses(docs_of(texts)).collect(), key=lambda r: r["doc_id"])
    assert [r["licenses"] for r in rows] == [["BSD-2-Clause"]] + [["BSD-3-Clause"]] * len(thirds) + [["BSD-4-Clause"]] * len(thirds)


def test_third_conditions_in_other_words(docs_of):
    thirds = [
        "\n3. Neither the name of the University nor the names of its contributors\n   may be used to endorse or promote products derived from this\n   software without prior written permission.\n",
        "\n3. The names of its contributors may not be used to endorse or promote\n   products derived from this software without our permission.\n",
    ]
    texts = [BSD_2 + t + BSD_END for t in thirds] + [BSD_2 + BSD_ADVERTISING + t.replace("3.", "4.") + BSD_END for t in thirds]
    rows = sorted(check(docs_of(texts)), key=lambda r: r["doc_id"])
    assert [r["licenses"] for r in rows] == [["BSD-3-Clause"]] * 2 + [["BSD-4-Clause"]] * 2


def test_phrases_and_identifiers(docs_of):
    texts = [
        "This project is licensed under the MIT License.",
        "// SPDX-License-Identifier: BSD-3-Clause",
        "# SPDX-License-Identifier: gpl-2.0-only WITH Classpath-exception-2.0",
        "/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND LicenseRef-own */\ncode",
        "SPDX-License-Identifier: LGPL-2.1+",
        "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed",
        "It is unlicensed under the MIT Licenses.",
        "SPDX-License-Identifier:\nMIT",
    ]
    rows = sorted(check(docs_of(texts)), key=lambda r: r["doc_id"])
    assert [r["licenses"] for r in rows] == [["MIT"], ["BSD-3-Clause"], ["GPL-2.0-only"], ["Apache-2.0", "MIT"], ["LGPL-2.1-or-later"], ["MPL-2.0"], [], []]


def test_every_phrase_has_an_anchor():
    assert all(any(a in normal(p) for p in parts for a in ANCHORS) for n, parts in PHRASES.items() if not n.startswith("no-end") and n != "acknowledgement")
