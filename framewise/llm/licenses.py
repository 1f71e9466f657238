"""License scans by sentence rules. DataFrame operations only.

A text is split into sentences, each is normalised and looked up among known licence sentences, and the
sequence of identifiers found is matched against rules, which are sequences of identifiers themselves.
Licence texts are wrapped anywhere, so lines are also looked up joined with the unfinished ones before them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.columns import whole_text, without

# Sentences of public licence texts and of usual notices, by identifier.
SENTENCES = {
    "apache-2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-2-use": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at",
    "apache-2-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-2-see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl-2-version": "either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    # The holder's name comes ahead of this part. Of several usual wordings.
    "bsd-names": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-names-other": "nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "spdx-apache-2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-gpl-3": "SPDX-License-Identifier: GPL-3.0-or-later",
}

class Rule(NamedTuple):
    """A licence is there if its sentences follow each other and the phrase, if one is named, is in the text, and that of
    ``unless`` is not."""

    licence: str
    sentences: Sequence[str] = ()
    phrase: str | None = None
    unless: str | None = None


# Parts of sentences, by identifier. They count wherever they are, whatever stands around them: "This project
# is licensed under the MIT License." All that a text must hold for an identifier is listed.
PHRASES = {
    "no-endorsement": ["endorse or promote products derived from"],
    "acknowledgement": ["must display the following acknowledgement"],
    "no-endorsement-advertised": ["endorse or promote products derived from", "must display the following acknowledgement"],
    "mit-named": ["licensed under the MIT License"],
    "apache-2-named": ["licensed under the Apache License 2.0"],
    "gpl-2-only": ["the terms of the GNU General Public License version 2 as published by the Free Software Foundation"],
    "lgpl-2.1-terms": ["GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "lgpl-3-terms": ["GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "agpl-3-terms": ["GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "mpl-2-notice": ["subject to the terms of the Mozilla Public License, v. 2.0"],
    "epl-2-notice": ["made available under the terms of the Eclipse Public License 2.0"],
    "bsl-1-notice": ["Distributed under the Boost Software License, Version 1.0"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense-grant": ["This is free and unencumbered software released into the public domain"],
    "cc0-notice": ["dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"],
    "zlib-grant": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"],
}

# Identifiers in the order in which a licence has them. A shorter rule is for texts that
# quote a part; a rule inside a longer one that matches adds nothing.
RULES = {
    "apache-2-notice": Rule("Apache-2.0", ["apache-2-notice"]),
    "apache-2-header": Rule("Apache-2.0", ["apache-2-header", "apache-2-use", "apache-2-copy", "apache-2-basis", "apache-2-see"]),
    "apache-2-begin": Rule("Apache-2.0", ["apache-2-header", "apache-2-use"]),
    "apache-2-spdx": Rule("Apache-2.0", ["spdx-apache-2"]),
    "mit-notice": Rule("MIT", ["mit-notice"]),
    "mit-licensed": Rule("MIT", ["mit-licensed"]),
    "mit-text": Rule("MIT", ["mit-grant", "mit-keep", "mit-as-is"]),
    "mit-spdx": Rule("MIT", ["spdx-mit"]),
    "gpl-3-notice": Rule("GPL-3.0", ["gpl-3-notice"]),
    "gpl-3-header": Rule("GPL-3.0-or-later", ["gpl-free", "gpl-3-terms", "gpl-hope", "gpl-implied"]),
    "gpl-3-terms": Rule("GPL-3.0-or-later", ["gpl-3-terms"]),
    "gpl-2-terms": Rule("GPL-2.0-or-later", ["gpl-terms", "gpl-2-version"]),
    "gpl-3-spdx": Rule("GPL-3.0-or-later", ["spdx-gpl-3"]),
    "cc-by-nc-4-notice": Rule("CC-BY-NC-4.0", ["cc-by-nc-4-notice"]),
    "cc-by-nc-4-work": Rule("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    "cc-by-4-notice": Rule("CC-BY-4.0", ["cc-by-4-notice"]),
    "cc-by-4-work": Rule("CC-BY-4.0", ["cc-by-4-work"]),
    "cc-by-sa-4-notice": Rule("CC-BY-SA-4.0", ["cc-by-sa-4-notice"]),
    "bsd-text": Rule("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], unless="no-endorsement"),
    "bsd-3-text": Rule("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    "bsd-3-other": Rule("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names-other"]),
    "bsd-3-author": Rule("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-author"]),
    "bsd-4-text": Rule("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]),
    "bsd-4-other": Rule("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names-other"]),
    "bsd-4-author": Rule("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-author"]),
    # A third condition in whatever words.
    "bsd-3-any": Rule("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], phrase="no-endorsement", unless="acknowledgement"),
    "bsd-4-any": Rule("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary"], phrase="no-endorsement-advertised"),
    "mit-named": Rule("MIT", phrase="mit-named"),
    "apache-2-named": Rule("Apache-2.0", phrase="apache-2-named"),
    "gpl-2-only": Rule("GPL-2.0-only", phrase="gpl-2-only"),
    "lgpl-2.1-terms": Rule("LGPL-2.1-or-later", phrase="lgpl-2.1-terms"),
    "lgpl-3-terms": Rule("LGPL-3.0-or-later", phrase="lgpl-3-terms"),
    "agpl-3-terms": Rule("AGPL-3.0-or-later", phrase="agpl-3-terms"),
    "mpl-2-notice": Rule("MPL-2.0", phrase="mpl-2-notice"),
    "epl-2-notice": Rule("EPL-2.0", phrase="epl-2-notice"),
    "bsl-1-notice": Rule("BSL-1.0", phrase="bsl-1-notice"),
    "isc-text": Rule("ISC", phrase="isc-grant"),
    "unlicense-text": Rule("Unlicense", phrase="unlicense-grant"),
    "cc0-notice": Rule("CC0-1.0", phrase="cc0-notice"),
    "zlib-text": Rule("Zlib", phrase="zlib-grant"),
}

# Identifiers of the public list of licences that are told in file headers, without their ``-only`` and
# ``-or-later`` forms.
SPDX = (
    "0BSD AFL-3.0 Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 "
    "CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 ECL-2.0 "
    "EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL ICU IJG ISC JSON Libpng LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 "
    "NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL Python-2.0 QPL-1.0 Ruby SISSL Sleepycat TCL Unicode-3.0 "
    "Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()
SPDX_GNU = ("AGPL-3.0", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")
SPDX_NAMES = {n.lower(): n for n in [*SPDX, *[f"{g}{form}" for g in SPDX_GNU for form in ("", "-only", "-or-later")]]}
#: Old ways to say "or later".
SPDX_NAMES |= {f"{g}+".lower(): f"{g}-or-later" for g in SPDX_GNU}
#: An expression runs to the end of its line; what its words are.
_SPDX_LINE = r"(?i)spdx-license-identifier:[ \t]*([^\r\n]*)"
_SPDX_WORD = r"[A-Za-z0-9][A-Za-z0-9.+-]*"

#: Every known sentence has one of these words or beginnings, so a text without them has no match.
ANCHORS = ("licen", "permission", "permitted", "copyright", "warranty", "software", "redistribut")

#: A colon that ends no sentence: what follows belongs to it.
_NAMED = r"(?i)(identifier:)[ \t]+"
#: Where sentences end. A line break ends one unless a small letter follows.
_END = r"(?<=[.!?:;])[ \t\r\n]+|\r?\n(?![ \t]*[a-z])"
#: Where the parts between two ends are divided further; neighbouring ones are joined again. The
#: word "nor" follows a holder's name, so what it begins is looked up without the name.
_BREAK = r"\r?\n|[ \t]+(?=(?i:nor)\b)"
_OTHER = r"[^a-z0-9]+"


def normal(sentence: str) -> str:
    """Lower case, with one blank for all that is neither a letter a-z nor a digit, none at the ends."""
    return re.sub(_OTHER, " ", sentence.lower()).strip()


def _normal(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), _OTHER, " "))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _lines(text: Column) -> Column:
    """The lines of each sentence, normalised: its place, the words, and whether a mark ends them."""
    parts = F.split(F.regexp_replace(text, _NAMED, "$1"), _END)
    line = lambda t, i: F.struct(i.alias("place"), _normal(t).alias("words"), t.rlike("[.!?:;]$").alias("ended"))
    lines = F.flatten(F.transform(parts, lambda s, i: F.transform(F.split(s, _BREAK), lambda t: line(t, i))))
    sign = lambda x: (x["words"] == "") & x["ended"]
    # Comment signs like ; and ! are cut off as sentences of their own. Two in a row are an empty line.
    return _with(lines, lambda all: F.filter(all, lambda x, i: ~sign(x) | F.coalesce(sign(F.get(all, i + 1)), F.lit(True))))


def _found(lines: Column, sentences: dict[str, str]) -> Column:
    """Known sentences among lines and joins of lines, the longest from each line on."""
    words = {normal(s): i for i, s in sorted(sentences.items())}
    known = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    texts = F.array(*[F.lit(x) for x in words])
    most = max(x.count(" ") + 1 for x in words)  # Each line that is joined has a word.
    begins = lambda w: (w != "") & F.exists(texts, lambda s: F.startswith(s, w))

    def join(acc, x):
        longer = F.when(acc["open"] & (x["words"] != ""), F.concat_ws(" ", acc["words"], x["words"]))
        name = F.try_element_at(known, longer)
        return F.struct(
            longer.alias("words"),
            (longer.isNotNull() & ~x["ended"]).alias("open"),
            (acc["n"] + 1).alias("n"),
            F.coalesce(name, acc["sentence"]).alias("sentence"),
            F.when(name.isNotNull(), acc["n"] + 1).otherwise(acc["size"]).alias("size"),
        )

    none = F.lit(None).cast("string")
    start = F.struct(none.alias("words"), F.lit(True).alias("open"), F.lit(0).alias("n"), none.alias("sentence"), F.lit(0).alias("size"))

    def of_line(all, x, i):
        best = F.when(begins(x["words"]), F.aggregate(F.slice(all, i + 1, F.lit(most)), start, join))
        return _with(best, lambda b: F.struct(x["place"].alias("place"), b["sentence"].alias("sentence"), (i + b["size"]).alias("upto")))

    matches = _with(lines, lambda all: F.filter(F.transform(all, lambda x, i: of_line(all, x, i)), lambda m: m["sentence"].isNotNull()))
    # A line may be a sentence by itself and also the end of a longer one, which began at most ``most`` matches before.
    before = lambda all, i: F.slice(all, F.greatest(F.lit(1), i + 1 - most), F.least(i, F.lit(most)))
    whole = _with(matches, lambda all: F.filter(all, lambda m, i: ~F.exists(before(all, i), lambda o: o["upto"] >= m["upto"])))
    return F.transform(whole, lambda m: F.struct(m["place"].alias("place"), m["sentence"].alias("sentence")))


_RESULTS = ("license_sentences", "license_phrases", "license_spdx", "license_rules", "licenses")


def listed(rule: Rule) -> str:
    """A rule's sentences as they stand in a list of identifiers; nothing for a rule without any."""
    return f" {' '.join(rule.sentences)} " if rule.sentences else ""


def _phrases(text: Column) -> Column:
    """The known phrases that are in the text, in alphabetical order. Lines and comment signs are like blanks."""

    def held(words: Column) -> Column:
        names = [
            F.when(reduce(and_, [F.contains(words, F.lit(f" {normal(part)} ")) for part in parts]), F.lit(name))
            for name, parts in sorted(PHRASES.items())
        ]
        return F.array_compact(F.array(*names))

    return _with(F.concat(F.lit(" "), _normal(text), F.lit(" ")), held)


def _spdx(text: Column) -> Column:
    """The known identifiers of all SPDX lines, each once, in alphabetical order."""
    known = F.create_map(*[F.lit(x) for pair in sorted(SPDX_NAMES.items()) for x in pair])
    words = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_SPDX_LINE), 1), lambda line: F.regexp_extract_all(line, F.lit(_SPDX_WORD), 0)))
    names = F.transform(words, lambda w: F.try_element_at(known, F.lower(w)))
    return F.array_sort(F.array_distinct(F.array_compact(names)))


def scan_licenses(docs: DataFrame, text: str = "text", sentences: dict[str, str] = SENTENCES, rules: dict = RULES, anchors=ANCHORS) -> DataFrame:
    """``docs`` with ``license_sentences``, ``license_phrases``, ``license_spdx``, ``license_rules`` and ``licenses``.

    ``license_sentences`` lists the known sentences of the whole text as structs of their place
    (from 0, that of the first line) and identifier. Places count what sentence marks and line
    breaks separate, but for line breaks before small letters. A sentence may be wrapped over
    lines anywhere, with comment signs ahead of them; empty lines end it, and one that is a
    part of a longer one is not listed.  ``license_rules`` the names of rules whose
    identifiers follow each other in that list (unknown sentences between them don't matter),
    without rules inside a longer one that matches. ``license_phrases`` lists the known parts of sentences that are
    anywhere in the text, which rules may ask for or exclude; ``license_spdx`` the identifiers of SPDX lines, all
    that an expression names. ``licenses`` has the licences of the rules and identifiers, each once.
    All but the sentences are in alphabetical order.

    Null and empty texts have empty lists. A sentence that a document repeats is listed each
    time. Rows are looked at one by one: repeated rows, nulls and further columns pass through, and
    input columns with the names of the results are replaced. An empty table gives an empty table.

    ``anchors`` spares most texts the splitting; every known sentence must hold one of them.
    """
    for name, sentence in sentences.items():
        if not any(a in normal(sentence) for a in anchors):
            raise ValueError(f"no anchor in the sentence {name}")
        if len(re.split(_END, re.sub(_NAMED, r"\1", sentence))) > 1:
            raise ValueError(f"{name} is more than one sentence")
    nothing = F.expr("cast(array() as array<struct<place:int,sentence:string>>)")
    candidate = F.lower("_text").rlike("|".join(re.escape(a) for a in anchors))
    found = F.when(candidate, _found(_lines(F.col("_text")), sentences)).otherwise(nothing)

    phrases, spdx = _phrases(F.col("_text")), _spdx(F.col("_text"))
    joined = F.concat(F.lit(" "), F.array_join(F.transform("license_sentences", lambda x: x["sentence"]), " "), F.lit(" "))
    def matches(rule: Rule) -> Column:
        held = F.contains(F.col("_ids"), F.lit(listed(rule)))
        if rule.phrase:
            held = held & F.array_contains("license_phrases", rule.phrase)
        if rule.unless:
            held = held & ~F.array_contains("license_phrases", rule.unless)
        return held

    match = {name: matches(rule) for name, rule in rules.items()}
    inside = {
        name: [o for o, other in rules.items() if o != name and rule.sentences and listed(rule) in listed(other)] for name, rule in rules.items()
    }
    hits = []
    for name in sorted(rules):
        condition = match[name]
        for longer in inside[name]:
            condition = condition & ~match[longer]
        hits.append(F.when(condition, F.lit(name)))
    licence = F.create_map(*[F.lit(x) for name, rule in sorted(rules.items()) for x in (name, rule.licence)])
    named = F.transform("license_rules", lambda r: F.element_at(licence, r))
    empty = F.array().cast("array<string>")
    scanned = (
        without(docs, *_RESULTS)
        .withColumn("_text", whole_text(text))
        .withColumn("license_sentences", found)
        .withColumn("license_phrases", F.when(candidate, phrases).otherwise(empty))
        .withColumn("license_spdx", F.when(candidate, spdx).otherwise(empty))
        .withColumn("_ids", joined)
        .withColumn("license_rules", F.array_compact(F.array(*hits)))
        .withColumn("licenses", F.array_sort(F.array_distinct(F.concat(named, "license_spdx"))))
    )
    return scanned.drop("_text", "_ids")
