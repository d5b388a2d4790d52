"""Licence notices in text, by Dice coefficient over word bigrams.

A template of m bigrams is compared with the runs of the text whose size allows the limit s: from m s / (2 - s) to
m (2 - s) / s bigrams. Size prunes templates that a text is too short for, and a run can only reach the limit if it has one
of the template's anchors, a choice of its bigrams so large that the others alone would not be enough; so none is missed.

Notices of kindred licences differ in few words, but these decide: the names, the words that change a licence (lesser,
noncommercial and the like) and the version. A run that names another licence or version than the template, or none
where the template does, is turned down, and of overlapping matches the best remains.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short forms in which texts declare a licence, standard headers, and whole licences where they are short, the
# latter two in the wording of the licences themselves.
_SINGLE = {
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "Artistic-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    "Artistic-1.0-Perl": "This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself.",
    "BSL-1.0 short": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so, all subject to the following"
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "CC0-1.0 short": "Licensed under CC0 1.0 Universal.",
    "EPL-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT short": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction"
    ),
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file "
        "except in compliance with the License."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "Unlicense short": "This is free and unencumbered software released into the public domain.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
}
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement"
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)
#: Licences of the GNU project by their versions.
_GNU = (
    ("GPL", "GNU General Public License", "program", ("1", "2", "3")),
    ("LGPL", "GNU Library General Public License", "library", ("2",)),
    ("LGPL", "GNU Lesser General Public License", "library", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", "program", ("3",)),
)
#: Kinds and versions of the Creative Commons licences.
_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}


def license_templates() -> dict[str, str]:
    """{name: text}. A name is an SPDX identifier, behind it what kind of text it is if a licence has several."""
    out = dict(_SINGLE)
    out["BSD-2-Clause"] = _BSD
    out["BSD-3-Clause"] = f"{_BSD} {_BSD_NAMES}"
    out["BSD-4-Clause"] = f"{_BSD} {_BSD_ADVERTISING}"
    for family, name, thing, versions in _GNU:
        for v in versions:
            key = f"{family}-{v if '.' in v else v + '.0'}"
            free = f"This {thing} is free software; you can redistribute it and/or modify it under the terms of"
            out[f"{key}-or-later"] = (
                f"{free} the {name} as published by the Free Software Foundation; either version {v} of the License, or (at your "
                "option) any later version."
            )
            out[f"{key}-only"] = f"{free} version {v} of the {name} as published by the Free Software Foundation."
            out[f"{key}-only header"] = f"{free} the {name} version {v} as published by the Free Software Foundation."
            out[f"{key} short"] = f"This work is licensed under the {name}, version {v}."
    for kind, name in _CC.items():
        for v, port in _CC_VERSIONS.items():
            out[f"CC-{kind}-{v}"] = f"This work is licensed under a Creative Commons {name} {v} {port} License."
            out[f"CC-{kind}-{v} short"] = f"Licensed under CC {kind} {v}."
    return out


TEMPLATES = license_templates()

# Words that tell licences apart, those of one meaning under one word.
_TELLING = {
    **{w: w for w in "gnu mit apache mozilla eclipse artistic perl boost creative commons cc cc0 lesser library affero advertising".split()},
    **dict.fromkeys(("nc", "noncommercial"), "nc"),
    **dict.fromkeys(("sa", "sharealike"), "sa"),
    **dict.fromkeys(("nd", "noderivatives", "noderivs"), "nd"),
}

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: Counter
    size: int
    anchors: frozenset
    facts: tuple[frozenset, frozenset]


def words(text: str) -> list[str]:
    """Normalised words: small letters, British spelling of licence folded, share-alike and its like as one word, a v before
    a number cut off, everything else parts words."""
    text = text.lower().replace("licence", "license")
    return _WORD.findall(_JOINED.sub(lambda m: m.group().replace("-", ""), _VERSION.sub(" ", text)))


_JOINED = re.compile(r"\b(?:share-alike|non-commercial|no-derivatives|no-derivs)\b")
_VERSION = re.compile(r"\bv\.?\s?(?=[0-9])")


def facts(found: list[str]) -> tuple[frozenset, frozenset]:
    """The words that tell licences apart, and the numbers of one or two digits: versions, not years."""
    # "this library" is no licence, the Library General Public License is
    names = frozenset(_TELLING[w] for w, x in zip(found, [*found[1:], ""]) if w in _TELLING and (w != "library" or x == "general"))
    return names, frozenset(w for w in found if len(w) <= 2 and w.isdigit() and w != "0")


def agrees(run: tuple[frozenset, frozenset], template: tuple[frozenset, frozenset]) -> bool:
    """Whether a run names the same licence: the same words, and a version of the template's if that has one, no other."""
    return run[0] == template[0] and run[1] <= template[1] and bool(run[1]) == bool(template[1])


def prepare(templates: dict[str, str], limit: float) -> list[Template]:
    """Templates with their bigrams and anchors; those with fewer than two words are an error."""
    out = []
    for name, text in templates.items():
        found = words(text)
        bigrams = Counter(zip(found, found[1:]))
        size = sum(bigrams.values())
        if not size:
            raise ValueError(f"template {name} has no bigram")
        # whatever the size of a run, it needs this many bigrams in common with the template
        common = math.ceil(limit * size / (2 - limit) - 1e-9)
        anchors: list[tuple[str, str]] = []
        # long words first: they are the rare ones
        for bigram in sorted(bigrams, key=lambda b: (-len(b[0]) - len(b[1]), b)):
            if sum(bigrams[b] for b in anchors) > size - common:
                break
            anchors.append(bigram)
        out.append(Template(name, bigrams, size, frozenset(anchors), facts(found)))
    return out


def _best_runs(found: list[str], places: list[int], template: Template, limit: float) -> Iterator[tuple[float, int, int]]:
    """(score, first bigram, end): for each place where a run can begin its best run that reaches the limit and agrees.

    `places` are those of the template's bigrams in the text, in order; a run begins and ends with one of them, as others
    at its ends only lower the score. Of equal scores the longer run counts.
    """
    longest = math.floor(template.size * (2 - limit) / limit + 1e-9)
    fewest = math.ceil(limit * template.size / (2 - limit) - 1e-9)
    bigram = lambda i: (found[i], found[i + 1])
    for k, first in enumerate(places):
        # as many places as are needed must lie within the longest run
        if k + fewest > len(places) or places[k + fewest - 1] - first >= longest:
            continue
        held: Counter = Counter()
        common, runs = 0, []
        for at in places[k:]:
            size = at - first + 1
            if size > longest:
                break
            b = bigram(at)
            held[b] += 1
            common += held[b] <= template.bigrams[b]
            score = 2 * common / (size + template.size)
            if score >= limit:
                runs.append((score, at + 1))
        for score, end in sorted(runs, reverse=True):
            if agrees(facts(found[first : end + 1]), template.facts):
                yield score, first, end
                break


class Scanner:
    """Templates made ready for a limit; built once per task."""

    def __init__(self, templates: dict[str, str], limit: float):
        self.limit, self.templates = limit, prepare(templates, limit)
        self.by_anchor, self.by_bigram = defaultdict(list), defaultdict(list)
        for i, template in enumerate(self.templates):
            for bigram in template.bigrams:
                self.by_bigram[bigram].append(i)
                if bigram in template.anchors:
                    self.by_anchor[bigram].append(i)
        self.by_anchor, self.by_bigram = dict(self.by_anchor), dict(self.by_bigram)
        self.fewest = min((t.size * limit / (2 - limit) for t in self.templates), default=math.inf)

    def runs(self, found: list[str]) -> Iterator[tuple[float, int, int, int]]:
        """(score, first bigram, end, number of the template) of the best run of each template and beginning."""
        if len(found) - 1 < self.fewest:
            return
        known = [(i, b) for i, b in enumerate(zip(found, found[1:])) if b in self.by_bigram]
        needed = {t for _, b in known for t in self.by_anchor.get(b, ())}
        needed = {t for t in needed if len(found) - 1 >= self.templates[t].size * self.limit / (2 - self.limit) - 1e-9}
        places = defaultdict(list)
        for i, b in known:
            for t in self.by_bigram[b]:
                if t in needed:
                    places[t].append(i)
        for t in sorted(needed):
            for score, first, end in _best_runs(found, places[t], self.templates[t], self.limit):
                yield score, first, end, t

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(licence, start, end, score) in code points, end exclusive, in text order; overlaps keep the best
        score, then the larger template, then the earlier place, then the name."""
        found = words(text) if text else []
        runs = [(-score, -self.templates[t].size, first, end, self.templates[t].name) for score, first, end, t in self.runs(found)]
        if not runs:
            return []
        spans = _word_spans(text)
        taken: list[tuple[int, int]] = []
        out = []
        for score, _, first, end, name in sorted(runs):
            if all(end + 1 <= a or first >= b for a, b in taken):
                taken.append((first, end + 1))  # a run of bigrams has one word more
                out.append((name.split(" ")[0], spans[first][0], spans[end][1], round(-score, 6)))
        return sorted(out, key=lambda r: r[1])


def _word_spans(text: str) -> list[tuple[int, int]]:
    """Places of the words in the text as given. Folding a text changes its length, so every character of the folded text
    carries the place that it comes from."""
    low, origin = [], []
    for i, c in enumerate(text):
        small = c.lower()
        low.append(small)
        origin += [i] * len(small)
    folded = "".join(low)
    for pattern, kept in ((_VERSION, " "), (_JOINED, None)):
        parts, places, at = [], [], 0
        for m in pattern.finditer(folded):
            parts.append(folded[at : m.start()])
            places += origin[at : m.start()]
            if kept is not None:
                parts.append(kept)
                places.append(origin[m.start()])
            else:
                letters = [i for i in range(m.start(), m.end()) if folded[i] != "-"]
                parts.append("".join(folded[i] for i in letters))
                places += [origin[i] for i in letters]
            at = m.end()
        folded, origin = "".join([*parts, folded[at:]]), places + origin[at:]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer(folded)]


def license_spans(text: Column, templates: dict[str, str], limit: float) -> Column:
    """ARRAY of STRUCT(license, start, end, score) of a text column; empty for NULL."""

    @F.pandas_udf("array<struct<license: string, start: long, end: long, score: double>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, limit)
        for batch in batches:
            yield pd.Series(
                [[dict(zip(("license", "start", "end", "score"), r)) for r in scanner.scan(t)] for t in batch], dtype=object
            )

    return spans(text)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, limit: float = 0.8
) -> DataFrame:
    """One row per input row: id and `found`, the licence notices in the whole text.

    NULL, empty and one-word texts have none. Repeated rows stay repeated, a NULL id stays NULL, an
    empty table gives an empty result. Other columns are neither read nor returned. The templates go to the
    executors; their number is the caller's.
    """
    prepare(templates, limit)  # a wrong template is an error here, not in a task
    return docs.select(F.col(id_col).alias(id_col), license_spans(F.col(text), templates, limit).alias("found"))
