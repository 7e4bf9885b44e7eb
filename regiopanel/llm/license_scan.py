"""License scans by matching template markup.

A template is a license's wording with two kinds of markup:

    <<beginOptional>> ... <<endOptional>>     words that may be left out, together
    <<var;name="holder";words="0-20">>        any words, so many of them; other texts put theirs here

It is compiled into an automaton over words: mandatory words are steps, an optional region is a way
round, a replaceable one a chain of steps that any word takes.  All templates run at once over each
text, from every word that may open one; a text is accepted where a run takes all mandatory words, in
order and with nothing between.  Between words only signs may stand, which no word holds.

Beside what templates accept, places of short phrases are counted and give labels of their own.
Each text is read once, in full, in the task that holds it; nothing is shuffled.

Defined results: a null or empty text has no words and a score of 0; a row of the input is a row of the
result, also if repeated; an empty table gives an empty result.  Only id and text are read, so
other columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of licenses and of notices that name one, by label.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "<<beginOptional>>GNU<<endOptional>> Affero General Public License"
        ' <<beginOptional>>version <<var;name="version";words="1-2">><<endOptional>>',
        "SPDX-License-Identifier: AGPL",
    ),
    "apache": (
        'licensed under the Apache License <<beginOptional>>, Version <<var;name="version";words="1-2">><<endOptional>>',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at"
        " <<beginOptional>>http<<endOptional>> <<beginOptional>>https<<endOptional>>"
        " www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software"
        ' distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY'
        " KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the"
        " following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain"
        " the above copyright notice, this list of conditions and the following disclaimer."
        " <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright"
        " notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
        " provided with the distribution."
        ' <<beginOptional>><<beginOptional>>3.<<endOptional>> Neither the name of <<var;name="owner";words="1-20">>'
        " may be used to endorse or promote products derived from this software without specific prior written"
        " permission.<<endOptional>>",
        "licensed under the <<beginOptional>>2<<endOptional>> <<beginOptional>>3<<endOptional>>"
        " <<beginOptional>>Clause<<endOptional>> BSD License",
        'SPDX-License-Identifier: BSD <<var;name="clauses";words="1-1">> Clause',
    ),
    "boost": ("Distributed under the Boost Software License", "SPDX-License-Identifier: BSL-1.0"),
    "cc-by": (
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons"
        ' Attribution <<var;name="version";words="1-2">> <<beginOptional>>International<<endOptional>> License',
        'licensed under CC BY <<var;name="major";words="1-1">> 0',
    ),
    "cc-by-nc": (
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> CC BY-NC"
        ' <<beginOptional>><<var;name="version";words="1-2">><<endOptional>>',
        "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> Creative Commons"
        " Attribution-NonCommercial",
    ),
    "cc-by-nd": ("licensed under CC BY-ND", "licensed under a Creative Commons Attribution-NoDerivatives"),
    "cc-by-sa": ("licensed under CC BY-SA", "licensed under a Creative Commons Attribution-ShareAlike"),
    "cc0": (
        "CC0 1.0 Universal",
        "waived all copyright and related or neighboring rights to",
    ),
    "gpl": (
        "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License"
        ' <<beginOptional>>, version <<var;name="version";words="1-2">><<endOptional>>',
        "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
        ' as published by the Free Software Foundation, either version <<var;name="version";words="1-2">> of the'
        " License, <<beginOptional>>or (at your option) any later version<<endOptional>>",
        'SPDX-License-Identifier: GPL <<var;name="version";words="1-2">>',
    ),
    "isc": (
        "Permission to use, copy, modify, <<beginOptional>>and<<endOptional>> <<beginOptional>>or<<endOptional>>"
        " distribute this software for any purpose with or without fee is hereby granted, provided that the above"
        " copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "lgpl": (
        "licensed under the GNU Lesser General Public License",
        "under the terms of the GNU <<beginOptional>>Lesser<<endOptional>> <<beginOptional>>Library<<endOptional>>"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        'SPDX-License-Identifier: LGPL <<var;name="version";words="1-2">>',
    ),
    "mit": (
        "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the"
        " <<beginOptional>>terms of the<<endOptional>> MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of"
        ' <<var;name="software";words="1-12">> (the "Software"), to deal in the Software without restriction, including'
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies"
        " of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next"
        " paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE"
        ' IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL"
        ' <<var;name="holders";words="1-20">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION'
        " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": (
        "free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
}

_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_WORDS = re.compile(r'words="(\d+)-(\d+)"')


def words_of(data: bytes) -> list[bytes]:
    """Lower-case A-Z, then runs of ASCII letters, digits and everything beyond ASCII."""
    return data.translate(_BLANKED).split()


def parsed(markup: str) -> list:
    """Regions of a template: a word, a list (optional) or a pair (any words, so many)."""
    open_: list[list] = [[]]
    at = 0
    for tag in [*_MARKUP.finditer(markup), None]:
        open_[-1].extend(words_of(markup[at : tag.start() if tag else len(markup)].encode()))
        if tag is None:
            break
        at = tag.end()
        if tag[1] == "beginOptional":
            open_.append([])
        elif tag[1] == "endOptional":
            if len(open_) == 1:
                raise ValueError(f"a region ends that hasn't begun: {markup}")
            inner = open_.pop()
            open_[-1].append(inner)
        else:
            least, most = map(int, _WORDS.search(tag[1]).groups())
            open_[-1].append((least, most))
    if len(open_) > 1:
        raise ValueError(f"a region doesn't end: {markup}")
    return open_[0]


def _mandatory(regions: Sequence) -> int:
    return sum(isinstance(r, bytes) for r in regions)


@dataclass
class State:
    """Moves by a word and by any word, each to states that are reached with all ways round taken."""

    by_word: dict[bytes, list[int]] = field(default_factory=dict)
    by_any: list[int] = field(default_factory=list)
    around: list[int] = field(default_factory=list)
    read: float = 0.0
    label: str | None = None


class Automaton:
    """All templates at once; ``opening`` gives the states after a word that may open one."""

    def __init__(self, templates: Mapping[str, Sequence[str]]):
        self.states: list[State] = []
        entries = []
        for label, markups in templates.items():
            for markup in markups:
                regions = parsed(markup)
                total = _mandatory(regions)
                if not total:
                    raise ValueError(f"a template without mandatory words would accept anything: {markup}")
                entries.append(self._state(0.0))
                end = self._add(regions, entries[-1], [0], total)
                self.states[end].label = label
        closed = [self._closure(i) for i in range(len(self.states))]
        self.opening: dict[bytes, list[int]] = {}
        for state in self.states:
            state.by_word = {w: sorted({c for t in to for c in closed[t]}) for w, to in state.by_word.items()}
            state.by_any = sorted({c for t in state.by_any for c in closed[t]})
        for entry in entries:
            for i in closed[entry]:
                if self.states[i].by_any:
                    raise ValueError("a template must open with a word")
                for w, to in self.states[i].by_word.items():
                    self.opening[w] = sorted({*self.opening.get(w, []), *to})

    def _state(self, read: float) -> int:
        self.states.append(State(read=read))
        return len(self.states) - 1

    def _add(self, regions: Sequence, start: int, done: list[int], total: int, mandatory: bool = True) -> int:
        at = start
        for region in regions:
            if isinstance(region, bytes):
                done[0] += mandatory
                after = self._state(done[0] / total)
                self.states[at].by_word.setdefault(region, []).append(after)
            elif isinstance(region, list):
                inside = self._add(region, at, done, total, False)
                after = self._state(done[0] / total)
                self.states[inside].around.append(after)
                self.states[at].around.append(after)
            else:
                least, most = region
                after = self._state(done[0] / total)
                for k in range(most + 1):
                    if k >= least:
                        self.states[at].around.append(after)
                    if k < most:
                        further = self._state(done[0] / total)
                        self.states[at].by_any.append(further)
                        at = further
            at = after
        return at

    def _closure(self, state: int) -> list[int]:
        seen, open_ = {state}, [state]
        while open_:
            for t in self.states[open_.pop()].around:
                if t not in seen:
                    seen.add(t)
                    open_.append(t)
        return sorted(seen)

    def matches(self, words: Sequence[bytes], places: Sequence[int]) -> tuple[dict[tuple[str, int], int], float]:
        """Longest end by (label, start) of what is accepted, and the largest share of a wording read.

        ``places`` are those of the words that may open a template, in order.
        """
        found: dict[tuple[str, int], int] = {}
        share, at, k = 0.0, 0, 0
        active: dict[int, set[int]] = {}
        while active or k < len(places):
            if not active:
                at = places[k]
            if at >= len(words):
                break
            word, moved = words[at], {}
            for i, starts in active.items():
                state = self.states[i]
                for t in (*state.by_word.get(word, ()), *state.by_any):
                    moved.setdefault(t, set()).update(starts)
            if k < len(places) and places[k] == at:
                for t in self.opening[word]:
                    moved.setdefault(t, set()).add(at)
                k += 1
            for t, starts in moved.items():
                state = self.states[t]
                share = max(share, state.read)
                if state.label is not None:
                    found.update(((state.label, s), at + 1) for s in starts)
            active, at = moved, at + 1
        return found, share


SCANNED = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "matches array<struct<label: string, first: long, words: long>>"
)


class Scanner:
    def __init__(self, templates: Mapping[str, Sequence[str]], phrases: Mapping[str, str]):
        self.automaton = Automaton(templates)
        # Phrases by their last word, so that frequent first words cost nothing.
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases.items():
            words = words_of(phrase.encode())
            self.phrases.setdefault(words[-1], []).append((words, label))
        self.marked = {*self.automaton.opening, *self.phrases}

    def __call__(self, data: bytes | None) -> dict:
        words = words_of(data or b"")
        marked = self.marked
        marks = [i for i, w in enumerate(words) if w in marked]
        base: list[tuple[int, str]] = []
        for i in marks:
            for phrase, label in self.phrases.get(words[i], ()):
                start = i + 1 - len(phrase)
                if start >= 0 and words[start : i + 1] == phrase:
                    base.append((start, label))
        opening = self.automaton.opening
        found, share = self.automaton.matches(words, [i for i in marks if words[i] in opening])
        own = sorted({label for _, label in base})
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(base)[0] if base else None,
            "last_word": max(base)[0] if base else None,
            "base_labels": ",".join(own),
            "labels": ",".join(sorted({*own, *(label for label, _ in found)})),
            "score": share,
            "matches": [
                {"label": label, "first": start, "words": end - start} for (label, start), end in sorted(found.items())
            ],
        }


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """One row per document: doc_id, then ``SCANNED``; ``matches`` are the places templates accept, in words."""
    texts = docs.select(
        docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].cast("string").cast("binary").alias("data")
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    scanner = Scanner(templates, phrases)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            if schema is None:
                schema = _arrow_schema(batch.schema.field("doc_id"))
            rows = [scanner(x.as_py()) for x in batch.column("data")]
            columns = [batch.column("doc_id")]
            columns += [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.mapInArrow(scan, f"doc_id {kind}, {SCANNED}")


def _arrow_schema(doc_id: pa.Field) -> pa.Schema:
    match = pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())])
    kinds = {"score": pa.float64(), "base_labels": pa.string(), "labels": pa.string(), "matches": pa.list_(match)}
    names = [part.split()[0] for part in SCANNED.split(", ")[:7]] + ["matches"]
    return pa.schema([doc_id, *[(n, kinds.get(n, pa.int64())) for n in names]])
