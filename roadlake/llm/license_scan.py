"""License scan by template markup.

A template is plain wording with two kinds of marked regions: optional text,
``<<beginOptional>> ... <<endOptional>>``, and replaceable text,
``<<var;name=...;original=...;match=...>>`` with ``match`` either alternatives of words
(``2|3``) or ``.{a,b}``, any a to b words.  A template becomes an automaton over words: its
states are the places between mandatory words, optional regions are empty moves around
them, replaceable regions are the alternatives or a counted run of any words.  A text is
accepted where a stretch of its words drives the automaton to its end, so every mandatory
word has matched exactly and in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, text_bytes
from .token_ids import pieces_of

# --------------------------------------------------------------------------
# FIXED VALUES: phrases and labels, and public license notices as templates
# --------------------------------------------------------------------------
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

def _bullet(marks: str) -> str:
    return f"<<beginOptional>><<var;name=bullet;original={marks[0]};match={'|'.join(marks)}>> <<endOptional>>"


def _party(original: str, most: int = 12) -> str:
    return f"<<var;name=party;original={original};match=.{{1,{most}}}>>"


_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    f"conditions are met: {_bullet('1a')}Redistributions of source code must retain the above copyright notice, this list of conditions "
    f"and the following disclaimer. {_bullet('2b')}Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_ADVERTISING = (
    f"{_bullet('3c')}All advertising materials mentioning features or use of this software must display the following "
    f"<<var;name=spelling;original=acknowledgement;match=acknowledgement|acknowledgment>>: This product includes software developed by "
    f"{_party('the organization', 20)}. ")
_BSD_NAMES = (
    f"Neither the name of {_party('the copyright holder')} nor the names of <<var;name=its;original=its;match=its|other|any>> contributors "
    "may be used to endorse or promote products derived from this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    f"THIS SOFTWARE IS PROVIDED BY {_party('THE COPYRIGHT HOLDERS AND CONTRIBUTORS')} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    f"EVENT SHALL {_party('THE COPYRIGHT HOLDER OR CONTRIBUTORS')} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "<<var;name=work;original=this software and associated documentation files;match=.{1,12}>> (the "
    "<<beginOptional>>\"<<endOptional>>Software<<beginOptional>>\"<<endOptional>>), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so")
_MIT_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND <<var;name=spelling;original=NONINFRINGEMENT;"
    f"match=noninfringement|non infringement>>. IN NO EVENT SHALL {_party('THE AUTHORS OR COPYRIGHT HOLDERS')} BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_DISCLAIMER = (
    f"THE SOFTWARE IS PROVIDED \"AS IS\" AND {_party('THE AUTHOR')} <<var;name=verb;original=DISCLAIMS;match=disclaims|disclaim>> ALL "
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
    f"{_party('THE AUTHOR')} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
    "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

#: One sentence that names a license.
NOTICES = [
    ("mit", "Released under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "<<beginOptional>>This <<endOptional>><<var;name=work;original=work;match=.{1,4}>> is licensed under the "
            "GNU General Public License, version <<var;name=version;original=3;match=2|3>>"),
    ("cc-by-nc-4.0", "Licensed under <<beginOptional>>a Creative Commons <<endOptional>>CC BY-NC 4.0"),
]

#: Whole license texts, and the whole headers that Apache, GPL and MPL prescribe for source files.
TEXTS = [
    ("mit", _MIT_GRANT + ", subject to the following conditions: "
            "The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>"
            "shall be included in all copies or substantial portions of the Software. " + _MIT_DISCLAIMER),
    ("isc", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_DISCLAIMER),
    ("bsd", _BSD_OPENING + _BSD_DISCLAIMER),  # two clauses
    ("bsd", _BSD_OPENING + _bullet("3c") + _BSD_NAMES + _BSD_DISCLAIMER),
    ("bsd", _BSD_OPENING + _BSD_ADVERTISING + _bullet("4d") + _BSD_NAMES + _BSD_DISCLAIMER),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at <<var;name=scheme;original=http;match=http|https>>://www.apache.org/"
                   "licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("gpl", "is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version <<var;name=version;original=3;match=2|3>> of the License, or "
            f"(at your option) any later version. {_party('This program', 6)} is distributed in the hope that it will be useful, but WITHOUT ANY "
            "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
            "License for more details. You should have received a copy of the GNU General Public License along with "
            f"{_party('this program', 6)}. If not, <<var;name=where;original=see;match=see|write to the Free Software Foundation>>"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at <<var;name=scheme;original=https;match=http|https>>://"
                "<<beginOptional>>www.<<endOptional>>mozilla.org/MPL/2.0/."),
    ("mit-0", _MIT_GRANT + ". " + _MIT_DISCLAIMER),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
             + _ISC_DISCLAIMER),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will "
             f"{_party('the authors')} be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
             f"the following restrictions: {_bullet('1a')}The origin of this software must not be misrepresented; you must not claim that you "
             "wrote the original software. If you use this software in a product, an "
             "<<var;name=spelling;original=acknowledgment;match=acknowledgment|acknowledgement>> in the product documentation would be "
             f"appreciated but is not required. {_bullet('2b')}Altered source versions must be plainly marked as such, and must not be "
             f"misrepresented as being the original software. {_bullet('3c')}This notice may not be removed or altered from any source "
             "distribution."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
                "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to "
                "do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above "
                "license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or "
                "in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
                "machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
                "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
                "PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE "
                "BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
                "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
                  "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for "
                  "the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
                  "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
                  + _MIT_DISCLAIMER),
]

TEMPLATES = [NOTICES[0], *TEXTS, *NOTICES[1:]]
# --------------------------------------------------------------------------

#: 0 for a byte that parts words, else the byte with A-Z in lower case.
_BYTES = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
               else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


@dataclass(frozen=True)
class Automaton:
    """States 0 to ``last``; ``on[s]`` is (word or None for any word, next states), ``free[s]`` are empty moves."""

    label: str
    on: tuple[tuple[tuple[bytes | None, int], ...], ...]
    free: tuple[tuple[int, ...], ...]
    last: int
    anchor: bytes  # a run of mandatory words that every accepted text holds, in marks " ... "
    before: int  # at most so many words lead up to the anchor
    leads: int  # and at least so many

    def closure(self, states: set[int]) -> set[int]:
        open_ = list(states)
        while open_:
            for t in self.free[open_.pop()]:
                if t not in states:
                    states.add(t)
                    open_.append(t)
        return states

    def accept(self, words: list[bytes], start: int) -> int:
        """End of the longest accepted stretch from word ``start``, or -1."""
        states, end, k = self.closure({0}), -1, start
        while states:
            if self.last in states:
                end = k
            if k == len(words):
                break
            w = words[k]
            states = self.closure({t for s in states for on, t in self.on[s] if on is None or on == w})
            k += 1
        return end


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of one template; unbalanced or unknown markup is an error."""
    on: list[list[tuple[bytes | None, int]]] = [[]]
    free: list[list[int]] = [[]]

    def state() -> int:
        on.append([])
        free.append([])
        return len(on) - 1

    at, open_, runs, run = 0, [], [], []
    low = high = 0  # words so far, at least and at most
    run_from = (0, 0)
    for k, part in enumerate(_MARK.split(markup)):
        if k % 2 == 0:
            for w in words_of(part.encode()):
                if not open_:
                    run = run or []
                    if not run:
                        run_from = (low, high)
                    run.append(w)
                following = state()
                on[at].append((w, following))
                at, high, low = following, high + 1, low + (not open_)
            continue
        if run:
            runs.append((run, run_from))
            run = []
        if part == "beginOptional":
            open_.append(at)
        elif part == "endOptional":
            if not open_:
                raise ValueError(f"{label}: endOptional without begin")
            begun, following = open_.pop(), state()
            free[at].append(following)
            free[begun].append(following)
            at = following
        else:
            fields = dict(f.split("=", 1) for f in part.split(";")[1:] if "=" in f)
            counted = re.fullmatch(r"\.\{(\d+),(\d+)\}", fields["match"])
            following = state()
            if counted:
                fewest, most = map(int, counted.groups())
                for n in range(most + 1):
                    if n >= fewest:
                        free[at].append(following)
                    if n < most:
                        more = state()
                        on[at].append((None, more))
                        at = more
                low, high = low + fewest * (not open_), high + most
            else:
                sizes = []
                for choice in fields["match"].split("|"):
                    s, parts = at, words_of(choice.encode())
                    for w in parts:
                        t = state()
                        on[s].append((w, t))
                        s = t
                    free[s].append(following)
                    sizes.append(len(parts))
                low, high = low + min(sizes) * (not open_), high + max(sizes)
            at = following
    if run:
        runs.append((run, run_from))
    if open_ or not runs:
        raise ValueError(f"{label}: open optional region, or no mandatory word")
    anchor, (leads, before) = max(runs, key=lambda r: len(r[0]))
    return Automaton(label, tuple(map(tuple, on)), tuple(map(tuple, free)), at, b" " + b" ".join(anchor) + b" ", before, leads)


class Scanner:
    """Finds phrases and accepted templates in texts."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.whole = [tuple(t) in TEXTS for t in templates]
        self.automata = [compile_template(*t) for t in templates]
        self.phrases = {p.encode(): label for p, label in phrases.items()}
        options = b"|".join(re.escape(p) for p in self.phrases)
        self.places = re.compile(rb"(?= (" + options + rb") )") if phrases else None

    def scan(self, text: bytes) -> tuple:
        """``n_words, n_base, first_word, last_word, base_labels, labels, score, text_labels, spans``."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base, starts = set(), []
        blanks = None

        def word_at(place: int) -> int:
            """The number of the word that begins behind the blank at ``place``: the blanks before it."""
            nonlocal blanks
            if blanks is None:  # most texts have no phrase and no anchor
                blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20)
            return int(np.searchsorted(blanks, place))

        if self.places:
            for m in self.places.finditer(joined):
                base.add(self.phrases[m.group(1)])
                starts.append(word_at(m.start()))
        spans, texts = [], set()
        for a, whole in zip(self.automata, self.whole):
            at, reached = joined.find(a.anchor), 0
            while at >= 0:
                word = word_at(at)
                # the earliest start that is accepted over this anchor
                for start in range(max(reached, word - a.before), word - a.leads + 1):
                    end = a.accept(words, start)
                    if end > word:
                        spans.append((a.label, start, end))
                        if whole:
                            texts.add(a.label)
                        reached = end
                        break
                at = joined.find(a.anchor, at + 1)
        labels = base | {s[0] for s in spans}
        score = 1.0 if texts else 0.8 if spans else 0.5 if base else 0.0
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score, ",".join(sorted(texts)), sorted(set(spans), key=lambda s: s[1:]))


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))


def scan(docs: DataFrame, *, templates=TEMPLATES, phrases=PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``.

    ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of all places where
    a phrase's words stand one after the other; ``labels`` with those of accepted
    templates; ``score`` 1 if a whole license text or header is accepted, 0.8 if only a sentence that
    names a license is, 0.5 if only a phrase occurs, else 0;
    ``text_labels`` those of accepted ``TEXTS``, so a notice that only names its license is
    told from the license text; ``spans`` the accepted stretches, in words.  Labels are distinct, sorted and joined by
    commas.  Null and empty texts have no word, no label and score 0.  Nothing is
    shuffled; equal rows and null ids each give a row; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), _SPANS]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "text_labels", "spans"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in parts:
            at = 0
            for texts in pieces_of(batch.column("text")):
                columns = zip(*map(scanner.scan, texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)),
                     *(pa.array([[dict(zip(("label", "first_word", "end_word"), s)) for s in v] for v in c] if t is _SPANS else c, t)
                       for c, t in zip(columns, types))], names=["doc_id", *names])
                at += len(texts)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
                                "last_word long, base_labels string, labels string, score double, text_labels string, "
                                "spans array<struct<label:string,first_word:long,end_word:long>>")
