"""Licence scans with a generalised suffix automaton.

The words of all licence templates go into one suffix automaton (bounded by
the templates, so every task holds it).  A text is streamed through it once:
after each word the automaton knows the longest run of words ending there
that stands in some template (the matching statistics), and through the
state's suffix path the longest run for every single template.  Runs of a
template that cannot be extended are matches, at all their places in it.  Long
ones are chained, over gaps of at most ``GAP`` words of text, by dynamic
programming: places rise in text and template, and the chain that covers most
words of the template wins.  Whole notices and each of their clauses are
templates; the covered share of one decides on its label, and chains that
reach it are the covered spans.  The base phrases are templates too: a phrase
stands wherever its state lies on the suffix path of the match.

Defined results: null, empty and wordless texts have no words, no places and
score 0; repeated rows give repeated results; a null doc_id is kept; further
columns are ignored.  Texts are read whole, one document at a time.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of public licences (fixed values: the licences' own words), by label; a blank line parts clauses.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

This notice may not be removed or altered from any source distribution.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
}
#: Words of a long match, words a chain may skip in the text, and the covered share of a clause (or of a whole notice) that gives a label.
LONG, GAP, SHARE = 5, 8, 0.6

_SPACE = bytes.maketrans(bytes(range(0x41, 0x5B)) + bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61))
                         + bytes(range(0x7B, 0x80)), bytes(range(0x61, 0x7B)) + b" " * (0x30 + 7 + 6 + 5))


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, cut at every other ASCII sign."""
    return (text or "").encode("utf-8", "replace").translate(_SPACE).split()


class SuffixAutomaton:
    """Generalised suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length = [{}], [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]  # sequence -> all positions where the state's words end there
        for seq in sequences:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        for k, seq in enumerate(sequences):  # when no state will be split any more
            v = 0
            for i, word in enumerate(seq):  # every state on the suffix path of a prefix ends at i
                v = self.next[v][word]
                u = v
                while u > 0:
                    self.ends[u].setdefault(k, []).append(i)
                    u = self.link[u]

    def _new(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of the words of p followed by ``word``, when q stands for longer ones too."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        cur = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, self.next[p][word], word)
        return cur

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Matching statistics after one more word."""
        while state > 0 and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0


class Scanner:
    """Templates and base phrases in one automaton."""

    def __init__(self, templates: dict[str, str], base: dict[str, str]):
        self.texts: list[tuple[str, list[bytes], bool]] = []
        for label, t in templates.items():
            clauses = [w for w in map(words, t.split("\n\n")) if w]
            self.texts += [(label, w, False) for w in clauses]
            if len(clauses) > 1:
                self.texts.append((label, [x for w in clauses for x in w], False))
        self.texts += [(label, words(p), True) for p, label in base.items()]
        self.ids: dict[bytes, int] = {}
        for _, ws, _ in self.texts:
            for w in ws:
                self.ids.setdefault(w, len(self.ids))
        a = self.automaton = SuffixAutomaton([[self.ids[w] for w in ws] for _, ws, _ in self.texts])
        own: dict[int, list[int]] = {}  # state of a whole base phrase -> phrase
        for k, (_, ws, is_base) in enumerate(self.texts):
            if is_base:
                v = 0
                for w in ws:
                    v = a.next[v][self.ids[w]]
                own.setdefault(v, []).append(k)
        self.phrases: list[list[int]] = [[] for _ in a.next]  # phrases on each state's suffix path
        for v in sorted(range(len(a.next)), key=a.length.__getitem__):
            self.phrases[v] = own.get(v, []) + (self.phrases[a.link[v]] if a.link[v] > 0 else [])
        # Template -> the longest state of the suffix path that stands in it.
        self.nearest: list[dict[int, int]] = [{} for _ in a.next]
        for v in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.nearest[v] = self.nearest[a.link[v]] | {k: v for k in a.ends[v] if not self.texts[k][2]}

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
        ws = words(text)
        get, a = self.ids.get, self.automaton
        places: list[tuple[int, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}  # template -> (end, length, state)
        running: dict[int, tuple[int, int]] = {}  # template -> (length, state) of the run that ends at the word before
        state = length = 0
        before = -2

        def close(now: dict[int, tuple[int, int]]) -> None:
            for k, (n, v) in running.items():
                if k not in now or now[k][0] <= n:
                    matches.setdefault(k, []).append((before, n, v))

        for i, w in [(i, k) for i, k in enumerate(map(get, ws)) if k is not None]:
            if i != before + 1:
                close({})
                running = {}
                state = length = 0
            state, length = a.step(state, length, w)
            now = {}
            if length >= LONG:
                for k, v in self.nearest[state].items():
                    n = min(length, a.length[v])
                    if n >= LONG:
                        now[k] = (n, v)
            if running:
                close(now)
            running, before = now, i
            for k in self.phrases[state]:
                size = len(self.texts[k][1])
                if size <= length:
                    places.append((i - size + 1, k))
        close({})
        share: dict[str, float] = {}
        spans: set[tuple] = set()
        for k, found in matches.items():
            label, template, _ = self.texts[k]
            chains = chain([(end, n, at) for end, n, v in found for at in a.ends[v][k]])
            share[label] = max(share.get(label, 0.0), max(c for _, _, c in chains) / len(template))
            spans |= {(label, first, last, c, c / len(template)) for first, last, c in covered(chains, SHARE * len(template))}
        base = {self.texts[k][0] for _, k in places}
        labels = base | {label for label, s in share.items() if s >= SHARE}
        score = max([1.0 if places else 0.0, *share.values()])
        at = [p for p, _ in places]
        return (len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
                min(1.0, score), [dict(zip(("label", "first_word", "last_word", "covered", "share"), s, strict=True)) for s in sorted(spans)])


def chain(matches: list[tuple[int, int, int]], gap: int | None = None) -> list[tuple[int, int, int]]:
    """The best chain that ends with each match: (first word, last word, template words covered).

    ``matches``: (last word in the text, words, last word in the template).
    A chain rises in text and template and skips at most ``gap`` words of text
    between neighbours; where these overlap, the later one counts for the words
    it adds.  The matches within reach of one are bounded by the template.
    """
    gap = GAP if gap is None else gap
    matches = sorted(matches)
    out: list[tuple[int, int, int]] = []
    low = 0
    longest = max(n for _, n, _ in matches)
    for i, (end, n, at) in enumerate(matches):
        best = (n, end - n + 1)
        while matches[low][0] < end - longest - gap:
            low += 1
        for j in range(low, i):
            e, _, t = matches[j]
            if e < end and t < at and end - n - e <= gap:
                c = out[j][2] + n - max(0, e - (end - n), t - (at - n))
                best = max(best, (c, out[j][0]))
        out.append((best[1], end, best[0]))
    return out


def covered(chains: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """Chains of at least ``least`` words, the widest cover first, none overlapping another."""
    out: list[tuple[int, int, int]] = []
    taken: list[int] = []  # first and last words of the chosen spans, in order
    for first, last, c in sorted((x for x in chains if x[2] >= least), key=lambda x: (-x[2], x[0], x[1])):
        p = bisect_left(taken, first)
        if p % 2 == 0 and p == bisect_right(taken, last):
            taken[p:p] = [first, last]
            out.append((first, last, c))
    return out


@lru_cache(maxsize=4)
def _scanner(templates: tuple, base: tuple) -> Scanner:
    return Scanner(dict(templates), dict(base))


def scan_licences(documents: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    spans (label, first and last word, template words covered, their share) of every whole text."""
    t, b = tuple((templates or TEMPLATES).items()), tuple((base or BASE).items())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = _scanner(t, b)
        for pdf in batches:
            got = pd.DataFrame([s.scan(x) for x in pdf["text"]], columns=[
                "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
            got = got.astype({"first_word": "Int64", "last_word": "Int64", "score": "float64"})
            got.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield got.astype({"doc_id": "Int64"})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInPandas(scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                  "base_labels string, labels string, score double, "
                                  "spans array<struct<label:string,first_word:bigint,last_word:bigint,covered:bigint,share:double>>")
