"""Licence scans: texts against licence templates by the Dice coefficient of word bigrams.

A document's units are its lines, its paragraphs of several lines and, if it has several
paragraphs, its whole text.  Unit and template are normalised (ASCII letters and digits, lower
case) and compared as bags of word bigrams, a single word counting as a bigram with nothing:
dice = 2 |A n B| / (|A| + |B|).  A template can reach the threshold t only if its size is within
t / (2 - t) times the unit's and the inverse, so most units meet few templates or none; units
without any bigram of the templates are passed over.

Templates also stand inside longer lines and across lines and paragraphs: every stretch of words
that begins and ends with a bigram of a template is a unit too, where the size bound and the
number of the template's bigrams allow the threshold.  Of stretches that overlap, the one with
most common bigrams counts; one that overlaps a hit of at least half its words does not count
again.  Templates of one word are compared with whole units only.

Null and empty texts have no units.  Ties of a document's best match go to the template named
first.  Rows are judged one by one.  Templates are a parameter; they are broadcast, and more
than ``TEMPLATE_BYTES`` of text in them is an error.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
TEMPLATE_BYTES = 16 << 20
_WORD = re.compile(r"[a-z0-9]+")
OUT = "doc_id long, licence string, dice double, n_matches long, licences array<string>"

# Public licence texts and notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        'provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" '
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}


def bigrams(text: str) -> Counter:
    """The bag of word bigrams of a text; one word alone pairs with nothing."""
    found = _WORD.findall(text.lower())
    return Counter(zip(found, found[1:])) if len(found) != 1 else Counter([(found[0], "")])


def units(text: str) -> list[str]:
    """Lines, paragraphs of several lines, and the text if it has several paragraphs."""
    lines = text.split("\n")
    out = [x for x in lines if x.strip()]
    paragraphs, own = [], []
    for x in (*lines, ""):
        if x.strip():
            own.append(x)
        elif own:
            paragraphs.append(own)
            own = []
    out += ["\n".join(p) for p in paragraphs if len(p) > 1]
    if len(paragraphs) > 1:
        out.append(text)
    return out


def placed(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a text, and where each of its ``units`` begins and ends among them."""
    words: list[str] = []
    lines, paragraphs, first = [], [], None
    for x in text.split("\n"):
        at = len(words)
        words += _WORD.findall(x.lower())
        if x.strip():
            lines.append((at, len(words)))
            first = len(lines) - 1 if first is None else first
        elif first is not None:
            paragraphs.append((first, len(lines)))
            first = None
    if first is not None:
        paragraphs.append((first, len(lines)))
    out = lines + [(lines[a][0], lines[b - 1][1]) for a, b in paragraphs if b - a > 1]
    if len(paragraphs) > 1:
        out.append((0, len(words)))
    return words, out


class Templates:
    def __init__(self, texts: dict[str, str], threshold: float):
        self.threshold = threshold
        self.bags = [(name, bag, sum(bag.values())) for name, text in texts.items() if (bag := bigrams(text))]
        self.known = {g for _, bag, _ in self.bags for g in bag}
        sizes = [n for _, _, n in self.bags]
        self.ratio = threshold / (2 - threshold)
        self.largest = max(sizes, default=0) / self.ratio + 1
        self.of_size: dict[int, list[int]] = {}
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, (_, bag, _) in enumerate(self.bags):
            for g in bag:
                if g[1]:
                    self.holders.setdefault(g, []).append(i)

    def candidates(self, n: int) -> list[int]:
        """Templates whose size allows the threshold for a unit of n bigrams."""
        if n > self.largest:
            return []
        found = self.of_size.get(n)
        if found is None:
            found = [i for i, (_, _, m) in enumerate(self.bags) if m >= n * self.ratio - 1e-9 and n >= m * self.ratio - 1e-9]
            self.of_size[n] = found
        return found

    def hits(self, text: str) -> list[tuple[float, int]]:
        """Coefficients and templates of the units and of the stretches inside longer ones."""
        words, places = placed(text)
        found = [(h, a, b) for a, b in places if (h := self.best(words[a:b]))]
        stretches = self.stretches(words)
        for _, dice, i, a, b in sorted(stretches, key=lambda x: (-x[0], -x[1], x[2], x[3])):
            if not any(x < b and a < y and 2 * (y - x) >= b - a for _, x, y in found):
                found.append(((dice, i), a, b))
        return [h for h, _, _ in found]

    def stretches(self, words: list[str]) -> list[tuple[int, float, int, int, int]]:
        """(common bigrams, dice, template, first word, end) of the best stretch from each bigram on."""
        at: dict[int, list[int]] = {}
        pairs = list(zip(words, words[1:]))
        for k, g in enumerate(pairs):
            for i in self.holders.get(g, ()):
                at.setdefault(i, []).append(k)
        out = []
        for i, own in at.items():
            _, bag, m = self.bags[i]
            need = math.ceil(m * self.ratio - 1e-9)  # common bigrams that the least stretch has
            longest = int(m / self.ratio + 1e-9)
            for x in range(len(own) - need + 1):
                if own[x + need - 1] - own[x] >= longest:
                    continue
                left, common, best = {}, 0, None
                for k in own[x:]:
                    size = k - own[x] + 1
                    if size > longest:
                        break
                    g = pairs[k]
                    n = left.get(g, bag[g])
                    if n:
                        left[g] = n - 1
                        common += 1
                        dice = 2 * common / (m + size)
                        if dice >= self.threshold and (best is None or dice > best[1]):
                            best = common, dice, i, own[x], k + 2
                if best:
                    out.append(best)
        return out

    def best(self, found: list[str]) -> tuple[float, int] | None:
        """The best template of a unit's words and its coefficient, if it reaches the threshold."""
        if not found:
            return None
        pairs = list(zip(found, found[1:])) or [(found[0], "")]
        candidates = self.candidates(len(pairs))
        if not candidates or self.known.isdisjoint(pairs):
            return None
        bag, best = Counter(pairs), None
        for i in candidates:
            _, own, m = self.bags[i]
            common = sum(min(n, bag[g]) for g, n in own.items() if g in bag)
            dice = 2 * common / (m + len(pairs))
            if dice >= self.threshold and (best is None or dice > best[0]):
                best = dice, i
        return best


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, its best licence or null, dice, n_matches and all licences found."""
    texts = TEMPLATES if templates is None else templates
    if sum(len(t.encode()) for t in texts.values()) > TEMPLATE_BYTES:
        raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(Templates(texts, threshold))

    def run(batches):
        known = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                hits = known.hits(text.as_py() or "")
                top = min(hits, key=lambda h: (-h[0], h[1]), default=None)
                names = [known.bags[i][0] for i in sorted({i for _, i in hits})]
                out.append((known.bags[top[1]][0] if top else None, top[0] if top else None, len(hits), names))
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds))],
                names=["doc_id", "licence", "dice", "n_matches", "licences"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, OUT)
