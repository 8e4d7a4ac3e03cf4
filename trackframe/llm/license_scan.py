"""Licence scan: spans of normalised lines compared to licence templates by Dice over word bigrams.

Normalised text is lower-case ASCII letters and digits with single blanks. A unit is a line with words, or
a span of several such lines that follow one another (empty lines between don't count), so a licence is
found as lines, blocks or several paragraphs inside a longer text. A unit is the set of its neighbouring
word pairs, those across line ends included. With ``n`` pairs in a unit, ``m`` in a template and ``c`` in
both, Dice is ``2c / (n + m)``. Bounds prune, and only a longer span than the second says is no unit:

* ``c`` is at most ``n`` and must be ``m t / (200 - t)`` or more at the threshold ``t``, so a template is
  compared only with documents that have as many of its pairs, and only near places that have;
* a span of several lines has at most ``M (200 - t) / t`` neighbouring words, of ``M`` in the template;
* a span begins and ends with lines in which a pair of the template begins and ends: others are no better.

One row per document and licence that reach the threshold, with the best Dice (as integers ``2c`` and
``n + m``, of equal shares the larger) and the number of units that reach it. A licence that begins or ends
amid a long line is found only if the whole lines reach the threshold. Null, empty and one-word texts have
no pairs and match nothing. Texts are scanned whole, one after the other, in time that grows with their
length times the size of templates they resemble. Rows without an id and repeated rows are scanned like
others; other columns are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from trackframe.llm.common import texts
from trackframe.llm.words import slices

# Percent of the Dice coefficient that counts as a match.
THRESHOLD = 80

# The disclaimer of the BSD licences as published.
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission."
)

# Notices and short licences as their stewards publish them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the "
        "GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
    "BSD-2-Clause": (_BSD_CONDITIONS, f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    "BSD-3-Clause": (f"{_BSD_CONDITIONS} {_BSD_ENDORSEMENT}", f"{_BSD_CONDITIONS} {_BSD_ENDORSEMENT} {_BSD_DISCLAIMER}"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
        "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large "
        "and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more "
        "information, please refer to <https://unlicense.org/>",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.",
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0.",
    ),
    "proprietary": ("All rights reserved.",),
}

_OTHER = re.compile(rb"[^0-9a-z]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return _OTHER.sub(b" ", raw.translate(_LOWER)).split()


def pairs_of(words: list[bytes]) -> frozenset:
    return frozenset(zip(words, words[1:]))


class Scanner:
    """Templates sorted by size; those with more pairs than a document can match are a slice that is left out."""

    def __init__(self, templates: dict[str, tuple[str, ...]], threshold: int):
        if not 0 < threshold <= 100:
            raise ValueError("the threshold is a percentage above 0")
        self.threshold = threshold
        known = [(w, name) for name, list_ in templates.items() for t in list_ if len(w := words_of(t.encode("utf-8"))) > 1]
        self.templates = sorted(((len(pairs_of(w)), len(w) - 1, name, pairs_of(w)) for w, name in known), key=lambda x: x[:3])
        self.sizes = [x[0] for x in self.templates]
        self.owners: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
        for i, template in enumerate(self.templates):
            for pair in template[3]:
                self.owners[pair].append(i)

    def scan(self, raw: bytes) -> dict[str, tuple[int, int, int]]:
        """Licence to ``2c`` and ``n + m`` of its best unit, and the number of units."""
        t = self.threshold
        lines = [w for line in raw.split(b"\n") if (w := words_of(line))]
        words = [w for line in lines for w in line]
        pairs = list(zip(words, words[1:]))
        distinct = set(pairs)
        common = Counter(i for pair in distinct & self.owners.keys() for i in self.owners[pair])
        if not common:
            return {}
        ends = [0]
        for line in lines:
            ends.append(ends[-1] + len(line))
        best: dict[str, tuple[int, int]] = {}
        units: dict[str, set[tuple[int, int]]] = defaultdict(set)
        for i in range(bisect_right(self.sizes, len(distinct) * (200 - t) // t)):
            m, _, name, _ = self.templates[i]
            if common[i] * (200 - t) < t * m:
                continue
            for unit, twice, both in self.spans(i, pairs, ends):
                units[name].add(unit)
                if name not in best or (twice * best[name][1], twice) > (best[name][0] * both, best[name][0]):
                    best[name] = (twice, both)
        return {name: (*best[name], len(units[name])) for name in best}

    def spans(self, template: int, pairs: list[tuple[bytes, bytes]], ends: list[int]) -> Iterator[tuple[tuple[int, int], int, int]]:
        """Units that reach the threshold with a template: first and last line, ``2c`` and ``n + m``; line ``i`` ends before ``ends[i + 1]``."""
        m, most, _, own = self.templates[template]
        t = self.threshold
        longest = most * (200 - t) // t
        hits = [p for p, pair in enumerate(pairs) if pair in own]
        lasts = {bisect_right(ends, p + 1) - 1 for p in hits}
        for first in sorted({bisect_right(ends, p) - 1 for p in hits}):
            begin = ends[first]
            reach = max(begin + longest, ends[first + 1] - 1)
            if (bisect_left(hits, reach) - bisect_left(hits, begin)) * (200 - t) < t * m:
                continue  # too few pairs of the template from here on
            seen: set[tuple[bytes, bytes]] = set()
            common, at = 0, begin
            for last in range(first, len(ends) - 1):
                end = ends[last + 1] - 1
                if last > first and end - begin > longest:
                    break
                for pair in pairs[at:end]:
                    if pair not in seen:
                        seen.add(pair)
                        common += pair in own
                at = end
                if last in lasts and 200 * common >= t * (len(seen) + m):
                    yield (first, last), 2 * common, len(seen) + m


def scan_licences(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``licence``, ``twice_common``, ``both_sizes``, ``dice`` and ``n_units``, without a shuffle."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in slices(batches):
            rows = [
                (doc, name, twice, both, round(twice / both, 6), count)
                for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
                for name, (twice, both, count) in sorted(scanner.scan(raw).items())
            ]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "licence", "twice_common", "both_sizes", "dice", "n_units"]
            )

    schema = "doc_id long, licence string, twice_common long, both_sizes long, dice double, n_units long"
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NORMAL = "string_split(trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z]+', ' ', 'g')), ' ')"
SQL = f"""
with d as (select row_number() over () as no, doc_id, text from documents where text is not null),
ln as (select no, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from d),
lw as (select no, i, {_NORMAL.format("line")} as w from ln),
l as (select no, i, w, sum(len(w)) over (partition by no order by i) as last from lw where w[1] <> ''),
wd as (select no, i, unnest(w) as word, last - len(w) + generate_subscripts(w, 1) as p from l),
pr as (select no, p, i, lead(i) over o as i2, word || ' ' || lead(word) over o as pair from wd window o as (partition by no order by p)),
tw as (
    select row_number() over () as tid, licence, {_NORMAL.format("template")} as w from (values
        {", ".join(f"({_quoted(name)}, {_quoted(t)})" for name, list_ in TEMPLATES.items() for t in list_)}) as v(licence, template)),
t as (
    select tid, licence, len(w) - 1 as most, list_distinct(list_transform(list_zip(w[:-2], w[2:]), lambda x: x[1] || ' ' || x[2])) as own
    from tw),
tp as (select tid, len(own) as m, unnest(own) as pair from t),
h as (select pr.no, tp.tid, tp.m, pr.pair, pr.i, pr.i2 from pr join tp on tp.pair = pr.pair),
c as (select no, tid from h group by no, tid, m having count(distinct pair) * (200 - {THRESHOLD}) >= {THRESHOLD} * m),
b as (select distinct h.no, h.tid, h.i from h join c on c.no = h.no and c.tid = h.tid),
e as (select distinct h.no, h.tid, h.i2 from h join c on c.no = h.no and c.tid = h.tid),
pl as (select no, list(pair order by p) as pairs from pr where pair is not null and no in (select no from c) group by no),
u as (
    select b.no, t.licence, t.own, b.i, e.i2, list_distinct(pl.pairs[x.last - len(x.w) + 1 : y.last - 1]) as pairs
    from b join e on e.no = b.no and e.tid = b.tid and e.i2 >= b.i join t on t.tid = b.tid join pl on pl.no = b.no
    join l x on x.no = b.no and x.i = b.i join l y on y.no = e.no and y.i = e.i2
    where b.i = e.i2 or (y.last - x.last + len(x.w) - 1) * {THRESHOLD} <= t.most * (200 - {THRESHOLD})),
m as (select no, licence, i, i2, 2 * len(list_intersect(pairs, own)) as twice_common, len(pairs) + len(own) as both_sizes from u),
r as (select * from m where 100 * twice_common >= {THRESHOLD} * both_sizes),
f as (select *, row_number() over (partition by no, licence order by twice_common / both_sizes desc, twice_common desc) as nth from r)
select any_value(d.doc_id) as doc_id, licence, max(twice_common) filter (nth = 1) as twice_common, max(both_sizes) filter (nth = 1) as both_sizes,
       round(max(twice_common / both_sizes) filter (nth = 1), 6) as dice, count(distinct (i, i2)) as n_units
from f join d on d.no = f.no group by f.no, licence"""
