"""License scan by conditional compression.

1. All that stands within reach of a hint, as many words on each side as the longest template
   has, is cut into candidate blocks of bounded size. Blocks overlap by more than the longest
   template, so every statement lies whole in the block that it begins in the first part of.
2. A block is compressed with zstandard, alone and with every template as raw dictionary.
   Templates are ranked by the bytes they save; one that saves less than ``MIN_SAVING`` of what
   it saves of its own wording is out.
3. The winners are confirmed in that order by exact differences in wording: few words may
   differ, and none that tells licenses apart (names, versions, clauses). Of confirmed places
   that overlap, the one whose template saves most bytes of it stays, then the better ranked.

A block costs the same wherever it stands, so a text takes time in proportion to its length,
however often it repeats a statement.

Defined results: a null or empty text has no blocks. Of templates that save alike the
first by name comes first. A text may state several licenses, or one repeatedly; all are
reported in order. Rows may repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

MIN_SAVING = 0.3
MAX_CHANGED = 0.2

# Wordings of public license statements.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        'this software and associated documentation files (the "Software"), to deal in '
        "the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. Neither "
        "the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, "
        "OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
        "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY "
        "OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. Neither "
        "the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, "
        "are permitted provided that the following conditions are met: Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution. THIS "
        'SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
        "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
        "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies.",
    ),
    ("ISC", "Released under the ISC License."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
        "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
        "at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
        "2.0.",
    ),
    (
        "GPL-2.0",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "LGPL-2.1",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 2.1 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
)
#: Words that tell one license from another; a difference in one of them rejects a template.
TELLING = frozenset(
    "0 1 2 3 4 affero agpl apache attribution bsd by cc cc0 clause commons creative domain gnu "
    "general gpl isc later lesser lgpl mit mozilla mpl nc nd noncommercial noderivatives only "
    "permission public sa sharealike free foundation version".split()
)

_HINT = (
    r"(?i)licen[sc]e|spdx|copyright|public\s+domain|creative\s+commons|\bcc[ -]by|\bcc0\b"
    r"|permission\s+is\s+hereby|free\s+software|redistributions?\b|permission\s+to\s+use"
)
_HINTED = re.compile(_HINT)
_WORD = re.compile(r"[^\W_]+")
_CLOSING = re.compile(r"[.!?)\"']*")

FOUND = "array<struct<license:string,start:int,end:int,saving:double,changed:int>>"


def blocks(text: str, templates=TEMPLATES) -> list[tuple[int, int]]:
    """Ranges of text of the candidate blocks."""
    return [(words[0][1], words[-1][2]) for words, _ in _placed(text, templates)]


def _placed(text: str, templates) -> list[tuple[list[tuple[str, int, int]], int]]:
    """Candidate blocks: words in small letters with their places, and how many may begin one.

    A statement that begins among these is in the block to its end.
    """
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    longest = max((len(t.words) for t in _templates(templates)), default=0)
    starts, ends = [w[1] for w in words], [w[2] for w in words]
    ranges: list[list[int]] = []
    for hint in _HINTED.finditer(text):
        low = max(0, bisect_right(ends, hint.start()) - longest)
        high = min(len(words), bisect_left(starts, hint.end()) + longest)
        if ranges and low <= ranges[-1][1]:
            ranges[-1][1] = max(high, ranges[-1][1])
        else:
            ranges.append([low, high])
    found, more = [], int(longest * (1 + MAX_CHANGED)) + 1
    for low, high in ranges:
        while low < high:
            own = longest if high - low > longest + more else high - low
            found.append((words[low : min(low + own + more, high)], own))
            low += own
    return found


@dataclass
class _Template:
    license: str
    words: list[str]
    compressor: zstandard.ZstdCompressor
    own: int  # bytes that it saves of its own wording
    most: int  # how many words may differ
    run: int  # so many words in a row are then left unchanged somewhere
    runs: dict[tuple[str, ...], list[int]]  # where they stand in the template


#: Fixed, as zstandard would choose by size, and choose other ones beside a dictionary.
_PARAMETERS = zstandard.ZstdCompressionParameters(
    window_log=17,
    chain_log=16,
    hash_log=15,
    search_log=6,
    min_match=3,
    target_length=64,
    strategy=zstandard.STRATEGY_BTOPT,
    write_content_size=False,
    write_checksum=False,
    write_dict_id=False,
)


def _compressor(dictionary: str | None) -> zstandard.ZstdCompressor:
    if dictionary is None:
        return zstandard.ZstdCompressor(compression_params=_PARAMETERS)
    raw = zstandard.ZstdCompressionDict(
        dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(dict_data=raw, compression_params=_PARAMETERS)


def _plain(text: str) -> str:
    return " ".join(text.lower().split())


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=4)
def _templates(templates: tuple[tuple[str, str], ...]) -> list[_Template]:
    ordered = sorted(templates)
    known = []
    for name, text in ordered:
        words, packer = _words(text), _compressor(_plain(text))
        most = int(MAX_CHANGED * len(words))
        run = max(1, (len(words) - most) // (most + 1))
        runs: dict[tuple[str, ...], list[int]] = {}
        for place in range(len(words) - run + 1):
            runs.setdefault(tuple(words[place : place + run]), []).append(place)
        plain = _plain(text).encode()
        own = len(_compressor(None).compress(plain)) - len(packer.compress(plain))
        known.append(_Template(name, words, packer, own, most, run, runs))
    return known


def _saved(window: str, template: _Template) -> tuple[int, float]:
    """Bytes that the template saves of a window, and their share."""
    plain = _plain(window).encode()
    alone = len(_compressor(None).compress(plain))
    saved = alone - len(template.compressor.compress(plain))
    return saved, saved / alone


def differences(words: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that the block lacks, and words it has in their place.

    What stands before the first common word and after the last belongs to other prose.
    """
    return _aligned(words, block)[:2]


def _aligned(words: list[str], block: list[str]) -> tuple[list[str], list[str], int, int]:
    """``differences``, and where the first common word is and the last one ends."""
    matcher = SequenceMatcher(None, words, block, autojunk=False)
    same = [match for match in matcher.get_matching_blocks() if match.size]
    if not same:
        return list(words), [], 0, 0
    lacking, extra, a, b = [], [], 0, same[0].b
    for match in same:
        lacking += words[a : match.a]
        extra += block[b : match.b]
        a, b = match.a + match.size, match.b + match.size
    return lacking + words[a:], extra, same[0].b, b


def _windows(template: _Template, words: list[str]) -> list[tuple[int, int, int]]:
    """Ranges of ``words`` that have the template's wording, with the number of changes.

    A range that is close enough has a run of unchanged words. Each of those that the template
    has says where the range would begin; places that alignment allows for are tried once.
    """
    size, most, found = len(template.words), template.most, []
    tried: set[int] = set()
    for place in range(len(words) - template.run + 1):
        for offset in template.runs.get(tuple(words[place : place + template.run]), ()):
            start = place - offset
            if any(one in tried for one in range(start - most // 2, start + most // 2 + 1)):
                continue
            tried.add(start)
            begin, end = max(0, start - most), min(len(words), start + size + most)
            lacking, extra, first, last = _aligned(template.words, words[begin:end])
            changed = len(lacking) + len(extra)
            if changed <= most and not TELLING.intersection(lacking + extra):
                found.append((changed, begin + first, begin + last))
    chosen: list[tuple[int, int, int]] = []
    for changed, first, last in sorted(found):
        if all(last <= low or high <= first for low, high, _ in chosen):
            chosen.append((first, last, changed))
    return sorted(chosen)


def identify(text: str, templates=TEMPLATES) -> list[tuple[str, int, int, float, int]]:
    """License, start, end, saving and number of changed words of what is confirmed."""
    return _identify(text, _placed(text, templates), templates)


def _ranked(plain: bytes, templates) -> list[tuple[int, int, _Template]]:
    """Templates that save enough of a block, the one that saves most first."""
    alone, ranked = len(_compressor(None).compress(plain)), []
    for place, template in enumerate(_templates(templates)):
        saved = alone - len(template.compressor.compress(plain))
        if saved > 0 and saved >= MIN_SAVING * template.own:
            ranked.append((-saved, place, template))
    return sorted(ranked, key=lambda one: one[:2])


def _identify(text: str, placed, templates) -> list[tuple[str, int, int, float, int]]:
    found: list[tuple[str, int, int, float, int]] = []
    for block, own in placed:
        words = [word for word, _, _ in block]
        plain = _plain(text[block[0][1] : block[-1][2]]).encode()
        # what earlier blocks found may reach into this one
        taken = [one for one in found[-len(words) :] if one[2] > block[0][1]]
        before, confirmed = len(taken), []
        for rank, (_, _, template) in enumerate(_ranked(plain, templates)):
            for first, last, changed in _windows(template, words):
                start, end = block[first][1], block[last - 1][2]
                if first < own:
                    saved, share = _saved(text[start:end], template)
                    confirmed.append((-saved, rank, start, end, template.license, share, changed))
        for _, _, start, end, name, share, changed in sorted(confirmed):
            if all(end <= one[1] or one[2] <= start for one in taken):
                end = _CLOSING.match(text, end).end()
                taken.append((name, start, end, share, changed))
        found += sorted(taken[before:], key=lambda one: one[1])
    return found


_FOUND = pa.list_(
    pa.struct(
        [
            ("license", pa.string()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("saving", pa.float64()),
            ("changed", pa.int32()),
        ]
    )
)


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``docs`` with ``_blocks`` (how many candidates) and ``_licenses`` (those confirmed)."""

    names = ("license", "start", "end", "saving", "changed")

    def look(batches):
        for batch in batches:
            column = batch.column(text)
            hint = pc.match_substring_regex(column, _HINT).fill_null(False)
            counts, found = [0] * len(column), [[]] * len(column)
            for row in pc.indices_nonzero(hint).to_pylist():
                body = column[row].as_py()
                placed = _placed(body, templates)
                counts[row] = len(placed)
                found[row] = [dict(zip(names, one)) for one in _identify(body, placed, templates)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(found, _FOUND)],
                [*batch.schema.names, "_blocks", "_licenses"],
            )

    out = docs.drop("_blocks", "_licenses")
    added = StructType.fromDDL(f"_blocks long, _licenses {FOUND}")
    return out.mapInArrow(look, StructType([*out.schema, *added]))
