"""License scans by a positional index of rare words.

Templates are indexed by their rarest words (highest inverse template frequency), each with its offset: as many as hold
more weight than a match may lack, so that every match has one of them in its place. The rare words of a file are looked
up there and name templates and places; postings of the template's other words are intersected at the same relative
positions, place by place, and a place counts where enough of the weight lines up and the mandatory phrases stand
verbatim. Long notices may have words put in or left out: their words count within a slack of a tenth of their length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare
from lapwise.llm.texts import ALPHANUMERIC, Words, hash_text, slices, words_of

#: Least share of a template's weight, in hundredths, that must line up in a notice; names must line up whole.
LEAST_PERCENT = 80
#: A word in so many of a notice's may be put in or left out before a place.
SLACK_WORDS = 10
#: Weights are whole numbers of this part, so that shares are exact.
WEIGHT_UNIT = 1000
#: Votes of a file whose places are looked at together; bounds the memory of a long file.
VOTES_AT_ONCE = 8192


@dataclass(frozen=True)
class Template:
    """A license's name or notice, and the label it gives.

    ``mandatory`` has groups of phrases; of every group one must stand verbatim in its place. A name (``percent`` of
    100) has to stand as it is.
    """

    label: str
    words: tuple[str, ...]
    mandatory: tuple[tuple[tuple[str, ...], ...], ...] = ()
    percent: int = 100
    base: bool = False

    @property
    def slack(self) -> int:
        return len(self.words) // SLACK_WORDS if self.percent < 100 else 0


def name(label: str, text: str, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), base=base)


def notice(label: str, text: str, *mandatory: str) -> Template:
    """A longer text, found also where it was edited. Alternatives of a mandatory phrase are parted by ``|``."""
    groups = tuple(tuple(tuple(phrase.split()) for phrase in group.split("|")) for group in mandatory)
    return Template(label, tuple(text.split()), groups, LEAST_PERCENT)


#: Names of licenses, and notices as their publishers word them.
TEMPLATES = (
    name("mit", "mit license", base=True),
    name("apache", "apache license", base=True),
    name("gpl", "general public license", base=True),
    name("apache-2.0", "apache license version 2 0"),
    name("apache-2.0", "apache license 2 0"),
    name("mit-notice", "released under the mit license"),
    name("gpl-3.0", "gnu general public license version 3"),
    name("gpl-2.0", "gnu general public license version 2"),
    name("lgpl", "gnu lesser general public license"),
    name("agpl", "gnu affero general public license"),
    name("cc-by-nc-4.0", "cc by nc 4 0"),
    name("cc-by-4.0", "cc by 4 0"),
    name("cc-by-sa-4.0", "cc by sa 4 0"),
    name("cc-by", "creative commons attribution"),
    name("cc0", "cc0 1 0 universal"),
    name("bsd", "bsd license"),
    name("mpl-2.0", "mozilla public license version 2 0"),
    name("isc", "isc license"),
    name("all-rights-reserved", "all rights reserved"),
    notice(
        "mit-notice",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "permission is hereby|free of charge|any person obtaining",
    ),
    notice(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software the "
        "software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
        "in the software",
        "free of charge|to deal in the software|substantial portions of|copy modify merge publish",
    ),
    notice(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "source and binary forms|redistribution and use|with or without modification",
    ),
    notice(
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution this software is provided by the copyright holders and contributors as is and "
        "any express or implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be "
        "liable for any direct indirect incidental special exemplary or consequential damages including but not limited "
        "to procurement of substitute goods or services loss of use data or profits or business interruption however "
        "caused and on any theory of liability whether in contract strict liability or tort including negligence or "
        "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "redistributions of source code|redistributions in binary form|source and binary forms",
    ),
    notice(
        "bsd-3-clause",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution 3 neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission this software is provided by the "
        "copyright holders and contributors as is",
        "neither the name of|endorse or promote|specific prior written|nor the names of",
    ),
    notice(
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software "
        "is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
        "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
        "with or without fee|other tortious action|the author disclaims|damages whatsoever",
    ),
    notice(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
        "by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
        "apache license|www apache org|apache org licenses",
    ),
    notice(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details you should have received a copy of the gnu general public license along with "
        "this program if not see https www gnu org licenses",
        "gnu general public|general public license",
    ),
    notice(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0",
        "mozilla public license|source code form|mozilla org|of the mpl",
    ),
    notice(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely subject "
        "to the following restrictions",
        "held liable|commercial applications|alter it and redistribute|to anyone",
    ),
    notice(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means",
        "unencumbered software|the public domain|compiled binary|by any means",
    ),
    name("unlicense", "this is free and unencumbered software released into the public domain"),
)


@dataclass
class Index:
    """Words of all templates, sorted by hash, with their weights; and where templates have their rarest words."""

    templates: tuple[Template, ...] = TEMPLATES
    hashes: np.ndarray = field(init=False)
    weights: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        seen = Counter(w for t in self.templates for w in set(t.words))
        by_hash = sorted((hash_text(w), w) for w in seen)
        if len({h for h, _ in by_hash}) < len(by_hash):
            raise ValueError("two template words share a hash")
        self.hashes = np.array([h for h, _ in by_hash], dtype=np.uint64)
        number = {w: i for i, (_, w) in enumerate(by_hash)}
        weights = [round(WEIGHT_UNIT * (1 + math.log(len(self.templates) / seen[w]))) for _, w in by_hash]
        self.weights = np.array(weights, dtype=np.int64)
        self.numbered = [np.array([number[w] for w in t.words], dtype=np.int64) for t in self.templates]
        # The least weight of a match, and the weight each word of the index has in each template.
        self.least = np.array([-(-t.percent * int(self.weights[w].sum()) // 100) for t, w in self._each()], dtype=np.int64)
        self.held = np.zeros((len(seen), len(self.templates)))
        for t, words in enumerate(self.numbered):
            np.add.at(self.held[:, t], words, self.weights[words])
        # Groups of phrases: for each phrase where it stands in the template, and its words.
        self.phrases = [
            [[(_offsets(t.words, phrase), np.array([number.get(w, -1) for w in phrase])) for phrase in group] for group in t.mandatory]
            for t in self.templates
        ]
        if any(not offsets for groups in self.phrases for group in groups for offsets, _ in group):
            raise ValueError("a mandatory phrase is not in its template")
        rare = sorted((word, t, offset) for t in range(len(self.templates)) for word, offset in self._rarest(t))
        self.rare_word, self.rare_template, self.rare_offset = np.array(rare, dtype=np.int64).reshape(-1, 3).T

    def _each(self):
        return zip(self.templates, self.numbered, strict=True)

    def _rarest(self, t: int) -> list[tuple[int, int]]:
        """The rarest words of a template, with offsets, that together weigh more than a match may lack."""
        words, out = self.numbered[t], []
        lacking = int(self.weights[words].sum() - self.least[t])
        for i in sorted(range(len(words)), key=lambda i: (-self.weights[words[i]], i)):
            out.append((int(words[i]), i))
            lacking -= int(self.weights[words[i]])
            if lacking < 0:
                break
        return out

    def places(self, found: FoundWords, t: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the places hold the template, and the weight of it found there."""
        template, words = self.templates[t], self.numbered[t]
        weight = self.weights[words]
        slack, left = template.slack, int(weight.sum())
        lined = np.zeros(len(starts), dtype=np.int64)
        # Rarest first; a place goes as soon as the words to come can not bring it up to the least weight.
        for i in sorted(range(len(words)), key=lambda i: (-weight[i], i)):
            lined += weight[i] * found.near(words[i], starts + i, slack)
            left -= int(weight[i])
            keep = lined + left >= self.least[t]
            if not keep.all():
                starts, lined = starts[keep], lined[keep]
            if not len(starts):
                return starts, lined
        for group in self.phrases[t]:
            stands = np.zeros(len(starts), dtype=bool)
            for offsets, phrase in group:
                at = found.phrase(phrase)
                for offset in offsets:
                    stands |= _near(at, starts + offset, slack)
            starts, lined = starts[stands], lined[stands]
        return starts, lined

    def apart(self, found: FoundWords, t: int, starts: np.ndarray, lined: np.ndarray):
        """Of sorted places nearer to one another than the template is long, the best: most weight, then most of it without
        slack, then first."""
        words = self.numbered[t]
        straight = np.zeros(len(starts), dtype=np.int64)
        for i, word in enumerate(words):
            straight += self.weights[word] * found.near(word, starts + i, 0)
        kept: list[int] = []
        taken = np.zeros(len(starts), dtype=bool)
        for j in np.lexsort((starts, -straight, -lined)):
            if not taken[j]:
                kept.append(j)
                low, high = np.searchsorted(starts, [starts[j] - len(words) + 1, starts[j] + len(words)])
                taken[low:high] = True
        kept.sort()
        return starts[kept], lined[kept]


def _offsets(words: tuple[str, ...], phrase: tuple[str, ...]) -> list[int]:
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def _near(sorted_positions: np.ndarray, wanted: np.ndarray, slack: int) -> np.ndarray:
    """Whether a position lies within ``slack`` of each wanted one."""
    low = np.searchsorted(sorted_positions, wanted - slack)
    high = np.searchsorted(sorted_positions, wanted + slack, side="right")
    return high > low


class FoundWords:
    """Positions in one file of each word of the index: its postings."""

    def __init__(self, number: np.ndarray, position: np.ndarray):
        order = np.argsort(number, kind="stable")
        self.number, self.position = number[order], position[order]

    def of(self, word: int) -> np.ndarray:
        low, high = np.searchsorted(self.number, [word, word + 1])
        return self.position[low:high]

    def near(self, word: int, wanted: np.ndarray, slack: int) -> np.ndarray:
        return _near(self.of(word), wanted, slack)

    def phrase(self, words: np.ndarray) -> np.ndarray:
        """Positions at which the words stand one after another: postings intersected by relative position."""
        at = self.of(words[0])
        for i, word in enumerate(words[1:], 1):
            at = at[_near(self.of(word), at + i, 0)]
        return at


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "matches array<struct<label string, first_word long, n_words long, share double>>"
)


def license_scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: Iterable[Template] = TEMPLATES
) -> DataFrame:
    """Per row: its id, the license names and notices found in the whole text, and what sums them up.

    ``n_words`` words of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case;
    ``n_base`` places of base phrases, ``first_word`` and ``last_word`` the smallest and largest of their starts
    (null without any), ``base_labels`` and ``labels`` distinct, sorted and comma-joined (empty without any),
    ``score`` the best share of a template that lined up (0 without any). ``matches`` has every place, of notices those
    at least their length apart; one that starts before the text does is at 0. Null and empty texts have no words. Ids
    may be null or repeat; every row is scanned on its own. Other columns are ignored, an empty table gives an empty
    result.
    """
    prepare(docs.sparkSession)
    index = Index(tuple(templates))
    kind = docs.schema[id_column].dataType.simpleString()
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = docs.mapInArrow(lambda batches: _scan(batches, index), f"id {kind}, {SCHEMA}")
    return found.withColumnRenamed("id", id_column)


def _scan(batches, index: Index):
    matches_type = pa.list_(
        pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())])
    )
    for batch, texts in slices(batches, "text"):
        words = words_of(texts, ALPHANUMERIC)
        summed = [_summary(index, found) for found in find_templates(words, index)]
        n_base, first, last, base, labels, score, matches = zip(*summed, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("id")),
                pa.array(words.counts, pa.int64()),
                pa.array(n_base, pa.int64()),
                pa.array(first, pa.int64()),
                pa.array(last, pa.int64()),
                pa.array(base, pa.string()),
                pa.array(labels, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(matches, matches_type),
            ],
            names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
        )


def find_templates(words: Words, index: Index) -> list[list[tuple[int, int, float]]]:
    """Per row: template, first word and share of each match."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(words.bounds) - 1)]
    number = np.searchsorted(index.hashes, words.hash)
    number[number == len(index.hashes)] = 0
    known = np.flatnonzero(index.hashes[number] == words.hash) if len(words.hash) else np.zeros(0, dtype=np.int64)
    number, bounds = number[known], np.searchsorted(known, words.bounds)
    row = np.repeat(np.arange(len(out)), np.diff(bounds))
    position = known - words.bounds[row]

    # Rows and templates that a rare word brings together, unless the words of the row, wherever they stand, weigh too
    # little for the template.
    n_words, n_templates = index.held.shape
    has = np.zeros((len(out), n_words))
    has[row, number] = 1
    rare = np.zeros((n_words, n_templates))
    rare[index.rare_word, index.rare_template] = 1
    proposed = (has @ rare > 0) & (has @ index.held >= index.least)
    for r in np.flatnonzero(proposed.any(axis=1)):
        found = FoundWords(number[bounds[r] : bounds[r + 1]], position[bounds[r] : bounds[r + 1]])
        for t in np.flatnonzero(proposed[r]):
            for start, share in _matches(index, found, int(t)):
                out[r].append((int(t), start, share))
    return out


def _matches(index: Index, found: FoundWords, t: int) -> list[tuple[int, float]]:
    """Matches of a template in a file: its rare words name the places, a bounded number of them at a time."""
    slack, of_template = index.templates[t].slack, index.rare_template == t
    rare = zip(index.rare_word[of_template].tolist(), index.rare_offset[of_template].tolist(), strict=True)
    votes = np.unique(np.concatenate([found.of(word) - offset for word, offset in rare]))
    around = np.arange(-slack, slack + 1)
    good: dict[int, int] = {}
    for first in range(0, len(votes), VOTES_AT_ONCE):
        named = np.unique((votes[first : first + VOTES_AT_ONCE, None] + around).ravel())
        starts, lined = index.places(found, t, named)
        good.update(zip(starts.tolist(), lined.tolist(), strict=True))
    starts = np.array(sorted(good), dtype=np.int64)
    lined = np.array([good[s] for s in starts.tolist()], dtype=np.int64)
    if slack:
        starts, lined = index.apart(found, t, starts, lined)
    total = int(index.weights[index.numbered[t]].sum())
    return [(s, x / total) for s, x in zip(starts.tolist(), lined.tolist(), strict=True)]


def _summary(index: Index, found: list[tuple[int, int, float]]):
    base = [(start, index.templates[t].label) for t, start, _ in found if index.templates[t].base]
    starts = [start for start, _ in base]
    return (
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in base})),
        ",".join(sorted({index.templates[t].label for t, _, _ in found})),
        max((share for _, _, share in found), default=0.0),
        [
            {"label": index.templates[t].label, "first_word": max(start, 0), "n_words": len(index.templates[t].words), "share": share}
            for t, start, share in found
        ],
    )
