"""Licence scan: TF-IDF cosine of notices to templates, then inheritance from the nearest ancestor directory.

Every line of a file (a stretch between tags, for pages) is a candidate notice. Its sparse vector has the words of the
templates and one more dimension for all other words, weighted by their frequency over all files. Where a file speaks of
licences at all, windows over all its words, across lines and tags, are candidates too: for each notice and each whole
licence text windows of its length. A file has the licence of its most similar line or window, if that is similar enough;
words that tell versions and kinds apart decide within a family. A licence file, or the index of a directory, also licenses its directory,
and a file without a notice inherits from its nearest ancestor that has one.
"""

from __future__ import annotations

import html
import math
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import text_of
from reelhouse.session import written

# fixed values: short public notices of common licences
TEMPLATES: Sequence[tuple[str, str]] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_GPL_RIGHTS = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
_GPL_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
_GPL_COPY = "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
# fixed values: headers of several sentences
HEADERS: Sequence[tuple[str, str]] = (
    ("GPL-3.0", _GPL_RIGHTS),
    ("GPL-3.0", f"{_GPL_RIGHTS} {_GPL_WARRANTY} {_GPL_COPY}"),
    ("LGPL-3.0", _GPL_RIGHTS.replace("General", "Lesser General")),
    ("LGPL-3.0", f"{_GPL_RIGHTS} {_GPL_WARRANTY} {_GPL_COPY}".replace("General", "Lesser General").replace("program", "library")),
    ("Apache-2.0", _APACHE_HEADER),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", _UNLICENSE),
)
#: Licences whose standard text lies in licence_texts/.
TEXTS = ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "Apache-2.0", "MPL-2.0", "MIT", "BSD-3-Clause", "BSD-2-Clause")
#: Only a file with one of these is searched by windows; every template has one.
_SPEAKS = re.compile(r"(?i)licen[cs]|permission|redistribution|free software|public domain")
#: Words without which a window is none of the licence, similar or not.
_NAMED = {
    "Apache-2.0": r"\bapache", "MIT": r"\bmit\b|\bpermission is hereby", "BSD-3-Clause": r"\bbsd|\bredistribution", "BSD-2-Clause": r"\bredistribution",
    "GPL-3.0": r"\bgnu\b|\bgpl", "GPL-2.0": r"\bgnu\b|\bgpl", "LGPL-3.0": r"\blesser\b|\blgpl", "LGPL-2.1": r"\blesser\b|\blgpl", "MPL-2.0": r"\bmozilla\b|\bmpl",
    "CC-BY-4.0": r"\battribution 4|\bby 4", "CC-BY-SA-4.0": r"sharealike|\bby-sa\b", "CC-BY-NC-4.0": r"\bby-nc\b|noncommercial", "Unlicense": r"\bunencumbered\b",
}
#: Templates longer than SENTENCE words are compared every eighth of their length; one that is as similar as SURE goes before sentences.
SENTENCE, SURE = 60, 0.9
LICENCE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"
DIRECTORY_INDEX = r"(?i)^$|^index\.[a-z]+$"
SIMILAR = 0.75
OTHER = ""

_WORD = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
_WORDS = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_TAGS = re.compile(r"</?[A-Za-z!][^<>]*>")
_LINES = re.compile(r"[\n\r<>]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def stream_of(text: str) -> list[str]:
    """All words, across lines and tags."""
    return words_of(html.unescape(_TAGS.sub(" ", text)))


def standard_texts() -> list[tuple[str, str]]:
    return [*HEADERS, *((n, pkgutil.get_data("reelhouse.llm", f"licence_texts/{n}.txt").decode()) for n in TEXTS)]


def in_family(name: str, words: str) -> str:
    """The member of the licence's family that the words of a notice name; without a version word the template's own."""
    if not re.match("L?GPL", name):
        return name
    if "affero" in words or "agpl" in words:
        name = "AGPL-3.0"
    elif re.search(r"\blesser\b|\blgpl", words):
        name = name if name[0] == "L" else "LGPL-3.0"
    version = re.search(r"\b(?:version |v(?:\. ?)?|l?gpl-?v?|agpl-?v?)(\d(?:\.\d)?)\b", words)
    if not version:
        return name
    number = version[1] if "." in version[1] else f"{version[1]}.0"
    return f"{name.split('-')[0]}-{number}"


def web_path(url: Column) -> Column:
    """host/directories/file of an address, without scheme, query and fragment; an address without path gets one."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"[?#].*$", "")
    return F.when(F.instr(bare, "/") > 0, bare).otherwise(F.concat(bare, F.lit("/")))


def _weights(files: DataFrame, vocabulary: list[str], more: list[str]) -> dict[str, float]:
    """Inverse document frequency of the templates' words, of those in `more` and of words outside `vocabulary`, over all files."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0)))
    known, wanted = (F.array(*[F.lit(w) for w in ws]) for ws in (vocabulary, sorted({*vocabulary, *more})))
    seen = F.concat(F.array_intersect(words, wanted), F.when(F.size(F.array_except(words, known)) > 0, F.array(F.lit(OTHER))).otherwise(F.array().cast("array<string>")))
    counts = files.select(F.explode(F.concat(F.array(F.lit("\n")), seen)).alias("word")).groupBy("word").count().collect()  # one row per template word
    found = {r["word"]: r["count"] for r in counts}
    n = found.get("\n", 0)
    return {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1 for w in [*vocabulary, *more, OTHER]}


def own_licences(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """path, file_id, own (licence or null), score (cosine of the best line or window, 0 without any) for each of `files` (file_id, path, text)."""
    bags = [Counter(words_of(t)) for _, t in templates]
    vocabulary = sorted(set().union(*bags))
    longer = [*templates, *standard_texts()]
    streams = [stream_of(t) for _, t in longer]
    wide = {w: i for i, w in enumerate(sorted(set().union(*streams)))}
    weights = _weights(files, vocabulary, list(wide))
    place = {w: i for i, w in enumerate(vocabulary)}
    rows = np.array([[bag[w] * weights[w] for w in vocabulary] for bag in bags])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    names = [n for n, _ in templates]

    wide_weights = np.array([*(weights[w] for w in wide), weights[OTHER]])
    wide_rows = np.array([np.bincount([wide[w] for w in words], minlength=len(wide) + 1) * wide_weights for words in streams])
    wide_rows /= np.linalg.norm(wide_rows, axis=1, keepdims=True)

    def in_windows(text: str) -> tuple[str | None, float]:
        words = stream_of(text)
        ids = np.array([wide.get(w, len(wide)) for w in words], dtype=np.int64)
        found = (False, 0.0, None)
        for k, (licence, _) in enumerate(longer):
            length = min(len(streams[k]), len(ids))
            if not length:
                continue
            # a window's squared counts are at least its counts, so no window is nearer than this
            sums = [np.cumsum(np.r_[0.0, x[ids]]) for x in (wide_rows[k] * wide_weights, wide_weights**2)]
            dots, squares = (x[length:] - x[:-length] for x in sums)
            near = dots >= similar * np.sqrt(squares) - 1e-9
            starts = np.arange(len(near))
            if length > SENTENCE:
                starts = np.unique(np.r_[0 : len(near) : length // 8, len(near) - 1])
            starts = starts[near[starts]]
            for at in starts.tolist():
                bag = np.bincount(ids[at : at + length], minlength=len(wide) + 1) * wide_weights
                cosine = float(wide_rows[k] @ bag / np.linalg.norm(bag))
                rank = (length > SENTENCE and cosine >= SURE, cosine)
                if cosine < similar or rank <= found[:2]:
                    continue
                said = " ".join(words[at : at + length])
                if not re.search(_NAMED.get(licence, ""), said):
                    continue
                whole = k >= len(longer) - len(TEXTS)
                if licence.startswith("BSD") and whole:
                    licence = "BSD-3-Clause" if "neither the name" in said else "BSD-2-Clause"
                elif not whole:
                    licence = in_family(licence, " ".join(words[at : at + length + 4]))
                found = (*rank, licence)
        return found[2], found[1]

    def best(text: str) -> tuple[str | None, float]:
        name, top = in_lines(text)
        if not _SPEAKS.search(text):
            return name, top
        wider, score = in_windows(text)
        return (wider, score) if wider and (name is None or score >= top - 1e-9 or score >= SURE) else (name, top)

    def in_lines(text: str) -> tuple[str | None, float]:
        top, name = 0.0, None
        for line in _LINES.split(text):
            bag = Counter(words_of(line))
            known = {w: n * weights[w] for w, n in bag.items() if w in place}
            if not known:
                continue
            inside = sum(x * x for x in known.values())
            others = sum(n for w, n in bag.items() if w not in place) * weights[OTHER]
            norm = math.sqrt(inside + others * others)
            if math.sqrt(inside) / norm < max(similar, top):  # no template can be nearer than that
                continue
            cosines = sum(rows[:, place[w]] * x for w, x in known.items()) / norm
            k = int(np.argmax(cosines))
            if cosines[k] > top:
                top, name = float(cosines[k]), in_family(names[k], " ".join(words_of(line)))
        return (name, top) if top >= similar else (None, top)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [best(t) for t in b["text"]]
            yield pd.DataFrame({"file_id": b["file_id"], "path": b["path"], "own": [x[0] for x in found], "score": [x[1] for x in found]})

    return files.mapInPandas(scan, "file_id long, path string, own string, score double")


def scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """file_id, path, licence, how ('own', 'inherited' or 'none'), score, licensed_by (a directory) for every row of `files` (file_id, path, text).

    A missing text or path counts as empty: no notice, no directory. If several files license one directory, the most similar one
    counts, then the first licence by name. Equally similar templates: the first of the list. Repeated rows come out as
    often as they stand in the table; an empty table gives none. Other columns are not looked at.
    """
    rows = files.select(F.col("file_id").cast("long").alias("file_id"), text_of("path").alias("path"), text_of().alias("text"))
    own = own_licences(rows, templates)
    directory, name = F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.regexp_extract("path", r"([^/]*)$", 1)
    own = written(own.withColumn("directory", directory).withColumn("name", name), "licences")

    licensing = own.where(F.col("own").isNotNull() & (F.col("name").rlike(LICENCE_FILE) | F.col("name").rlike(DIRECTORY_INDEX)))
    first = F.min(F.struct((-F.col("score")).alias("s"), "own"))
    licensed = licensing.groupBy(F.col("directory").alias("ancestor")).agg(first.alias("best")).select("ancestor", F.col("best.own").alias("inherited"))

    parts = F.split("directory", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("ancestor")))
    above = own.where("own is null").select("directory").distinct().select("directory", F.explode(ancestors).alias("x")).select("directory", "x.depth", "x.ancestor")
    nearest = above.join(licensed, "ancestor").groupBy("directory").agg(F.max(F.struct("depth", "ancestor", "inherited")).alias("near"))

    found = own.join(nearest, "directory", "left")
    how = F.when(F.col("own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return found.select(
        "file_id", "path", F.coalesce("own", "near.inherited").alias("licence"), how.alias("how"), "score",
        F.when(F.col("own").isNull(), F.col("near.ancestor")).alias("licensed_by"),
    )
