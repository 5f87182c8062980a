"""License texts in documents: MinHash bands over windows, then exact containment.

Templates are grouped by size: a template of s shingles has size class c, the
power of two from s up.  Windows of 2c shingles start at every c-th shingle,
so an unbroken occurrence lies whole in one of them.  Each band is one MinHash
value; a window retrieves a template when a band agrees.  The number of bands
of a class follows from the least similarity that a matching window can have,
so that a match is missed with a probability of ``MISS`` at most.  Retrieved
templates are verified: 0.8 of their shingles must stand within the length of
a window, word by word.
"""

from __future__ import annotations

import math
from bisect import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table, utf8, window_hashes, word_hashes

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-6
_SEGMENT = 1 << 20  # shingles whose windows are looked at at once

# Wordings of public licenses and of the notices that name them.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": "Released under the MIT License.",
    "mit-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software.""",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


class _Group:
    """Templates of one shingle length and size class."""

    def __init__(self, gram: int, size: int):
        self.gram, self.size = gram, size
        self.names: list[str] = []
        self.shingles: list[dict[int, tuple[bytes, ...]]] = []

    def ready(self, multipliers: np.ndarray) -> None:
        # least Jaccard similarity of a window with a template that it contains so far as is asked
        least = min(math.ceil(CONTAINED * len(s) - 1e-9) / (2 * self.size + len(s) - math.ceil(CONTAINED * len(s) - 1e-9))
                    for s in self.shingles)
        self.bands = math.ceil(math.log(MISS) / math.log(1 - least))
        keys = [np.array(list(s), np.uint64) for s in self.shingles]
        with np.errstate(over="ignore"):
            self.signatures = [[(k * m).min() for k in keys] for m in multipliers[:self.bands]]


def _word_list(data: bytes) -> list[bytes]:
    lowered = data.lower()
    starts, ends, _ = word_hashes(data)
    return [lowered[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


class Scanner:
    def __init__(self, templates: dict[str, str]):
        groups: dict[tuple[int, int], _Group] = {}
        for name, text in templates.items():
            words = _word_list(text.encode())
            if not words:
                continue
            gram = min(SHINGLE, len(words))
            h = window_hashes(word_hashes(text.encode())[2], gram)
            shingles = {int(x): tuple(words[i:i + gram]) for i, x in enumerate(h)}
            size = 1 << (len(shingles) - 1).bit_length()
            group = groups.setdefault((gram, size), _Group(gram, size))
            group.names.append(name)
            group.shingles.append(shingles)
        by_gram = defaultdict(list)
        for key in sorted(groups):
            by_gram[key[0]].append(groups[key])
        self.by_gram = dict(by_gram)
        # odd multipliers permute the hashes of the shingles
        self.multipliers = np.random.default_rng(8).integers(0, 1 << 63, 1024, np.uint64) * np.uint64(2) + np.uint64(1)
        for group in groups.values():
            group.ready(self.multipliers)

    def _retrieved(self, h: np.ndarray, groups: list[_Group]) -> set[tuple[int, int, int]]:
        """(group, template, place): a window at ``place`` has a band that equals the template's."""
        found = set()
        for band in range(max(g.bands for g in groups)):
            with np.errstate(over="ignore"):
                low = h * self.multipliers[band]
            size = 1
            for number, group in enumerate(groups):  # sizes rise
                while size < group.size:  # least of twice as many shingles
                    if len(low) % 2:
                        low = np.append(low, np.uint64(0xFFFFFFFFFFFFFFFF))
                    low = np.minimum(low[::2], low[1::2])
                    size *= 2
                if band < group.bands:
                    windows = np.append(np.minimum(low[:-1], low[1:]), low[-1])
                    for i, x in enumerate(group.signatures[band]):
                        found.update((number, i, w * size) for w in np.flatnonzero(windows == x).tolist())
        return found

    def matches(self, texts: list[bytes]) -> list[list[tuple[str, int, int, float]]]:
        """For each text (template, start, end, containment) by start; byte offsets.

        The shingles of all texts stand in one row, so windows may reach from
        one text into the next; each text that a window touches is verified
        on its own.
        """
        words = [word_hashes(t) for t in texts]
        found: list[list] = [[] for _ in texts]
        for gram, groups in self.by_gram.items():
            own = [window_hashes(h, gram) for *_, h in words]
            ends = np.cumsum([len(h) for h in own])
            row = np.concatenate(own) if own else np.zeros(0, np.uint64)
            reach = 2 * groups[-1].size
            wanted = set()
            for at in range(0, len(row), _SEGMENT):  # segments overlap by the longest window
                part = row[at:at + _SEGMENT + reach]
                for number, i, place in self._retrieved(part, groups):
                    first = int(np.searchsorted(ends, at + place, "right"))
                    last = int(np.searchsorted(ends, at + place + 2 * groups[number].size - 1, "right"))
                    wanted.update((number, i, t) for t in range(first, min(last, len(texts) - 1) + 1))
            for number, i, t in sorted(wanted):
                group, h, (starts, stops, _), lowered = groups[number], own[t], words[t], texts[t].lower()
                shingles = group.shingles[i]
                places = [p for p in np.flatnonzero(np.isin(h, np.array(list(shingles), np.uint64))).tolist()
                          if shingles[int(h[p])] == tuple(lowered[x:y] for x, y in zip(starts[p:p + gram], stops[p:p + gram]))]
                for a, b, share in _occurrences(places, h, len(shingles), 2 * group.size):
                    found[t].append((group.names[i], int(starts[a]), int(stops[b + gram - 1]), share, round(share * len(shingles))))
        return [_best(f) for f in found]


def _best(found: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float]]:
    """Where matches overlap, the one of the most shingles, then of the largest share, then by name."""
    kept: list[tuple[int, int, str, float]] = []  # apart, by start
    for name, start, end, share, _ in sorted(found, key=lambda x: (-x[4], -x[3], x[0], x[1])):
        at = bisect(kept, (start,))
        if (not at or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
            kept.insert(at, (start, end, name, share))
    return [(name, start, end, share) for start, end, name, share in kept]


def _occurrences(places: list[int], h: np.ndarray, n: int, reach: int):
    """(first, last, containment) of stretches of at most ``reach`` that hold enough of n shingles."""
    i = 0
    while i < len(places):
        j, seen, last = i, set(), i
        while j < len(places) and places[j] < places[i] + reach and len(seen) < n:
            if int(h[places[j]]) not in seen:
                seen.add(int(h[places[j]]))
                last = j
            j += 1
        if len(seen) < CONTAINED * n - 1e-9:
            i += 1
            continue
        rest = [int(h[places[k]]) for k in range(i, last + 1)]
        while rest[0] in rest[1:]:  # what comes again later is not part of it
            rest.pop(0)
            i += 1
        yield places[i], places[last], len(seen) / n
        i = last + 1


_MATCHES = T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType())]))


def scanned(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``license_matches``: template, code point range and containment, by start.

    Where matches overlap, the one with the most shingles stays.
    A null, empty or wordless text matches nothing; repeated rows give
    repeated results; a column of this name is replaced.  ``templates`` is a
    table of names and texts that the caller holds in memory.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(templates or TEMPLATES))

    def start():
        scanner = Scanner(shared.value)

        def f(texts):
            texts = [t or b"" for t in utf8(texts)]
            return [[[{"license": name, "start": len(data[:s].decode()), "end": len(data[:e].decode()), "containment": share}
                      for name, s, e, share in found] for data, found in zip(texts, scanner.matches(texts))]]
        return f

    return append_columns(docs, ["text"], [T.StructField("license_matches", _MATCHES)], start)


def op8_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License matches of every document."""
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("license_matches", lambda m: m["license"])))
    spans = F.transform("license_matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    return found.select("doc_id", F.size("license_matches").cast("long").alias("n_matches"),
                        F.concat_ws(",", names).alias("licenses"), F.concat_ws(",", spans).alias("spans"))
