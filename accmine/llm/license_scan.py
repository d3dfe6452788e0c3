"""License scans by patience alignment of texts with notice templates.

A template's words are found in a text by anchors: words that occur exactly once in both. The longest
increasing subsequence of the anchors is kept, and the gaps between them are aligned again in the same way,
after equal words at either end of a gap are matched. Coverage is the share of template words aligned.

A text is scanned whole: every place where a window of one and a half template lengths holds enough template
words for the required coverage (a bound that no alignment can pass) is aligned; accepted spans do not
overlap for one template, and of overlapping spans of several templates the one with most aligned words stays.

Defined cases: null or word-less texts have no finding; words are runs of letters, digits and non-ASCII
characters, lower-cased A-Z, so punctuation and line ends do not matter; ties between templates go to the
greater coverage, then to the smaller name; repeated rows are scanned each for itself; other columns are kept,
and if one is named like ``out_col`` the new one gets an underscore behind its name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_pieces
from .decontaminate import bench_words

MIN_COVERAGE = 0.8
STRETCH = 1.5             # window length, in template lengths
TEMPLATE_BYTES = 32 << 20 # text of a templates table, at most

# Public notice texts (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                          "provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                      "or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (ordered by the first) whose seconds increase: patience sorting."""
    tops, pile_of, back = [], [], []
    for k, (_, y) in enumerate(pairs):
        p = bisect_left(tops, y)
        if p == len(tops):
            tops.append(y)
            pile_of.append(k)
        else:
            tops[p], pile_of[p] = y, k
        back.append(pile_of[p - 1] if p else -1)
    out, k = [], pile_of[-1] if pile_of else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of equal words, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: k for k, w in enumerate(b[b0:b1], b0)}
        anchors = increasing([(k, place[w]) for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and in_b.get(w) == 1])
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(out)


def load_templates(table: DataFrame, name_col: str = "name", text_col: str = "text", max_bytes: int = TEMPLATE_BYTES) -> dict[str, str]:
    """Templates from a table (null names or texts are passed over; of a name's rows the longest text, then the
    greatest, counts). The table goes to every worker, so one of more than ``max_bytes`` of text is refused."""
    rows = table.where(F.col(name_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(name_col).alias("n"), F.col(text_col).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"{size} bytes of templates, at most {max_bytes} are broadcast")
    return {r.n: r.t for r in sorted(rows.collect(), key=lambda r: (len(r.t), r.t))}


def prepare(templates: dict[str, str]):
    """(vocabulary, [(name, word codes, which codes are in it)]); code 0 is any other word."""
    vocab: dict[bytes, int] = {}
    coded = [(n, [vocab.setdefault(w, len(vocab) + 1) for w in bench_words(t.encode())]) for n, t in sorted(templates.items())]
    out = []
    for name, words in coded:
        if words:
            member = np.zeros(len(vocab) + 1, bool)
            member[words] = True
            out.append((name, words, member))
    return vocab, out


def scan_words(code: np.ndarray, templates, min_coverage: float, stretch: float) -> list[tuple]:
    """(name, coverage, first word, end word) of the notices in one text's word codes."""
    found = []
    for name, words, table in templates:
        need = int(np.ceil(len(words) * min_coverage))
        member = table[code]
        total = np.zeros(len(code) + 1, np.int32)
        np.cumsum(member, dtype=np.int32, out=total[1:])
        if total[-1] < need:
            continue
        length = int(np.ceil(len(words) * stretch))
        stop = np.minimum(np.arange(len(code)) + length, len(code))
        starts = np.flatnonzero(member & (total[stop] - total[:-1] >= need)).tolist()
        done = k = 0
        while k < len(starts):
            p = starts[k]
            hit = align(words, code[p:p + length].tolist()) if p >= done else ()
            k += 1
            if len(hit) < need:
                continue
            # the window may have begun before the notice and end inside it: take the best start nearby
            best = (len(hit), -p, hit)
            while k < len(starts) and starts[k] < p + length:
                q = starts[k]
                hit = align(words, code[q:q + length].tolist())
                best = max(best, (len(hit), -q, hit))
                k += 1
            n, p, hit = best[0], -best[1], best[2]
            s, e = p + hit[0][1], p + hit[-1][1] + 1
            found.append((name, n / len(words), s, e, n))
            done = e
            k = bisect_left(starts, done)
    return best_apart(found)


def best_apart(found: list[tuple]) -> list[tuple]:
    """Of (name, coverage, start, end, aligned words) the notices that stay, in text order: by aligned words,
    coverage and name, each unless it overlaps one before. Those that stay never overlap, so only the last one
    that begins before a notice's end can be in its way."""
    starts, kept = [], []
    for f in sorted(found, key=lambda f: (-f[4], -f[1], f[0], f[2])):
        k = bisect_left(starts, f[3])
        if not k or kept[k - 1][3] <= f[2]:
            starts.insert(k, f[2])
            kept.insert(k, f[:4])
    return kept


_FOUND = "array<struct<license: string, coverage: double, start: bigint, end: bigint>>"


def scan_licenses(docs: DataFrame, text_col: str = "text", out_col: str = "notices",
                  templates: dict[str, str] | DataFrame = TEMPLATES, min_coverage: float = MIN_COVERAGE,
                  stretch: float = STRETCH) -> DataFrame:
    """``docs`` plus ``out_col``: the notices found, with coverage and word span (end
    exclusive), in text order. ``templates`` are short notices or whole license texts by name, or a table of
    them (see ``load_templates``)."""
    out_col = free_name(docs, out_col)
    if isinstance(templates, DataFrame):
        templates = load_templates(templates)

    @F.arrow_udf(_FOUND)
    def notices(text: pa.Array) -> pa.Array:
        vocab, coded = prepare(templates)
        shortest = min((int(np.ceil(len(c) * min_coverage)) for _, c, _ in coded), default=0)
        get, out = vocab.get, []
        for piece in text_pieces(text):
            for t in piece:
                words = bench_words(t)
                code = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
                rows = []
                if shortest and np.count_nonzero(code) >= shortest:
                    rows = scan_words(code, coded, min_coverage, stretch)
                out.append([dict(zip(("license", "coverage", "start", "end"), r)) for r in rows])
        return pa.array(out, pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()),
                                                 ("start", pa.int64()), ("end", pa.int64())])))

    return docs.withColumn(out_col, notices.asNondeterministic()(F.col(text_col)))
