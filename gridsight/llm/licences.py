"""Licence scans with a trained paragraph classifier.

A multinomial logistic regression over sparse word n-grams tells the licence families apart, and
from ordinary text.  It is trained here: on the notices below with words dropped and put around
them, on the same notices with the words that only their family uses exchanged (an unknown
licence), and on a bounded sample of the corpus' paragraphs as the unknown class.  The bar above
which a family is believed comes from a histogram over all paragraphs of the corpus.  A believed
paragraph is then compared with the notices of its family, and only one that shares enough word
pairs with a notice is reported; a pair counts less the more families use it.

A notice may stand on one line or be wrapped over lines, with comment marks: every line is judged,
and every passage, that is two or more lines in a row of a paragraph which all take part in three
words in a row of some notice.  A line without words ends a paragraph.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import table
from .words import ALNUM, blocks, grams, hashes, spans

# Families and wordings of their notices.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0", "distributed under the terms of the Apache 2.0 license"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", "This project is available under the MIT license"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL version 2 or later"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1-only"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "SPDX-License-Identifier: BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC-SA 4.0."],
    "CC0": ["Released under CC0 1.0 Universal.", "This work is dedicated to the public domain under CC0.", "This is free and unencumbered software released into the public domain."],
    "EPL": ["Licensed under the Eclipse Public License 2.0.", "made available under the terms of the Eclipse Public License 2.0 which is available at", "SPDX-License-Identifier: EPL-2.0"],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "SPDX-License-Identifier: ISC"],
    "Zlib": ["Released under the zlib License.", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "SPDX-License-Identifier: Zlib"],
    "Proprietary": ["All rights reserved.", "Copyright, all rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
FAMILIES = list(NOTICES)
#: Paragraphs of the corpus that stand for ordinary text, and variants made of every notice.
SAMPLE, VARIANTS = 4000, 40
GRAMS = (1, 2, 3)
STEPS, STEP, PULL = 300, 0.5, 1e-4
#: Share of all unconfirmed lines and passages that may be believed at most; weight of a notice's word pairs that must be shared.
WRONG, SHARED = 0.001, 0.6
#: Log-odds of a family are counted in steps of 1 / FINE, up to TOP.
FINE, TOP = 10, 30


def _family_words() -> list[set[str]]:
    """The words that only one family's notices use."""
    used = [{w.strip(".,;:()").lower() for n in ns for w in n.split()} for ns in NOTICES.values()]
    return [u - set().union(*(o for o in used if o is not u)) for u in used]


def _blocks_of_paragraphs(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words (starts, ends, hashes) and for each the number of its line, counted over all texts;
    the text and the first byte of every line."""
    breaks = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.concatenate([begin[:-1], breaks[breaks < len(data)]])) if len(data) else np.zeros(0, np.int64)
    starts, ends, _ = spans(data, begin, ALNUM)
    line = np.searchsorted(lines, starts, "right") - 1
    text = np.searchsorted(begin, lines, "right") - 1
    return starts, ends, hashes(data, starts, ends), line, lines, text


def _features(words: np.ndarray, line: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line and number of every n-gram that the model knows (``names`` are sorted hashes)."""
    where, which = [], []
    for n in GRAMS:
        g = grams(words, n)
        at = np.minimum(np.searchsorted(names, g), len(names) - 1)
        hit = np.flatnonzero((names[at] == g) & (line[: len(g)] == line[n - 1 :]))
        where.append(line[hit])
        which.append(at[hit])
    return np.concatenate(where), np.concatenate(which)


def _as_lines(texts: list[str]) -> tuple[np.ndarray, ...]:
    batch = pa.record_batch([pa.array([" ".join(t.split()) for t in texts], pa.string())], ["text"])
    words, line, at = [], [], 0
    for rows, data, begin in blocks(iter([batch]), "text"):
        starts, ends, counts = spans(data, begin, ALNUM)
        words.append(hashes(data, starts, ends))
        line.append(np.repeat(np.arange(len(rows)) + at, counts))
        at += len(rows)
    return np.concatenate(words), np.concatenate(line)


class Model:
    """Names (hashes of known n-grams), weights per name and class (0 is unknown), and bars."""

    def __init__(self, ordinary: list[str], seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        texts, labels = [], []
        for k, (notices, own) in enumerate(zip(NOTICES.values(), _family_words()), 1):
            for notice in notices:
                words = notice.split()
                for v in range(VARIANTS):
                    kept = [w for w in words if v == 0 or rng.random() > 0.08]
                    if v % 3 == 2 and ordinary:
                        around = ordinary[rng.integers(len(ordinary))].split()[:8]
                        kept = around + kept if rng.random() < 0.5 else kept + around
                    texts.append(" ".join(kept))
                    labels.append(k)
                    other = ordinary[rng.integers(len(ordinary))].split() if ordinary else []
                    if other and v % 4 == 0:  # the notice of a licence that is not known
                        texts.append(" ".join(other[rng.integers(len(other))] if w.strip(".,;:()").lower() in own else w for w in words))
                        labels.append(0)
        known, line = _as_lines([n for ns in NOTICES.values() for n in ns])
        self.names = np.unique(np.concatenate([grams(known, n)[line[: max(0, len(known) - n + 1)] == line[n - 1 :]] for n in GRAMS]))
        texts += ordinary
        labels += [0] * len(ordinary)
        self.weights = np.zeros((len(self.names) + 1, len(FAMILIES) + 1))  # the last row is the constant
        where, which = _features(*_as_lines(texts), self.names)
        y = np.eye(len(FAMILIES) + 1)[labels]
        share = np.where(np.array(labels) == 0, 1.0 / max(1, labels.count(0)), 1.0 / max(1, len(labels) - labels.count(0)))[:, None] * 0.5
        rate = np.zeros_like(self.weights)
        for _ in range(STEPS):
            error = (self._p(where, which, len(texts)) - y) * share
            slope = PULL * self.weights
            np.add.at(slope, which, error[where])
            slope[-1] += error.sum(axis=0)
            rate += slope**2
            self.weights -= STEP * slope / (np.sqrt(rate) + 1e-8)
        self.pairs = _notice_pairs()

    def _p(self, where: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        z = np.tile(self.weights[-1], (n, 1))
        for k in range(z.shape[1]):
            z[:, k] += np.bincount(where, self.weights[which, k], n)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def judge(self, words: np.ndarray, unit: np.ndarray) -> list[tuple[int, int, float, float]]:
        """Unit, family, log-odds and shared weight of the best notice's word pairs, of every unit
        that is likelier a family than not.  ``unit`` is the rising number of each word's unit."""
        where, which = _features(words, unit, self.names)
        units, where = np.unique(where, return_inverse=True)  # without a known n-gram it is unknown
        p = self._p(where, which, len(units))
        out = []
        for i in np.flatnonzero((p.argmax(axis=1) > 0) & (p.max(axis=1) >= 0.5)):
            family = int(p[i].argmax()) - 1
            a, b = np.searchsorted(unit, units[i]), np.searchsorted(unit, units[i], "right")
            odds = np.log(p[i].max()) - np.log(max(1 - p[i].max(), 1e-15))
            out.append((int(units[i]), family, float(odds), _shared(words[a:b], self.pairs[family])))
        return out

    def passages(self, words: np.ndarray, line: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last line of every passage, its words, and the number of each word's passage."""
        g = grams(words, 3)
        at = np.minimum(np.searchsorted(self.names, g), len(self.names) - 1)
        a, b, c = line[: len(g)], line[1 : len(g) + 1], line[2:]
        hit = (self.names[at] == g) & (b - a <= 1) & (c - b <= 1) & (owner[a] == owner[c]) if len(g) else np.zeros(0, bool)
        none = np.zeros(0, np.int64)
        if not hit.any():
            return none, none, words[:0], none
        touched = np.unique(np.concatenate([a[hit], b[hit], c[hit]]))
        new = np.ones(len(touched), bool)
        new[1:] = (np.diff(touched) != 1) | (np.diff(owner[touched]) != 0)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(touched)) - 1
        long = ends > starts
        first, last = touched[starts[long]], touched[ends[long]]
        of = np.searchsorted(first, line, "right") - 1
        inside = (of >= 0) & (line <= last[of]) if len(first) else np.zeros(len(line), bool)
        return first, last, words[inside], of[inside]


def _notice_pairs() -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per family and notice the word pairs and their weights, one over the families that use a pair."""
    pairs = [[np.unique(grams(_as_lines([n])[0], 2)) for n in notices] for notices in NOTICES.values()]
    names, used = np.unique(np.concatenate([np.unique(np.concatenate(p)) for p in pairs]), return_counts=True)
    return [[(t, 1.0 / used[np.searchsorted(names, t)]) for t in p] for p in pairs]


def _shared(words: np.ndarray, notices: list[tuple[np.ndarray, np.ndarray]]) -> float:
    own = np.unique(grams(words, 2))
    return max((float(w[np.isin(t, own, assume_unique=True)].sum() / w.sum()) for t, w in notices if len(t)), default=0.0)


def _judged(model: Model, data: np.ndarray, begin: np.ndarray):
    """Lines, their texts, the line of every word, the number of lines and passages with words, and
    (first line, last line, family, log-odds, shared) of all that is likelier a family than not."""
    _, _, words, line, lines, owner = _blocks_of_paragraphs(data, begin)
    out = [(i, i, *rest) for i, *rest in model.judge(words, line)]
    first, last, inner, of = model.passages(words, line, owner)
    out += [(int(first[i]), int(last[i]), *rest) for i, *rest in model.judge(inner, of)]
    return lines, owner, line, len(np.unique(line)) + len(first), out


def _bar(rows: DataFrame, model) -> float:
    """The least log-odds that at most ``WRONG`` of all unconfirmed lines and passages reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bins = 0, np.zeros(FINE * TOP + 1, np.int64)
        for _, data, begin in blocks(batches, "text"):
            *_, n, found = _judged(model.value, data, begin)
            open_ = [odds for _, _, _, odds, shared in found if shared < SHARED]
            seen += n - len(found) + len(open_)
            bins += np.bincount(np.minimum(np.array(open_) * FINE, FINE * TOP).astype(int), minlength=len(bins)) if open_ else 0
        used = np.flatnonzero(bins)
        yield pa.record_batch([pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(bins[used], seen), pa.int64())], ["bin", "n"])

    # at most FINE * TOP + 2 rows, whatever the corpus
    counts = {r["bin"]: r["n"] for r in rows.select("text").mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    allowed, above = WRONG * counts.pop(-1, 0), 0
    for at in range(FINE * TOP, -1, -1):
        above += counts.get(at, 0)
        if above > allowed:
            return min(at + 1, FINE * TOP) / FINE
    return 0.0


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_paragraphs (lines with words in a row), n_licences, families
    (distinct, sorted, joined by commas) and spans (family:start:end of the reported lines and
    passages in code points, end exclusive, by start, joined by commas).

    A passage is not reported if one of its lines is, for the same family; a passage with several
    notices is reported for the likeliest.  Null and empty texts have no paragraphs.  Repeated rows
    repeat; other columns are ignored.  Equal chances go to the family listed first.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # a bounded sample of ordinary paragraphs (the first 2000 characters of each are enough to
    # learn from), the same for the same rows whatever their order, out of a share of the
    # documents that shrinks as there are more of them
    share = min(1.0, SAMPLE / max(1, rows.count()))
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    paragraphs = picked.where(F.length("text") > 0).select(F.explode(F.array_distinct(F.split("text", "\n"))).alias("t")).where("length(trim(t)) > 0")
    sample = paragraphs.withColumn("h", F.xxhash64("t")).where(F.pmod("h", F.lit(8)) == 0).orderBy("h", "t").limit(SAMPLE).select(F.substring("t", 1, 2000).alias("t")).collect()
    notices = [n for family in _notice_pairs() for n in family]
    texts = [r[0] for r in sample if _shared(_as_lines([r[0]])[0], notices) < SHARED]
    model = docs.sparkSession.sparkContext.broadcast(Model(texts))
    bar = _bar(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, begin in blocks(batches, "text"):
            lines, owner, line, _, found = _judged(model.value, data, begin)
            held = np.unique(line)
            new = np.ones(len(held), bool)
            new[1:] = (np.diff(held) != 1) | (np.diff(owner[held]) != 0)
            n = np.bincount(owner[held[new]], minlength=len(part)) if len(held) else np.zeros(len(part), np.int64)
            good = [(first, last, family) for first, last, family, odds, shared in found if odds >= bar and shared >= SHARED]
            alone = {(first, family) for first, last, family in good if first == last}
            families: list[set] = [set() for _ in range(len(part))]
            places: list[list[str]] = [[] for _ in range(len(part))]
            for first, last, family in sorted(good):
                if last > first and any((i, family) in alone for i in range(first, last + 1)):
                    continue
                doc = int(owner[first])
                a, b = int(lines[first]), int(lines[last + 1]) if last + 1 < len(lines) else len(data)
                b = min(b, int(begin[doc + 1]))
                if b > a and data[b - 1] == 10:
                    b -= 1
                before = int(np.count_nonzero((data[begin[doc] : a] & 0xC0) != 0x80))
                size = int(np.count_nonzero((data[a:b] & 0xC0) != 0x80))
                families[doc].add(FAMILIES[family])
                places[doc].append(f"{FAMILIES[family]}:{before}:{before + size}")
            yield pa.record_batch(
                [part.column(0), pa.array(n, pa.int64()), pa.array([len(p) for p in places], pa.int64()), pa.array([",".join(sorted(f)) for f in families]), pa.array([",".join(p) for p in places])],
                ["doc_id", "n_paragraphs", "n_licences", "families", "spans"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_paragraphs bigint, n_licences bigint, families string, spans string")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
