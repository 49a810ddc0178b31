"""License scans by a trained paragraph classifier.

Each line of a text is a paragraph; neighbouring lines none of which says enough by itself are judged together once more, as a notice that is wrapped. Word bigrams and trigrams are the sparse features of a multinomial logistic
regression over licence families and an unknown class. The regression is fitted on varied copies of the templates
below, and on paragraphs of documents, made-up sentences about licences and notices of made-up licences as the unknown class; probabilities are calibrated by a
temperature, and the least probability of a family by an error bound, both on paragraphs left out of the fit. A prediction counts if
a template of the family confirms it: enough of the template's n-grams stand in the paragraph, or enough
of the paragraph's in the template; a template of three words or fewer must be most of the paragraph. What a template has confirmed is taken out and the rest is judged again, so a paragraph can have
several licences. A paragraph without any known n-gram is unknown by the model's bias, at once.

Defined results: a null or empty text has no paragraphs and no family; a null doc_id keeps its row; repeated rows and
lines count each; of rows that repeat a sampled id the first text is an example; an empty table gives no rows and a model of made-up sentences alone; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import first_by_hash, own_columns, table, utf8

#: Documents whose paragraphs serve as unknown examples at most, and paragraphs taken from them at most.
SAMPLE, PARAGRAPHS = 400, 1500
#: Share of n-grams that a template must have in common with a paragraph, and that one of under ``FEW`` must; lines judged together at most.
CONFIRM, CONFIRM_FEW, FEW, WRAPPED = 0.6, 0.75, 10, 12
# Public licence notices, the first words of each family's text and its usual short forms.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "MIT License",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL.",
        "GNU General Public License v2.0",
        "GNU General Public License v3.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "GNU Lesser General Public License v3.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is distributed under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "GNU Affero General Public License v3.0",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "Mozilla Public License - v 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, Version 2.0.",
        "Eclipse Public License - v 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-SA": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-ND": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software."),
    "Proprietary": ("All rights reserved.", "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher."),
}
#: Sentences that only sound like a licence: slots are filled at random.
_CHAFF = ("the {n} license was renewed in {n}", "released under the {n} of the {n}", "a {n} is free to {v} the {n}", "this work is {v} under the {n}", "you may not {v} this {n} except on {n}", "all {n} of the {n} reserved a {n}", "a copy of the {n} was {v} along with the {n}", "version 2 of the {n} was {v}", "the general public {v} the {n}", "licensed {n} under the {n}, version 3", "permission to {v} the {n} for any {n}", "driving license number {n}")
#: Notices of other licences, made up or not told apart here.
_OTHER = ("licensed under the {n} license", "released under the {n} license version 2 0", "licensed under the {n} license version 1 0", "{n} public license v 2 0", "{n} public license version 3", "this work is licensed under the {n} public license version 3", "this file is subject to the terms of the {n} public license v 1 1", "spdx license identifier {n} 2 0", "spdx license identifier {n}", "{n} license", "the {n} license", "{n} 3 clause license", "licensed under {n} by 4 0", "licensed under {n} nc 4 0", "this work is licensed under a {n} attribution 4 0 international license", "this program is distributed under the terms of the {n} general public license")
_NOUNS = "driver city plumber museum river team project report garden kitchen pilot hunter dealer teacher band bridge holiday weather market fishing liquor station".split()
_VERBS = "visit paint sell open close read carry repair watch describe publish copy".split()
_FLAT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))


def words(paragraph: bytes) -> list[bytes]:
    return paragraph.translate(_FLAT).split()


def grams(w: list, n: int) -> list[tuple]:
    return list(zip(*(w[i:] for i in range(n)), strict=False))


def _varied(template: list[bytes], rng: random.Random) -> list[bytes]:
    """A copy with a stretch cut out of a long text, a few words lost or replaced, and words around it."""
    w = list(template)
    if len(w) > 14 and rng.random() < 0.5:
        n = rng.randint(10, len(w))
        at = rng.randint(0, len(w) - n)
        w = w[at : at + n]
    for _ in range(rng.choice((0, 0, 0, 1, 2)) if len(w) > 6 else 0):
        k = rng.randrange(len(w))
        w[k : k + 1] = [] if rng.random() < 0.5 else [rng.choice(_NOUNS).encode()]
    lead = [rng.choice(_NOUNS).encode() for _ in range(rng.choice((0, 0, 0, 2, 6)))]
    tail = [rng.choice(_NOUNS).encode() for _ in range(rng.choice((0, 0, 0, 3)))]
    return lead + w + tail


@dataclass
class LicenseModel:
    families: tuple[str, ...]
    ids: dict[bytes, int]
    keys: np.ndarray  # sorted codes of the known n-grams
    weights: np.ndarray  # n-grams by classes, the last one unknown
    bias: np.ndarray
    temperature: float
    least: float
    templates: list[list[tuple[frozenset, int, int]]]  # of each family: n-grams, n, and words

    def codes(self, w: list[bytes]) -> np.ndarray:
        """Places of the paragraph's known n-grams in ``keys``."""
        get, v = self.ids.get, len(self.ids) + 1
        i = np.fromiter((get(x, 0) for x in w), np.int64, len(w))
        two = i[:-1] * v + i[1:]
        two[(i[:-1] == 0) | (i[1:] == 0)] = 0
        three = two[:-1] * v + i[2:]
        three[(two[:-1] == 0) | (i[2:] == 0)] = 0
        all_ = np.r_[two[two > 0], three[three > 0]]
        at = np.searchsorted(self.keys, all_)
        at = np.minimum(at, max(0, len(self.keys) - 1))
        return np.unique(at[self.keys[at] == all_]) if len(self.keys) else at[:0]

    def probabilities(self, known: np.ndarray) -> np.ndarray:
        z = (self.bias + self.weights[known].sum(0) / np.sqrt(max(1, len(known)))) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def _confirmed(self, k: int, w: list[bytes]) -> frozenset | None:
        """N-grams of the template of family ``k`` that confirms the paragraph."""
        for t, n, size in self.templates[k]:
            have = frozenset(grams(w, n))
            both = len(have & t)
            if size <= 3 and len(w) > 2 * size + 2:
                continue
            if both >= (CONFIRM if len(t) >= FEW else CONFIRM_FEW) * len(t) or len(have) >= 6 and both >= CONFIRM_FEW * len(have):
                return t
        return None

    def classify_all(self, w: list[bytes]) -> list[tuple[str, float]]:
        """Families of a paragraph with their probabilities, the surest first; none for unknown."""
        out: list[tuple[str, float]] = []
        while len(w) > 1 and len(known := self.codes(w)):
            p = self.probabilities(known)
            k = int(p[:-1].argmax())
            if p[k] < max(self.least, p[-1]) or self.families[k] in dict(out) or (t := self._confirmed(k, w)) is None:
                break
            out.append((self.families[k], float(p[k])))
            # The words that the template has are taken out.
            n = len(next(iter(t)))
            inside = np.zeros(len(w) + n, bool)
            for i, g in enumerate(grams(w, n)):
                if g in t:
                    inside[i : i + n] = True
            w = [x for x, used in zip(w, inside, strict=False) if not used]
        return out

    def classify(self, w: list[bytes]) -> tuple[str, float] | None:
        """The surest family of a paragraph and its probability, or None for unknown."""
        found = self.classify_all(w)
        return found[0] if found else None


def fit_licenses(paragraphs: list[bytes], seed: int = 11, copies: int = 24) -> LicenseModel:
    """Fit on the templates and on ``paragraphs`` as unknown examples; those that share a trigram with a template are passed over."""
    rng = random.Random(seed)
    families = tuple(TEMPLATES)
    plain = [[words(t.encode()) for t in TEMPLATES[f]] for f in families]
    shared = {g for ts in plain for t in ts for g in grams(t, 3)}
    rows = [(_varied(t, rng), k) for k, ts in enumerate(plain) for t in ts for _ in range(copies)]
    unknown = [w for p in paragraphs if len(w := words(p)) > 1 and not shared.intersection(grams(w, 3))]
    for i in range(1000):
        text = rng.choice(_CHAFF if i < 600 else _OTHER)
        while "{" in text:
            text = text.replace("{n}", rng.choice(_NOUNS), 1).replace("{v}", rng.choice(_VERBS), 1)
        unknown.append(words(text.encode()) if rng.random() < 0.7 else _varied(words(text.encode()), rng))
    rows += [(w, len(families)) for w in unknown]
    rng.shuffle(rows)
    cut = len(rows) * 3 // 4
    # Known n-grams: those of templates and made-up sentences that the fit has seen twice.
    vocabulary: dict[tuple, int] = {}
    for w, k in rows[:cut]:
        if k < len(families) or any(x in (b"license", b"licensed", b"version", b"public") for x in w):
            for g in {*grams(w, 2), *grams(w, 3)}:
                vocabulary[g] = vocabulary.get(g, 0) + 1
    seen = sorted(g for g, n in vocabulary.items() if n > 1)
    ids = {x: i + 1 for i, x in enumerate(sorted({x for g in seen for x in g}))}
    v = len(ids) + 1
    code = [ids[g[0]] * v + ids[g[1]] if len(g) == 2 else (ids[g[0]] * v + ids[g[1]]) * v + ids[g[2]] for g in seen]
    classes = len(families) + 1
    model = LicenseModel(families, ids, np.sort(np.array(code, np.int64)), np.zeros((len(seen), classes)), np.zeros(classes), 1.0, 0.5, [[(frozenset(grams(t, n)), n, len(t)) for t in ts for n in (3 if len(t) > 2 else 2,)] for ts in plain])
    known = [model.codes(w) for w, _ in rows]
    y = np.array([k for _, k in rows])
    x = np.zeros((len(rows), len(seen)), np.float32)
    for i, c in enumerate(known):
        x[i, c] = 1 / np.sqrt(max(1, len(c)))
    target = np.eye(classes, dtype=np.float32)[y]
    weights, bias = np.zeros((len(seen), classes), np.float32), np.zeros(classes, np.float32)
    step_w, step_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(150):  # gradient steps with momentum on the mean log loss and a ridge
        z = x[:cut] @ weights + bias
        p = np.exp(z - z.max(1, keepdims=True))
        gap = (p / p.sum(1, keepdims=True) - target[:cut]) / cut
        step_w = 0.9 * step_w - 8 * (x[:cut].T @ gap + 1e-5 * weights)
        step_b = 0.9 * step_b - 8 * gap.sum(0)
        weights += step_w
        bias += step_b
    model.weights, model.bias = weights.astype(float), bias.astype(float)
    # Calibration on the rows left out: temperature by log loss, then the least probability that lets one in 200 unknown ones through.
    z, truth = x[cut:] @ weights + bias, y[cut:]

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), truth]).mean())

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8), key=loss) if len(z) else 1.0
    far = sorted((model.probabilities(known[i])[:-1].max() for i in range(cut, len(rows)) if y[i] == classes - 1 and len(known[i])), reverse=True)
    model.least = float(min(0.9, max(0.5, far[len(far) // 200] if far else 0.5)))
    return model


def example_paragraphs(docs: DataFrame, sample: int = SAMPLE, most: int = PARAGRAPHS) -> list[bytes]:
    """Paragraphs of the first ``sample`` documents by hash, ``most`` of them by hash."""
    rows = own_columns(docs, "doc_id", "text").where("text is not null")
    # Ids are chosen first, so that no texts are sorted; at most ``sample`` of them are broadcast.
    chosen = first_by_hash(rows, "doc_id", sample)
    some = rows.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return [r["line"].encode() for r in lines.orderBy(F.xxhash64("line"), "line").limit(most).collect()]


def scan_licenses(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """``doc_id, n_paragraphs, licences`` (array of paragraph number, family, probability; of a wrapped notice the first line's number)."""
    rows = own_columns(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    item = pa.list_(pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No pair of neighbouring known words, no known n-gram: such a line is unknown by the bias.
        first = {}
        for k in model.keys.tolist():
            v = len(model.ids) + 1
            if k < v * v:
                first.setdefault(k // v, set()).add(k % v)
        names = {i: w for w, i in model.ids.items()}
        pairs = {(names[a], names[b]) for a, bs in first.items() for b in bs}
        for b in batches:
            n, found = [], []
            for text in utf8(b.column("text")):
                lines = text.translate(_FLAT).split(b"\n")
                hits, filled, run = [], 0, []
                for i, line in enumerate([*lines, b""]):
                    w = line.split()
                    filled += bool(w)
                    got = []
                    like = len(w) > 1 and not pairs.isdisjoint(zip(w, w[1:], strict=False))
                    if like and not (got := model.classify_all(w)):
                        run.append((i, w))
                    if run and (not like or got or len(run) == WRAPPED):
                        # Lines that said too little by themselves, with the one that ends them.
                        whole = [x for _, part in run for x in part] + ([] if like else w)
                        if len(run) > 1 or not like:
                            hits += [{"paragraph": run[0][0], "family": f, "probability": p} for f, p in model.classify_all(whole)]
                        run = []
                    hits += [{"paragraph": i, "family": f, "probability": p} for f, p in got]
                n.append(filled)
                found.append(hits)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, item)], ["doc_id", "n_paragraphs", "licences"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_paragraphs long, licences array<struct<paragraph:long,family:string,probability:double>>")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its paragraphs, those with a licence, and the families found, sorted."""
    docs = table(spark, sf_dir, "documents")
    found = scan_licenses(docs, fit_licenses(example_paragraphs(docs)))
    return found.select("doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"), F.array_sort(F.array_distinct(F.col("licences.family"))).alias("families"), F.array_max(F.col("licences.probability")).alias("probability"))
