"""Licence families: a slow twin of the classifier, a planted table, neighbours, short forms, wrapped and dual notices."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import license_scan
from palimpsest.llm.common import table
from palimpsest.llm.license_scan import CONFIRM, CONFIRM_FEW, FEW, TEMPLATES, words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.fit_licenses(license_scan.example_paragraphs(table(spark, SF, "documents")))


def families(model, text):
    return [f for f, _ in model.classify_all(words(text.encode()))]


def slow_classify_all(model, w):
    """One n-gram after another, from the model's own weights."""
    names = {i: x for x, i in model.ids.items()}
    v = len(model.ids) + 1
    place = {}
    for at, code in enumerate(model.keys.tolist()):
        ids = [code // v, code % v] if code < v * v else [code // v // v, code // v % v, code % v]
        place[tuple(names[i] for i in ids)] = at
    out = []
    while True:
        grams = {tuple(w[i : i + n]) for n in (2, 3) for i in range(len(w) - n + 1)}
        known = [place[g] for g in grams if g in place]
        if not known or len(w) < 2:
            return out
        z = np.array(model.bias, float)
        for k in known:
            z = z + model.weights[k] / len(known) ** 0.5
        z = z / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        best = max(range(len(model.families)), key=lambda k: (p[k], -k))
        if p[best] < model.least or p[best] < p[-1] or model.families[best] in dict(out):
            return out
        for text in TEMPLATES[model.families[best]]:
            t = words(text.encode())
            n = min(3, len(t))
            own, have = ({tuple(x[i : i + n]) for i in range(len(x) - n + 1)} for x in (t, w))
            both = len(own & have)
            if len(t) <= 3 and len(w) > 2 * len(t) + 2:
                continue
            if both >= (CONFIRM if len(own) >= FEW else CONFIRM_FEW) * len(own) or len(have) >= 6 and both >= CONFIRM_FEW * len(have):
                break
        else:
            return out
        out.append((model.families[best], p[best]))
        used = {i + j for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in own for j in range(n)}
        w = [x for i, x in enumerate(w) if i not in used]


def test_classifier_against_slow_twin(model):
    rng = random.Random(3)
    bag = sorted({x for ts in TEMPLATES.values() for t in ts for x in words(t.encode())})
    texts = [t for ts in TEMPLATES.values() for t in ts]
    cases = [words(" ".join([rng.choice(texts), rng.choice(["or", "", "some words between"]), rng.choice([*texts, "", ""])]).encode()) for _ in range(400)]
    cases += [rng.choices(bag, k=rng.randint(0, 25)) for _ in range(300)] + [words(t.encode())[: rng.randint(1, 20)] for t in texts]
    some = 0
    for w in cases:
        got, want = model.classify_all(list(w)), slow_classify_all(model, list(w))
        assert [f for f, _ in got] == [f for f, _ in want] and [p for _, p in got] == pytest.approx([p for _, p in want])
        some += len(want)
    assert some > 300


def test_short_forms_and_neighbours(model):
    want = {
        "MIT License": "MIT",
        "Licensed under the GPL": "GPL",
        "SPDX-License-Identifier: MIT": "MIT",
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "GNU General Public License v2.0": "GPL",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY': "MIT",
        "Eclipse Public License - v 2.0": "EPL-2.0",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA",
        "GNU Affero General Public License v3.0": "AGPL",
    }
    assert {t: families(model, t) for t in want} == {t: [f] for t, f in want.items()}
    for text in ("Artistic License 2.0", "Licensed under the Boost Software License, Version 1.0.", "Harbour Public License - v 2.0", "Licensed under the Zlib License.", "Licensed under CC BY-XX 4.0.", "the MIT license office was closed and the city renewed the driving license"):
        assert families(model, text) == [], text


def test_two_licences_in_a_paragraph(model):
    got = families(model, "Licensed under the Apache License, Version 2.0. Portions are released under the MIT License.")
    assert sorted(got) == ["Apache-2.0", "MIT"]


def scanned(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: [(h["paragraph"], h["family"]) for h in r["licences"]] for r in license_scan.scan_licenses(df, model).collect()}


def test_wrapped_notices(spark, model):
    long = TEMPLATES["Apache-2.0"][1]
    w = long.split()
    wrapped = "\n".join(" ".join(w[i : i + 4]) for i in range(0, len(w), 4))
    got = scanned(spark, model, [f"a first line\n{wrapped}\na last line", long, "", None, wrapped.replace("\n", "\n\n")])
    assert {f for _, f in got[0]} == {"Apache-2.0"} and got[1] == [(0, "Apache-2.0")] and got[2] == got[3] == []


def planted(rng, prose):
    """Documents with one notice each, edited lightly, among lines of prose; some have none."""
    out = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            for _ in range(3):
                w = t.split()
                if len(w) > 12:
                    w[rng.randrange(len(w))] = rng.choice(["quite", "THE", "herein"])
                lines = rng.sample(prose, 6)
                lines.insert(rng.randrange(6), rng.choice(["", "# ", "Copyright 2021 A. Writer. "] if len(w) > 3 else [""]) + " ".join(w))
                out.append((family, "\n".join(lines)))
    return out


def test_recall_and_false_families_on_a_planted_table(spark, model):
    rng = random.Random(8)
    lines = [x.decode() for x in license_scan.example_paragraphs(table(spark, SF, "documents"), 100, 400)]
    prose = [x for x in lines if not any(k in x.lower() for k in ("licen", "rights reserved", "copyright"))]
    rows = planted(rng, prose) + [(None, "\n".join(rng.sample(prose, 8))) for _ in range(200)]
    got = scanned(spark, model, [t for _, t in rows])
    found = [{f for _, f in got[i]} for i in range(len(rows))]
    recall = np.mean([f in g for (f, _), g in zip(rows, found, strict=True) if f])
    false = sum(len(g - {f}) for (f, _), g in zip(rows, found, strict=True))
    print("recall", recall, "false families", false, "of", len(rows))
    assert recall >= 0.95 and false <= 0.01 * len(rows)


def test_repeated_ids_give_one_example_each(spark):
    rows = [(1, f"line {i} of a row that repeats an id") for i in range(500)] + [(i, f"line of document {i}") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.example_paragraphs(docs, 20)
    assert len(got) == 20
    every = license_scan.example_paragraphs(docs.union(docs), 100)
    assert len(every) == 29 and b"line 0 of a row that repeats an id" in every
    assert docs.where(F.col("doc_id") == 1).count() == 500
