"""Licence scans by a trained paragraph classifier.

A paragraph is what stands between line breaks; a notice wrapped over neighbouring lines, with or without
comment marks, is found as a run of lines and named by the first, where no line holds it alone. A sparse logistic regression over its words and word
pairs gives a probability for each licence family and for none (``unknown``). It is trained on notices
with words dropped, replaced and surrounded, against paragraphs of the corpus and sentences that use
the same words for other things. Its temperature and the least probability for a family are set on held-out examples, so
that at most ``FALSE_SHARE`` of those without a licence pass. What is predicted is compared with the
family's templates, and confirmed if it holds enough of the word pairs of one of them.

Null and empty texts have no paragraphs. Texts are scanned whole. Repeated rows and null ids are
judged row by row; extra columns are ignored unless carried. An empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.llm.common import as_rows, map_arrow, raw_texts, sample_texts, slices, words_of

UNKNOWN = "unknown"
# Training: variants of each template, corpus documents for the unknown class, bytes of each.
VARIANTS = 40
NEGATIVE_DOCUMENTS = 300
NEGATIVE_BYTES = 3_000
FALSE_SHARE = 0.002
# Share of a template's word pairs that a paragraph must hold to be confirmed.
CONFIRMED = 0.6

# Short notices and opening sentences of public licences.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
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
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "This software is proprietary and confidential and may not be disclosed without written permission.",
    ),
}
# Sentences about licences that grant none.
OTHER_USES = (
    "The driver lost his license after the second accident and had to renew it in person.",
    "A version of the public statement was released under pressure from the press.",
    "The film was released under a new title in the second week of the year.",
    "She was granted permission to copy the letters in the library free of charge.",
    "The terms of the contract are subject to change with the general price level.",
    "The commission licensed three new banks under the law of the country.",
    "They work with the general public and with software companies in the region.",
    "The warranty covers this product for two years, provided that it was used with care.",
    "The source of the river is open to the public and free to use without a fee.",
    "Members of the foundation published the program of the conference, version two.",
)

FINDING = T.ArrayType(
    T.StructType(
        [
            T.StructField("paragraph", T.LongType()),
            T.StructField("family", T.StringType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField("overlap", T.DoubleType()),
            T.StructField("confirmed", T.BooleanType()),
        ]
    )
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def words(text: str) -> list[str]:
    """A paragraph's words, as the scan folds them."""
    return bytes(_FOLD[np.frombuffer(text.encode(), np.uint8)]).decode().split(" ")


def terms(text: str) -> set[str]:
    """Its distinct words and word pairs."""
    own = [w for w in words(text) if w]
    return {*own, *(f"{a} {b}" for a, b in zip(own, own[1:], strict=False))}


def pairs(text: str) -> set[str]:
    return {t for t in terms(text) if " " in t}


@dataclass(frozen=True)
class Model:
    """Weights per term and family (unknown last), temperature, least probability, held-out accuracy."""

    families: tuple[str, ...]
    places: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    accuracy: float
    false_share: float

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        scaled = (sums + self.bias) / self.temperature
        scaled -= scaled.max(axis=1, keepdims=True)
        grown = np.exp(scaled)
        return grown / grown.sum(axis=1, keepdims=True)

    def of(self, text: str) -> np.ndarray:
        found = [self.places[t] for t in terms(text) if t in self.places]
        return self.probabilities(self.weights[found].sum(axis=0)[None, :])[0]


def _variants(text: str, noise: list[str], chance: random.Random) -> Iterator[str]:
    yield text
    own = text.split()
    for _ in range(VARIANTS - 1):
        kept = [w if chance.random() > 0.05 else chance.choice(noise) for w in own if chance.random() > 0.08]
        before = [chance.choice(noise) for _ in range(chance.choice((0, 0, 0, 1, 4)))]
        after = [chance.choice(noise) for _ in range(chance.choice((0, 0, 0, 2, 6)))]
        yield " ".join([*before, *kept, *after])


def _examples(corpus: list[str]) -> tuple[list[str], list[int], list[str]]:
    chance = random.Random(5)
    families = [*TEMPLATES, UNKNOWN]
    lines = [line for text in corpus for line in text.split("\n") if line.strip()]
    noise = sorted({w for line in lines for w in line.split()})[:5000] or ["and", "the"]
    texts, labels = [], []
    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            for variant in _variants(template, noise, chance):
                texts.append(variant)
                labels.append(k)
    # Corpus lines that look like a notice are left out: nobody has labelled them.
    notices = set().union(*(pairs(t) for own in TEMPLATES.values() for t in own))
    chosen = [line for line in lines if len(pairs(line) & notices) < 2]
    chance.shuffle(chosen)
    for text in (*chosen[: 8 * VARIANTS], *(v for s in OTHER_USES for v in _variants(s, noise, chance))):
        texts.append(text)
        labels.append(len(families) - 1)
    return texts, labels, families


def train(corpus: list[str], rounds: int = 300) -> Model:
    """Fit on templates and a bounded list of corpus texts; every fourth example is held out."""
    texts, labels, families = _examples(corpus)
    seen = [terms(t) for t in texts]
    held = np.arange(len(texts)) % 4 == 3
    times: dict[str, int] = {}
    for own, out in zip(seen, held, strict=True):
        for t in () if out else own:
            times[t] = times.get(t, 0) + 1
    places = {t: i for i, t in enumerate(sorted(t for t, n in times.items() if n >= 3))}
    rows = np.repeat(np.arange(len(seen)), [sum(t in places for t in own) for own in seen])
    columns = np.array([places[t] for own in seen for t in sorted(own) if t in places], np.int64)
    target = np.eye(len(families))[labels]
    weights, bias = np.zeros((len(places), len(families))), np.zeros(len(families))
    step_w, step_b = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    fit = ~held[rows]

    def sums(w: np.ndarray) -> np.ndarray:
        out = np.zeros((len(seen), len(families)))
        np.add.at(out, rows, w[columns])
        return out

    def softmax(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    for _ in range(rounds):
        wrong = np.where(held[:, None], 0, softmax(sums(weights) + bias) - target) / (~held).sum()
        slope = np.zeros_like(weights)
        np.add.at(slope, columns[fit], wrong[rows[fit]])
        slope += 1e-5 * weights
        step_w += slope**2
        step_b += wrong.sum(axis=0) ** 2
        weights -= 0.3 * slope / np.sqrt(step_w)
        bias -= 0.3 * wrong.sum(axis=0) / np.sqrt(step_b)
    raw = (sums(weights) + bias)[held]
    truth = np.array(labels)[held]
    heats = np.geomspace(0.25, 8, 41)
    loss = [-np.log(softmax(raw / h)[np.arange(len(truth)), truth] + 1e-12).mean() for h in heats]
    temperature = float(heats[int(np.argmin(loss))])
    found = softmax(raw / temperature)
    unknown = truth == len(families) - 1
    # The least probability that lets through no more than the allowed share of the held-out unknown.
    wrongly = np.sort(found[unknown, :-1].max(axis=1))[::-1]
    allowed = int(FALSE_SHARE * len(wrongly))
    least = max(0.5, float(wrongly[allowed]) + 1e-9) if len(wrongly) else 0.5
    guess = np.where(found[:, :-1].max(axis=1) >= least, found[:, :-1].argmax(axis=1), len(families) - 1)
    passed = float((guess[unknown] != len(families) - 1).mean()) if unknown.any() else 0.0
    return Model(tuple(families), places, weights, bias, temperature, least, float((guess == truth).mean()), passed)


def fit(docs: DataFrame, documents: int = NEGATIVE_DOCUMENTS, size: int = NEGATIVE_BYTES) -> Model:
    """A model whose unknown class comes from at most ``documents`` texts, chosen by a hash."""
    return train(sample_texts(docs, F.lit(UNKNOWN), documents, size).get(UNKNOWN, []))


def _overlap(text: str, family: str) -> float:
    own = pairs(text)
    return max(len(own & template) / len(template) for template in map(pairs, TEMPLATES[family]))


NOTICES = [(family, pairs(t)) for family, own in TEMPLATES.items() for t in own]


def _runs(events: list[tuple[int, int, str]], need: float) -> list[tuple[int, int, int]]:
    """Runs of lines with at least ``need`` distinct pairs: first and last line, and their pairs.

    ``events`` are pairs with the lines of their two words, in order. A run is the shortest that holds
    enough, grown by neighbouring lines as long as they add pairs; the next starts behind it.
    """
    found, start = [], 0
    starts = sorted({e[0] for e in events})
    while start < len(events):
        low, times, run = start, {}, None
        for k in range(start, len(events)):
            times[events[k][2]] = times.get(events[k][2], 0) + 1
            while len(times) >= need and low <= k:
                # The run ends here; it starts as late as it can.
                run = (events[low][0], events[k][1])
                pair = events[low][2]
                times[pair] -= 1
                if not times[pair]:
                    del times[pair]
                low += 1
            if run:
                break
        if not run:
            break
        inside = lambda a, b: {p for x, y, p in events if a <= x and y <= b}
        first, last = run
        held = inside(first, last)
        while len(grown := inside(first, last + 1)) > len(held):
            last, held = last + 1, grown
        while first > starts[0] and len(grown := inside(first - 1, last)) > len(held):
            first, held = first - 1, grown
        found.append((first, last, len(held)))
        start = next((k for k, e in enumerate(events) if e[0] > last), len(events))
    return found


def _wrapped(line: np.ndarray, of_text: np.ndarray, number: np.ndarray, numbers: dict[str, int]):
    """(first line, last line, family, overlap) of the runs of two or more lines that hold a template."""
    if len(number) < 2:
        return []
    # Lines without a word, and ends of texts, part blocks of lines.
    apart = (np.diff(line) > 1) | (np.diff(of_text[line]) > 0)
    block = np.concatenate([[0], np.cumsum(apart)])
    known = sorted(set().union(*(own for _, own in NOTICES)))
    codes = np.array([(numbers[a] << 32) | numbers[b] for a, _, b in (t.partition(" ") for t in known)], np.int64)
    order = np.argsort(codes)
    code = (number[:-1] << 32) | number[1:]
    spot = np.minimum(np.searchsorted(codes[order], code), len(codes) - 1)
    hits = np.flatnonzero((codes[order][spot] == code) & ~apart)
    pair, at = order[spot[hits]], block[hits]
    blocks, place = np.unique(at, return_inverse=True)
    distinct = np.unique(place.astype(np.int64) * len(known) + pair)
    found = []
    for family, own in NOTICES:
        member = np.array([t in own for t in known])
        times = np.bincount((distinct // len(known))[member[distinct % len(known)]], minlength=len(blocks))
        for b in np.flatnonzero(times >= CONFIRMED * len(own)).tolist():
            low, high = np.searchsorted(place, [b, b + 1])
            chosen = [k for k in range(low, high) if member[pair[k]]]
            events = [(int(line[hits[k]]), int(line[hits[k] + 1]), known[pair[k]]) for k in chosen]
            runs = _runs(events, CONFIRMED * len(own))
            found += [(a, z, family, n / len(own)) for a, z, n in runs if a < z]
    return found


def _line_scores(column: pa.Array, model: Model):
    """Terms of all paragraphs: (paragraph, term place) pairs, where paragraphs start and end, wrapped notices."""
    bounds, data = raw_texts(column)
    found, starts, _, _ = words_of(column, _FOLD)
    breaks = np.flatnonzero(data[bounds[0] : bounds[-1]] == 10) + bounds[0]
    firsts = np.unique(np.concatenate([bounds[:-1][bounds[:-1] < bounds[1:]], breaks]))
    line = np.searchsorted(firsts, starts, side="right") - 1
    distinct = [w.rstrip(b" ").decode("utf-8", "replace") for w in found.dictionary.to_pylist()]
    which = found.indices.to_numpy()
    # Numbers for words that occur in some term; all others are 0.
    numbers = {w: i + 1 for i, w in enumerate(sorted({w for t in (*model.places, *(p for _, own in NOTICES for p in own)) for w in t.split(" ")}))}
    number = np.array([numbers.get(w, 0) for w in distinct], np.int64)[which] if distinct else np.zeros(0, np.int64)
    singles = np.full(len(numbers) + 1, -1, np.int64)
    couples = {}
    for t, i in model.places.items():
        a, _, b = t.partition(" ")
        if b:
            couples[(numbers[a] << 32) | numbers[b]] = i
        else:
            singles[numbers[a]] = i
    keys = np.array(sorted(couples), np.int64)
    values = np.array([couples[k] for k in keys.tolist()], np.int64)
    at = singles[number] if len(number) else number
    lines, places = [line[at >= 0]], [at[at >= 0]]
    if len(number) > 1 and len(keys):
        code = (number[:-1] << 32) | number[1:]
        spot = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        hit = (keys[spot] == code) & (line[:-1] == line[1:])
        lines.append(line[:-1][hit])
        places.append(values[spot[hit]])
    both = np.unique(np.stack([np.concatenate(lines), np.concatenate(places)], axis=1), axis=0)
    of_text = np.searchsorted(bounds, firsts, side="right") - 1
    return both, firsts, bounds, data, _wrapped(line, of_text, number, numbers)


def scan(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns), n_paragraphs and findings, see ``FINDING``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carry = docs.columns if carry is None else carry
    row = T.StructType([docs.schema[c] for c in carry])
    schema = T.StructType(
        [T.StructField("row", row), T.StructField("n_paragraphs", T.LongType()), T.StructField("findings", FINDING)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, lambda b: pc.struct_field(b.column("row"), "text")):
            rows = batch.column("row")
            both, firsts, bounds, data, wrapped = _line_scores(pc.struct_field(rows, "text"), own)
            sums = np.zeros((len(firsts), len(own.families)))
            np.add.at(sums, both[:, 0], own.weights[both[:, 1]])
            sure = own.probabilities(sums) if len(firsts) else sums
            best = sure[:, :-1].argmax(axis=1) if len(firsts) else np.zeros(0, np.int64)
            passed = np.flatnonzero(sure[np.arange(len(firsts)), best] >= own.least) if len(firsts) else best
            of_text = np.searchsorted(bounds, firsts, side="right") - 1
            first_line = np.searchsorted(firsts, bounds)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            edges = np.append(firsts, bounds[-1])
            between = lambda a, z: bytes(data[edges[a] : min(edges[z + 1], bounds[of_text[a] + 1])]).decode("utf-8", "replace")  # noqa: E731, B023
            alone, taken = set(), set()
            for k in passed.tolist():
                text = between(k, k)
                family = own.families[best[k]]
                overlap = _overlap(text, family)
                found[of_text[k]].append(
                    (k - int(first_line[of_text[k]]), family, float(sure[k, best[k]]), overlap, overlap >= CONFIRMED)
                )
                if overlap >= CONFIRMED:
                    alone.add((k, family))
            # Of runs that share a line the one that holds most of its template.
            for a, z, family, overlap in sorted(wrapped, key=lambda w: (-w[3], w[0], w[1])):
                chance = own.of(between(a, z))
                k = int(chance[:-1].argmax())
                # A whole template names its family; less of one must agree with the classifier.
                if 1 - chance[-1] < own.least or (overlap < 1 and own.families[k] != family):
                    continue
                if any((i, family) in alone or i in taken for i in range(a, z + 1)):
                    continue
                taken.update(range(a, z + 1))
                found[of_text[a]].append((a - int(first_line[of_text[a]]), family, float(1 - chance[-1]), overlap, True))
            for own_found in found:
                own_found.sort(key=lambda f: f[0])
            kept = pa.StructArray.from_arrays([pc.struct_field(rows, c) for c in carry], names=carry)
            names = ["paragraph", "family", "probability", "overlap", "confirmed"]
            listed = pa.array([[dict(zip(names, f, strict=True)) for f in own_found] for own_found in found], _KIND)
            yield pa.RecordBatch.from_arrays([kept, pa.array(np.diff(first_line)), listed], names=schema.names)

    return map_arrow(as_rows(docs), run, schema)


_KIND = pa.list_(
    pa.struct(
        [("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("confirmed", pa.bool_())]
    )
)
