"""Licence statements found by a trained paragraph classifier and confirmed by templates.

Paragraphs are the lines of a text. They are read in overlapping windows of words, about as long
as long and short templates, and lines that are not much longer also as a whole, so that a
statement counts as much inside a long line as on a line of its own. The word unigrams and
bigrams of a window feed a multinomial logistic regression over licence families and an unknown
class. It is trained on the driver from the templates below, worn down at random, and from
sentences that only sound similar. Its weights are sparse: words outside the training vocabulary
weigh nothing, so that a window without any of them is unknown. A temperature fitted on held-out
examples calibrates the probabilities, and the threshold is the lowest with the wanted held-out
precision. A predicted family counts only if the window and one of the family's templates share
enough bigrams, and if the line does not name another licence there: the shared words are grown
over the licence words beside them, and where that span holds whole licence names, the longest
of them must be one of the family. Names of licences without a family are known too, so that
they confirm nothing. A line has a span for each family, unless the words that speak for it are part
of a longer statement.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts_in

WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
UNKNOWN = "unknown"

# Statements by which works name their licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without"
        " restriction",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0"
        " International License.",
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0"
        " International License.",
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives"
        " 4.0 International License.",
    ),
    "public-domain": (
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "The author has dedicated the work to the public domain.",
    ),
    "unlicense": (
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation",
    ),
    "epl": (
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License 2.0",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    "artistic": (
        "Licensed under the Artistic License 2.0.",
        "This is free software; you can redistribute it under the terms of the Artistic License",
    ),
    "reserved": (
        "All rights reserved. No part of this work may be reproduced without the written"
        " permission of the publisher.",
    ),
}

# Whole names of licences, hyphens read as spaces.
NAMES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("apache license version 2.0", "apache license 2.0", "apache 2.0", "apache license", "apache licence"),
    "mit": ("mit license", "mit licence"),
    "bsd": ("bsd license", "bsd licence", "bsd 2 clause", "bsd 3 clause"),
    "gpl": ("gnu general public license", "gnu general public licence", "gnu gpl", "gpl"),
    "lgpl": (
        "gnu lesser general public license", "gnu library general public license",
        "lesser general public license", "gnu lgpl", "lgpl",
    ),
    "agpl": ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"),
    "mpl-2.0": ("mozilla public license", "mpl 2.0"),
    "epl": ("eclipse public license",),
    "isc": ("isc license", "isc licence"),
    "unlicense": ("the unlicense",),
    "artistic": ("artistic license", "artistic licence"),
    "cc-by": ("cc by", "creative commons attribution"),
    "cc-by-sa": ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    "cc-by-nc": (
        "cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial",
    ),
    "cc-by-nd": (
        "cc by nd", "creative commons attribution noderivatives", "creative commons attribution noderivs",
        "creative commons attribution no derivatives",
    ),
    "cc-by-nc-sa": (
        "cc by nc sa", "creative commons attribution noncommercial sharealike",
        "creative commons attribution non commercial share alike",
    ),
    "cc-by-nc-nd": (
        "cc by nc nd", "creative commons attribution noncommercial noderivatives",
        "creative commons attribution noncommercial noderivs",
        "creative commons attribution non commercial no derivatives",
    ),
    "public-domain": ("cc0 1.0", "cc0"),
}
# Names of licences that are no family here.
OTHER_NAMES = (
    "academic free license", "adaptive public license", "boost software license",
    "business source license", "common development and distribution license",
    "common public license", "elastic license", "european union public licence",
    "european union public license", "eupl", "gnu free documentation license", "ibm public license",
    "lucent public license", "microsoft public license", "microsoft reciprocal license",
    "netscape public license", "open data commons attribution license", "open database license",
    "open software license", "postgresql license", "python software foundation license",
    "q public license", "server side public license", "sil open font license", "sleepycat license",
    "sun public license", "zlib license", "zope public license",
)

#: Sentences that share words with licences and name none.
OTHER = (
    "The driver had to show a licence before the car was released to the public.",
    "Permission to enter the building was granted by the guard in the first version of events.",
    "A new version of the software was released in May and is free for everyone to use.",
    "The general public was not permitted to use the common land without charge.",
    "He obtained a copy of the work from the library and read it under the tree.",
    "The terms of the agreement are subject to the following conditions and may change.",
    "The foundation published a report on the use of source and binary stars.",
    "She apologised for the commercial, and the creative work of others was dedicated to her.",
    "You may use this file to store the pictures; you can modify it at any time.",
    "Many rights were reserved for the king, and no part of the land was free.",
    "The license plate of the car was not in compliance with the law.",
    "International attribution of the attack was published by the free press.",
    "The apache helicopter was modified in version two of the plan.",
    "Students at MIT released a study under the name of their teacher.",
    "The public domain of a website is subject to a charge by the person who holds it.",
    "Common people were granted the right to redistribute the land.",
    "This file is associated with the software and its documentation.",
    "The mozilla was a form of dinosaur that lived in the lesser hills.",
    "Without restriction, the universal law of nature is published in the work.",
    "All persons obtaining a permit must comply with the general conditions.",
    "The licensed pilot and the licensed doctor work under the same roof.",
    "This work is under review, and version 3 will be published later.",
    "By 4.0 seconds the cc of the engine was measured under load.",
    "The terms of the license fee were not met, as the public report says.",
    *(
        sentence.format(name)
        for name in OTHER_NAMES
        for sentence in ("Licensed under the {}, version 1.2.", "{}")
    ),
)
#: Seeds and sizes of the made training set.
COPIES, UNLIKE, SEED, EPOCHS = 160, 53, 11, 300
#: Held-out precision at which the threshold is set, and shared bigrams that confirm.
PRECISION, SHARED = 0.995, 0.6
#: Words in a window and from one window to the next, for long and for short templates; lines up
#: to LONG words are also read whole.
WINDOWS, LONG = ((24, 8), (8, 4)), 128
WINDOW, STRIDE = WINDOWS[0]
#: Words that one step of scanning holds; a longer line comes in pieces that overlap.
STEP = 1 << 15


def grams(words: Sequence[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def template_bigrams() -> dict[str, list[frozenset[str]]]:
    return {
        family: [frozenset(pairs(WORD.findall(t.lower()))) for t in some]
        for family, some in TEMPLATES.items()
    }


def pairs(words: Sequence[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def nearest(words: Sequence[str], templates: Sequence[frozenset[str]]) -> tuple[float, list[int]]:
    """Shared bigrams with the nearest template, as a share of the smaller of the two sets, and
    the places of the words in them.

    A window with fewer than three bigrams must hold all of them in the template.
    """
    own = pairs(words)
    some = set(own)
    if not some:
        return 0.0, []
    least = 3 if len(some) > 2 else len(some)
    close, template = max(
        ((len(some & t) / max(min(len(some), len(t)), least), t) for t in templates), key=lambda c: c[0]
    )
    return close, sorted({p for i, g in enumerate(own) if g in template for p in (i, i + 1)})


def _name_words(word: str) -> list[str]:
    return [w for w in word.split("-") if w]


def _names() -> dict[str, list[tuple[tuple[str, ...], str]]]:
    """Names by their first word, the longest first; the family is '' for OTHER_NAMES."""
    some = [(tuple(n.split()), f) for f, own in [*NAMES.items(), ("", OTHER_NAMES)] for n in own]
    out: dict[str, list[tuple[tuple[str, ...], str]]] = {}
    for name, family in sorted(some, key=lambda n: -len(n[0])):
        out.setdefault(name[0], []).append((name, family))
    return out


BY_FIRST = _names()
#: The words that names are made of.
NAME_WORDS = frozenset(w for some in BY_FIRST.values() for name, _ in some for w in name)
#: Words beside the shared ones over which a span grows: longer than any name.
REACH = 12


def named(words: Sequence[str]) -> set[str]:
    """Families whose whole names stand in the words; '' for licences without a family.

    From left to right the longest name counts, and names do not overlap.
    """
    flat = [w for word in words for w in _name_words(word)]
    found, at = set(), 0
    while at < len(flat):
        for name, family in BY_FIRST.get(flat[at], ()):
            if tuple(flat[at : at + len(name)]) == name:
                found.add(family)
                at += len(name)
                break
        else:
            at += 1
    return found


def agrees(family: str, line: Sequence[str], places: Sequence[int]) -> bool:
    """Whether the line names no licence around these places, or this family among others.

    The span from the first to the last place grows over the words of licence names beside it.
    """
    if not places:
        return True
    first, last = places[0], places[-1] + 1
    for _ in range(REACH):
        if first and any(w in NAME_WORDS for w in _name_words(line[first - 1])):
            first -= 1
        if last < len(line) and any(w in NAME_WORDS for w in _name_words(line[last])):
            last += 1
    some = named(line[first:last])
    return not some or family in some


@dataclass
class Model:
    families: list[str]
    vocabulary: dict[str, int]
    weights: np.ndarray  # (grams, classes); class 0 is unknown
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, paragraphs: Sequence[Sequence[str]]) -> np.ndarray:
        hits = [
            [i for g in grams(words) if (i := self.vocabulary.get(g)) is not None]
            for words in paragraphs
        ]
        logits = np.tile(self.bias, (len(hits), 1))
        sizes = np.array(list(map(len, hits)), np.int64)
        some = np.flatnonzero(sizes)
        if len(some):
            flat = np.fromiter((i for h in hits for i in h), np.int64, int(sizes.sum()))
            starts = (np.cumsum(sizes) - sizes)[some]
            scale = np.sqrt(np.array([max(1, len(grams(paragraphs[i]))) for i in some]))
            logits[some] += np.add.reduceat(self.weights[flat], starts, axis=0) / scale[:, None]
        return self._shares(logits)

    def _shares(self, logits: np.ndarray) -> np.ndarray:
        logits /= self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)

    @cached_property
    def parts(self) -> frozenset[str]:
        """Words of known bigrams."""
        return frozenset(w for g in self.vocabulary if " " in g for w in g.split(" "))

    def in_windows(self, words: Sequence[str], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Probabilities of the windows [start, end) of ``words``, as ``probabilities`` has them."""
        find, parts = self.vocabulary.get, self.parts
        logits = np.tile(self.bias, (len(starts), 1))
        single = [(i, k) for i, w in enumerate(words) if (k := find(w)) is not None]
        near = [i for i, w in enumerate(words) if w in parts]
        double = [
            (i, k) for i, j in zip(near, near[1:], strict=False)
            if j == i + 1 and (k := find(f"{words[i]} {words[j]}")) is not None
        ]
        scale = np.sqrt(np.maximum(1, 2 * (ends - starts) - 1))[:, None]
        for hits, reach in ((single, 0), (double, 1)):
            if hits:
                at, rows = np.array(hits, np.int64).T
                sums = np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(self.weights[rows], axis=0)])
                lo = np.searchsorted(at, starts)
                hi = np.maximum(lo, np.searchsorted(at, ends - reach))
                logits += (sums[hi] - sums[lo]) / scale
        return self._shares(logits)


def examples(random: np.random.Generator) -> list[tuple[list[str], int]]:
    """Templates with words lost, replaced and added, and unknown sentences treated the same."""
    noise = sorted({w for s in OTHER for w in WORD.findall(s.lower())})
    strange = ["".join(random.choice(list("abdeghilmnorstu"), random.integers(2, 9))) for _ in range(400)]

    def worn(words: list[str]) -> list[str]:
        out = []
        for w in words:
            r = random.random()
            if r < 0.06:
                continue
            out.append(str(random.choice(strange)) if r < 0.09 else w)
        extra = [str(w) for w in random.choice(noise + strange, random.integers(0, 7))]
        return out + extra if random.random() < 0.5 else extra + out

    made = []
    for number, some in enumerate(TEMPLATES.values(), 1):
        for text in some:
            words = WORD.findall(text.lower())
            made += [(worn(words) if k else words, number) for k in range(COPIES // len(some))]
    for text in OTHER:
        words = WORD.findall(text.lower())
        made += [(worn(words), 0) for _ in range(UNLIKE)]
    for _ in range(COPIES * 3):
        made.append(([str(w) for w in random.choice(noise + strange, random.integers(1, 30))], 0))
        made.append(([str(w) for w in random.choice(strange, random.integers(1, 60))], 0))
    return made


def train(seed: int = SEED) -> Model:
    """Fit on four fifths of the made examples, calibrate on the rest."""
    random = np.random.default_rng(seed)
    made = examples(random)
    order = random.permutation(len(made))
    fit, held = order[len(order) // 5 :], order[: len(order) // 5]
    spread: dict[str, int] = {}
    for i in fit:
        for g in set(grams(made[i][0])):
            spread[g] = spread.get(g, 0) + 1
    vocabulary = {g: i for i, g in enumerate(sorted(g for g, n in spread.items() if n >= 5))}
    classes = len(TEMPLATES) + 1
    model = Model(list(TEMPLATES), vocabulary, np.zeros((len(vocabulary), classes)), np.zeros(classes), 1.0, 0.5)
    x = np.zeros((len(fit), len(vocabulary)), np.float32)
    for row, i in enumerate(fit):
        own = grams(made[i][0])
        for g in own:
            if g in vocabulary:
                x[row, vocabulary[g]] += 1 / np.sqrt(max(1, len(own)))
    y = np.zeros((len(fit), classes), np.float32)
    y[np.arange(len(fit)), [made[i][1] for i in fit]] = 1
    w, b = np.zeros((len(vocabulary), classes), np.float32), np.zeros(classes, np.float32)
    b[0] = 1.0
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(EPOCHS):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - y) / len(fit)
        speed_w = 0.9 * speed_w - 10.0 * (x.T @ error + 1e-5 * w)
        speed_b = 0.9 * speed_b - 1.0 * error.sum(0)
        w, b = w + speed_w, b + speed_b
    # Weights that hardly matter are dropped, and words left without any.
    w[np.abs(w) < 0.02] = 0
    alive = np.flatnonzero(np.abs(w).sum(1))
    names = sorted(vocabulary, key=vocabulary.get)
    model.vocabulary = {names[i]: k for k, i in enumerate(alive)}
    model.weights, model.bias = w[alive].astype(np.float64), b.astype(np.float64)
    _calibrate(model, [made[i][0] for i in held], np.array([made[i][1] for i in held]))
    return model


def _calibrate(model: Model, paragraphs: list[list[str]], labels: np.ndarray) -> None:
    def loss(temperature: float) -> float:
        model.temperature = temperature
        p = model.probabilities(paragraphs)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.2, 5, 41)), key=loss)
    p = model.probabilities(paragraphs)
    best, top = p[:, 1:].argmax(1) + 1, p[:, 1:].max(1)
    for threshold in np.arange(0.3, 0.96, 0.05):
        taken = top >= threshold
        if not taken.any() or (best[taken] == labels[taken]).mean() >= PRECISION:
            break
    model.threshold = float(threshold)


SPAN = "struct<paragraph: long, start: long, length: long, family: string, probability: double, likeness: double, confirmed: boolean>"


def windows_of(n_words: int) -> list[tuple[int, int]]:
    """Windows of a line that together hold all its words; a line of up to LONG words is one too."""
    out = [(0, n_words)] if n_words <= LONG else []
    for length, stride in WINDOWS:
        if n_words > length:
            out += [(s, s + length) for s in range(0, n_words - length, stride)]
            out.append((n_words - length, n_words))
    return out


def _steps(lines: list[list[str]]) -> Iterator[tuple[list[str], list[tuple[int, int, int, int]]]]:
    """Words of some lines, and their windows: line, first word in the line, place in the words."""
    words: list[str] = []
    windows: list[tuple[int, int, int, int]] = []
    for number, line in enumerate(lines):
        most = STEP // STRIDE * STRIDE
        for cut in range(0, max(1, len(line) - WINDOW), most):
            # Each piece of a long line starts at a window and holds all of the last one.
            piece = line[cut : cut + most + WINDOW] if len(line) > most + WINDOW else line
            if words and len(words) + len(piece) > STEP:
                yield words, windows
                words, windows = [], []
            windows += [(number, cut + s, len(words) + s, len(words) + e) for s, e in windows_of(len(piece))]
            words += piece
            if piece is line:
                break
    if windows:
        yield words, windows


def judge(model: Model, text: str | None, templates: dict[str, list[frozenset[str]]]) -> tuple[int, list[dict]]:
    """Paragraphs with a word, and those of a predicted family, with their place in the text."""
    spans, lines, at = [], [], 0
    for line in (text or "").split("\n"):
        if line.strip():
            spans.append((at, len(line)))
            lines.append(WORD.findall(line.lower()))
        at += len(line) + 1
    found: dict[int, list[tuple]] = {}
    for words, windows in _steps(lines):
        number, first, starts, ends = np.array(windows, np.int64).T
        p = model.in_windows(words, starts, ends)
        best = p[:, 1:].argmax(1)
        for i in np.flatnonzero(p[:, 1:].max(1) >= model.threshold).tolist():
            family = model.families[best[i]]
            close, places = nearest(words[starts[i] : ends[i]], templates[family])
            places = [int(first[i]) + x for x in places]
            if close >= SHARED and not agrees(family, lines[int(number[i])], places):
                close = 0.0  # another licence is named here
            found.setdefault(int(number[i]), []).append((close, float(p[i, best[i] + 1]), family, places))
    out = []
    for paragraph, some in sorted(found.items()):
        for close, probability, family in _closest(some, len(lines[paragraph])):
            out.append(
                {
                    "paragraph": paragraph, "start": spans[paragraph][0], "length": spans[paragraph][1],
                    "family": family, "probability": probability,
                    "likeness": close, "confirmed": close >= SHARED,
                }
            )
    return len(lines), out


def _closest(some: list[tuple], n_words: int) -> Iterator[tuple[float, float, str]]:
    """For each family of a line its confirmed window with the most shared words, if there is one.

    Windows overlap and may cut a statement, so that a family counts only where at least half of
    the words it shares with its template do not speak for another family with more of them.
    """
    taken, seen = [""] * n_words, set()
    for close, probability, family, places in sorted(
        some, key=lambda c: (c[0] < SHARED, -len(c[3]), -c[0], -c[1], c[2])
    ):
        if sum(taken[x] not in ("", family) for x in places) * 2 > len(places):
            continue
        for x in places:
            taken[x] = taken[x] or family
        if family not in seen:
            seen.add(family)
            yield close, probability, family


def scanned(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_paragraphs, family, families and spans.

    ``spans`` has every paragraph with a predicted family, once for each; ``families`` the confirmed ones in
    alphabetical order and ``family`` the one of the most probable confirmed paragraph (the
    earliest of equals), null without one. The likeness is 0 where the line names another licence.
    Ids must be whole numbers or text of such. A null or empty text has no paragraphs. Other
    columns are not read; an empty table gives an empty result.
    """
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # a few hundred KB
    fields = "key long, n_paragraphs long, spans array<" + SPAN + ">"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, templates = pickle.loads(sent.value), template_bigrams()
        kind = pa.list_(
            pa.struct(
                [
                    ("paragraph", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("family", pa.string()), ("probability", pa.float64()),
                    ("likeness", pa.float64()), ("confirmed", pa.bool_()),
                ]
            )
        )
        for batch in batches:
            judged = [judge(own, text, templates) for text in texts_in(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([n for n, _ in judged], pa.int64()),
                    pa.array([s for _, s in judged], kind),
                ],
                names=["key", "n_paragraphs", "spans"],
            )

    confirmed = F.filter("spans", lambda s: s["confirmed"])
    best = F.array_max(
        F.transform(confirmed, lambda s: F.struct(s["probability"], -s["paragraph"], s["family"].alias("family")))
    )
    return slim.mapInArrow(run, fields).select(
        F.col("key").alias(key), "n_paragraphs", best["family"].alias("family"),
        F.array_sort(F.array_distinct(F.transform(confirmed, lambda s: s["family"]))).alias("families"),
        "spans",
    )
