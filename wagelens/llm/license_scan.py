"""Licence scans by a trained paragraph classifier (op4).

A softmax regression over sparse word uni- and bigrams tells licence families
from ordinary paragraphs.  It is trained here on a bounded sample: up to
``SAMPLE`` paragraphs of the corpus (those of least hash, of at most
``SAMPLE_CHARS`` characters) and pieces of the
templates put between words of them; pieces whose telling words are replaced
teach the class ``unknown``.  Weights are kept sparse by shrinking.
The probability from which a family is named is calibrated on rows kept out
of the training; below it a licence-like paragraph is ``unknown``.  A named
family counts as confirmed when the paragraph holds half of the word pairs of
one of its templates, or half of its own pairs are the template's.

The model is bounded by the templates and broadcast; the scan is one narrow
pass over whole texts, paragraph by paragraph (lines).

Defined results: null and empty texts have no paragraphs; repeated rows each
give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.kernels import ALNUM_WORDS, BASE, LOWER, U64, mix, prefix_hash, span_hash, text_buffer, word_spans
from wagelens.llm.shared import id_and_text, least_hashed, small_batches

#: Characteristic sentences of licence families.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Distributed under the License on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License."],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl-2": [
        "This work is licensed under the GNU General Public License, version 2.",
        "redistribute it and/or modify it under the terms of the GNU General Public License, either version 2 of the License"],
    "gpl-3": [
        "This work is licensed under the GNU General Public License, version 3.",
        "redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License"],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": [
        "All rights reserved. No part of this work may be reproduced without permission."],
}
FAMILIES = list(TEMPLATES)
#: Bounds of the sample of corpus paragraphs that the classifier is fitted on:
#: paragraphs, and characters of a sampled one (the scan reads all of any length).
SAMPLE, SAMPLE_CHARS = 10_000, 4000
ROUNDS, RATE, SHRINK = 300, 2.0, 1e-4
#: Share of right names among the kept-out rows from which a probability counts.
PRECISION = 0.99
CONFIRM = 0.5
NEWLINE = 0x0A


def paragraphs(column):
    """Words of each paragraph: (row, paragraph, word hash, opening, paragraphs per row)."""
    data, off = text_buffer(column)
    start, end, row = word_spans(LOWER[data], off, ALNUM_WORDS)
    line = np.cumsum(data == NEWLINE)
    lines = np.concatenate(([0], line))
    full = off[1:] > off[:-1]
    count = np.where(full, lines[off[1:]] - lines[off[:-1]] + 1, 0)
    if len(start) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U64), count
    h = span_hash(prefix_hash(LOWER[data]), start, end)
    return row, line[start] - lines[off[row]], h, count


def pairs(h: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one (0 where the paragraph ends)."""
    out = np.zeros(len(h), U64)
    if len(h) > 1:
        out[:-1] = np.where(same, mix(h[:-1] * U64(BASE) + h[1:]), U64(0))
    return out


def vocabulary() -> SimpleNamespace:
    """Word and pair terms of the templates, and each template's pairs."""
    texts = [t for f in FAMILIES for t in TEMPLATES[f]]
    row, _, h, _ = paragraphs(pa.array([t.replace("\n", " ") for t in texts]))
    two = pairs(h, row[1:] == row[:-1])
    terms = np.unique(np.concatenate((h, two[two != 0])))
    family = [i for i, f in enumerate(FAMILIES) for _ in TEMPLATES[f]]
    own = [np.unique(np.searchsorted(terms, two[(row == i) & (two != 0)])) for i in range(len(texts))]
    return SimpleNamespace(terms=terms, is_pair=~np.isin(terms, h), family=family, pairs=own)


def features(column, vocab: SimpleNamespace):
    """Sparse rows of the paragraphs that hold a template word: (row,
    paragraph, per entry its feature row, term), words per feature row."""
    row, para, h, count = paragraphs(column)
    if len(h) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z, count
    key = row * np.int64(1 << 32) + para
    unit, at = np.unique(key, return_inverse=True)
    two = pairs(h, key[1:] == key[:-1])
    entry = np.concatenate((at, at))
    term = np.concatenate((h, two))
    place = np.minimum(np.searchsorted(vocab.terms, term), len(vocab.terms) - 1)
    known = vocab.terms[place] == term
    cell = np.unique(entry[known] * np.int64(len(vocab.terms)) + place[known])
    words = np.bincount(at, minlength=len(unit))
    return unit >> 32, unit & 0xFFFFFFFF, cell // len(vocab.terms), cell % len(vocab.terms), words, count


def design(entry, term, words, n_terms: int) -> np.ndarray:
    """Dense rows for the bounded sample: terms present, and their share."""
    x = np.zeros((len(words), n_terms + 1), np.float32)
    x[entry, term] = 1
    x[:, n_terms] = np.minimum(1, np.bincount(entry, minlength=len(words)) / np.maximum(1, 2 * words))
    return x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, classes: int):
    """Softmax regression by proximal gradient steps with momentum; classes
    weigh alike.  Shrinking sets the weights of idle terms to zero."""
    weight = (1 / np.maximum(1, np.bincount(y, minlength=classes)))[y]
    weight /= weight.sum()
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    onehot = np.eye(classes)[y]
    for _ in range(ROUNDS):
        err = (softmax(x @ (w + 0.9 * vw) + b + 0.9 * vb) - onehot) * weight[:, None]
        vw, vb = 0.9 * vw - RATE * (x.T @ err), 0.9 * vb - RATE * err.sum(0)
        w, b = w + vw, b + vb
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * SHRINK, 0)
    return w, b


def train(docs: DataFrame) -> SimpleNamespace:
    vocab = vocabulary()
    lines = (id_and_text(docs).select(F.explode(F.split("text", "\n")).alias("line"))
             .where(F.length("line").between(1, SAMPLE_CHARS)).withColumn("k", F.xxhash64("line")))
    lines = (least_hashed(lines, F.col("k"), SAMPLE).groupBy("k").agg(F.min("line").alias("line"))
             .orderBy("k").limit(SAMPLE).collect())
    plain = [r["line"] for r in lines if not like_template(r["line"], vocab)] or ["a"]
    texts, y = [], []
    unknown, none = len(FAMILIES), len(FAMILIES) + 1
    bare = lambda word: "".join(c for c in word.lower() if c.isalnum())
    families_of: dict[str, set] = {}
    for family in FAMILIES:
        for template in TEMPLATES[family]:
            for word in template.split(" "):
                families_of.setdefault(bare(word), set()).add(family)
    for i, line in enumerate(plain):
        texts.append(line)
        y.append(none)
    k = 0
    for f, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split(" ")
            for cut in (1.0, 0.8, 0.65):
                size = max(3, round(cut * len(words)))
                for begin in sorted({0, (len(words) - size) // 2, len(words) - size}):
                    piece = " ".join(words[begin:begin + size])
                    shared_words = [v for v in words[begin:begin + size] if len(families_of[bare(v)]) >= 3]
                    if 3 <= len(shared_words) < size:
                        for turn in range(12):
                            other = plain[(k + turn) % len(plain)].split(" ")
                            texts.append(" ".join(v if len(families_of[bare(v)]) >= 3 else other[(turn + j) % len(other)]
                                                  for j, v in enumerate(words[begin:begin + size])))
                            y.append(unknown)
                    for around in range(12):
                        other = plain[k % len(plain)].split(" ")
                        k += 1
                        texts.append(" ".join([*other[:around // 2 * 4], piece, *other[around // 2 * 4:around * 5]]) if around else piece)
                        y.append(f)
    _, _, entry, term, words, _ = features(pa.array([t.replace("\n", " ") for t in texts]), vocab)
    unit = np.array([i for i, t in enumerate(texts) if has_word(t)], np.int64)
    y = np.array(y)[unit]
    x = design(entry, term, words, len(vocab.terms))
    kept_out = np.arange(len(y)) % 5 == 0
    w, b = fit(x[~kept_out], y[~kept_out], none + 1)
    p = softmax(x[kept_out] @ w + b)[:, :unknown]
    top, right = p.max(1), p.argmax(1) == y[kept_out]
    named = np.argsort(-top)
    share = np.cumsum(right[named]) / np.arange(1, len(named) + 1)
    good = np.flatnonzero(share >= PRECISION)
    limit = float(np.clip(top[named][good[-1]], 0.5, 0.95)) if len(good) else 0.95
    return SimpleNamespace(vocab=vocab, w=w, b=b, limit=limit)


def has_word(text: str) -> bool:
    return len(paragraphs(pa.array([text.replace("\n", " ")]))[2]) > 0


def like_template(text: str, vocab: SimpleNamespace) -> bool:
    """Whether a sampled paragraph holds half of a template: no plain one."""
    _, _, _, term, _, _ = features(pa.array([text.replace("\n", " ")]), vocab)
    here = set(term.tolist())
    return any(sum(t in here for t in p.tolist()) >= CONFIRM * len(p) and len(p) > 2 for p in vocab.pairs)


FOUND = "array<struct<paragraph:int,family:string,probability:double,confirmed:boolean>>"


def scan_batches(shared):
    def run(batches):
        model = shared.value
        vocab, none = model.vocab, len(FAMILIES) + 1
        for batch in batches:
            row, para, entry, term, words, count = features(batch.column("text"), vocab)
            share = np.minimum(1, np.bincount(entry, minlength=len(words)) / np.maximum(1, 2 * words))
            z = np.tile(model.b, (len(words), 1)) + share[:, None] * model.w[-1]
            for c in range(none + 1):
                z[:, c] += np.bincount(entry, weights=model.w[term, c], minlength=len(words))
            p = softmax(z) if len(z) else z
            likely = np.flatnonzero(p[:, none] < 0.5) if len(z) else np.zeros(0, np.int64)
            cut = np.searchsorted(entry, np.arange(len(words) + 1))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for u in likely.tolist():
                f = int(p[u, :none].argmax())
                named = f < len(FAMILIES) and p[u, f] >= model.limit
                here = term[cut[u]:cut[u + 1]]
                two = int(vocab.is_pair[here].sum())
                # An unknown licence still reads like one: a third of its word pairs do.
                if not named and (two < 2 or 3 * two < words[u] - 1):
                    continue
                confirmed = False
                for owner, own in zip(vocab.family, vocab.pairs):
                    if named and owner == f and len(own):
                        both = len(np.intersect1d(here, own, assume_unique=True))
                        confirmed |= both >= CONFIRM * min(len(own), max(1, words[u] - 1)) and both >= min(2, len(own))
                found[int(row[u])].append({"paragraph": int(para[u]), "family": FAMILIES[f] if named else "unknown",
                                           "probability": float(p[u, f]), "confirmed": bool(named and confirmed)})
            kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(found, kind)],
                                             ["doc_id", "n_paragraphs", "found"])

    return run


def scan(docs: DataFrame) -> DataFrame:
    """Per document: paragraphs, licence paragraphs found, the confirmed
    families, and the counts of unconfirmed and unknown ones."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    found = id_and_text(docs).mapInArrow(scan_batches(shared), f"doc_id long, n_paragraphs long, found {FOUND}")
    named = F.filter("found", lambda x: x["confirmed"])
    loose = F.filter("found", lambda x: ~x["confirmed"] & (x["family"] != "unknown"))
    return found.select(
        "doc_id", "n_paragraphs", F.array_join(F.array_sort(F.array_distinct(F.transform(named, lambda x: x["family"]))), ",").alias("families"),
        F.size(named).cast("long").alias("n_confirmed"), F.size(loose).cast("long").alias("n_unconfirmed"),
        F.size(F.filter("found", lambda x: x["family"] == "unknown")).cast("long").alias("n_unknown"), "found")
