"""License scan as an exact set-similarity join between text blocks and license templates.

Blocks are overlapping windows of words over the whole text, across line ends.  Their size and step follow each template's
length: a block is twice as long as the template and starts every half template, so any stretch of one and a half template
lengths lies whole inside a block, however the text is wrapped.
A block meets a template if it holds at least the share `containment` of the template's distinct tokens.
Tokens are ordered by their frequency in the corpus, rarest first.  A block that meets a template of n tokens
shares one of the template's n - ceil(containment * n) + 1 rarest tokens (prefix filter); it has at least
ceil(containment * n) distinct tokens (length filter); and after the first shared token at place i of the
template at most n - i tokens can be shared (positional filter).  What passes is counted exactly.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import per_text, texts

# Phrases that name a license by themselves.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Sentences of public licenses.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License. See the LICENSE file for details."),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("all-rights-reserved", "All rights reserved."),
    ("all-rights-reserved", "Copyright. All rights reserved. No part of this publication may be reproduced"),
)
#: Word bytes stay: digits, ASCII letters and all of UTF-8 beyond ASCII; other ASCII becomes a blank.
BLANKED = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def words_of(body: bytes) -> list[bytes]:
    return body.lower().translate(BLANKED).split()


class Prefixes:
    """The templates with their tokens rarest first, and an index of their prefixes."""

    def __init__(self, templates, frequency: dict[bytes, int], containment: float, block_words: int | None = None):
        self.templates, self.index = [], defaultdict(list)
        for label, text in templates:
            length = len(words := words_of(text.encode()))
            tokens = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
            need = math.ceil(containment * len(tokens) - 1e-9)
            size = max(block_words or 0, 2 * length)
            step = max(1, size // 2 if block_words else length // 2)
            for place, token in enumerate(tokens[: len(tokens) - need + 1]):
                self.index[token].append((len(self.templates), place))
            self.templates.append((label, frozenset(tokens), len(tokens), need, size, step))
        self.rare = frozenset(self.index)

    def meets(self, words: list[bytes]):
        """(first word, template, share) of every block of a text that contains a template far enough."""
        seen = defaultdict(list)
        for at, word in enumerate(words):
            if word in self.rare:
                for template, place in self.index[word]:
                    seen[template].append((at, place))
        for template, places in seen.items():
            _, wanted, n, need, size, step = self.templates[template]
            last = max(0, len(words) - size + step - 1) // step
            first: dict[int, int] = {}
            for at, place in places:
                for block in range(max(0, (at - size) // step + 1), min(at // step, last) + 1):
                    first[block] = min(place, first.get(block, place))
            for block, place in first.items():
                tokens = set(words[block * step : block * step + size])
                if len(tokens) >= need and n - place >= need and (shared := len(tokens & wanted)) >= need:
                    yield block * step, template, shared / n


def phrase_places(words: list[bytes], phrases) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after the other."""
    line, found = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases:
        wanted = b" " + b" ".join(words_of(phrase.encode())) + b" "
        at = line.find(wanted)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(wanted, at + 1)
    return found


COUNTED = pa.schema([("token", pa.binary()), ("n", pa.int64())])
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("blocks", pa.list_(pa.struct([("start_word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))),
])
DDL = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<start_word:long,label:string,containment:double>>"


def token_frequencies(cols: DataFrame, tokens: frozenset[bytes]) -> dict[bytes, int]:
    """Occurrences in all texts of the templates' tokens (a fixed list of a few hundred at most)."""

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for body in batch.column("body").to_pylist():
                if body and not tokens.isdisjoint(words := words_of(body)):
                    total.update(w for w in words if w in tokens)
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], schema=COUNTED)

    summed = cols.select("body").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {bytes(r["token"]): r["n"] for r in summed.collect()}  # one row for each template token at most


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment: float = 0.8, block_words: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Phrase places, labels and matching blocks of every row of `docs`.

    `labels` joins the phrases' labels and those of the templates met; `score` is 1 where a phrase stands, else the
    best containment met, else 0; `blocks` lists what the join found.  With `block_words` blocks have at least so many words
    and overlap by half.  A null or empty text has no words and no labels.  Repeated rows are
    scanned one by one, a null id is handed through, other columns are ignored, an empty table gives an empty result.

    Two passes over the texts: one counts the template tokens, one joins.  Templates are a parameter of a few
    hundred tokens, so their prefix index goes to every task; nothing of a text is shuffled.
    """
    cols = texts(docs, id_col, text_col)
    vocabulary = frozenset(w for _, text in templates for w in words_of(text.encode()))
    index = Prefixes(templates, token_frequencies(cols, vocabulary), containment, block_words)

    def make():
        def one(doc_id, body):
            words = words_of(body or b"")
            base = phrase_places(words, phrases)
            found = () if index.rare.isdisjoint(words) else sorted(index.meets(words))
            met = [{"start_word": start, "label": index.templates[t][0], "containment": share} for start, t, share in found]
            base_labels = {label for _, label in base}
            places = [place for place, _ in base]
            score = 1.0 if base else max((m["containment"] for m in met), default=0.0)
            return doc_id, len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {m["label"] for m in met})), score, met

        return one

    return cols.mapInArrow(per_text(make, SCHEMA), DDL)
