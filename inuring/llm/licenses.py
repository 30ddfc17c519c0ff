"""License scans with a positional index of words.

Templates (notices) are indexed by word and position. Each licence word of a file is looked up at every place; the postings
that agree on where the template would start are its words in place, counted exactly. A template that stands is then verified
for its key phrases, which must lie in the notice as placed. A key phrase is looked up by its own rarest word, by IDF over the
whole table, at every place, so each of its occurrences is found whatever else the file holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.text import WORD, Texts, Words, add_columns, chunks, fresh, list_array, texts_of


@dataclass(frozen=True)
class Template:
    """A notice, with phrases of which each must stand in it, as the file has it, for the label to be given."""

    label: str
    text: str
    key_phrases: tuple[str, ...]


#: (phrase, label): each occurrence counts.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: One-line notices, then the wording of common licences without names and years.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "source and binary forms")),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("general public license",)),
    Template(
        "mit",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
        files the software to deal in the software without restriction including without limitation the rights to use copy modify
        merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
        express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability
        whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or
        other dealings in the software""",
        ("permission is hereby granted", "free of charge", "without warranty of any kind"),
    ),
    Template(
        "bsd",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and
        the following disclaimer in the documentation and or other materials provided with the distribution""",
        ("redistribution and use", "source and binary forms", "following disclaimer"),
    ),
    Template(
        "isc",
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
        that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author
        disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness""",
        ("with or without fee", "author disclaims all warranties"),
    ),
    Template(
        "zlib",
        """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
        damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
        commercial applications and to alter it and redistribute it freely subject to the following restrictions""",
        ("held liable for any damages", "alter it and redistribute it freely"),
    ),
    Template(
        "unlicense",
        """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell
        or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial
        and by any means""",
        ("free and unencumbered software", "public domain"),
    ),
    Template(
        "apache-2.0",
        """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
        may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in
        writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
        either express or implied see the license for the specific language governing permissions and limitations under the license""",
        ("apache license", "version 2 0", "as is basis"),
    ),
    Template(
        "gpl",
        """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
        published by the free software foundation either version 3 of the license or at your option any later version this program is
        distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability
        or fitness for a particular purpose see the gnu general public license for more details""",
        ("gnu general public license", "without any warranty"),
    ),
    Template(
        "lgpl",
        """this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
        as published by the free software foundation""",
        ("gnu lesser general public license",),
    ),
    Template(
        "mpl",
        """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with
        this file you can obtain one at http mozilla org mpl 2 0""",
        ("mozilla public license", "source code form"),
    ),
)
#: Share of a template's words that have to stand at their places.
LEAST_SHARE = 0.8
#: How far a key phrase may lie outside the notice as placed, as a share of the notice.
SLACK = 0.25


class Index:
    """Postings of the templates, numbered words and the IDF of each."""

    def __init__(self, phrases: tuple[tuple[str, str], ...], templates: tuple[Template, ...]):
        self.phrases, self.templates = phrases, templates
        lines = [p for p, _ in phrases] + [t.text for t in templates] + sorted({k for t in templates for k in t.key_phrases})
        words = texts_of(pa.array(lines, pa.string())).words(WORD, lower=True)
        number, self.vocabulary = words.encoded()
        by_line = {line: number[words.first[i] : words.first[i + 1]].astype(np.int64) for i, line in enumerate(lines)}
        self.phrase_words = [by_line[p] for p, _ in phrases]
        self.template_words = [by_line[t.text] for t in templates]
        self.key_words = [[by_line[k] for k in t.key_phrases] for t in templates]
        self.idf = np.zeros(len(self.vocabulary))

    def numbers(self, words: Words) -> np.ndarray:
        """The licence word each word is, or -1."""
        if not len(words):
            return np.zeros(0, np.int64)
        return pc.fill_null(pc.index_in(words.array(), value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def places(self, number: np.ndarray, words: Words, phrase: np.ndarray) -> np.ndarray:
        """Words at which the phrase starts: found by its rarest word, then verified at the relative positions."""
        anchor = int(np.argmax(self.idf[phrase]))
        at = np.flatnonzero(number == phrase[anchor]) - anchor
        at = at[(at >= 0) & (at + len(phrase) <= len(words))]
        at = at[words.doc[at] == words.doc[at + len(phrase) - 1]] if len(at) else at
        for k, w in enumerate(phrase):
            at = at[number[at + k] == w]
        return at

    def shares(self, number: np.ndarray, words: Words, least: float) -> tuple[np.ndarray, list[set[int]]]:
        """By template and text: the largest share of the template's words that one placement, where two at least stand, has
        in place; and by template the texts where a placement with ``least`` of them has all its key phrases. Every posting
        of every licence word counts, so it is exact however much else the text holds."""
        at = np.flatnonzero(number >= 0)
        gap = 2 * max(map(len, self.template_words), default=0)  # apart by so much, texts have no placement in common
        shift = lambda p: p + words.doc[p] * gap + gap
        base = words.first[:-1] + np.arange(len(words.counts)) * gap
        place = shift(at)
        order = np.argsort(number[at], kind="stable")
        first = np.searchsorted(number[at][order], np.arange(len(self.vocabulary) + 1))
        best, labelled = np.zeros((len(self.template_words), len(base))), []
        for t, line in enumerate(self.template_words):
            labelled.append(set())
            # a template may begin before its file does or run over its end: those words are not in place
            agree = np.bincount(np.concatenate([place[order[first[w] : first[w + 1]]] - i for i, w in enumerate(line)]))
            start = np.flatnonzero(agree >= 2)
            doc = np.searchsorted(base, start) - 1
            own = np.flatnonzero(np.diff(doc, prepend=-1))
            if not len(own):
                continue
            best[t, doc[own]] = np.maximum.reduceat(agree[start], own) / len(line)
            good = agree[start] / len(line) >= least
            start, doc, slack = start[good], doc[good], int(SLACK * len(line))
            for key in self.key_words[t] if len(start) else ():
                where = shift(self.places(number, words, key))  # rising
                low, high = np.searchsorted(where, start - slack), np.searchsorted(where, start + len(line) + slack - len(key), side="right")
                start, doc = start[high > low], doc[high > low]
            labelled[-1] = set(doc.tolist())
        return best, labelled


def word_counts(df: DataFrame, text: str, index: Index) -> tuple[int, np.ndarray]:
    """Texts in the whole table, and in how many of them each licence word stands."""

    def count(batches):
        for batch in batches:
            total = np.zeros(len(index.vocabulary) + 1, np.int64)
            for _, texts in chunks(batch, text):
                words = texts.words(WORD, lower=True)
                number = index.numbers(words)
                at = np.flatnonzero(number >= 0)
                pairs = np.unique(words.doc[at] * len(index.vocabulary) + number[at])
                total[:-1] += np.bincount(pairs % len(index.vocabulary), minlength=len(index.vocabulary))
                total[-1] += len(texts)
            yield pa.RecordBatch.from_pydict({"word": np.arange(len(total)), "n": total})

    rows = df.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # as many rows as licence words
    total = np.zeros(len(index.vocabulary) + 1, np.int64)
    for r in rows:
        total[r.word] = r.n
    return int(total[-1]), total[:-1]


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
    least_share: float = LEAST_SHARE,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``n_words``, ``phrases`` (array of (label, start) of every key phrase, by start and label), ``labels``
    (sorted, of phrases and verified templates) and ``score`` (1 with a phrase, else the best share of a template in place).

    Words are runs of digits, a-z and characters beyond ASCII, after A-Z are lower-cased, counted from 0. Null and empty
    texts have no words, empty arrays and score 0; repeated rows get equal results; in an empty table all words have the
    same IDF. Names that ``df`` has already get underscores. One pass counts the licence words, one scans; no shuffle but
    of the counts.
    """
    index = Index(phrases, templates)
    n, counts = word_counts(df, text, index)
    index.idf = np.array([math.log((n + 1) / (c + 1)) for c in counts])
    sent = df.sparkSession.sparkContext.broadcast(index)  # as large as the templates

    def scan(texts: Texts, _) -> list:
        index, words = sent.value, texts.words(WORD, lower=True)
        number = index.numbers(words)
        found = sorted((int(words.doc[a]), int(a - words.first[words.doc[a]]), label) for (_, label), phrase in zip(index.phrases, index.phrase_words) for a in index.places(number, words, phrase))
        share, labelled = index.shares(number, words, least_share)
        score, labels = share.max(axis=0, initial=0.0), [set() for _ in range(len(texts))]
        for template, docs in zip(index.templates, labelled):
            for d in docs:
                labels[d].add(template.label)
        for d, _, label in found:
            labels[d].add(label)
            score[d] = 1.0
        values = pa.StructArray.from_arrays([pa.array([x[2] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64())], names=["label", "start"])
        places = list_array(np.bincount(np.array([x[0] for x in found], np.int64), minlength=len(texts)), values)
        return [words.counts.astype(np.int64), places, pa.array([sorted(x) for x in labels], pa.list_(pa.string())), score]

    names = fresh(df, "n_words", "phrases", "labels", "score")
    place = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
    kinds = (T.LongType(), T.ArrayType(place), T.ArrayType(T.StringType()), T.DoubleType())
    return add_columns(df, text, [T.StructField(n, k) for n, k in zip(names, kinds)], scan, drop=() if keep_text else (text,))
