"""Operator 12: license notices, by templates compiled into a token automaton.

A template is a notice's wording with two kinds of regions.  ``[[ ... ]]`` is
optional; ``<<a|b c>>`` is replaceable by one of the wordings given and
``<<2-6>>`` by any 2 to 6 words.  All else is mandatory and must stand word for
word.  The templates become one automaton over words (states of the templates'
positions, made deterministic), so that every word of a text that can begin a
notice is followed through all templates at once, and the followed places of a
batch move on together, one word a step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentflow.llm import common
from incidentflow.llm.common import HashTable, Words

# The phrases of the base labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

#: What a work under a license is called, and how it is put under it.
_WORK = "this <<1-3>> <<is|are>> [[hereby]] <<licensed|released|distributed|published|provided|available|made available>>"
# A template begins with a stated word, so that few places of a text are followed.
_UNDER = "<<licensed|released|distributed|published|available>> under [[the terms of]]"

# (label, template); the wording of public license notices.
TEMPLATES = [
    ("mit", f"{_UNDER} [[the]] mit license"),
    ("mit", f"{_WORK} under [[the terms of]] [[the]] mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of <<1-8>> to deal in <<1-4>> without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of <<1-4>>",
    ),
    ("apache-2", f"{_UNDER} [[the]] apache license [[version]] 2 [[0]]"),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use <<1-4>> except in compliance with the license "
        "[[you may obtain a copy of the license at <<1-10>>]]",
    ),
    ("gpl-3", f"{_UNDER} [[the]] gnu general public license [[as published by the free software foundation]] [[either]] <<version|v>> 3 [[0]]"),
    ("gpl-3", f"{_WORK} under [[the terms of]] the gnu general public license [[either]] <<version|v>> 3 [[0]]"),
    (
        "gpl-3",
        "is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation [[either]] version 3 of the license [[or at your option any later version]]",
    ),
    ("gpl-2", f"{_UNDER} [[the]] gnu general public license [[either]] <<version|v>> 2 [[0]]"),
    ("gpl-2", f"{_WORK} under [[the terms of]] the gnu general public license [[either]] <<version|v>> 2 [[0]]"),
    ("lgpl", f"{_UNDER} [[the]] gnu lesser general public license [[<<version|v>> <<2|3>>]]"),
    ("mpl-2", f"{_UNDER} [[the]] mozilla public license [[<<version|v>>]] 2 [[0]]"),
    ("bsd", f"{_UNDER} [[the]] [[<<2|3>> clause]] bsd [[style]] license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", f"{_UNDER} [[a]] [[the]] <<cc|creative commons>> <<by|attribution>> <<nc|noncommercial|non commercial>> [[<<2|3|4>> <<0|5>>]] [[international]] [[license]]"),
    ("cc-by-sa", f"{_UNDER} [[a]] [[the]] <<cc|creative commons>> <<by|attribution>> <<sa|sharealike|share alike>> [[<<2|3|4>> <<0|5>>]] [[international]] [[license]]"),
    ("cc-by", f"{_UNDER} [[a]] [[the]] <<cc|creative commons>> <<by|attribution>> <<2|3|4>> <<0|5>> [[international]] [[license]]"),
    ("cc0", "<<dedicated to|released into|placed in>> the public domain"),
    ("all-rights-reserved", "all rights <<are reserved|reserved>>"),
]

_TOKEN = re.compile(r"\[\[|\]\]|<<[^<>]*>>|[^\s\[\]<>]+")


@dataclass
class Nfa:
    """Positions of the templates: moves by a word (``None``: any word), empty
    moves, and the template that ends in a position."""

    moves: list[list[tuple[str | None, int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)
    ends: dict[int, int] = field(default_factory=dict)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def word(self, a: int, word: str | None) -> int:
        b = self.state()
        self.moves[a].append((word, b))
        return b

    def add(self, start: int, number: int, template: str) -> int:
        """One template from ``start``; how many mandatory words it has."""
        at, opened, mandatory = start, [], 0
        for token in _TOKEN.findall(template):
            if token == "[[":
                opened.append(at)
            elif token == "]]":
                self.empty[opened.pop()].append(at)
            elif token.startswith("<<"):
                inside = token[2:-2]
                if span := re.fullmatch(r"(\d+)-(\d+)", inside):
                    end = self.state()
                    for k in range(int(span[2]) + 1):
                        if k >= int(span[1]):
                            self.empty[at].append(end)
                        if k < int(span[2]):
                            at = self.word(at, None)
                    at = end
                else:
                    end = self.state()
                    for wording in inside.split("|"):
                        a = at
                        for w in wording.split():
                            a = self.word(a, w)
                        self.empty[a].append(end)
                    at = end
                    mandatory += not opened
            else:
                at = self.word(at, token)
                mandatory += not opened
        if opened:
            raise ValueError(f"a region of {template!r} is not closed")
        end = self.state()
        self.empty[at].append(end)
        self.ends[end] = number
        return mandatory

    def closed(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for b in self.empty[todo.pop()]:
                if b not in out:
                    out.add(b)
                    todo.append(b)
        return frozenset(out)


class Automaton:
    """All templates as one deterministic automaton.  ``table[state, word]`` is
    the next state (0: none; state 1 is the start; word 0 is any other word),
    ``ended[state]`` the templates that end there."""

    def __init__(self, templates: list[str]):
        nfa = Nfa()
        start = nfa.state()
        self.mandatory = [nfa.add(start, k, t) for k, t in enumerate(templates)]
        self.words = sorted({w for moves in nfa.moves for w, _ in moves if w is not None})
        self.number = {w: i + 1 for i, w in enumerate(self.words)}
        first = nfa.closed([start])
        seen, todo, rows = {frozenset(): 0, first: 1}, [first], {0: [0] * (len(self.words) + 1)}
        while todo:
            now = todo.pop()
            by_word: dict[str, set[int]] = {}
            anywhere: set[int] = set()
            for a in now:
                for w, b in nfa.moves[a]:
                    (anywhere if w is None else by_word.setdefault(w, set())).add(b)
            row = []
            for w in [None, *self.words]:
                nxt = nfa.closed(anywhere | by_word.get(w, set()))
                if nxt not in seen:
                    seen[nxt] = len(seen)
                    todo.append(nxt)
                row.append(seen[nxt])
            rows[seen[now]] = row
        self.table = np.array([rows[i] for i in range(len(seen))], dtype=np.int32)
        of = {i: sorted(nfa.ends[a] for a in s if a in nfa.ends) for s, i in seen.items()}
        if of[1]:
            raise ValueError("a template without mandatory words accepts every text")
        self.ended = [of[i] for i in range(len(seen))]
        self.has_end = np.array([bool(x) for x in self.ended])
        words = Words(pa.array(self.words, pa.string()))
        self.find = HashTable(words.hash)

    def follow(self, texts: list[str]) -> set[int]:
        """The templates that end after exactly these words."""
        state = 1
        for w in texts:
            state = self.table[state, self.number.get(w, 0)]
        return set(self.ended[state])

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Template, first word and end (past the last word) of every place
        where a template's wording stands; several ends of one start and
        template give a row each."""
        symbol = np.zeros(len(words.hash), dtype=np.int32)
        at, entry = self.find.find(words.hash)
        symbol[at] = entry + 1
        start = np.flatnonzero(self.table[1][symbol])
        state, now = self.table[1][symbol[start]], start
        last = words.first[words.doc[start] + 1] if len(start) else start
        found: list[tuple[int, int, int]] = []
        while len(start):
            for i in np.flatnonzero(self.has_end[state]).tolist():
                a, b = int(start[i]), int(now[i]) + 1
                # hashes led here: the words themselves decide
                exact = self.follow([words.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist())])
                found += [(k, a, b) for k in self.ended[state[i]] if k in exact]
            now = now + 1
            inside = np.flatnonzero(now < last)
            start, now, last = start[inside], now[inside], last[inside]
            state = self.table[state[inside], symbol[now]]
            alive = np.flatnonzero(state)
            start, now, last, state = start[alive], now[alive], last[alive], state[alive]
        out = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def strength(mandatory: int) -> float:
    """How surely a template's wording is a license notice: more with every
    mandatory word."""
    return 1 - 0.5 ** (mandatory / 2)


#: One row for each place: the label and template (its number, base phrases first) and its words.
SPANS = "array<struct<label:string,template:int,start:long,stop:long>>"


def scan(
    df: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    base: list[tuple[str, str]] = BASE,
    id_col: str = common.ID,
    text_col: str = common.TEXT,
) -> DataFrame:
    """``doc_id, n_words, base, found`` of every row of ``df``: every place of
    a base phrase, and of every start the longest match of each template.

    ``base`` are (label, phrase), ``templates`` (label, markup as above); the
    automaton is made on the driver and broadcast (its size depends on the
    templates alone).  A null or empty text has no words and no places;
    overlapping places and repeated rows count each; an empty table gives
    none; other columns are ignored.
    """
    spark = df.sparkSession
    names = [label for label, _ in [*base, *templates]]
    shared = spark.sparkContext.broadcast(Automaton([t for _, t in [*base, *templates]]))
    n_base = len(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in common.slices(batches, common.TEXT, 1 << 22):
            words = Words(part.column(1))
            places: tuple[list[list], list[list]] = [[] for _ in range(words.n_docs)], [[] for _ in range(words.n_docs)]
            longest = {(k, a): b for k, a, b in zip(*map(np.ndarray.tolist, own.matches(words)))}
            for (k, a), b in longest.items():
                d, name = int(words.doc[a]), names[k]
                o = int(words.first[d])
                places[k >= n_base][d].append({"label": name, "template": k, "start": a - o, "stop": b - o})
            kind = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words.count.astype(np.int64)), pa.array(places[0], kind), pa.array(places[1], kind)],
                names=[common.ID, "n_words", "base", "found"],
            )

    rows = common.texts(df, id_col, text_col)
    kind = rows.schema[common.ID].dataType.simpleString()
    return common.per_task(rows, run, f"{common.ID} {kind}, n_words long, base {SPANS}, found {SPANS}")


def label_scores(found: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, base: list[tuple[str, str]] = BASE) -> DataFrame:
    """Adds to the rows of :func:`scan` ``base_labels`` and ``labels`` (arrays,
    distinct and sorted; ``labels`` has the base ones too) and ``score``: the
    strongest template that occurs, 0 without any."""
    mandatory = Automaton([t for _, t in [*base, *templates]]).mandatory
    strong = F.array(*[F.lit(strength(m)) for m in mandatory])
    every = F.concat("base", "found")
    return found.withColumns(
        {
            "base_labels": F.array_sort(F.array_distinct("base.label")),
            "labels": F.array_sort(F.array_distinct(every["label"])),
            "score": F.coalesce(F.array_max(F.transform(every, lambda m: F.element_at(strong, m["template"] + 1))), F.lit(0.0)),
        }
    )
