import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incidentflow.llm import license_scan
from incidentflow.llm.common import Words
from incidentflow.llm.license_scan import BASE, Automaton
from incidentflow.llm.twins import as_regex, mandatory
from tests.llm.fixtures import SCHEMA, WORD, documents, lower, prose


def _places(template, text):
    own = Automaton([template])
    _, a, b = own.matches(Words(pa.array([text])))
    return list(zip(a.tolist(), b.tolist()))


def test_regions():
    t = "under [[the terms of]] the <<mit|x y>> license <<1-2>> end"
    assert _places(t, "under the mit license a end") == [(0, 6)]
    assert _places(t, "Under the terms of THE x-y license, a b; end") == [(0, 11)]
    assert _places(t, "under the terms the mit license a end") == []  # mandatory wording differs
    assert _places(t, "under the mit license end") == []  # a region of one word at least
    assert _places(t, "under the mit license a b c end") == []
    assert _places("a [[b [[c]] d]] e", "a e a b d e a b c d e a c e") == [(0, 2), (2, 6), (6, 11)]
    assert _places("a <<0-3>> b", "a a b b") == [(0, 3), (0, 4), (1, 3), (1, 4)]


def test_bad_templates():
    with pytest.raises(ValueError):
        Automaton(["a [[b"])
    with pytest.raises(ValueError):
        Automaton(["[[a]]"])


def test_places_stay_inside_a_text():
    own = Automaton(["cc by nc"])
    assert len(own.matches(Words(pa.array(["x cc by", "nc cc by nc", "", None, "cc"])))[0]) == 1


def cases():
    rows = documents()
    rows += [
        (70, "Released under the MIT License.\n" + prose(1, 50) + " under the mit license", 0),
        (71, "CC BY-NC 4.0 cc by nc cc-by-nc", 0),
        (72, "Licensed under the Apache License, Version 2.0.", 0),
        (73, "This work is licensed under the GNU General Public License, version 3.", 0),
        (74, "under the mit licenses", 0),
        (75, "All rights reserved. " + "released under the terms of the " * 200 + "mit license", 0),
        (75, "all rights are reserved", 0),
        (76, "Permission is hereby granted, free of charge, to any person obtaining a copy of this program, to deal in it without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of it", 0),
    ]
    return rows


def test_scan_equals_regexes(spark):
    rows = cases()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"base": F.lit(1), "found": F.lit("x"), "label": F.lit(0)})
    got = license_scan.label_scores(license_scan.scan(df)).collect()
    every = [*BASE, *license_scan.TEMPLATES]
    want = []
    for i, t, _ in rows:
        w = WORD.findall(lower(t))
        base = [(label, p, a) for label, p in BASE for a in range(len(w)) if w[a : a + len(p.split())] == p.split()]
        joined = "".join(f" {x}" for x in w) + " "
        hits = [(label, license_scan.strength(mandatory(t))) for label, t in every if re.search(as_regex(t) + " ", joined)]
        want.append((i, len(w), sorted(a for _, _, a in base), sorted({x[0] for x in base}), sorted({x[0] for x in hits}), max([x[1] for x in hits], default=0.0)))
    assert sorted([(r.doc_id, r.n_words, sorted(m.start for m in r.base), r.base_labels, r.labels, r.score) for r in got], key=str) == sorted(want, key=str)
    by_id = {r.doc_id: r for r in got}
    assert by_id[76].labels == ["mit"] and by_id[76].score > 0.99 and by_id[73].labels == ["gpl-3"] and by_id[74].labels == []
    assert [(m.template, m.start, m.stop) for m in by_id[72].found] == [(len(BASE) + next(k for k, x in enumerate(license_scan.TEMPLATES) if x[0] == "apache-2"), 0, 8)]


def test_mandatory_words_agree():
    for _, t in license_scan.TEMPLATES:
        assert Automaton([t]).mandatory == [mandatory(t)]


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], SCHEMA)).count() == 0
