import functools
import math
import re

import pytest
from llm_data import documents, odd_texts
from pyspark.sql import functions as F

from candlemill.llm import licence_scan as L
from candlemill.llm.licence_templates import CUES, TEMPLATES, UNKNOWN

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def families(spark, model, texts):
    rows = L.licences(documents(spark, texts), model).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: r["licences"] for r in rows}


def test_every_notice_is_known_and_other_texts_are_not(spark, model):
    given = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    got = families(spark, model, [t for _, t in given] + list(UNKNOWN))
    # Some notices offer two licences.
    owners = {t: ",".join(f for f in sorted(TEMPLATES) if t in TEMPLATES[f]) for _, t in given}
    assert [got[i] for i in range(len(given))] == [owners[t] for _, t in given]
    assert all(got[len(given) + i] == "" for i in range(len(UNKNOWN)))


def test_notices_inside_other_text(spark, model):
    given = [
        "Some code.\nThis tool is licensed under the Apache License, Version 2.0, see there.\nMore.",
        "RELEASED UNDER THE MIT LICENSE.\nLicensed under CC BY-NC 4.0.",
        "words " * 3000 + "released under the MIT License." + " words" * 3000,
        "licence " * 50,
    ]
    assert families(spark, model, given) == {
        0: "Apache-2.0", 1: "CC-BY-NC-4.0,MIT", 2: "MIT", 3: "",
    }


def test_all_notices_have_cues():
    assert all(any(c in t.lower() for c in CUES) for texts in TEMPLATES.values() for t in texts)


def test_planted_notices(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {
        "GNU General Public License, version 3": "GPL-3.0",
        "Released under the MIT License": "MIT",
        "Apache License, Version 2.0": "Apache-2.0",
        "CC BY-NC 4.0": "CC-BY-NC-4.0",
    }
    got = {r["doc_id"]: r["licences"] for r in L.licences(docs, model).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    wanted = {
        i: ",".join(sorted(f for notice, f in planted.items() if notice in t))
        for i, t in texts.items()
    }
    assert got == wanted and any(wanted.values())


def test_odd_texts_and_empty_table(spark, model):
    got = families(spark, model, odd_texts())
    assert set(got.values()) == {""}
    df = documents(spark, ["Released under the MIT License."] * 2)
    same = df.withColumn("doc_id", F.lit(None).cast("long"))
    rows = L.licences(same, model).collect()
    assert [(r["doc_id"], r["n_cues"], r["licences"]) for r in rows] == [(None, 2, "MIT")]
    assert L.licences(df.limit(0), model).count() == 0
    assert L.fit(df.limit(0)).weights


def test_no_python_touches_rows(spark, model):
    plan = L.licences(spark.read.parquet(f"{FOLDER}/documents.parquet"), model)
    text = plan._jdf.queryExecution().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


GPL = """/*
 * frobnicate.c - a tool
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */
int main() { return 0; }"""
MIT = """The MIT License (MIT)

Copyright (c) 2015 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """# Copyright (c) 2011, Some One
# All rights reserved.
#
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice,
#    this list of conditions and the following disclaimer.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_wrapped_notices(spark, model):
    given = [
        (GPL, "GPL-3.0"),
        (MIT, "MIT"),
        (MIT.split("\n\n", 1)[1], "MIT"),
        ("The MIT License (MIT)", "MIT"),
        (BSD, "BSD"),
        (ISC, "ISC"),
        (ISC.replace("\n", "\r\n"), "ISC"),
        (ISC.replace("\n", "\r"), "ISC"),
        (re.sub("(?m)^", "rem ", BSD), "BSD"),
        (GPL + "\n\n" + ISC, "GPL-3.0,ISC"),
        ("They like the MIT license\nless than others.", ""),
    ]
    got = families(spark, model, [t for t, _ in given])
    assert [got[i] for i in range(len(given))] == [f for _, f in given]


def test_paragraphs_are_counted_once(spark, model):
    rows = L.licences(documents(spark, [ISC + "\n \n * \n" + ISC + "\n\nSome licence.\n\nx"]), model)
    (row,) = rows.collect()
    assert (row["n_cues"], row["n_unknown"], row["licences"]) == (3, 1, "ISC")


def test_a_long_paragraph_is_scored_in_linear_space(spark, model):
    body = "\n".join(f"word{i} " * 5 for i in range(20_000))
    assert families(spark, model, [body + "\n" + ISC]) == {0: "ISC"}


def test_notices_without_the_word_licence(spark, model):
    given = [
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("This is free and unencumbered software released into the\npublic domain.", "Unlicense"),
        ("Released into the public domain under CC0 1.0", "CC0-1.0"),
        ("Available under CC BY-NC 4.0", "CC-BY-NC-4.0"),
        ("Available under CC\nBY 4.0", "CC-BY-4.0"),
        ("The house is open to the public; its domain is the sea, by 4.0 miles.", ""),
    ]
    got = families(spark, model, [t for t, _ in given])
    assert [got[i] for i in range(len(given))] == [f for _, f in given]


def test_no_text_without_covering_words_can_be_confirmed():
    for notice in (t for texts in TEMPLATES.values() for t in texts):
        pairs = L.pairs_of(notice)
        free = [p for p in pairs if not any(c in w for c in L.COVER for w in p)]
        assert len(free) < L.LEAST_SHARED * len(pairs), notice


VERSIONS = [
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
    ("Licensed under the Apache License, Version 1.0.", ""),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of "
     "the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\n"
     "version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1"),
    ("Released under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    ("Released under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("This file is subject to the Mozilla Public License, version 1.1.", "MPL-1.1"),
    ("Licensed under the GNU General Public License, version 1.", "GPL-1.0"),
    ("Licensed under the GNU General Public License, version 2.0.", "GPL-2.0"),
    ("Licensed under the GNU General Public License, version 4.", ""),
    (GPL.replace("General Public", "Affero General Public"), "AGPL-3.0"),
    (GPL.replace("version 3", "version 2"), "GPL-2.0"),
    ("Released under the BSD 4-Clause License.", "BSD-4-Clause"),
    ("Released under the BSD License.", "BSD"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY 3.0.", ""),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
]


def test_versions_and_variants_are_told_apart(spark, model):
    got = families(spark, model, [t for t, _ in VERSIONS])
    assert [(t, got[i]) for i, (t, _) in enumerate(VERSIONS)] == VERSIONS


def test_several_notices_in_one_line(spark, model):
    given = [
        ("Released under the MIT License. Licensed under CC BY-NC 4.0. Licensed under the Apache "
         "License, Version 2.0.", "Apache-2.0,CC-BY-NC-4.0,MIT"),
        ("Licensed under either of Apache License, Version 2.0 or MIT license", "Apache-2.0,MIT"),
        ("You may use either of Apache License, Version 2.0 or MIT license", "Apache-2.0,MIT"),
        ("Licensed under the Mozilla Public License, version 1.1, or released under the GNU General "
         "Public License, version 2.", "GPL-2.0,MPL-1.1"),
    ]
    got = families(spark, model, [t for t, _ in given])
    assert [got[i] for i in range(len(given))] == [f for _, f in given]


def test_denied_grants(spark, model):
    given = [
        ("This work is not licensed under the Apache License, Version 2.0.", ""),
        ("It isn't released under the MIT License", ""),
        ("This is no longer licensed under the MIT license!", ""),
        ("It is not released under the MIT License. It is licensed under the Apache License,\n"
         "Version 2.0. Enjoy.", "Apache-2.0"),
    ]
    got = families(spark, model, [t for t, _ in given])
    assert [got[i] for i in range(len(given))] == [f for _, f in given]


@functools.cache
def brute_demands(family, notice):
    """The notice's pairs, those that few families have, numbers, and what like ones lack."""
    every = {f: [L.pairs_of(n) for n in own] for f, own in TEMPLATES.items()}
    pairs = L.pairs_of(notice)
    few = {p for p in pairs if sum(any(p in n for n in own) for own in every.values()) <= len(every) / 2}
    numbers = {p for p in pairs if re.search(r"\d", p[1])}
    rivals = [n for own in every.values() for n in own if n not in every[family]]
    alike = [r for r in rivals if len(r & pairs) >= L.LEAST_SHARED * max(len(pairs), len(r))]
    return pairs, few, numbers, [{p for p in pairs - r if not re.search(r"\d", "".join(p))} for r in alike]


def brute_families(model, unit):
    """Families of a unit, scored and compared without Spark."""
    found = re.findall(L._WORD, unit.lower())
    grams = {" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)}
    scores = list(model.intercepts)
    for gram in grams & set(model.weights):
        scores = [s + w for s, w in zip(scores, model.weights[gram])]
    out = {}
    held = set(zip(found, found[1:]))
    for i, family in enumerate(model.classes[1:], 1):
        chance = 1 / (1 + math.exp((scores[0] - scores[i]) / model.temperature))
        if chance < L.LEAST_PROBABILITY:
            continue
        for notice in TEMPLATES[family]:
            pairs, few, numbers, apart = brute_demands(family, notice)
            if (
                len(held & pairs) >= L.LEAST_SHARED * len(pairs)
                and 2 * len(held & few) > len(few)
                and numbers <= held
                and all(2 * len(held & own) >= len(own) for own in apart)
            ):
                out[family] = max(out.get(family, 0), len(held & pairs) / len(pairs))
    return out


def test_units_are_scored_like_brute_force(spark, model):
    texts = [t for t, _ in VERSIONS] + [t for own in TEMPLATES.values() for t in own] + list(UNKNOWN)
    texts += [" ".join(t.split()[::2]) for t in texts] + [a + " " + b for a, b in zip(texts, texts[7:])]
    texts = [" ".join(t.split()) for t in texts]
    rows = L.scan(documents(spark, texts), model).collect()
    got = {}
    for r in rows:
        if r["line"] == texts[r["doc_id"]]:
            own = got.setdefault(r["doc_id"], {})
            if r["family"] != L.UNKNOWN_CLASS:
                own[r["family"]] = pytest.approx(r["shared"])
    assert len(got) > 200
    assert got == {i: brute_families(model, texts[i]) for i in got}


def test_probabilities_are_calibrated_on_notices_held_out(model):
    assert model.temperature in L._TEMPERATURES
