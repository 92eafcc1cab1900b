"""Recall on public notices, wrapped and between prose, and false alarms on prose of other kinds."""

import random
import textwrap

from quire.llm import common, licenses

PROSE = ("The harbour was quiet in the morning and the boats came back with the tide.", "She asked whether the letter had come, and he said that it had not.", "Prices rose by three percent over the year, the office reported on Monday.")
ALARMS = (
    "You need a driving license to rent a car in this country.", "The general public is asked to keep the gates closed.", "Copyright 2019 by the author. All rights reserved.", "The free software movement began in the eighties, and many people joined it.",
    "A notice was put up at the library: please return the copies in time.", "He studied at MIT and later moved to Berkeley.", "The Apache helicopter was delivered in 1984.", "The warranty covers any kind of damage for two years.",
    "Permission to land was granted by the tower.", "The eclipse was seen by the public from the square.", "The distribution of the binary stars is uneven.", "Attribution of the painting remains contested by scholars.",
)


def notices():
    """Long notices of each family as a paragraph, wrapped at some width, with a holder's line before it."""
    for family, templates in licenses.TEMPLATES.items():
        for i, t in enumerate(x for x in templates if len(x) > 80):
            for width in (45, 65, 79):
                yield family, i, width, "\n".join(textwrap.wrap(t, width))


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in licenses.scan(df).collect()}


def test_wrapped_notices(spark):
    cases = list(notices())
    texts = [f"{PROSE[0]}\n{PROSE[1]}\n\n{n}\n\n{PROSE[2]}" for *_, n in cases]
    got = scanned(spark, texts)
    missed = [c[:3] for i, c in enumerate(cases) if c[0] not in got[i]["families"].split(",")]
    assert len(missed) <= 0.03 * len(cases), missed
    extra = [(c[:3], got[i]["families"]) for i, c in enumerate(cases) if set(got[i]["families"].split(",")) - {c[0], ""}]
    assert len(extra) <= 0.1 * len(cases), extra
    assert all(r["n_paragraphs"] == 3 for r in got.values())


def test_lines(spark):
    cases = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) <= 80]
    got = scanned(spark, [f"{PROSE[0]}\n{t}\n{PROSE[1]}" for _, t in cases])
    missed = [c for i, c in enumerate(cases) if got[i]["families"] != c[0]]
    assert len(missed) <= 0.05 * len(cases), [(c, got[cases.index(c)]["families"]) for c in missed]


def test_false_alarms(spark):
    rng = random.Random(6)
    texts = [*ALARMS, *licenses.OTHERS, *["\n".join(rng.sample(ALARMS + PROSE, 6)) for _ in range(40)]]
    got = scanned(spark, texts)
    assert [texts[i] for i, r in got.items() if r["families"]] == []


def test_nothing_is_left_out_by_the_words_told(spark, monkeypatch):
    """The same notices are found when every line and paragraph is looked at."""
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    want = sorted(map(str, licenses.scan(docs).collect()))
    words = licenses.told()
    monkeypatch.setattr(licenses, "told", lambda: ["[a-z0-9]+", *words])
    assert sorted(map(str, licenses.scan(docs).collect())) == want and any("families='MIT'" in x for x in want)


def test_versions_and_variants(spark):
    """One family for a wrapped notice, none for versions and variants that aren't known, a title alone, one notice for one paragraph."""
    wrap = lambda t, w=60: "\n".join(textwrap.wrap(t, w))
    long = lambda f: max(licenses.TEMPLATES[f], key=len)
    cases = [(wrap(long(f), w), f) for f in ("GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL", "Apache-2.0", "MIT") for w in (45, 60, 79)]
    cases += [
        ("Licensed under the GNU General Public License, version 1.", ""), ("Licensed under the Apache License, Version 1.1.", ""), ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", ""),
        ("Licensed under CC BY-NC-SA 4.0.", ""), ("Licensed under CC BY-ND 4.0.", ""), ("Licensed under the Mozilla Public License, version 1.1.", ""), ("MIT License", "MIT"), ("MIT License\n\nCopyright (c) 2020 A. Person", "MIT"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA"), ("Licensed under the GNU Lesser General Public License.", "LGPL"),
    ]
    got = scanned(spark, [t for t, _ in cases])
    wrong = [(t, want, got[i]["families"]) for i, (t, want) in enumerate(cases) if got[i]["families"] != want]
    assert wrong == []
    assert all(got[i]["n_notices"] == 1 for i, (_, want) in enumerate(cases) if want)
