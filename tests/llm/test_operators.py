"""Each operator on small hand-made tables: brute force, nulls, blanks, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadflow.llm import (decontaminate, host_rules, html_text, licences, line_dedup, ngram_join, pieces, suffix_tree,
                          toxicity, warc)
from leadflow.llm.oracles import ORACLE

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}x{i * i % 7}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w30x4", "other")), (4, BASE.replace("w10x2", "a").replace("w40x4", "b")),
    (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "ONE two"), (10, "short line here\n" + BASE), (2, BASE),
    (None, BASE), (11, "fresh words of their own in a line\nand one more line of the same text"),
    (12, "fresh words of their own in a line\nsomething else is said down here"), (13, "x " * 3000)]


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{(i or 0) % 3}", None, n) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, node long, label int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def shingled(n):
    sets = []
    for _, text in TEXTS:
        w = words(text)
        k = min(n, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    return sets


def linked(sets, percent):
    """Smallest id reachable, by brute force."""
    part = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            old, new = part[b], part[a]
            part = [new if p == old else p for p in part]
    return part


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_join(docs, none, n, percent):
    sets = shingled(n)
    part = linked(sets, percent)
    expected = Counter()
    for i, (doc, _) in enumerate(TEXTS):
        ids = [TEXTS[j][0] for j in range(len(TEXTS)) if part[j] == part[i] and TEXTS[j][0] is not None]
        expected[doc, len(sets[i]), min(ids, default=None) if sets[i] else doc] += 1
    got = ngram_join.ngram_components(docs, n, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == expected
    assert ngram_join.ngram_components(none, n, percent).count() == 0


def test_one_of_each(docs):
    sets = shingled(3)
    part = linked(sets, 90)
    groups = {p: min(TEXTS[j][0] for j in range(len(TEXTS)) if part[j] == p and TEXTS[j][0] is not None)
              for p in {part[i] for i in range(len(TEXTS)) if sets[i]}}
    blank = [TEXTS[i][0] for i in range(len(TEXTS)) if not sets[i]]
    left = ngram_join.one_of_each(docs, 3, 90)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted([*groups.values(), *blank])


def test_line_dedup(docs, none):
    lines = sorted((i if i is not None else -1, k, frozenset(words(x)))
                   for i, t in set(TEXTS) for k, x in enumerate((t or "").split("\n")))
    gone = {(i, k) for i, k, s in lines for j, m, o in lines
            if (j, m) < (i, k) and s and o and 100 * len(s & o) >= 90 * len(s | o)}
    expected = Counter((i, "\n".join(x for k, x in enumerate((t or "").split("\n")) if (-1 if i is None else i, k) not in gone))
                       for i, t in TEXTS)
    cut = line_dedup.drop_repeated_lines(docs)
    assert cut.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text or "") for r in cut.collect()) == expected
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_short_lines(spark):
    long_ = "ha " * 400 + "ho"
    rows = [(1, f"Read more\nHome\n\n{long_}\nbest regards Ann"), (2, "Read  more\nread more\n\nhome\nmore Read"), (3, None),
            (4, f"{long_} ho\n{long_}\nHome"), (5, "\u4f60\u597d\u4e16\u754c\n\u4f60\u597d\u4e16\u754c"),
            (6, "https://a.b/c\nHOME\nRead more Home"), (7, "https://a.b/c\n \n\t")]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter((r.doc_id, r.text, r.n_dropped) for r in got.collect()) == Counter([
        (1, rows[0][1], 0), (2, "", 4), (3, None, 0), (4, "", 3),
        (5, rows[4][1][:4], 1), (6, "https://a.b/c\nRead more Home", 1), (7, " \n\t", 1)])


CLASH = ("n_dropped", "n_lines", "row", "id", "key", "of", "text_key", "gone", "__id", "__key", "group")


def clashing(spark, rows):
    """Texts with columns named like those that the operators use."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


@pytest.mark.parametrize("stage", ["lines", "copies", "leaks"])
def test_columns_of_any_name_pass(spark, stage):
    rows = [(1, BASE), (2, f"{BASE} more"), (3, None), (4, "one line of words that nobody else has\nread more"), (5, "Read more"),
            (6, "what is the largest city in the country that lies to the north of us")]
    bench = spark.createDataFrame([(7, rows[5][1])], "item_id long, text string")
    docs = clashing(spark, rows)
    out = {"lines": lambda: corpus_pipeline.drop_lines(spark, docs, ""), "copies": lambda: ngram_join.one_of_each(docs, 5, 80),
           "leaks": lambda: decontaminate.without_leaks(docs, bench)}[stage]()
    assert out.columns == docs.columns
    kept = {"lines": [1, 3, 4, 6], "copies": [1, 3, 4, 5, 6], "leaks": [1, 2, 3, 4, 5]}[stage]
    assert sorted(r.doc_id for r in out.collect()) == kept
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASH)
    assert {"lines": lambda: corpus_pipeline.drop_lines(spark, docs.limit(0), ""), "copies": lambda: ngram_join.one_of_each(docs.limit(0), 5, 80),
            "leaks": lambda: decontaminate.without_leaks(docs.limit(0), bench)}[stage]().count() == 0


def test_one_row_stays_of_near_copies_under_one_id(spark):
    """Two near copies of one id, and copies without any id."""
    rows = [(1, BASE), (1, BASE.replace("w30x4", "other")), (2, BASE), (None, "text " + BASE[::-1]), (None, "text " + BASE[::-1]), (3, "a b c d e f")]
    out = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in out) == [-1, 1, 3]


def test_pipeline_keeps_what_lines_leave(spark):
    shared = "a passage of several words that many documents share and nobody wrote twice " * 3
    own = "just these words are new"
    rows = [(1, shared), (2, f"{own}\n{shared}"), (3, shared), (4, f"{shared}\n \n"), (5, ""), (6, None)]
    table = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long")
    kept = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, table, "").collect()}
    assert kept == {1: (shared, len(shared)), 2: (own, len(own)), 5: ("", 0), 6: (None, 0)}


def test_suffix_tree(docs, none):
    rows = [(zlib.crc32(str("" if i is None else i).encode()) % 5 == 1, [*words(t), None]) for i, t in TEXTS]
    train = [w for held, w in rows if not held]
    one, two, three = (Counter(g for w in train for g in zip(*(w[i:] for i in range(k)))) for k in (1, 2, 3))
    n, v = sum(one.values()), len(one)

    def p0(x):
        return (one[x,] + 0.5) / (n + 0.5 * (v + 1))

    def states(runs, counts, parent):
        gain = Counter()
        for run, c in runs.items():
            s, k = counts[run[:-1]], counts[run[:-1]] ** 0.75
            if s >= 2:
                q = parent(run[-2:] if len(run) == 3 else run[-1:])
                gain[run[:-1]] += c * math.log((c - 1 + k * q) / (s - 1 + k) / q)
        return {s for s, g in gain.items() if g > 2}

    first = states(two, one, lambda r: p0(r[-1]))

    def p1(r):
        if len(r) < 2 or r[:1] not in first:
            return p0(r[-1])
        k = one[r[:1]] ** 0.75
        return (two[r] + k * p0(r[-1])) / (one[r[:1]] + k)

    second = states(three, two, p1)

    def p2(r):
        if len(r) < 3 or r[:2] not in second:
            return p1(r[-2:])
        k = two[r[:2]] ** 0.75
        return (three[r] + k * p1(r[-2:])) / (two[r[:2]] + k)

    expected = sorted((len(w), held, sum(one[x,] > 0 for x in w), n, round(sum(math.log10(p0(x)) for x in w), 6),
                       round(sum(math.log10(p2(tuple(w[max(0, i - 2):i + 1]))) for i in range(len(w))), 6)) for held, w in rows)
    got = suffix_tree.suffix_tree_scores(docs).collect()
    rows = sorted((r.n_tokens, r.held_out, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert list(itertools.chain(*rows)) == pytest.approx(list(itertools.chain(*expected)), abs=2e-6)
    assert suffix_tree.suffix_tree_scores(none).count() == 0


def test_host_rules(spark, docs, none):
    rows = [(i, BASE + f" {i}", "good") for i in range(40)] + [(100 + i, "a b", "bad") for i in range(40)] \
        + [(200, BASE, None), (201, None, "good")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in host_rules.judge(table).collect()}
    assert got[0].kept and not got[100].kept and got[100].host_out and got[201].base_failed
    assert host_rules.judge(docs).count() == len(TEXTS) and host_rules.judge(none).count() == 0


def test_licences(spark, none):
    mit = licences.SENTENCES
    text = f"Head\n\n{mit['mit-grant'].replace(' person', chr(10) + 'person')}:\n\n{mit['mit-notice']}. Tail."
    table = spark.createDataFrame(
        [(1, "Prose\nLicensed under the Apache License, Version 2.0.\nmore"), (2, text), (3, None), (4, ""),
         (5, f"{mit['mit-notice']}. {mit['mit-grant']}."), (6, "Released under the MIT License. Licensed under CC BY-NC 4.0.")],
        "doc_id long, text string")
    got = {r.doc_id: list(r.licences) for r in licences.licence_scan(table).collect()}
    assert got == {1: ["Apache-2.0"], 2: ["MIT"], 3: [], 4: [], 5: [], 6: ["CC-BY-NC-4.0", "MIT"]}
    assert all(re.search(licences.HINT, s) for s in licences.SENTENCES.values() if "spdx" not in s)
    assert licences.licence_scan(none).count() == 0


@pytest.mark.parametrize("text, expected", [
    ("Copyright\n\nAll rights\nreserved.", ["All rights reserved"]),
    ("This is free and unencumbered software released into the public\ndomain.", ["Unlicense"]),
    ("All\trights  reserved", ["All rights reserved"]), ("# SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
    ("// SPDX-License-Identifier: GPL-2.0\nint x;", ["GPL-2.0"]), ("SPDX-License-Identifier: ISC", ["ISC"]),
    ("SPDX-License-Identifier: LGPL-3.0-or-later", ["LGPL-3.0"]), ("SPDX-License-Identifier: CC0-1.0", ["CC0-1.0"]), ("ISC\nmit", [])])
def test_licences_however_they_are_wrapped(spark, text, expected):
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert list(licences.licence_scan(table).first().licences) == expected
    sql = ORACLE["op4_license_scans"]
    assert "hinted" not in sql  # the SQL cuts every text
    con = duckdb.connect()
    con.execute("create table documents as select 1 as doc_id, ? as text", [text])
    assert con.execute(sql).fetchall()[0][2] == ",".join(expected)


GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL_2 = GPL_3.replace("software:", "software;").replace("Foundation,", "Foundation;").replace("version 3", "version 2")
MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE_2 = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MIT = """The MIT License (MIT)

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
NOTICES = [
    (GPL_3, "GPL-3.0"), (GPL_2, "GPL-2.0"), (GPL_2.replace("version 2", "version 3"), "GPL-3.0"),
    (GPL_3.replace("version 3", "version 2"), "GPL-2.0"), ("# " + GPL_3.replace("\n", "\n# "), "GPL-3.0"),
    (GPL_3.replace("software:", "software,").replace("WARRANTY;", "WARRANTY,"), "GPL-3.0"),
    (GPL_2.replace("software;", "software,").replace("Foundation;", "Foundation,").replace("WARRANTY;", "WARRANTY,"), "GPL-2.0"),
    (MPL_2, "MPL-2.0"), (MPL_2.replace("https", "http"), "MPL-2.0"), (MPL_2.replace("v. 2.0", "v.2.0"), "MPL-2.0"),
    (APACHE_2, "Apache-2.0"), (APACHE_2[APACHE_2.index("you may"):], "Apache-2.0"), ("Licensed under the Apache License, Version 2.0", "Apache-2.0"),
    (MIT, "MIT"), (MIT[MIT.index("Permission"):], "MIT"), (MIT[:MIT.index("The above")], "MIT"),
    (MIT[MIT.index("Permission"):MIT.index("THE SOFTWARE")], "MIT"), ("Released under the MIT License.", "MIT"),
    ("Licensed under the MIT License.", "MIT"), ("This project is licensed under the MIT License.", "MIT"),
    (BSD_2, "BSD-2-Clause"), (BSD_3, "BSD-3-Clause"), (ISC, "ISC"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    *[(f"Licensed under the GNU {kind}General Public License, version {n}.", name) for kind, n, name in (
        ("", 3, "GPL-3.0"), ("", 2, "GPL-2.0"), ("Lesser ", 3, "LGPL-3.0"), ("Affero ", 3, "AGPL-3.0"))],
    *[(f"Licensed under CC {x} 4.0.", f"CC-{x}-4.0") for x in ("BY", "BY-SA", "BY-NC", "BY-ND")],
    *[(f"This work is licensed under a Creative Commons Attribution{x} 4.0 International License.", name) for x, name in (
        ("", "CC-BY-4.0"), ("-ShareAlike", "CC-BY-SA-4.0"), ("-NonCommercial", "CC-BY-NC-4.0"))],
    ("Licensed under CC0 1.0", "CC0-1.0"), ("All rights reserved.", "All rights reserved"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    *[(f"{a}SPDX-License-Identifier:{b}{x}{c}", name) for x, name in (
        ("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0-or-later", "GPL-3.0"), ("GPL-2.0-or-later", "GPL-2.0"),
        ("BSD-3-Clause", "BSD-3-Clause"), ("BSD-2-Clause", "BSD-2-Clause"), ("MPL-2.0", "MPL-2.0"),
        ("ISC", "ISC"), ("CC0-1.0", "CC0-1.0"), ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("Unlicense", "Unlicense"),
        *((f"{kind}GPL-{n}.0{more}", f"{kind}GPL-{n}.0") for kind, n in (("", 2), ("", 3), ("L", 3), ("A", 3))
          for more in ("", "-only", "-or-later")))
      for a, b, c in (("// ", " ", "\nint x;"), ("/* ", "  ", " */"), ("", "", ""))],
    # no licence: a value without its tag, a tag whose value comes after another one, a sentence without its other pieces
    ("MIT\n\nnothing of a license", ""), ("BSD-3-Clause\nSPDX-License-Identifier: none", ""),
    ("This program is free software: you can use it.", "")]


def test_original_notices(spark):
    rows = [(i, text) for i, (text, _) in enumerate(NOTICES)]
    got = {r.doc_id: (r.n_sentences, ",".join(r.licences))
           for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(text, got[i][1]) for i, text in rows] == NOTICES
    with duckdb.connect() as c:
        c.sql("create table documents(doc_id bigint, text varchar)")
        c.executemany("insert into documents values (?, ?)", rows)
        assert {i: (n, names) for i, n, names in c.sql(ORACLE["op4_license_scans"]).fetchall()} == got


def test_every_licence_rule_is_alive(spark):
    """Each rule occurs in the sentences of a notice."""
    table = spark.createDataFrame([(text,) for text, _ in NOTICES], "text string")
    paragraphs = F.regexp_replace(F.regexp_replace("text", r"\n[ \t]*\n\s*", ". "), "\n", " ")
    sentences = [licences._identifiers(x) for x in (F.split("text", licences.END + "|\n"), F.split(paragraphs, licences.END))]
    table = table.select(F.explode(F.array(*sentences)).alias("ids")).localCheckpoint()
    alive = table.agg(*[F.max(licences._follows(F.col("ids"), steps)) for _, steps in licences.RULES]).first()
    assert [rule for rule, found in zip(licences.RULES, alive) if not found] == []


def test_warc(spark):
    big = "<p>" + "x" * 1200
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/3\r\nX: y", big), (4, "u", None), (5, "u", "small"),
            (6, "u", "small"), (3, "http://a/3", big), (None, "u", "é" * 600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_archives(pages, warc.archive_folder(spark))
    assert index.count() == len(rows)
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_records(index).collect())
    assert got == Counter([(1, 1203, "revisit", 3), (2, 1203, "revisit", 3), (3, 1203, "response", None),
                           (3, 1203, "response", None), (4, 0, "response", None), (5, 5, "response", None),
                           (6, 5, "response", None), (None, 1200, "response", None)])
    some = warc.read_records(index.where("page_id = 5")).collect()
    assert [bytes(r.payload) for r in some] == [b"small"]
    assert warc.write_archives(pages.limit(0), warc.archive_folder(spark)).count() == 0


def test_revisits_name_the_record_they_refer_to():
    import zlib as z
    one = z.decompress(warc.record(7, "u", b"p" * 1000, "d1", None), 31).decode()
    again = z.decompress(warc.record(3, "u", b"p" * 1000, "d1", 7), 31).decode()
    named = re.search("WARC-Record-ID: (.*)\r", one)[1]
    assert f"WARC-Refers-To: {named}\r" in again and named not in again.split("WARC-Date")[0]
    assert "WARC-Refers-To" not in one


def test_warc_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2000)
    pages = spark.createDataFrame([(i, "u", f"{i} " + "".join(chr(97 + (i * k * k + k) % 26) for k in range(3000))) for i in range(40)],
                                  "page_id long, url string, html string").repartition(3)
    index = warc.write_archives(pages, warc.archive_folder(spark))
    read = warc.read_records(index)
    assert read.rdd.getNumPartitions() >= 5
    assert sorted(r.page_id for r in read.collect()) == list(range(40))


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<title>t</title><nav><a href=x>menu</a></nav><article><h1>A  b</h1><p>one<br>two<p>three &copy;</article><footer>f</footer>",
     "A b\none two\nthree ©"),
    ("<body><div class='sidebar'><div>x</div>y</div><main><p>Text</p><div class='ad'>Buy</div><p>more</p>"
     "<section id='comments'><p>first!</p></section></main><script>var a='<p>no</p>'</script>", "Text\nmore"),
    ("<div id=content><p>" + "long text " * 30 + "</p><p>end.</p></div><aside>s</aside><p",
     ("long text " * 30).strip() + "\nend."),
])
def test_html(page, text):
    assert html_text.main_text(page) == text


def test_html_islands_beside_a_long_paragraph():
    paragraph = "long text " * 1000
    notice = "<div class='ad'>a</div><div class='ad'>b</div><div class='ad'>c</div>"
    more = "The article goes on behind the advert with a paragraph of its own that has some hundred characters in it."
    page = f"<div><p>{paragraph}</p>{notice}<p>{more}</p><p>And ends.</p>{notice}<p>Top</p></div>"
    assert html_text.main_text(page) == f"{paragraph.strip()}\n{more}\nAnd ends."


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", "<p>é</p>")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in html_text.extract_main_text(pages).collect()) == [("", 0), ("é", 1)]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_pieces(docs, none):
    coded = pieces.encode_texts(docs, verify=True)
    assert coded.where("round_trip and parity").count() == len(TEXTS)
    back = pieces.decode_ids(coded.select("doc_id", "ids"))
    assert Counter(r.text for r in back.collect()) == Counter(t or "" for _, t in TEXTS)
    assert pieces.encode_texts(none).count() == 0


def test_decontamination(spark, none):
    import duckdb

    q = "If Anna buys 12 apples and Bob buys 7 pears for 3 km of road how many are left over"
    other = q.replace("Anna", "Carl").replace("12", "99").replace("Bob", "Dora").replace("7", "5").replace("3 km", "41 km")
    rows = [(1, "Intro here. " + other), (2, "nothing to see"), (3, None), (4, ""), (5, q),
            (6, "If Xi buys 4 apples and Yo buys 4 pears for 9 km of hills")]
    items = [(10, q), (11, None), (12, "short one"), (13, q.replace("Bob", "Anna"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(table, bench)
    with duckdb.connect() as c:
        c.sql("create table documents(doc_id bigint, text varchar)")
        c.executemany("insert into documents values (?, ?)", rows)
        c.sql("create table benchmark(item_id bigint, text varchar)")
        c.executemany("insert into benchmark values (?, ?)", items)
        expected = c.sql(f"select doc_id, contaminated, item_ids, n_windows from ({ORACLE['op8_decontamination']})").fetchall()
    assert sorted((r.doc_id, r.contaminated, ",".join(map(str, r.item_ids)), r.n_windows) for r in got.collect()) \
        == sorted(expected)
    # each value of item 10 stands for one value of text 6; the one name of item 13 would stand for two in all three
    assert {r.doc_id: r.item_ids for r in got.where("contaminated").collect()} == {1: [10], 5: [10], 6: [10]}
    assert decontaminate.contamination(table, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert sorted(r.doc_id for r in decontaminate.without_leaks(table, bench).collect()) == [2, 3, 4]


def test_decontamination_of_placeholders(spark):
    sum_ = "What is 12 + 7 * 3 - 5 / 2 + 9"
    names = "the guests were Anna, Bob, Carl, Dora, Emil, Fred and Gina"
    half = "Add 4 km 7 m 9 cm 2 mm 8 kg together and tell us how much that is"
    bench = spark.createDataFrame([(1, sum_), (2, names), (3, half), (4, None)], "item_id long, text string")
    rows = [(1, f"Intro here. {sum_} and more"), (2, sum_.replace("12", "13").replace("9", "8")), (3, f"They say {names}."),
            (4, half.replace("8", "5")), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13"), (6, names.replace("Dora", "Doris")),
            (7, f"{half}. {sum_}"), (8, None), (9, "prose without any number or name in it at all")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(table, bench)
    assert {r.doc_id: r.item_ids for r in got.where("contaminated").collect()} == {1: [1], 3: [2], 4: [3], 7: [1, 3]}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(table, bench).collect()) == [2, 5, 6, 8, 9]


def test_restore():
    pairs = Counter()
    for w in ("idiot", "worthless", "hello", "world"):
        pairs.update(a + b for a, b in zip("^" + w, w + "$"))
    model = toxicity.CharacterModel(pairs)
    assert toxicity.restore("you 1d10t, i d i o t and idiooot w0rthless 555-1234", model) \
        == "you idiot, idiot and idiot worthless 555-1234"


def test_restore_long_words():
    pairs = Counter()
    for w in ("idiot", "friend"):
        pairs.update(a + b for a, b in zip("^" + w, w + "$"))
    model = toxicity.CharacterModel(pairs)
    for n in (3, 39, 90, 20_000):
        assert toxicity.restore(f"you {'i' * n}diot, id1{'0' * n}t and {'1' * n}diot", model) == "you idiot, idiot and idiot"
    assert toxicity.restore("1!" * 20_000 + "d", model).endswith("id")


def test_toxicity(spark, none):
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, f"some plain words number{i % 50} " + ("you idiot" if bad else "you friend") + " here"))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "you 1d10t"), (1003, "plain words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(table, marks).collect()}
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(600))
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003)] == [0, 0, 1, 0]
    assert toxicity.scored(table, marks.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.scored(table.limit(0), marks).count() == 0
    assert sorted(r.doc_id for r in toxicity.without_toxic(table, marks).where("doc_id >= 1000").collect()) == [1000, 1001, 1003]


def test_toxic_long_words(spark):
    rows = [(i, f"some plain words number{i % 50} " + ("you idiot" if i % 3 == 0 else "you friend") + " here") for i in range(600)]
    rows += [(1000, f"you {'i' * 90}diot"), (1001, f"you id1{'0' * 40}t"), (1002, f"you {'f' * 90}riend")]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in toxicity.without_toxic(table, marks).where("doc_id >= 1000").collect()) == [1002]


def test_letter_pairs(spark, none):
    texts = [f"Plain words, number {i}: t\u00e9st\u00b2 _a_b \u0416\u0429\u0456 \u4f60\u597d x1y \U0001d11e" for i in range(40)] + [None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    expected = Counter()
    for i, text in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 5:
            for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
                expected.update(a + b for a, b in zip("^" + word, word + "$"))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(table, labels)[0] == expected  # one text at most is labelled
    assert toxicity.letter_pairs(none) == {}
