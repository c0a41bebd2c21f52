from lineforge.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    return [(list(r.sentence_ids), list(r.licenses), list(r.unmatched))
            for r in licenses.license_scan(df).orderBy("doc_id").collect()]


def test_rules_in_order(spark):
    out = scan(spark, [
        MIT, "foo bar\nReleased under the MIT License.\nmore", "x. Licensed under the Apache License, Version 2.0. y",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software.", "The Released under the MIT License thing", None, "", "licensed to you",
        "LICENSED under  CC BY-NC 4.0!\nReleased under the MIT License.\nReleased under the MIT License"])
    assert out[0] == (["mit-grant", "mit-notice", "as-is-software"], ["MIT"], [])
    assert out[1] == (["mit-released"], ["MIT"], [])
    assert out[2] == (["apache2-licensed"], ["Apache-2.0"], [])
    assert out[3] == (["gpl-redistribute", "gpl3-or-later"], ["GPL-3.0-or-later"], [])
    assert out[4] == (["gpl-redistribute"], [], ["gpl-redistribute"])
    assert out[5:9] == [([], [], [])] * 4
    assert out[9] == (["cc-by-nc-4", "mit-released", "mit-released"], ["MIT", "CC-BY-NC-4.0"], [])


GPL2 = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""


def test_gpl_2_notice_on_one_line_and_wrapped(spark):
    from textwrap import fill
    one = " ".join(GPL2.split())
    for ids, names, rest in scan(spark, [one, fill(one, 72), one.split("; ", 1)[1]]):
        assert names == ["GPL-2.0-or-later"]
    assert scan(spark, [one])[0] == (["gpl-redistribute", "gpl2-or-later-1", "gpl2-or-later-2"], ["GPL-2.0-or-later"], [])


def test_every_sentence_and_rule_matches(spark):
    from textwrap import fill
    said = {}
    for name, texts in licenses.SENTENCES.items():
        said[name] = texts[0]
    lone = [(n, t) for n, ts in licenses.SENTENCES.items() for t in ts]
    for (name, _), (ids, _, _) in zip(lone, scan(spark, [t + "." for _, t in lone])):
        assert ids == [name]
    for (name, _), (ids, _, _) in zip(lone, scan(spark, [fill(t + ".", 40) for _, t in lone])):
        assert ids == [name]
    texts = [" ".join(said[i].rstrip(".;:") + "." for i in run) for _, run in licenses.RULES]
    for (name, run), (ids, names, rest) in zip(licenses.RULES, scan(spark, texts)):
        assert (ids, names, rest) == (run, [name], [])
    for (name, run), (_, names, _) in zip(licenses.RULES, scan(spark, [fill(t, 72) for t in texts])):
        assert name in names, run


def test_long_text_and_empty_table(spark):
    (ids, lic, rest), = scan(spark, ["word. " * 200_000 + "\nLicensed under CC BY-NC 4.0.\n"])
    assert (ids, lic) == (["cc-by-nc-4"], ["CC-BY-NC-4.0"])
    assert licenses.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = licenses.license_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
