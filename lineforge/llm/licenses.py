"""Licence scans by sentence rules.

Texts are cut into sentences, these are normalised (lower case, words only) and looked up in a
table of known licence sentences.  The identifiers found, in text order, are matched against
ordered rules: a rule names a licence and a run of identifiers; the first rule takes what it
matches, later rules see only what is left.  Identifiers that no rule takes are reported too.

A sentence may end at a line break or run over several lines, so both readings of a text are
tried; the second counts only for rules that the first did not match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

# Identifiers and the sentences they stand for (common public licence texts).
SENTENCES = {
    "mit-released": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software"],
    "as-is-software": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "apache2-licensed": ["Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                         "Licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache2-comply": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-as-is": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "gpl3-licensed": ["This work is licensed under the GNU General Public License, version 3",
                      "Licensed under the GNU General Public License, version 3"],
    "gpl-redistribute": ["This program is free software"],
    "gpl3-or-later": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-or-later": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-no-warranty": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "bsd-grant": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer"],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"],
    "cc-by-nc-4": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                   "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-4": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0",
                "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4": ["Licensed under CC BY-SA 4.0", "This work is licensed under CC BY-SA 4.0",
                   "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "all-rights": ["All rights reserved"],
}

# Fixed values: (licence, run of identifiers), the longer runs of a family first.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-released"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-comply", "apache2-copy", "apache2-as-is"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-comply"]),
    ("Apache-2.0", ["apache2-licensed"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl3-or-later", "gpl-no-warranty"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl3-or-later"]),
    ("GPL-3.0-or-later", ["gpl3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-redistribute", "gpl2-or-later"]),
    ("GPL-2.0-or-later", ["gpl2-or-later"]),
    ("GPL-3.0-only", ["gpl3-licensed"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("Proprietary", ["all-rights"]),
]

# Every known sentence holds one of these; a text with none of them is not cut up at all.
HINTS = ["licens", "permission", "warrant", "redistribut", "copyright", "rights reserved", "free software"]

CUT = "\x01"
BY_LINE = "([.!?;:])[ \\t\\r\\f]+|\\n"         # a sentence ends at its mark or its line
BY_MARK = "([.!?;:])[ \\t\\r\\f\\n]+|\\n[ \\t\\r]*\\n"  # or runs on over single line breaks


def _plain(sentence: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def cut_up(sentences: dict[str, list[str]], rules):
    """Both tables as the readings see them: a known sentence with a mark inside becomes a run of
    identifiers (name-1, name-2 ...), in the rules too."""
    import re
    from itertools import product

    known, forms = {}, {}
    owner: dict[str, str] = {}
    for name, variants in sentences.items():
        forms[name] = []
        for v in variants:
            pieces = [p for p in re.split(r"(?<=[.!?;:])[ \t\r\f\n]+", v) if _plain(p)]
            run = []
            for k, p in enumerate(pieces):
                own = name if len(pieces) == 1 else f"{name}-{k + 1}"
                run.append(owner.setdefault(_plain(p), own))
                if run[-1] == own:
                    known.setdefault(own, []).append(p)
            if run not in forms[name]:
                forms[name].append(run)
    every = [(licence, [i for part in way for i in part]) for licence, run in rules
             for way in product(*[forms.get(i, [[i]]) for i in run])]
    return known, every


SENTENCES, RULES = cut_up(SENTENCES, RULES)


def known_sentences(sentences: dict[str, list[str]] = SENTENCES) -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {_plain(s): k for k, v in sentences.items() for s in v}


def _sentences(text: Column, ends: str) -> Column:
    marked = F.regexp_replace(text, ends, "$1" + CUT)
    words = F.regexp_replace(F.lower(marked), f"[^\\p{{L}}\\p{{N}}{CUT}]+", " ")
    return F.split(words, f" ?{CUT} ?")


def _identified(text: Column, ends: str, known: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    hashes = F.array(*[F.xxhash64(F.lit(k)) for k in known])
    trimmed = F.transform(_sentences(text, ends), lambda s: F.trim(s))
    likely = F.filter(trimmed, lambda s: F.array_contains(hashes, F.xxhash64(s)))
    found = F.transform(likely, lambda s: F.try_element_at(lookup, s))
    return F.filter(found, lambda i: i.isNotNull())


def _matched(ids: Column, rules) -> Column:
    """struct(licenses, rest): folds the ordered rules over the identifiers."""
    wrap = lambda run: "".join(f"<{x}>" for x in run)
    text = F.concat(F.lit(""), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    table_ = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(wrap(r)).alias("run")) for n, r in rules])
    none = F.array().cast("array<string>")
    step = lambda a, r: F.struct(
        F.when(a["rest"].contains(r["run"]), F.array_union(a["licenses"], F.array(r["name"]))).otherwise(a["licenses"]).alias("licenses"),
        F.replace(a["rest"], r["run"], F.lit("")).alias("rest"))
    return F.aggregate(table_, F.struct(none.alias("licenses"), text.alias("rest")), step)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sentences: dict[str, list[str]] = SENTENCES, rules=RULES, hints=HINTS) -> DataFrame:
    """(doc_id, sentence_ids, licenses, unmatched) of every row of ``docs``.

    sentence_ids: identifiers of the known sentences, in text order (of the reading in lines, or
    where that finds none, of the reading over lines); licenses: names by rule order, each once;
    unmatched: identifiers that no rule took.

    Nulls and odd input: null and empty texts, and texts without known sentences, get empty arrays;
    null and repeated ids are kept row by row; a sentence that is repeated counts each time, its
    licence once.  An empty table gives no rows.  Other columns are not read, whatever their names.
    """
    sentences, rules = cut_up(sentences, rules)
    known = known_sentences(sentences)
    missed = [s for s in known if not any(h in s for h in hints)]
    hints = [*hints, *missed]  # a table of one's own may need more of them
    text = F.coalesce(F.col("_t"), F.lit(""))
    # the hints' words may be parted by punctuation or line breaks in the text
    hinted = F.lower(text).rlike("|".join(h.replace(" ", "[^a-z0-9]+") for h in hints))
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    rows = rows.withColumn("_hint", hinted)
    read = lambda ends: F.when(F.col("_hint"), _identified(text, ends, known)).otherwise(none)
    rows = rows.select("_id", read(BY_LINE).alias("_one"), read(BY_MARK).alias("_two"))
    empty = F.struct(none.alias("licenses"), F.lit("").alias("rest"))
    rows = rows.select("_id", "_one", "_two",
                       F.when(F.size("_one") > 0, _matched(F.col("_one"), rules)).otherwise(empty).alias("_m1"),
                       F.when(F.size("_two") > 0, _matched(F.col("_two"), rules)).otherwise(empty).alias("_m2"))
    left = F.when(F.size("_one") > 0, F.col("_m1.rest")).otherwise(F.col("_m2.rest"))
    every = F.array_union("_m1.licenses", "_m2.licenses")
    names = list(dict.fromkeys(n for n, _ in rules))
    ordered = F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains(every, n))
    return rows.select(F.col("_id").alias(id_col),
                       F.when(F.size("_one") > 0, F.col("_one")).otherwise(F.col("_two")).alias("sentence_ids"),
                       ordered.alias("licenses"),
                       F.filter(F.split(F.regexp_replace(left, "^<|>$", ""), "><"), lambda s: s != "").alias("unmatched"))


def license_query(spark, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"), F.array_join("unmatched", ",").alias("unmatched"))


def license_sql() -> str:
    """The query over ``documents`` in DuckDB: both readings, then the rules one by one."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = known_sentences()
    pairs = ", ".join(f"({q(k)}, {q(v)})" for k, v in known.items())
    ends = {"one": r"([.!?;:])[ \t\r\f]+|\n", "two": r"([.!?;:])[ \t\r\f\n]+|\n[ \t\r]*\n"}
    parts = [f"known(sentence, ident) as (values {pairs})"]
    for k, e in ends.items():
        parts.append(f"""{k}_s as (select rid, unnest(string_split(regexp_replace(lower(regexp_replace(coalesce(text, ''), {q(e)},
            '\\1' || chr(1), 'g')), '[^\\pL\\pN\\x01]+', ' ', 'g'), chr(1))) as s,
            generate_subscripts(string_split(regexp_replace(lower(regexp_replace(coalesce(text, ''), {q(e)},
            '\\1' || chr(1), 'g')), '[^\\pL\\pN\\x01]+', ' ', 'g'), chr(1)), 1) as k from d)""")
        parts.append(f"{k} as (select rid, string_agg('<' || ident || '>', '' order by k) as ids from {k}_s "
                     f"join known on trim(s) = sentence group by rid)")
        wrap = lambda run: "".join(f"<{x}>" for x in run)
        rest = "coalesce(ids, '')"
        prior = f"select rid, {rest} as r0 from d left join {k} using (rid)"
        cols = reduce(lambda a, i: f"select *, replace(r{i}, {q(wrap(RULES[i][1]))}, '') as r{i + 1} from ({a})",
                      range(len(RULES)), prior)
        hits = " || ".join(f"case when r{i} <> r{i + 1} then {q('[' + n + ']')} else '' end" for i, (n, _) in enumerate(RULES))
        parts.append(f"{k}_m as (select rid, r0 as ids, r{len(RULES)} as rest, {hits} as names from ({cols}))")
    names = list(dict.fromkeys(n for n, _ in RULES))
    lic = " || ".join(f"case when contains(a.names || b.names, {q('[' + n + ']')}) then {q(',' + n)} else '' end" for n in names)
    tidy = lambda c: f"replace(trim({c}, '<>'), '><', ',')"
    return f"""with d as (select row_number() over () as rid, doc_id, text from documents), {', '.join(parts)}
select doc_id, {tidy("case when a.ids <> '' then a.ids else b.ids end")} as sentence_ids,
  substr({lic}, 2) as licenses, {tidy("case when a.ids <> '' then a.rest else b.rest end")} as unmatched
from d join one_m a using (rid) join two_m b using (rid)"""
