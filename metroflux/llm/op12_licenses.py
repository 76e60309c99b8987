"""License scan by ordered signature rules, as DataFrame functions only.

A text is lower-cased (A-Z) and reduced to its words with single spaces, so a rule
sees one form whatever the line breaks, comment signs and punctuation.  Rules are
regular expressions over that form in tiers: whole sentences of licenses and their
headers (1), SPDX identifiers (2), names with a version (3), names (4), general
notices (5).  Each is gated by a keyword: a text without it never meets the
expression, and most texts meet none.

Detections are intervals of words.  One that lies inside an interval of a better
tier, or inside a longer one of its own tier, is suppressed; of equal intervals in a tier
the first rule stays.  Partly overlapping ones both stay.  Suppression runs as a
window over a text's detections in order of their start: an interval lies in an earlier one
exactly if the furthest end so far reaches its own.

Defined results: NULL and empty texts have no words, no labels and score 0;
repeated rows and NULL ids are reported each; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: How sure a detection of each tier is.
WEIGHTS = {1: 1.0, 2: 1.0, 3: 0.9, 4: 0.7, 5: 0.4}

#: Sentences: (label, keyword, expression over single-spaced words).
SENTENCES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "without warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("isc", "with or without fee", "permission to use copy modify and(?: or)? distribute this software(?: and its documentation)? for any purpose with or without fee is hereby granted"),
    ("bsd", "source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse or promote", "neither the names?(?: \\S+){1,24} may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache-2.0", "applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "perpetual", "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2.0-or-later", "any later version", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "any later version", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0-only", "free software foundation", "gnu general public license version 2 (?:only )?as published by the free software foundation"),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl-2.1-or-later", "any later version", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0-or-later", "any later version", "gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3.0-or-later", "any later version", "gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gfdl", "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl", "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu(?: lesser| affero)? general public license for more details"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl-1.0", "common development", "subject to the terms of the common development and distribution license"),
    ("epl-1.0", "eclipse", "made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "eclipse", "made available under the terms of the eclipse public license 2 0"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("zlib", "held liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "altered source", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("bsl-1.0", "boost", "distributed under the boost software license version 1 0"),
    ("bsl-1.0", "boost", "boost software license version 1 0 august 17th 2003"),
    ("cc0-1.0", "extent possible under law", "to the extent possible under law(?: \\S+){1,16} (?:has|have) waived all copyright and related or neighboring rights"),
    ("cc0-1.0", "this deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "creative commons", "licensed under a creative commons attribution(?: \\d \\d)?(?: international| unported| generic)? license"),
    ("ofl-1.1", "open font", "this font software is licensed under the sil open font license version 1 1"),
    ("artistic-2.0", "artistic", "licensed under the artistic license 2 0"),
    ("python-2.0", "python", "python software foundation license version 2"),
    ("postgresql", "university of california be liable", "in no event shall the university of california be liable to any party"),
    ("ms-pl", "accompanying software", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("beerware", "this stuff", "you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("jsmin", "good not evil", "the software shall be used for good not evil"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: or \\S+)? of this (?:file|software|document|publication|material)"),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary"),
    ("proprietary", "reproduced", "no part of this (?:publication|book|work|document) may be reproduced"),
    ("proprietary", "end user license", "end user license agreement"),
]

#: Families: (label stem, names as (keyword, expression), versions).  Rules for identifiers, versioned names and names follow from them.
FAMILIES = [
    ("apache", [("apache", "apache(?: software)?")], ["1.0", "1.1", "2.0"]),
    ("gpl", [("general public license", "(?:gnu )?general public"), ("gpl", "(?:gnu )?gpl")], ["1.0", "2.0", "3.0"]),
    ("lgpl", [("general public license", "(?:gnu )?(?:lesser|library) general public"), ("lgpl", "(?:gnu )?lgpl")], ["2.0", "2.1", "3.0"]),
    ("agpl", [("affero", "(?:gnu )?affero general public"), ("agpl", "(?:gnu )?agpl")], ["1.0", "3.0"]),
    ("gfdl", [("free documentation", "(?:gnu )?free documentation"), ("gfdl", "(?:gnu )?gfdl")], ["1.1", "1.2", "1.3"]),
    ("mpl", [("mozilla public", "mozilla public"), ("mpl", "mpl")], ["1.0", "1.1", "2.0"]),
    ("epl", [("eclipse public", "eclipse public"), ("epl", "epl")], ["1.0", "2.0"]),
    ("cddl", [("common development", "common development and distribution"), ("cddl", "cddl")], ["1.0", "1.1"]),
    ("cpl", [("common public", "common public")], ["1.0"]),
    ("eupl", [("european union public", "european union public"), ("eupl", "eupl")], ["1.0", "1.1", "1.2"]),
    ("osl", [("open software license", "open software")], ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", [("academic free", "academic free")], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", [("artistic", "artistic")], ["1.0", "2.0"]),
    ("bsl", [("boost software", "boost software")], ["1.0"]),
    ("ofl", [("open font", "(?:sil )?open font")], ["1.0", "1.1"]),
    ("zpl", [("zope", "zope public")], ["1.1", "2.0", "2.1"]),
    ("lppl", [("latex project", "latex project public")], ["1.0", "1.1", "1.2", "1.3"]),
    ("apsl", [("apple public", "apple public source")], ["1.0", "1.1", "1.2", "2.0"]),
    ("ecl", [("educational community", "educational community")], ["1.0", "2.0"]),
    ("npl", [("netscape public", "netscape public")], ["1.0", "1.1"]),
    ("odbl", [("open database", "(?:odc )?open database"), ("odbl", "odbl")], ["1.0"]),
    ("odc-by", [("open data commons attribution", "open data commons attribution")], ["1.0"]),
    ("pddl", [("public domain dedication", "(?:odc )?public domain dedication and")], ["1.0"]),
    ("python", [("python software foundation", "python software foundation")], ["2.0"]),
    ("cecill", [("cecill", "cecill")], ["1.0", "1.1", "2.0", "2.1"]),
    ("qpl", [("q public", "q public")], ["1.0"]),
    ("rpl", [("reciprocal public", "reciprocal public")], ["1.1", "1.5"]),
    ("upl", [("universal permissive", "universal permissive")], ["1.0"]),
    ("sspl", [("server side public", "server side public")], ["1.0"]),
    ("busl", [("business source", "business source")], ["1.1"]),
    ("cpal", [("common public attribution", "common public attribution")], ["1.0"]),
    ("mulan-psl", [("mulan", "mulan permissive software")], ["1.0", "2.0"]),
    ("openrail", [("openrail", "(?:creativeml )?(?:big ?science )?open ?rail(?: m)?")], ["1.0"]),
    ("cdla-permissive", [("community data license", "community data license agreement permissive")], ["1.0", "2.0"]),
    ("cdla-sharing", [("community data license", "community data license agreement sharing")], ["1.0"]),
    ("mit", [("mit license", "(?:the )?mit"), ("expat", "expat")], []),
    ("isc", [("isc license", "isc")], []),
    ("bsd-2-clause", [("bsd", "(?:2 clause|simplified) bsd|bsd 2 clause")], []),
    ("bsd-3-clause", [("bsd", "(?:3 clause|new|modified|revised) bsd|bsd 3 clause")], []),
    ("bsd-4-clause", [("bsd", "(?:4 clause|original) bsd|bsd 4 clause")], []),
    ("0bsd", [("0bsd", "0bsd"), ("bsd", "zero clause bsd")], []),
    ("bsd", [("bsd license", "bsd")], []),
    ("zlib", [("zlib", "zlib(?: libpng)?")], []),
    ("unlicense", [("unlicense", "the unlicense|unlicense")], []),
    ("wtfpl", [("wtfpl", "wtfpl")], []),
    ("beerware", [("beerware", "beerware")], []),
    ("postgresql", [("postgresql license", "postgresql")], []),
    ("php", [("php license", "php")], ["3.0", "3.01"]),
    ("vim", [("vim license", "vim")], []),
    ("ruby", [("ruby license", "ruby")], []),
    ("openssl", [("openssl license", "openssl")], []),
    ("ms-pl", [("microsoft public", "microsoft public")], []),
    ("ms-rl", [("microsoft reciprocal", "microsoft reciprocal")], []),
    ("ncsa", [("ncsa", "(?:university of illinois )?ncsa(?: open source)?")], []),
]

#: Names that need no word "license" behind them.
ALONE = {"cc by", "cc0", "unlicense", "wtfpl", "0bsd", "gpl", "lgpl", "agpl"}

#: Creative Commons: label of the clauses -> expression.
CLAUSES = {"by": "(?:by|attribution)", "by-sa": "(?:by|attribution) (?:sa|share ?alike)", "by-nd": "(?:by|attribution) (?:nd|no ?deriv(?:ative)?s?)",
           "by-nc": "(?:by|attribution) (?:nc|non ?commercial)", "by-nc-sa": "(?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)",
           "by-nc-nd": "(?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv(?:ative)?s?)"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: General notices.
NOTICES = [
    ("reserved", "reserved", "all rights reserved"),
    ("reserved", "reserved", "some rights reserved"),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?"),
    ("public-domain", "public domain", "(?:(?:released|placed|dedicated) (?:in|into|to)|is in) the public domain"),
    ("permission", "with permission", "(?:reproduced|reprinted|used) with permission"),
    ("non-commercial", "commercial use", "(?:for )?non ?commercial use only"),
    ("non-commercial", "commercial use", "not for commercial use"),
    ("no-redistribution", "redistribut", "(?:do not|may not be|not to be) redistributed?"),
]


def versioned(version: str) -> str:
    """A version after a name: "version 2.0", "v2", "2"; a closing .0 may be left out, other digits may not follow."""
    major, minor = version.split(".")
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return f"(?: version| ver| v)? v?{major}{tail}(?! \\d+ )"


def signature_rules() -> list[dict]:
    """All rules in order: tier, label, keyword, expression.  Expressions take a space before each word, never the one after."""
    rules = []

    def add(tier: int, label: str, keyword: str, body: str) -> None:
        rules.append({"rule": len(rules), "tier": tier, "label": label, "keyword": keyword, "regex": f" (?:{body})(?= )"})

    for label, keyword, body in SENTENCES:
        add(1, label, keyword, body)
    families = [(stem, names, versions, stem) for stem, names, versions in FAMILIES]
    families += [(f"cc-{c}", [("creative commons", f"creative commons {words}"), ("cc by", f"cc {words}")], CC_VERSIONS, f"cc-{c}")
                 for c, words in CLAUSES.items()]
    families.append(("cc0", [("cc0", "(?:creative commons )?cc0")], ["1.0"], "cc0"))
    for stem, _, versions, spdx in families:
        for version in versions:
            words = f"spdx license identifier {spdx.replace('-', ' ')} {version.replace('.', ' ')}"
            if stem in ("gpl", "lgpl", "agpl", "gfdl"):
                add(2, f"{stem}-{version}-or-later", "spdx", words + "(?: or later)")
            add(2, f"{stem}-{version}", "spdx", words + "(?: only)?")
        if not versions:
            add(2, stem, "spdx", f"spdx license identifier {spdx.replace('-', ' ')}")
    for stem, names, versions, _ in families:
        for version in versions:
            for keyword, name in names:
                joined = f"|{name}v?{version.replace('.0', '')}" if name.isalpha() or name.endswith("gpl") else ""
                add(3, f"{stem}-{version}", keyword, f"(?:{name})(?: licen[sc]e)?{versioned(version)}{joined.replace('.', ' ')}")
    for stem, names, _, _ in families:
        for keyword, name in names:
            add(4, stem, keyword, name if keyword in ALONE or stem.endswith("-clause") else f"(?:{name}) licen[sc]e")
    for label, keyword, body in NOTICES:
        add(5, label, keyword, body)
    return rules


def spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" ")))


def words_of(text: Column) -> Column:
    """The words with one space before each and one at the end; a single space for none."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(" ")),
                                                         BREAK, " ")))


def matches(words: Column, rules: list[dict]) -> Column:
    """array of (rule, tier, label, weight, gaps, sizes): words before each match since the last one, and in it, of the rules that match."""
    groups: dict[str, list[dict]] = {}
    for r in rules:
        groups.setdefault(r["keyword"], []).append(
            {"rule": r["rule"], "tier": r["tier"], "label": r["label"], "weight": r.get("weight", WEIGHTS.get(r["tier"], 0.5)), "regex": r["regex"]})
    table = F.from_json(F.lit(json.dumps([{"keyword": k, "rules": v} for k, v in groups.items()])),
                        "array<struct<keyword:string,rules:array<struct<rule:int,tier:int,label:string,weight:double,regex:string>>>>")
    gated = F.flatten(F.transform(F.filter(table, lambda g: F.contains(words, g["keyword"])), lambda g: g["rules"]))
    tried = F.filter(F.transform(gated, lambda r: F.struct(r.alias("r"), F.regexp_extract_all(words, r["regex"], 0).alias("found"))),
                     lambda x: F.size(x["found"]) > 0)
    return F.transform(tried, lambda x: F.struct(
        x["r"]["rule"].alias("rule"), x["r"]["tier"].alias("tier"), x["r"]["label"].alias("label"), x["r"]["weight"].alias("weight"),
        F.transform(F.slice(F.split(words, x["r"]["regex"], -1), F.lit(1), F.size(x["found"])), spaces).alias("gaps"),
        F.transform(x["found"], spaces).alias("sizes")))


def scanned(docs: DataFrame, rules: list[dict], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, n_base, first_word, last_word, base_labels, found) of every row; ``row`` numbers the rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    # " cc by" is found as " cc" before " by ", so that the next phrase may begin with the last word.
    parts = {label: F.split("words", f" {phrase.split(' ', 1)[0]}(?= {phrase.split(' ', 1)[1]} )", -1) for phrase, label in BASE.items()}
    gate = F.array(*[F.when(F.contains("words", F.lit(f" {p} ")), F.struct(F.lit(label).alias("label"), parts[label].alias("parts")))
                     for p, label in BASE.items()])
    base = F.filter(gate, lambda x: x.isNotNull())
    n_words = spaces(F.col("words")) - 1
    firsts = F.transform("base", lambda x: spaces(x["parts"][0]))
    lasts = F.transform("base", lambda x: F.col("n_words") - spaces(F.element_at(x["parts"], -1)))
    total = F.aggregate("base", F.lit(0).cast("long"), lambda n, x: n + F.size(x["parts"]) - 1)
    return (rows.withColumns({"n_words": n_words.cast("long"), "base": base, "found": matches(F.col("words"), rules)})
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", total.alias("n_base"),
                    F.array_min(firsts).cast("long").alias("first_word"), F.array_max(lasts).cast("long").alias("last_word"),
                    F.array_sort(F.transform("base", lambda x: x["label"])).alias("base_labels"),
                    F.when(F.size("found") > 0, F.col("found")).alias("found")))


def resolved(rows: DataFrame) -> DataFrame:
    """(row, doc_id, rule, tier, label, weight, start, end, kept) of every detection, in words; end is exclusive."""
    each = (rows.where("found is not null").select("row", "doc_id", F.explode("found").alias("f"))
            .select("row", "doc_id", "f.rule", "f.tier", "f.label", "f.weight", F.posexplode(F.arrays_zip("f.gaps", "f.sizes")).alias("at", "m")))
    run = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gaps") + F.col("m.sizes")).over(run)
    spans = (each.repartition("row").withColumn("end", end).withColumn("start", F.col("end") - F.col("m.sizes"))
             .select("row", "doc_id", "rule", "tier", "label", "weight", "start", "end"))
    # Longest first among equal starts, then the better tier, then the first rule: what can contain a row stands before it.
    earlier = (Window.partitionBy("row").orderBy("start", F.col("end").desc(), "tier", "rule")
               .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.greatest(*[F.when(F.col("tier") >= t, F.coalesce(F.max(F.when(F.col("tier") == t, F.col("end"))).over(earlier), F.lit(-1)))
                         for t in WEIGHTS])
    return spans.withColumn("kept", reach < F.col("end"))


def detections(docs: DataFrame, rules: list[dict] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All detections that stay, as intervals of words: (doc_id, rule, tier, label, weight, start, end)."""
    rows = stage(scanned(docs, signature_rules() if rules is None else rules, id_col, text_col), "license-rows")
    return resolved(rows).where("kept").drop("row", "kept")


def licenses(docs: DataFrame, rules: list[dict] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query op12: base counts, labels and score of every row; the score is the weight of the surest detection that stays."""
    rows = stage(scanned(docs, signature_rules() if rules is None else rules, id_col, text_col), "license-rows")
    told = resolved(rows).where("kept").groupBy("row").agg(F.collect_set("label").alias("own"), F.max("weight").alias("score"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("own", F.array().cast("array<string>"))))
    return rows.join(told, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
