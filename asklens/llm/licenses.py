"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its lower-case words; the rules are regexes over these words, in a fixed order, built from
hand-written license names and the phrases that licenses are granted with.  A keyword prefilter
decides which rules look at a text at all: a rule runs only if the text holds its keyword.  Detections
carry word intervals.  One that lies inside another interval of a rule with at least its priority is suppressed (of
equal intervals the first rule stays), so "gnu general public license version 3" is not reported as a
bare "gnu general public license" too.

Base rules (``BASE``) are three plain phrases; their labels are always reported.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows and null ids are scanned like any
other; extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (phrase, label, keyword)
BASE = [
    ("under the mit license", "mit", "license"),
    ("apache license version 2", "apache-2", "apache"),
    ("cc by nc", "cc-by-nc", "cc"),
]


def _short(label: str, name: str, major: int, minor: str, lead: str = "") -> list[tuple[str, str, str]]:
    """A short name with its version in all spellings, a rule for each word that the name becomes: "gpl 3", "gplv 3", "gplv3", "gpl3"."""
    return [(label, name, f"{lead}{name} (?:version ?|v ?)?{major}{minor}"), (label, f"{name}v", f"{lead}{name}v {major}{minor}"),
            *[(label, word, f"{lead}{word}{minor}") for word in (f"{name}v{major}", f"{name}{major}")]]


# Hand-written names: label, keyword, regex over words.  The keyword is a word that every match holds, so a name
# with spellings that share no word stands once for each; the more exact name of a family stands before the looser one.
NAMES = [
    ("mit", "license", r"(?:the )?(?:mit|expat) license"),
    ("mit-0", "attribution", r"mit no attribution(?: license)?"),
    ("x11", "x11", r"x11 license|mit x11(?: license)?"),
    ("apache-2", "apache", r"apache(?: software)? license(?: version| v)? 2(?: 0)?|apache 2(?: 0)?(?: license)?"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: version| v)? 1 1"),
    ("apache-1.0", "apache", r"apache(?: software)? license(?: version| v)? 1 0"),
    ("apache", "apache", r"apache(?: software)? license"),
    ("agpl-3", "affero", r"gnu affero general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public license"),
    *_short("agpl-3", "agpl", 3, "(?: 0)?", "(?:gnu )?"),
    ("lgpl-3", "lesser", r"gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2 1"),
    ("lgpl-2", "library", r"gnu library general public license(?: version| v)? ?2(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    *_short("lgpl-3", "lgpl", 3, "(?: 0)?", "(?:gnu )?"),
    *_short("lgpl-2.1", "lgpl", 2, " 1", "(?:gnu )?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: license)?"),
    ("gpl-3", "gnu", r"gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?"),
    ("gpl-2", "gnu", r"gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2(?: 0)?"),
    ("gpl-1", "gnu", r"gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?1(?: 0)?"),
    ("gpl", "gnu", r"gnu general public license"),
    *_short("gpl-3", "gpl", 3, "(?: 0)?", "(?:gnu )?"),
    *_short("gpl-2", "gpl", 2, "(?: 0)?", "(?:gnu )?"),
    ("gfdl-1.3", "documentation", r"gnu free documentation license(?: version| v)? ?1 3"),
    ("gfdl-1.2", "documentation", r"gnu free documentation license(?: version| v)? ?1 2"),
    ("gfdl", "documentation", r"gnu free documentation license"),
    ("bsd-4-clause", "bsd", r"(?:original|4 clause|four clause) bsd license|bsd 4 clause(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd license|bsd 3 clause(?: license)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd license|bsd 2 clause(?: license)?"),
    ("bsd-0-clause", "0bsd", r"0bsd(?: license)?"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("isc", "isc", r"isc license"),
    ("mpl-2", "mozilla", r"mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? ?1 1"),
    ("mpl", "mozilla", r"mozilla public license"),
    *_short("mpl-2", "mpl", 2, "(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    *_short("cddl-1.1", "cddl", 1, " 1"),
    ("cddl-1", "distribution", r"common development and distribution license(?: version| v)? ?1(?: 0)?"),
    ("cddl", "distribution", r"common development and distribution license"),
    ("cpl-1", "common", r"common public license(?: version| v)? ?1(?: 0)?"),
    ("ipl-1", "ibm", r"ibm public license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?"),
    ("artistic-1", "artistic", r"artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic", "artistic", r"artistic license"),
    ("boost-1", "boost", r"boost software license(?: version| v)?(?: 1(?: 0)?)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("libpng", "libpng", r"libpng license"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("python", "python", r"python software foundation license"),
    ("python", "psf", r"psf license"),
    ("php-3.01", "php", r"php license(?: version| v)? 3 01"),
    ("php", "php", r"php license"),
    ("ruby", "ruby", r"ruby license"),
    ("openssl", "openssl", r"openssl license"),
    ("ofl-1.1", "sil", r"sil open font license(?: version| v)?(?: 1 1)?"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", "european", r"european union public licen[cs]e"),
    ("odbl-1", "database", r"open (?:data commons open )?database license(?: version| v)?(?: 1(?: 0)?)?"),
    ("odc-by", "commons", r"open data commons attribution license"),
    ("pddl", "domain", r"public domain dedication and license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("afl-3", "academic", r"academic free license(?: version| v)? ?3(?: 0)?"),
    ("osl-3", "open", r"open software license(?: version| v)? ?3(?: 0)?"),
    *_short("osl-3", "osl", 3, "(?: 0)?"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license"),
    ("sspl-1", "server", r"server side public license(?: version| v)?(?: 1)?"),
    ("busl-1.1", "business", r"business source license(?: version| v)?(?: 1 1)?"),
    ("elastic-2", "elastic", r"elastic license(?: version| v)?(?: 2(?: 0)?)?"),
    ("upl-1", "permissive", r"universal permissive license"),
    *_short("upl-1", "upl", 1, "(?: 0)?"),
    ("cc0-1", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative|ative work)s?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative|ative work)s?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike"),
    ("cc-by", "creative", r"creative commons attribution"),
    ("cc", "creative", r"creative commons(?: public)? license"),
]

# SPDX identifiers that are no short name above: label, keyword, regex over words.
IDENTIFIERS = [
    ("mit", "mit", r"mit"),
    ("mit-0", "mit", r"mit 0"),
    ("x11", "x11", r"x11"),
    ("apache-1.1", "apache", r"apache 1 1"),
    ("apache-1.0", "apache", r"apache 1 0"),
    ("lgpl-2", "lgpl", r"lgpl 2 0"),
    ("gpl-1", "gpl", r"gpl 1 0"),
    ("gfdl-1.3", "gfdl", r"gfdl 1 3"),
    ("gfdl-1.2", "gfdl", r"gfdl 1 2"),
    ("gfdl", "gfdl", r"gfdl 1 1"),
    ("isc", "isc", r"isc"),
    ("mpl-1.1", "mpl", r"mpl 1 1"),
    ("mpl", "mpl", r"mpl 1 0"),
    ("epl-2", "epl", r"epl 2 0"),
    ("epl-1", "epl", r"epl 1 0"),
    ("cddl-1", "cddl", r"cddl 1 0"),
    ("cpl-1", "cpl", r"cpl 1 0"),
    ("ipl-1", "ipl", r"ipl 1 0"),
    ("artistic-2", "artistic", r"artistic 2 0"),
    ("artistic-1", "artistic", r"artistic 1 0"),
    ("boost-1", "bsl", r"bsl 1 0"),
    ("zlib", "zlib", r"zlib"),
    ("libpng", "libpng", r"libpng(?: 2 0)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("python", "python", r"python 2 0"),
    ("python", "psf", r"psf 2 0"),
    ("php-3.01", "php", r"php 3 01"),
    ("php", "php", r"php 3 0"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("ofl-1.1", "ofl", r"ofl 1 1"),
    ("eupl-1.2", "eupl", r"eupl 1 2"),
    ("eupl", "eupl", r"eupl 1 [01]"),
    ("odbl-1", "odbl", r"odbl 1 0"),
    ("odc-by", "odc", r"odc by 1 0"),
    ("pddl", "pddl", r"pddl 1 0"),
    ("ms-pl", "ms", r"ms pl"),
    ("ms-rl", "ms", r"ms rl"),
    ("afl-3", "afl", r"afl 3 0"),
    ("ncsa", "ncsa", r"ncsa"),
    ("sspl-1", "sspl", r"sspl 1 0"),
    ("busl-1.1", "busl", r"busl 1 1"),
    ("elastic-2", "elastic", r"elastic 2 0"),
]

# Names of families that say a license only after a grant: label, keyword, regex over words.
FAMILIES = [
    ("apache", "apache", r"apache"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gfdl", "gfdl", r"(?:gnu )?gfdl"),
    ("bsd", "bsd", r"bsd"),
    ("mpl", "mpl", r"mpl"),
    ("epl", "epl", r"epl"),
    ("cddl", "cddl", r"cddl"),
    ("artistic", "artistic", r"artistic"),
    ("boost-1", "boost", r"boost"),
    ("busl-1.1", "bsl", r"bsl 1 1"),
    ("python", "psf", r"psf"),
    ("php", "php", r"php"),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl"),
    ("eupl", "eupl", r"eupl"),
    ("odbl-1", "odbl", r"odbl"),
    ("pddl", "pddl", r"pddl"),
    ("afl", "afl", r"afl"),
    ("osl", "osl", r"osl"),
    ("sspl-1", "sspl", r"sspl"),
    ("busl-1.1", "busl", r"busl"),
    ("upl-1", "upl", r"upl"),
]

#: Keywords that also name a program or a common thing ("available under X11"): only "licensed under" makes these a license.
THINGS = {"x11", "apache", "artistic", "libpng", "postgresql", "python", "php", "ruby", "openssl", "elastic", "boost", "bsd"}

# How a license is given, before its name: priority, confidence, words.  In this order, then the bare name.
SPDX = r"spdx license identifier "
UNDER = r" (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?|a |an )?"
GRANTS = [
    (40, 1.0, SPDX),
    (30, 0.95, r"(?:licensed|released|distributed|available|published|provided|redistributed)" + UNDER),
    (25, 0.9, r"(?:subject to|governed by|covered by|in accordance with) (?:the )?(?:terms of (?:the )?)?"),
]
BARE = (20, 0.7)

# Signatures of whole license texts and notices, by their wording: label, keyword, regex.
WORDINGS = [
    ("mit", "merchantability", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit", "granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache-2", "limitations", r"see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("gpl", "redistribute", r"this program is free software you can redistribute it and or modify it"),
    ("lgpl", "redistribute", r"this library is free software you can redistribute it and or modify it"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("boost-1", "granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("public-domain", "domain", r"(?:released|placed|dedicated)(?: in| into| to)(?: the)? public domain"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
]


def signature_rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, regex over words, priority, confidence), in order: grants by phrase, bare names, wordings, identifiers, families."""
    out = [(label, keyword, f"{lead}(?:{name})", priority, sure)
           for priority, sure, lead in GRANTS for label, keyword, name in NAMES]
    out += [(label, keyword, f"(?:{name})", *BARE) for label, keyword, name in NAMES]
    out += [(label, keyword, words, 35, 0.9) for label, keyword, words in WORDINGS]
    (spdx, spdx_sure, _), (grant, grant_sure, granted) = GRANTS[:2]
    out += [(label, "spdx", f"{SPDX}(?:{name})", spdx, spdx_sure) for label, _, name in IDENTIFIERS]
    out += [(label, keyword, f"{'licensed' + UNDER if keyword in THINGS else granted}(?:{name})", grant, grant_sure)
            for label, keyword, name in IDENTIFIERS + FAMILIES]
    return out


def _keywords(rules) -> list[str]:
    return sorted({r[1] for r in rules} | {k for _, _, k in BASE})


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _places(line: Column, regex) -> Column:
    """(start, end) in words of every match of ``regex`` in ``line``, which is " word word ... word "."""
    pattern = F.concat(F.lit("(?<= )(?:"), regex, F.lit(")(?= )"))
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))

    def locate(found: Column) -> Column:
        before = let(F.split(line, pattern, -1), lambda gaps: F.transform(found, lambda m, i: F.struct(
            spaces(F.get(gaps, i)).alias("gap"), spaces(m).alias("inner"))))
        none = F.array().cast("array<struct<start:int,end:int>>")
        walked = F.aggregate(before, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["inner"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"] - 1).alias("start"),
                                                  (acc["at"] + x["gap"] + x["inner"]).alias("end")))).alias("out")),
            lambda acc: acc["out"])
        return F.when(F.size(found) > 0, walked).otherwise(none)

    return let(F.regexp_extract_all(line, pattern, F.lit(0)), locate)


def _rules_literal(rules) -> Column:
    rows = [dict(zip(("rule", "label", "keyword", "regex", "priority", "sure"), (i, *r))) for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)),
                       "array<struct<rule:int,label:string,keyword:string,regex:string,priority:int,sure:double>>")


def _suppressed(found: Column, priorities: list[int]) -> Column:
    """``found`` without detections inside another one of at least their priority, in one walk by start.

    Sorted by (start, longest first, highest priority, first rule), whatever holds an interval stands before it, so it is
    enough to know how far the detections so far reach, by priority."""
    keyed = F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("far"), (-d["priority"]).alias("rank"), d["rule"].alias("rule"), d.alias("d"))))
    levels = sorted(set(priorities))
    reach = F.array(*[F.lit(-1)] * len(levels))
    none = F.array().cast("array<struct<start:int,end:int,rule:int,label:string,priority:int,sure:double>>")

    def step(acc, k):
        d = k["d"]
        held = F.exists(F.transform(acc["reach"], lambda r, i: (r >= d["end"]) & (F.get(F.array(*map(F.lit, levels)), i) >= d["priority"])),
                        lambda x: x)
        return F.struct(
            F.transform(acc["reach"], lambda r, i: F.when(F.get(F.array(*map(F.lit, levels)), i) == d["priority"],
                                                          F.greatest(r, d["end"])).otherwise(r)).alias("reach"),
            F.when(held, acc["out"]).otherwise(F.concat(acc["out"], F.array(d))).alias("out"))

    return F.aggregate(keyed, F.struct(reach.alias("reach"), none.alias("out")), step, lambda acc: acc["out"])


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rules=None) -> DataFrame:
    """The ``keep`` columns, n_words, base (places of base phrases), detections (surviving intervals in words), labels, score."""
    rules = signature_rules() if rules is None else rules
    slim = docs.select(*keep, words_of(F.col(text_col)).alias("__words"))
    keyed = slim.withColumn("__keys", F.array_intersect("__words", F.array(*[F.lit(k) for k in _keywords(rules)])))
    line = F.when(F.size("__keys") > 0, F.concat(F.lit(" "), F.array_join("__words", " "), F.lit(" ")))
    lined = keyed.select(*keep, F.size("__words").cast("long").alias("n_words"), "__keys", line.alias("__line"))
    no_base = F.array().cast("array<struct<start:int,end:int,label:string>>")
    no_found = F.array().cast("array<struct<start:int,end:int,rule:int,label:string,priority:int,sure:double>>")

    def places_of(phrase, label, keyword):
        return F.when(F.array_contains("__keys", keyword), F.transform(
            _places(F.col("__line"), F.lit(phrase)),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.lit(label).alias("label")))).otherwise(no_base)

    base = F.flatten(F.array(*[places_of(*b) for b in BASE]))
    found = F.flatten(F.transform(
        F.filter(_rules_literal(rules), lambda r: F.array_contains(F.col("__keys"), r["keyword"])),
        lambda r: F.transform(_places(F.col("__line"), r["regex"]), lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), r["rule"].alias("rule"), r["label"].alias("label"),
            r["priority"].alias("priority"), r["sure"].alias("sure")))))
    some = F.size("__keys") > 0
    out = lined.select(
        *keep, "n_words", F.when(some, base).otherwise(no_base).alias("base"),
        F.when(some, let(found, lambda f: F.when(F.size(f) > 0, _suppressed(f, [r[3] for r in rules])).otherwise(no_found)))
        .otherwise(no_found).alias("detections"))
    both = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: b["label"]),
                                                  F.transform("detections", lambda d: d["label"]))))
    score = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d["sure"])), F.lit(0.0)),
                       F.when(F.size("base") > 0, F.lit(0.7)).otherwise(F.lit(0.0)))
    return out.select(*keep, "n_words", "base", "detections", both.alias("labels"), score.alias("score"))


def license_report(scanned: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Digest columns: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    starts = F.transform("base", lambda b: b["start"].cast("long"))
    return scanned.select(
        *keep, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")
