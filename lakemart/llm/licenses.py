"""Operator 5: licences by ordered signature rules, with DataFrame functions only.

A rule is a regular expression over the words of a text, with a label and a
priority. Rules come from a table of licence names, a table of ways to refer to
a licence, and passages of licences and notices written one by one. From each expression follow sets of keywords of which every match
has one. The words of a text are first searched for a few strings of which every
match has one, then for the keywords, and only the rules that are left are run. Of the places found, one that
lies inside another of the same or a better priority is dropped, so "GNU
General Public License version 3" isn't a mention of some other version, too.
Base phrases are counted besides; their labels always stay.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import free_name
from lakemart.llm.license_texts import BODIES, NOTICES, SHARED

#: What stands between words, before and after A-Z is lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_V = "(?: version| v| ver)?"
_OR = "(?: or(?: at your option)?(?: any)? later(?: versions?)?| only)?"
_CC = "(?:cc|creative commons)"
_LIC = "(?: public)?(?: licen[cs]es?)?"

#: Names: label, pattern over words, and the words of the SPDX identifier.
NAMES: list[tuple[str, str, str]] = [
    ("mit", "(?:mit|mit x11|expat)", "mit"),
    ("mit-0", "mit(?: no attribution| 0)", "mit 0"),
    ("expat", "expat", "mit"),
    ("apache-2", f"apache(?: software)?(?: foundation)?(?: licen[cs]e)?{_V} ?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", f"apache(?: software)?(?: licen[cs]e)?{_V} 1 1", "apache 1 1"),
    ("apache", "apache(?: software)?(?: foundation)?", "apache 1 0"),
    ("gpl-3", f"(?:gnu )?(?:general public licen[cs]e|gpl){_V} ?3(?: 0)?{_OR}", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", f"(?:gnu )?(?:general public licen[cs]e|gpl){_V} ?2(?: 0)?{_OR}", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gplv3", "gplv3"),
    ("gpl-2", "gplv2", "gplv2"),
    ("gpl-1", f"(?:gnu )?(?:general public licen[cs]e|gpl){_V} ?1(?: 0)?{_OR}", "gpl 1 0(?: only| or later)?"),
    ("gpl", "(?:the )?gnu (?:general public licen[cs]e|gpl)", "gpl"),
    ("agpl-3", f"(?:gnu )?(?:affero general public licen[cs]e|agpl){_V} ?3(?: 0)?{_OR}", "agpl 3 0(?: only| or later)?"),
    ("agpl", "(?:gnu )?affero general public", "agpl 1 0"),
    ("lgpl-3", f"(?:gnu )?(?:lesser general public licen[cs]e|lgpl){_V} ?3(?: 0)?{_OR}", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", f"(?:gnu )?(?:lesser general public licen[cs]e|lgpl){_V} ?2 1{_OR}", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2", f"(?:gnu )?(?:library general public licen[cs]e|lgpl){_V} ?2(?: 0)?{_OR}", "lgpl 2 0(?: only| or later)?"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "lgpl"),
    ("gfdl-1.3", f"(?:gnu )?free documentation licen[cs]e{_V} 1 3{_OR}", "gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", f"(?:gnu )?free documentation licen[cs]e{_V} 1 2{_OR}", "gfdl 1 2(?: only| or later)?"),
    ("gfdl", "(?:gnu )?free documentation", "gfdl 1 1"),
    ("bsd-2-clause", "(?:(?:2|two) clause (?:free )?bsd|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "(?:(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "(?:(?:4|four) clause bsd|original bsd|old bsd)", "bsd 4 clause"),
    ("0bsd", "(?:0bsd|zero clause bsd)", "0bsd"),
    ("bsd", "bsd(?: style)?", "bsd 1 clause"),
    ("isc", "isc", "isc"),
    ("mpl-2", f"mozilla public licen[cs]e{_V} 2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", f"mozilla public licen[cs]e{_V} 1 1", "mpl 1 1"),
    ("mpl", "mozilla public", "mpl 1 0"),
    ("epl-2", f"eclipse public licen[cs]e{_V} 2(?: 0)?", "epl 2 0"),
    ("epl-1", f"eclipse public licen[cs]e{_V} 1(?: 0)?", "epl 1 0"),
    ("epl", "eclipse public", "epl"),
    ("cddl-1.1", f"common development and distribution licen[cs]e{_V} 1 1", "cddl 1 1"),
    ("cddl-1", f"common development and distribution licen[cs]e{_V} 1(?: 0)?", "cddl 1 0"),
    ("cddl", "common development and distribution", "cddl"),
    ("cc0", f"{_CC} ?(?:0|zero)(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-nc-nd", f"{_CC} (?:by nc nd|attribution non ?commercial no ?deriv(?:s|atives))(?: [234] [05])?(?: international)?", "cc by nc nd [234] [05]"),
    ("cc-by-nc-sa", f"{_CC} (?:by nc sa|attribution non ?commercial share ?alike)(?: [234] [05])?(?: international)?", "cc by nc sa [234] [05]"),
    ("cc-by-nc", f"{_CC} (?:by nc|attribution non ?commercial)(?: [234] [05])?(?: international)?", "cc by nc [234] [05]"),
    ("cc-by-nd", f"{_CC} (?:by nd|attribution no ?deriv(?:s|atives))(?: [234] [05])?(?: international)?", "cc by nd [234] [05]"),
    ("cc-by-sa", f"{_CC} (?:by sa|attribution share ?alike)(?: [234] [05])?(?: international)?", "cc by sa [234] [05]"),
    ("cc-by", f"{_CC} (?:by|attribution)(?: [234] [05])?(?: international)?", "cc by [234] [05]"),
    ("creative-commons", "creative commons", "cc pddc"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "(?:wtfpl|do what the f[a-z]* you want to public)", "wtfpl"),
    ("zlib", "(?:zlib|zlib libpng)", "zlib"),
    ("libpng", "libpng", "libpng 2 0"),
    ("bsl-1", f"boost(?: software)?(?: licen[cs]e)?{_V}(?: 1 0)?", "bsl 1 0"),
    ("artistic-2", f"artistic(?: licen[cs]e)?{_V} 2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic 1 0"),
    ("python-2", "(?:python software foundation|psf)", "python 2 0"),
    ("ofl-1.1", f"(?:sil )?open font licen[cs]e{_V}(?: 1 1)?", "ofl 1 1"),
    ("odbl", f"open (?:data commons open )?database licen[cs]e{_V}(?: 1 0)?", "odbl 1 0"),
    ("odc-by", f"open data commons attribution(?: licen[cs]e)?{_V}(?: 1 0)?", "odc by 1 0"),
    ("pddl", "public domain dedication and", "pddl 1 0"),
    ("eupl-1.2", f"european union public licen[cs]e{_V}(?: 1 2)?", "eupl 1 2"),
    ("ms-pl", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "ms rl"),
    ("afl-3", f"academic free licen[cs]e{_V}(?: 3 0)?", "afl 3 0"),
    ("osl-3", f"open software licen[cs]e{_V}(?: 3 0)?", "osl 3 0"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("php-3", f"php(?: licen[cs]e)?{_V}(?: 3 0[01]?)?", "php 3 01"),
    ("ruby", "ruby", "ruby"),
    ("llama", "(?:llama|llama [23]) community", "llama"),
    ("openrail", "(?:bigscience |creativeml )?open ?rail(?: m)?", "openrail"),
    ("sspl-1", f"server side public licen[cs]e{_V}(?: 1)?", "sspl 1 0"),
    ("busl-1.1", f"business source licen[cs]e{_V}(?: 1 1)?", "busl 1 1"),
]

#: Ways to refer to a licence: priority, confidence and the pattern around the name.
FORMS: list[tuple[int, float, str]] = [
    (1, 1.0, "spdx licen[cs]e identifier (?:{spdx})"),
    (2, 0.95, "(?:licen[cs]ed under|released under|distributed under|available under|published under|provided under|covered under|shared under)"
              f" (?:the )?(?:terms of (?:the )?)?{{name}}{_LIC}"),
    (2, 0.95, f"under the terms (?:and conditions )?of the {{name}}{_LIC}"),
    (3, 0.8, "(?:subject to|governed by|according to|see) the {name}(?: public)? licen[cs]e"),
    (4, 0.6, "{name}(?: public)? licen[cs]e"),
]

#: What licences say: priority, confidence and patterns by label.
TEXTS: list[tuple[int, float, dict[str, list[str]]]] = [(2, 0.95, NOTICES), (2, 0.9, BODIES), (4, 0.6, SHARED)]

#: Rules of other kinds: label, priority, confidence and pattern.
OTHERS: list[tuple[str, int, float, str]] = [
    ("all-rights-reserved", 3, 0.7, "all rights reserved"),
    ("proprietary", 3, 0.7, "(?:proprietary|confidential) and (?:proprietary|confidential)"),
    ("proprietary", 3, 0.7, "(?:may|must) (?:not be copied|not be reproduced|not be redistributed) without"),
    ("public-domain", 3, 0.7, "(?:dedicated to|released into|placed in|in) the public domain"),
    ("gpl-3", 2, 0.95, f"gnu general public licen[cs]e{_V} ?3(?: 0)?{_OR}"),
    ("gpl-2", 2, 0.95, f"gnu general public licen[cs]e{_V} ?2(?: 0)?{_OR}"),
    ("apache-2", 3, 0.8, f"apache licen[cs]e{_V} ?2(?: 0)?"),
    ("copyright", 5, 0.3, "copyright(?: c)?(?: [12][0-9]{3})+"),
]
LAST_PRIORITY = 5

#: Strings that many rules share and other texts seldom hold.
STEMS = ["licen", "cc by nc", "ed under", "available under", "under the terms", "rights reserved", "redistribut", "the public domain", "hereby",
         "copyright", "warrant", "be liable", "permission", "without restriction", "acknowledg", "product includes", "misrepresented"]

#: A keyword set of more strings is cut into two.
MOST = 6


def _branch(pattern: str, at: int) -> tuple[set[str] | None, list[set[str]], int]:
    """One branch from ``at`` on: the strings it matches (None if they are too many), else sets of which every match has a string of each."""
    run, sets, whole = {""}, [], True
    while at < len(pattern) and pattern[at] not in "|)":
        group = pattern.startswith("(?:", at)
        if group:
            strings, inner, at = _branches(pattern, at + 3)
        elif pattern[at] == "[":
            end = pattern.index("]", at)
            listed = pattern[at + 1 : end]
            strings, inner, at = None if "-" in listed else set(listed), [], end
        else:
            strings, inner = {pattern[at]}, []
        at += 1
        mark = pattern[at : at + 1]
        if mark in ("?", "*"):
            strings, inner = {*strings, ""} if strings and mark == "?" else None, []
        elif mark in ("+", "{"):
            strings, inner = None, [strings] if strings else inner
        if mark and mark in "?*+{":
            at = pattern.index("}", at) + 1 if mark == "{" else at + 1
        if strings and not group and len(run) * len(strings) <= MOST:
            run = {a + b for a in run for b in strings}
        else:  # Groups have sets of their own: rules share more of them.
            sets += [run, *inner, *([strings] if strings and group else [])]
            run, whole = strings if strings and not group else {""}, False
    return (run, [], at) if whole else (None, [*sets, run], at)


def _branches(pattern: str, at: int) -> tuple[set[str] | None, list[set[str]], int]:
    """The same for all branches up to the closing bracket, and its place."""
    found = []
    while not found or pattern[at : at + 1] == "|":
        strings, sets, at = _branch(pattern, at + bool(found))
        found.append([strings] if strings is not None else sets)
    if len(found) == 1:
        return strings, sets, at
    every = set().union(*(sets[0] for sets in found))
    if all(len(sets) == 1 for sets in found) and len(every) <= MOST:
        return every, [], at
    # A branch's set whose shortest string is the longest says most.
    return None, [set().union(*(max(sets, key=lambda x: min(map(len, x))) for sets in found))], at


def keywords(pattern: str) -> tuple[tuple[str, ...], ...]:
    """Sets of strings; every match of ``pattern``, with the blanks around it, has at least one string of each set.

    They follow from the pattern: it may have literals, ``(?:…|…)``, ``[…]``, ``?``, ``*``, ``+`` and ``{n}``, no escapes or dots.
    """
    strings, sets, _ = _branches(f" {pattern} ", 0)
    out = []
    for one in sets if strings is None else [strings]:
        short = sorted(x for x in one if not any(y != x and y in x for y in one))
        if all(x.strip() for x in short) and tuple(short) not in out:
            out.append(tuple(short))
    return tuple(sorted(out, key=lambda x: (len(x), -len(x[0]))))


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    pattern: str
    base: bool = False

    @property
    def keys(self) -> tuple[tuple[str, ...], ...]:
        return keywords(self.pattern)

    @property
    def needs(self) -> tuple[str, str]:
        """Two strings that every match has, with the blanks around it; empty where there is none."""
        first, second, *_ = [*(k[0] for k in self.keys if len(k) == 1), "", ""]
        return first, second


def rules() -> list[Rule]:
    """Base phrases first, then every name in every form, what licences and notices say, and the others."""
    out = [Rule(label, 0, 1.0, phrase, True) for phrase, label in BASE.items()]
    for priority, confidence, form in FORMS:
        out += [Rule(label, priority, confidence, form.format(name=f"(?:{name})", spdx=spdx)) for label, name, spdx in NAMES]
    out += [
        Rule(label, priority, confidence, pattern)
        for priority, confidence, said in TEXTS for label, patterns in said.items() for pattern in patterns
    ]
    out += [Rule(label, priority, confidence, pattern) for label, priority, confidence, pattern in OTHERS]
    return out


def gates(known: Sequence[Rule]) -> list[list[str]]:
    """Groups of strings; every match of a rule, with the blanks around it, has all the strings of one of them.

    A rule that no stem stands for adds one set of its keywords.
    """
    out = list(STEMS)
    for r in known:
        if not any(all(any(s in x for s in out) for x in k) for k in r.keys):
            out += (s.strip() for s in max(r.keys, key=lambda k: (min(map(len, k)), -len(k))))
    return [[s] for s in out]


GATES = gates(rules())


def _literal(known: Sequence[Rule]) -> Column:
    """The rules as one constant; Spark reads it once, while it plans."""
    rows = [
        {"rule": i, "label": r.label, "priority": r.priority, "confidence": r.confidence, "pattern": f"(?<= )(?:{r.pattern})(?= )",
         "keys": r.keys, "base": r.base}
        for i, r in enumerate(known)
    ]
    return F.from_json(
        F.lit(json.dumps(rows)),
        "array<struct<rule: int, label: string, priority: int, confidence: double, pattern: string, keys: array<array<string>>, base: boolean>>",
    )


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def scan(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the columns ``keep``, n_words, n_base, first_word, last_word, base_labels, labels, score.

    NULL and empty texts have no words, no labels and score 0. Repeated rows
    and ids are scanned on their own. The score is the best confidence of a
    place that is left. Rows move only with what was found in them, never with
    their text. Letters outside of A-Z are no part of any rule, so they may be
    lower-cased, too, but for the two that would turn into a letter of a-z.
    """
    row, norm = free_name(docs, "_row"), "_norm"
    kept = F.struct(*(F.col(c) for c in keep)).alias("kept")
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    odd = F.contains(F.col(text), F.lit("\u0130")) | F.contains(F.col(text), F.lit("\u212a"))
    small = F.when(odd, F.translate(F.col(text), UPPER, LOWER)).otherwise(F.lower(F.col(text)))
    normal = docs.select(
        kept, F.monotonically_increasing_id().alias(row),
        F.concat(F.lit(" "), F.trim(F.regexp_replace(small, BETWEEN, " ")), F.lit(" ")).alias(norm),
    ).select("kept", row, F.when(F.col(norm) == "  ", 0).otherwise(F.coalesce(blanks(F.col(norm)) - 1, F.lit(0))).cast("long").alias("n_words"), norm)
    gate = F.lit(False)
    for group in GATES:
        every = F.lit(True)
        for syllable in group:
            every = every & F.contains(F.col(norm), F.lit(syllable))
        gate = gate | every
    gated = normal.select("kept", row, "n_words", F.when(gate, F.col(norm)).alias(norm))
    known = rules()
    # Every keyword is looked for once; the array around makes them a variable, or Spark would look again for each rule.
    there = F.filter(_strings(sorted({x for r in known for k in r.keys for x in k})), lambda x: F.contains(F.col(norm), x))
    found = F.flatten(F.transform(
        F.array(there), lambda there: F.filter(_literal(known), lambda r: F.forall(r["keys"], lambda k: F.arrays_overlap(k, there)))
    ))
    # No rule is looked at for a text that no gate lets in.
    tried = gated.select("kept", row, "n_words", norm, F.explode_outer(F.when(F.col(norm).isNotNull(), found)).alias("r"))
    # Between two matches stands a piece: lengths and blanks of both give the places. A column of its own is matched once.
    matched = tried.select(
        "kept", row, "n_words", "r", norm, F.regexp_extract_all(F.col(norm), F.col("r.pattern"), F.lit(0)).alias("matches")
    )
    runs = F.when(
        F.size("matches") > 0,
        F.zip_with(
            "matches", F.slice(F.split(F.col(norm), F.col("r.pattern"), -1), 1, F.size("matches")),
            lambda m, p: F.struct(F.length(m).alias("m"), F.length(p).alias("p"), blanks(m).alias("bm"), blanks(p).alias("bp")),
        ),
    )
    places = matched.select(
        "kept", row, "n_words", F.col("r.rule").alias("rule"), F.col("r.label").alias("label"), F.col("r.priority").alias("priority"),
        F.col("r.confidence").alias("confidence"), F.col("r.base").alias("base"), runs.alias("runs"),
    )
    # Every document keeps a row, with or without a match.
    places = places.select(
        "kept", row, "n_words", "rule", "label", "priority", "confidence", "base", F.posexplode_outer("runs").alias("nth", "run")
    )
    so_far = Window.partitionBy(row, "rule").orderBy("nth")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    up_to = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = lambda p, m: F.sum(f"run.{p}").over(up_to) + F.coalesce(F.sum(f"run.{m}").over(before), F.lit(0))
    placed = places.repartition(row).select(
        "*", at("p", "m").alias("start"), (at("bp", "bm") - 1).alias("word"), (at("p", "m") + F.col("run.m")).alias("end")
    )
    order = Window.partitionBy(row).orderBy(F.col("start"), F.col("end").desc(), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for level in range(LAST_PRIORITY + 1):
        reach = F.max(F.when(F.col("priority") <= level, F.col("end"))).over(order)
        inside = F.when(F.col("priority") == level, F.coalesce(reach >= F.col("end"), F.lit(False))).otherwise(inside)
    judged = placed.withColumn("inside", inside)
    real, stays = F.col("run").isNotNull(), ~F.col("inside") | F.col("base")
    base = real & F.col("base")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return judged.groupBy(row).agg(
        F.first("kept").alias("kept"), F.first("n_words").alias("n_words"),
        F.sum(F.when(base, 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.col("word"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("word"))).cast("long").alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"), listed(F.when(real & stays, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(real & stays, F.col("confidence"))), F.lit(0.0)).alias("score"),
    ).select("kept.*", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
