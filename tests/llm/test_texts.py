"""Chat formatting, passages, licences, languages and the pipeline (2, 3, 5, 8) against brute force and held-out rows."""

import collections
import random
import re
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import chat, decontaminate, language, licenses
from lakemart.llm.common import table
from lakemart.llm.queries import ORACLES, QUERIES
from tests.llm.test_rows import brute_components, brute_fingerprint


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# 2 ------------------------------------------------------------------------------------------------------------------


def brute_chats(turns):
    by_id = collections.defaultdict(set)
    for conv, turn, role, text in turns:
        by_id[conv].add((turn is None, turn or 0, role is None, role or "", text is None, text or "", role, text))
    whole = {c: [(x[6], x[7]) for x in sorted(t)] for c, t in by_id.items()}
    inner = {tuple(t[:n]) for t in whole.values() for n in range(1, len(t))}
    out = {}
    for conv in sorted(whole, key=lambda c: (c is None, c or 0)):
        t = tuple(whole[conv])
        if t not in inner:
            out.setdefault(t, [conv, 0])[1] += 1
    shown = lambda t: "\n".join(f"<|{r or 'unknown'}|>\n{x or ''}<|end|>" for r, x in t)
    return sorted(((c, len(t), n, shown(t)) for t, (c, n) in out.items()), key=repr)


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_snapshots(spark):
    rng = random.Random(2)
    turns = []
    for c in range(40):
        length = rng.randrange(1, 7)
        for t in range(length):
            turns.append((c, t * 2, "user" if t % 2 == 0 else "assistant", f"{c % 4} says {t}" if rng.random() > 0.02 else None))
    turns += [(90, None, None, None), (90, 1, "user", ""), (91, 1, "user", ""), (None, 1, "user", "x"), (None, 2, None, "y")]
    turns += [(92, 5, "user", "again")] * 3 + [(93, 1, "user", "again"), (94, 1, "user", None), (95, 1, None, "")]
    docs = spark.createDataFrame(turns, CHAT).selectExpr("*", "'x' AS place", "1 AS n", "2 AS key", "3 AS h1")
    found = sorted((tuple(r) for r in chat.format_conversations(docs).collect()), key=repr)
    assert found == brute_chats(turns)


def test_chat_without_rows(spark):
    assert chat.format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_chat_sql(spark, testdata):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{testdata}/conversations.parquet'")
    sql = duck.execute(ORACLES["op2_chat_format"])
    names = [c[0] for c in sql.description]
    found = QUERIES["op2_chat_format"](spark, testdata)
    assert names == found.columns
    assert sorted(map(tuple, found.collect())) == sorted(sql.fetchall())


# 3 ------------------------------------------------------------------------------------------------------------------


def least_edits(passage, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1))
        before = row
    return min(before)


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + (kind != 2)] = rng.choice("abcde ") if kind else ""
    return "".join(out)


def test_passages_with_edits(spark):
    """Every passage within its budget of edits is found with its number of edits, and no other."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcde ") for _ in range(n))
    passages = [(i, decontaminate.normalise("x" + letters(rng.randrange(60, 130)) + "y")) for i in range(6)]
    passages += [(50, "a b c"), (51, None), (52, "  "), (None, decontaminate.normalise(letters(70)))]
    documents = []
    for n in range(60):
        item, passage = rng.choice(passages[:6])
        documents.append((n, letters(rng.randrange(30)) + edited(rng, passage, rng.randrange(14)).upper().replace(" ", "\n ") + letters(20)))
    documents += [(100, None), (101, ""), (102, "A  b\tC"), (103, "xa b cx"), (None, passages[9][1]), (104, "ab" * 100_000)] + [(105, passages[0][1])] * 2
    docs = spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "1 AS start")
    bench = spark.createDataFrame(passages, "item_id long, text string").selectExpr("*", "'y' AS doc_id")
    found = collections.Counter((r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.find_passages(docs, bench).collect())
    expected = collections.Counter()
    for doc_id, text in documents:
        plain = decontaminate.normalise(text or "")
        for item, passage in passages:
            passage = decontaminate.normalise(passage or "")
            if passage and len(plain) < 10_000:
                if len(passage) < decontaminate.Q:
                    edits = 0 if f" {passage} " in f" {plain} " else 99
                else:
                    edits = least_edits(passage, plain)
                if edits <= decontaminate.edits_allowed(len(passage), 0.1):
                    expected[doc_id, item, edits] += 1
    assert found == expected
    clean = decontaminate.without_passages(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(repr(d) for d, _ in documents if d not in {k[0] for k in expected})


def test_passages_in_blocks_are_all_searched(spark, documents, testdata, monkeypatch):
    bench = spark.read.parquet(f"{testdata}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.find_passages(documents, bench).collect()))
    held = [(i, decontaminate.normalise(t)) for i, t in ((r["item_id"], r["text"]) for r in bench.collect())]
    planted = {(d, i) for d, t in texts(documents) for i, p in held if p in decontaminate.normalise(t)}
    assert {(d, i) for d, i, _, _ in whole} >= planted
    parts = list(decontaminate.passages_in_blocks(bench, "item_id", "text", block=3000))
    assert len(parts) > 2 and sorted(r[0] for p in parts for r in p) == sorted(i for i, _ in held)


def test_passages_block_after_block(spark, documents, awkward, testdata, monkeypatch):
    """A benchmark of many blocks gives the rows of one block, and the same documents stay."""
    bench = spark.read.parquet(f"{testdata}/benchmark.parquet").orderBy("item_id").limit(20)
    docs = documents.limit(150).unionByName(awkward.select(documents.columns))
    whole = sorted(map(repr, decontaminate.find_passages(docs, bench).collect()))
    left = sorted(map(repr, decontaminate.without_passages(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK", 1500)
    assert decontaminate.n_blocks(bench, "item_id", "text") > 2
    assert sorted(map(repr, decontaminate.find_passages(docs, bench).collect())) == whole
    assert sorted(map(repr, decontaminate.without_passages(docs, bench).collect())) == left
    clash = awkward.unionByName(awkward)
    assert decontaminate.without_passages(clash, bench).columns == awkward.columns


def test_passages_in_a_text_that_repeats_itself():
    """Half a passage, repeated over 2 MB, fills nearly every second band; equal bands are aligned once."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(140)).replace("  ", " ").strip()
    index = decontaminate.Index.of([(1, passage)], 0.1)
    half = passage[:70] + " "
    text = half * 28_000
    began = time.perf_counter()
    assert index.search(text) == [] and not index.stands(text)
    assert time.perf_counter() - began < 20
    whole = half * 3000 + passage[:60] + "#" + passage[61:] + " " + half * 3000
    (item, start, edits), = index.search(whole)
    assert (item, edits) == (1, 1) and whole[start : start + 60] == passage[:60] and start >= 3000 * len(half) - 1


def test_passages_empty(spark, nothing, awkward):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(awkward, bench).count() == 0
    assert decontaminate.without_passages(awkward, bench).count() == awkward.count()
    assert decontaminate.find_passages(nothing, bench).count() == 0


# 5 ------------------------------------------------------------------------------------------------------------------


def brute_licenses(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    at, base = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hits
        base |= {label} if hits else set()
    norm = f" {' '.join(w)} "
    found = []
    for i, r in enumerate(licenses.rules()):
        if r.needs[0] in norm and r.needs[1] in norm:
            found += [(m.start(), -m.end(), r.priority, i, r) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm)]
    found.sort(key=lambda f: f[:4])
    left = [f for k, f in enumerate(found) if f[4].base or not any(e[2] <= f[2] and e[1] <= f[1] for e in found[:k])]
    labels = sorted(base | {f[4].label for f in left})
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(labels), max((f[4].confidence for f in left), default=0.0)


LICENSED = [
    "Licensed under CC BY-NC 4.0.", "CC BY NC cc-by-nc, Cc By-Nc", "Released under the MIT License. under the mit license",
    "SPDX-License-Identifier: GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3.",
    "Apache License, Version 2.0 and apache license version 2", "All rights reserved. Copyright (c) 2020 2021",
    "under the terms of the Mozilla Public License 2.0; see the BSD license", "mit einer lizenz, nicht under the", "dedicated to the public domain",
    "under\nthe\x00MIT\tlicense" + " word" * 30_000 + " under the mit license", "licensed under the GNU Lesser General Public License version 2.1 or later",
]


def test_licenses(spark, awkward, documents, nothing):
    made = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for docs in (made, awkward, documents):
        found = sorted(((r["doc_id"], *(r[c] for c in columns)) for r in licenses.scan(docs).collect()), key=repr)
        assert found == sorted(((d, *brute_licenses(t)) for d, t in texts(docs)), key=repr)
    assert licenses.scan(nothing).count() == 0


def test_license_scan_runs_no_python(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_rules():
    known = licenses.rules()
    assert len(known) > 300
    for r in known:
        re.compile(r.pattern)
        # What a rule needs opens a gate, too.
        assert any(all(any(s in n for n in (*r.needs, r.pattern)) for s in gate) for gate in licenses.GATES), r


def some_match(rng, tree):
    """A random string that a parsed regular expression matches."""
    out = ""
    for kind, value in tree:
        if kind is re._constants.LITERAL:
            out += chr(value)
        elif kind is re._constants.IN:
            picked, of = rng.choice(value)
            out += chr(of) if picked is re._constants.LITERAL else chr(rng.randint(*of))
        elif kind is re._constants.SUBPATTERN:
            out += some_match(rng, value[-1])
        elif kind is re._constants.BRANCH:
            out += some_match(rng, rng.choice(value[1]))
        else:
            assert kind is re._constants.MAX_REPEAT
            out += "".join(some_match(rng, value[2]) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2))))
    return out


def test_license_keywords_follow_from_every_match():
    rng = random.Random(6)
    for r in licenses.rules():
        tree = re._parser.parse(r.pattern)
        for _ in range(60):
            text = f" {some_match(rng, tree)} "
            assert all(any(x in text for x in k) for k in r.keys) and all(n in text for n in r.needs), (r, text)
        # One set of keywords opens a gate, whichever of them stands in the text.
        assert any(all(any(all(s in x for s in gate) for gate in licenses.GATES) for x in k) for k in r.keys), r


def test_licenses_without_prefilter(spark):
    """Texts of every rule and every way to write it, against all regular expressions."""
    rng = random.Random(8)
    written = [
        "available under the GPLv3", "distributed\nunder the GNU GPL version 2", "Creative Commons Attribution ShareAlike License",
        "Creative Commons Attribution 4.0 license", "creative commons zero license", "creative commons attribution noncommercial license",
        "wtfpl license", "PSF license", "the zero clause BSD license", "must not be copied without", "proprietary and proprietary",
    ]
    for r in licenses.rules():
        for _ in range(2):
            match = some_match(rng, re._parser.parse(r.pattern)).split(" ")
            written.append("".join(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", "\n", ", ", "  ", "-"]) for w in match))
    docs = spark.createDataFrame(list(enumerate(written)), "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs).collect()}
    known = [(i, r, re.compile(f"(?<= )(?:{r.pattern})(?= )")) for i, r in enumerate(licenses.rules())]
    for n, text in enumerate(written):
        norm = f" {' '.join(re.findall('[a-z0-9]+', text.lower()))} "
        hits = sorted(((m.start(), -m.end(), r.priority, i, r) for i, r, p in known for m in p.finditer(norm)), key=lambda h: h[:4])
        left = [h[4] for k, h in enumerate(hits) if h[4].base or not any(e[2] <= h[2] and e[1] <= h[1] for e in hits[:k])]
        assert left and found[n] == (",".join(sorted({r.label for r in left})), max(r.confidence for r in left)), text


def test_licenses_lower_case(spark):
    """Of all letters only two turn into a-z when they are lower-cased; words with these stay what they are."""
    every = "".join(chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and c not in (0x130, 0x212A))
    docs = spark.createDataFrame([(0, every)], "doc_id long, text string")
    assert docs.filter(F.lower("text").rlike(r"[\x00-\x7F]")).count() == 0
    made = ["Under the M\u0130T License", "Under the M\u0130T licen\u017fe. UNDER THE MIT LICENSE", "\u212a under \u00c9 the MIT License \u03a3", "\u0130", "  \u212a  "]
    found = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"]) for r in licenses.scan(
        spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    assert found == {0: (4, 0, None), 1: (8, 1, 4), 2: (7, 0, None), 3: (1, 0, None), 4: (1, 0, None)}


#: Whole notices and what is to be found in them.
NOTICES = [
    ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
     "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", "gpl-3"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
     "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1"),
    ('Licensed under the Apache License, Version 2.0 (the "License");\n you may not use this file except in compliance with the License.', "apache-2"),
    ("The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.", "mit"),
    ("Neither the name of Example Labs, Inc. nor the names of its contributors may be used to endorse or promote products derived from this software "
     "without specific prior written permission.", "bsd-3-clause"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Unauthorized copying of this file, via any medium is strictly prohibited", "proprietary"),
    ("The copy of this file was lost, and any medium is as good as another; she was liable to forget the exception.", ""),
]


def test_whole_notices(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(NOTICES)], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert found == {i: label for i, (_, label) in enumerate(NOTICES)}


# 8 ------------------------------------------------------------------------------------------------------------------


def test_language_on_held_out_rows(documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    found = language.predicted_languages(documents).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_awkward(awkward, nothing):
    found = language.predicted_languages(awkward).collect()
    assert len(found) == awkward.count()
    no_letter = {1, 2, 3, 7}
    for r in found:
        if r["doc_id"] in no_letter:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in {"en", "de", "fr"}
    kept = language.with_known_language(awkward)
    assert kept.columns == awkward.columns and not no_letter & {r["doc_id"] for r in kept.collect()}
    assert language.predicted_languages(nothing).count() == 0


@pytest.mark.parametrize("blank", ["lang", "doc_id"])
def test_language_with_nothing_to_learn_from(awkward, blank):
    """Without a label, or an id to choose by, only texts without a letter go."""
    docs = awkward.withColumn(blank, F.lit(None).cast(awkward.schema[blank].dataType))
    kept = language.with_known_language(docs)
    assert kept.columns == docs.columns
    with_letter = [t for _, t in texts(awkward) if t and re.search(r"[^\W\d_]", t)]
    assert sorted(t for _, t in texts(kept)) == sorted(with_letter) and len(with_letter) > 10


def test_language_sees_the_text_only(documents):
    """Other columns may be anything when a language is predicted."""
    model = language.fit(language.training_rows(documents))
    a = language.predict(documents, model).select("text", "lang_pred", "score")
    b = language.predict(documents.selectExpr("-doc_id AS doc_id", "text", "'zz' AS lang", "NULL AS source"), model).select("text", "lang_pred", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_presence_against_sets():
    """Bits of a text are those of its n-grams, however it is cut into pieces."""
    import numpy as np
    import pyarrow as pa

    column = pa.array(["Ab, cd!", None, "", "été 漢字", "ab cd", "12"])
    (_, _, bits, has_letter), = language.presence(column)
    assert has_letter.tolist() == [True, False, False, True, True, False]
    single = np.concatenate([b for i in range(6) for _, _, b, _ in language.presence(column.slice(i, 1))])
    assert (bits == single).all() and bits[0].sum() >= bits[4].sum() > 0


# the pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline(spark, testdata):
    documents = table(spark, testdata, "documents")
    result = corpus_pipeline.run(spark, testdata)
    assert result.columns[:5] == documents.columns
    kept = {r["doc_id"]: r["text"] for r in result.collect()}
    original = dict(texts(documents))
    assert all(original[d] == t for d, t in kept.items())
    bench = [decontaminate.normalise(r["text"]) for r in table(spark, testdata, "benchmark").collect()]
    assert not any(p in decontaminate.normalise(t) for t in kept.values() for p in bench)


def brute_pipeline(documents, passages):
    """(doc_id, text, shard, grown_shard) with its copies, and the rows left after each of the first three stages."""
    left = [[d for d in documents if re.search(r"[^\W\d_]", d[1] or "")]]
    least = {}
    for d, root in zip(left[0], brute_components([brute_fingerprint(d[1]) for d in left[0]], 2), strict=True):
        least[root] = min(least.get(root, d), d, key=lambda x: x[0])
    left.append(list(least.values()))
    near = lambda p, t: least_edits(p, t) <= decontaminate.edits_allowed(len(p), 0.1)
    left.append([d for d in left[1] if not any(near(decontaminate.normalise(p), decontaminate.normalise(d[1])) for _, p in passages)])
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", left[2])
    copies = dict(duck.execute(f"SELECT doc_id, n_copies FROM ({ORACLES['op6_source_mix']})").fetchall())
    shards = {d: (s, g) for d, s, g in duck.execute(f"SELECT doc_id, shard, grown_shard FROM ({ORACLES['op9_sharding']})").fetchall()}
    return collections.Counter({(d[0], d[1], *shards[d[0]]): copies[d[0]] for d in left[2]}), [len(x) for x in left]


def test_pipeline_by_brute_force(spark, tmp_path):
    """All five stages on a small folder against plain loops and SQL, with copies and shards."""
    rng = random.Random(9)
    words = {"en": "the river and stone of cloud with light in house garden".split(), "de": "der fluss und stein aus wolke mit licht im haus garten".split()}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(n))
    passages = [(i, prose("en", 14)) for i in range(3)]
    documents = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        text = prose(lang, rng.randrange(5, 60))
        if i % 7 == 3:
            text = documents[-1][1]
        elif i % 9 == 4:
            text += " " + edited(rng, passages[i % 3][1], rng.randrange(5)) + " " + prose(lang, 5)
        elif i % 10 == 8:
            text = rng.choice([None, "", "12 34 -- 5"])
        documents.append((100 - i, text, lang, rng.choice(["a", "b", "c", None]), len(text or "")))
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(passages, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected, left = brute_pipeline(documents, passages)
    assert len(documents) > left[0] > left[1] > left[2] > 20 and {0, 1, 2} & set(expected.values()) >= {0, 2}
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert collections.Counter((r["doc_id"], r["text"], r["shard"], r["grown_shard"]) for r in result.collect()) == +expected


@pytest.mark.parametrize("which", ["awkward", "nothing"])
def test_stages_keep_columns(which, request, spark, testdata):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, testdata).columns == docs.columns, name
        assert stage(spark, docs, testdata).count() <= 3 * docs.count()
