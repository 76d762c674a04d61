"""Whole results of llm operators, held against brute force."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.llm import chat_format, decontaminate, license_scan
from tests.helpers import SF, same_as_sql

D = "/root/testdata/sf0.01"


def test_license_notices_in_other_words(spark):
    gpl = " * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n * as published by the Free Software Foundation; either version {}\n * of the License, or (at your option) any later version.\n"
    texts = {
        "a": (gpl.format(2) + "int x;\n" * 50, "GPL-2.0-or-later"), "b": (gpl.format(3), "GPL-3.0-or-later"),
        "c": ("Copyright (c) 2020 Jane Doe. Released under the MIT License.", "MIT"), "d": ("Copyright 2019 Example Corp. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        "e": ("some prose " * 300 + "Licensed under the Apache License, Version 2.0. " + "more prose " * 300, "Apache-2.0"),
        "f": ("Apache License\nVersion 2.0, January 2004\n", "Apache-2.0"), "g": ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n", "GPL-2.0-only"),
        "h": ("the driver has a licence and a fishing license of no kind", None), "i": ("no permission was given for the redistribution of seats", None),
    }
    rows = [(f"{k}/x.txt", t) for k, (t, _) in texts.items()] + [(f"z{k}/y", f"the plain prose of file {k}, with some words under version {k % 9}") for k in range(200)]
    got = {r["path"]: r["license"] for r in license_scan.scan(spark.createDataFrame(rows, "path string, text string"), F.col("path")).collect()}
    assert {k: got[f"{k}/x.txt"] for k in texts} == {k: want for k, (_, want) in texts.items()}
    assert not any(v for k, v in got.items() if k.startswith("z"))


def test_chat_format_has_every_turn(spark):
    said = [(5, 0, "user", "alone"), (5, 1, "assistant", "an answer"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "after"), (3, 0, "user", "r"), (3, 1, "assistant", "b"), (8, 0, "user", "no answer"), (9, 0, "user", "s"), (9, 1, "assistant", "c")]
    for rows in (said, [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{D}/conversations.parquet").collect()]):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        turns, last, want = defaultdict(set), {}, Counter()
        for k, turn, role, text in rows:
            if k is not None and turn is not None:
                turns[k].add((turn, role or "", text or ""))
        for k, x in turns.items():
            last[k] = max(((t, text) for t, role, text in x if role == "assistant"), default=None)

        def placed(x):
            seen, number = Counter(), {t: k for k, t in enumerate(sorted({t for t, _, _ in x}))}
            return {(number[t], seen.update([t]) or seen[t]): (role, text) for t, role, text in sorted(x)}

        for k, x in turns.items():
            mine, theirs = last[k], last.get(k ^ 1)
            c, r = placed(x), placed({y for y in x if y[0] < mine[0]} | {(mine[0], "assistant", theirs[1])}) if mine and theirs else {}
            first = min((at for at in c.keys() | r.keys() if c.get(at) != r.get(at)), default=None)
            for part, side in (("chosen", c), ("rejected", r)):
                for at, (role, text) in side.items():
                    if first is not None and at >= first:
                        want[k, part, *at, f"<|{role}|>\n{text}<|end|>\n"] += 1
                    elif part == "chosen":
                        want[k, "prompt", *at, f"<|{role}|>\n{text}<|end|>\n"] += 1
        out = chat_format.preference_rows(*chat_format.swapped_pairs(df)).select("pair_id", "part", "turn", "place", "rendered").collect()
        assert Counter(map(tuple, out)) == want
        assert {r["pair_id"] for r in out} == set(turns)


def test_preferences_by_order(spark):
    """Any numbers of the turns, other ones on either side, give the records of turns numbered from 0."""
    said = "pair_id long, turn long, role string, text string"
    sides = [[("assistant" if k % 2 else "user", f"t{k}" if k < 300 else f"t{k}{x}") for k in range(n)] for x, n in (("c", 700), ("r", 520))]
    numbers = [lambda k: k, lambda k: k + 250, lambda k: 3 * k - 800, lambda k: k * k * k * 10**10 - (1 << 63)]
    rows = [[(p, number(k), *turn) for p, number in enumerate(numbers[x:] + numbers[:x]) for k, turn in enumerate(side)] for x, side in enumerate(sides)]
    short = [(9, 250 + k, "user", f"s{k}") for k in range(10)]
    rows = [rows[0] + short, rows[1] + [(9, k, *x[2:]) for k, x in enumerate(short[:9])] + [(9, 9, "assistant", "other")]]
    found = [r.asDict() for r in chat_format.preference_records(*(spark.createDataFrame(x, said) for x in rows)).collect()]
    got = {p: sorted(([v for k, v in r.items() if k != "pair_id"] for r in found if r["pair_id"] == p), key=lambda x: x[:2]) for p in (0, 1, 2, 3, 9)}
    assert got[0] == got[1] == got[2] == got[3] and [x[:2] for x in got[0]] == [[0, 1], [256, 1], [512, 1]]
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert [x[:5] for x in got[9]] == [[0, 1, "".join(turn("user", f"s{k}") for k in range(9)), turn("user", "s9"), turn("assistant", "other")]]


def test_decontamination_equals_sql(spark):
    """test_registered_oracles, which stops at op8_chat_format, doesn't come to it."""
    same_as_sql(decontaminate.op9_benchmark_decontamination(spark, SF), decontaminate.ORACLE)


def test_preference_records_join_to_the_rows(spark):
    """Long conversations in several records, repeated and null rows, long texts: records joined are the rows in order."""
    said = "pair_id long, turn long, role string, text string"
    long = [(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(700)]
    other = [(1, k, r, t if k < 400 else t + "!") for _, k, r, t in long[:600]]
    c = long + long[:5] + [(2, 0, None, None), (3, 0, "assistant", "x" * 300_000), (4, -1, "user", "ñ漢😀"), (4, 1, "assistant", "a"), (None, 1, "user", "u"), (5, 0, "user", "same")] + [(6, 0, "user", f"v{k:03}") for k in range(300)]
    r = other + [(4, -1, "user", "ñ漢😀"), (4, 1, "assistant", "b"), (5, 0, "user", "same"), (7, 3, "user", "only rejected")]
    c, r = (spark.createDataFrame(x, said) for x in (c, r))
    rows, joined, trained = chat_format.preference_rows(c, r).collect(), defaultdict(str), defaultdict(str)
    for x in sorted(rows, key=lambda x: (x["turn"], x["place"])):
        joined[x["pair_id"], x["part"]] += x["rendered"]
        trained[x["pair_id"], x["part"]] += x["rendered"][x["n_masked"] :]
    records = sorted(chat_format.preference_records(c, r).collect(), key=lambda x: (x["pair_id"], x["turns_from"], x["places_from"]))
    assert [(x["pair_id"], x["turns_from"], x["places_from"]) for x in records] == [(1, 0, 1), (1, 256, 1), (1, 512, 1), (2, 0, 1), (3, 0, 1), (4, 0, 1), (5, 0, 1), (6, 0, 1), (6, 0, 257), (7, 0, 1)]
    got, told = defaultdict(str), defaultdict(str)
    for x in records:
        for part in ("prompt", "chosen", "rejected"):
            got[x["pair_id"], part] += x[part] or ""
            for span in x[f"{part}_spans"] if part != "prompt" else []:
                told[x["pair_id"], part] += x[part][span["start"] : span["end"]]
    assert {k: v for k, v in got.items() if v} == joined
    assert {k: v for k, v in told.items() if v} == {k: v for k, v in trained.items() if v}
    assert chat_format.preference_records(c.limit(0), r.limit(0)).count() == 0


def test_license_of_few_and_of_equal_files(spark):
    """One file alone, two alike, a table where all documents hold one notice, plain rows and very long ones: terms of every document still count."""
    mit, kinds = "Released under the MIT License", "path string, text string, license string, term string, n int"

    def licences(rows):
        return sorted(((r["path"], r["license"], r["origin"]) for r in license_scan.scan(spark.createDataFrame([(*x, "x", "y", 1) for x in rows], kinds), F.col("path")).collect()), key=repr)

    assert licences([("a/LICENSE", mit)]) == [("a/LICENSE", "MIT", "own")]
    assert licences([("a/LICENSE", mit), ("a/LICENSE", mit)]) == [("a/LICENSE", "MIT", "own")] * 2
    same = [(f"d{k}/f.txt", f"{mit}\n" + "words of a file " * 40) for k in range(50)]
    assert licences(same) == sorted((p, "MIT", "own") for p, _ in same)
    assert licences([("a", "plain words")]) == [("a", None, "none")]
    assert licences([("a/b/c.txt", "x"), ("a/LICENSE", mit), (None, None), ("z", "")]) == sorted([("a/b/c.txt", "MIT", "inherited"), ("a/LICENSE", "MIT", "own"), (None, None, "none"), ("z", None, "none")], key=repr)
    assert licences([("l.txt", "word " * 60_000 + mit + " word" * 60_000)]) == [("l.txt", "MIT", "own")]
    assert licences([]) == []
