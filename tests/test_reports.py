"""Operators on sentences, reports, slots and guarded writes: nulls, empty tables, ties and hand-made results."""

from pyspark.sql import functions as F

from tidemark.operators import quality, text, ticks


def test_tag_report_skips_boilerplate_and_contradictions(spark):
    docs = spark.createDataFrame([(1, "a cat. a dog. licence cat. x"), (2, None), (3, "a cat.")], "i INT, t STRING")
    rules = [("cat", "cat"), ("dog", "dog"), ("(?i)licence", "legal")]
    got = text.tag_report(text.sentences(docs, "i", "t"), rules, "licence", [("cat", "dog")]).collect()
    assert {r["id"]: (r["tags"], r["unmatched"], r["skipped"]) for r in got} == {1: ([], 1, 1), 3: (["cat"], 0, 0)}


def test_tag_events_dates_and_negation(spark):
    docs = spark.createDataFrame([(1, "lame in 2001. lame. lame not. note lame. in 1999 lame and ill. ill"), (2, "ill"), (3, "")], "i INT, t STRING")
    groups = {"lame": r"\blame\b", "any": r"\b(?:lame|ill)\b"}
    e = text.tag_events(text.sentences(docs, "i", "t"), groups, r" (?:not|may)\b", "^note", "[0-9]{4}", "any").collect()
    got = {(r["id"], r["grp"], r["at"]): (r["n"], r["text"]) for r in e}
    assert got == {(1, "lame", 2001): (2, "lame in 2001 lame"), (1, "lame", 1999): (1, "in 1999 lame and ill"), (1, "any", None): (1, "ill"), (2, "any", None): (1, "ill")}


def test_report_blocks_glue_and_causes(spark):
    lines = [(1, 0, "before"), (1, 1, "Start here"), (1, 2, "(goes on)"), (1, 3, "Bad going then rain"), (1, 4, "Stop"), (1, 5, "Lost"), (1, 6, "Start again")]
    df = spark.createDataFrame(lines, "id INT, pos INT, line STRING")
    units = text.report_lines(df, ["id"], "pos", "line", r"^[a-z(]")
    e = text.report_events(units, ["id"], "pos", "line", "^Start", "^Stop", [("going", "ground"), (".", "other")], ["the", "then", "go", "going"]).orderBy("pos").collect()
    assert [(r["block"], r["pos"], r["line"], r["kind"], r["cause"]) for r in e] == [
        (1, 1, "Start here (goes on)", "other", "go"), (1, 3, "Bad going then rain", "ground", "going"), (2, 6, "Start again", "other", None),
    ]
    assert text.report_lines(df.limit(0), ["id"], "pos", "line", "^x").count() == 0


def test_label_templates(spark):
    keys = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "key STRING, n LONG")
    labels = spark.createDataFrame([("a", "A"), ("z", "Z")], "key STRING, label STRING")
    got = {(r["label"], r["key"], r["n"]) for r in text.label_templates(keys, labels, 2).collect()}
    assert got == {("A", None, 5), (None, "b", 3), (None, "c", 3)}


def test_guarded_replace_refuses_short_parts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id INT, part STRING")
    new = spark.createDataFrame([(11, "a"), (13, "b"), (15, "c"), (14, None)], "id INT, part STRING")
    got = {(r["id"], r["replaced"]) for r in quality.guarded_replace(old, new, "part", 0.9).collect()}
    # a shrank and is kept, b and the rows without a part are replaced, c is new.
    assert got == {(1, False), (2, False), (13, True), (15, True), (14, True)}
    assert quality.guarded_replace(old, new.limit(0), "part", 0.9).count() == 4


def test_ranked_collapses_needs_neighbouring_slots(spark):
    rows = [("g", k, i, v, i) for k, i, v in [(1, 1, 10.0), (1, 2, 5.0), (1, 4, 1.0), (2, 1, 8.0), (2, 2, 6.0), (3, 1, 0.0), (3, 2, 0.0), (2, 3, None)]]
    df = spark.createDataFrame(rows, "g STRING, key INT, slot INT, value DOUBLE, id INT").withColumn("ts", F.col("slot"))
    s = ticks.slots(df, ["g"], "key", F.col("slot"))
    got = [(r["key"], r["i"], r["o0"], r["o"]) for r in ticks.ranked_collapses(s, ["g"], "key").collect()]
    assert got == [(1, 2, 10.0, 5.0)]


def test_report_sentences_keep_brackets_and_lone_periods(spark):
    texts = [
        (1, "One ran (rule 2. of (4.) here). Two fell. (noted.) Three won. From 3 to 5. (seen) Four rode. No stop"), (2, "(first) ran. Until 9."), (3, "Open (a. b. c. d"), (4, "x) y. z. "), (5, None), (6, " . "), (7, "From 1 to 2."),
    ]
    df = spark.createDataFrame(texts, "a INT, s STRING")
    got = {}
    for r in text.report_sentences(df, ["a"], "s", "^(?:From|Until|On) [0-9]").orderBy("a", "unit").collect():
        got.setdefault(r["a"], []).append(r["sentence"])
    assert got == {
        1: ["One ran (rule 2. of (4.) here).", "Two fell. (noted.)", "Three won. From 3 to 5. (seen)", "Four rode.", "No stop"],
        2: ["(first) ran. Until 9."], 3: ["Open (a. b. c. d"], 4: ["x) y.", "z."], 7: ["From 1 to 2."],
    }


def test_periods(spark):
    texts = ["barred from 3 to 5.", "out until 12", "on 4, 2 and 4.", "On 7", "from 9 to 2", "until 3", "none", None, "on 99999999999999999999"]
    form, days = text.periods(F.col("s"), F.lit(10))
    got = spark.createDataFrame([(s,) for s in texts], "s STRING").select("s", form.alias("f"), days.alias("d")).collect()
    assert [(r["f"], [tuple(x) for x in r["d"]]) for r in got] == [
        ("range", [(3, 5)]), ("until", [(10, 12)]), ("list", [(2, 2), (4, 4)]), ("list", [(7, 7)]), ("range", []), ("until", []), (None, []), (None, []), ("list", []),
    ]
