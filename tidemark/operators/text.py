"""Rule-based tagging of texts as jobs on sentences: tags, negation, blocks, templates, dictionary codes, repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sentences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, pos, sentence: pieces between full stops or line ends, trimmed, empty ones left out."""
    parts = F.transform(F.split(F.coalesce(text_col, F.lit("")), r"[.\n]"), lambda s: F.btrim(s))
    out = docs.select(F.col(id_col).alias("id"), F.posexplode(parts).alias("pos", "sentence"))
    return out.filter("sentence <> ''")


def tags_of(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Sorted distinct labels of all rules (pattern, label) that text matches; an empty array if none does."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(t)) for p, t in rules]))))


def affirmed(text: Column, pattern: str, negation: str) -> Column:
    """Whether pattern occurs in text without a negation right after it."""
    return text.rlike(rf"(?:{pattern})(?!{negation})")


def template(text: Column, masks: Sequence[tuple[str, str]]) -> Column:
    """Text with numbers, names and the like replaced by marks: equal for all fillings of one template."""
    out = text
    for pattern, mark in masks:
        out = F.regexp_replace(out, pattern, mark)
    return out


def blocks(lines: DataFrame, by: Sequence[str], order: Sequence[str], start: Column) -> DataFrame:
    """lines with block: a number that rises at each start line; 0 before the first."""
    w = Window.partitionBy(*by).orderBy(*order)
    return lines.withColumn("block", F.sum(F.when(start, 1).otherwise(0)).over(w))


def dictionary_codes(rows: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """rows with code long: numbers by first appearance from 0 (of equal places by value), -1 for null.

    The dictionary is the distinct values; it is numbered by ranges side by side.
    """
    from .stats import numbered

    first = rows.filter(F.col(col).isNotNull()).groupBy(col).agg(F.min(F.struct(*order)).alias("__at"))
    codes = numbered(first, ["__at", col], "__place").select(col, (F.col("__place") - 1).cast("long").alias("__code"))
    return rows.join(codes, col, "left").withColumn("code", F.coalesce("__code", F.lit(-1).cast("long"))).drop("__code")


def merge_repeats(rows: DataFrame, by: Sequence[str], day: str, days: int, order: Sequence[str]) -> DataFrame:
    """One row for each run of equal announcements at most `days` apart: first day, last day, how many."""
    from .stats import islands

    run = rows.withColumn("run", islands(F.col(day), by, [day, *order], days))
    return run.groupBy(*by, "run").agg(F.min(day).alias("since"), F.max(day).alias("until"), F.count("*").alias("n"))


def tag_report(sentences: DataFrame, rules: Sequence[tuple[str, str]], skip: str, exclusive: Sequence[tuple[str, str]]) -> DataFrame:
    """id, tags, unmatched, skipped: labels of all sentences of a text, without those of pairs that contradict each other.

    Sentences that match `skip` (boiler-plate) give no tags; unmatched counts the others that no rule matches.
    """
    s = F.col("sentence")
    boiler = s.rlike(skip)
    hit = [(label, s.rlike(p)) for p, label in rules]
    none = ~boiler
    for _, h in hit:
        none = none & ~h
    labels = sorted({label for _, label in rules})
    has = []
    for label in labels:
        some = None
        for other, h in hit:
            if other == label:
                some = h if some is None else some | h
        has.append(F.bool_or(some & ~boiler).alias(f"__{label}"))
    g = sentences.groupBy("id").agg(*has, F.count_if(none).alias("unmatched"), F.count_if(boiler).alias("skipped"))
    drop = lambda t: [F.col(f"__{a}") & F.col(f"__{b}") for a, b in exclusive if t in (a, b)]
    kept = []
    for label in labels:
        ok = F.col(f"__{label}")
        for clash in drop(label):
            ok = ok & ~clash
        kept.append(F.when(ok, F.lit(label)))
    return g.select("id", F.array_compact(F.array(*kept)).alias("tags"), "unmatched", "skipped")


def tag_events(sentences: DataFrame, groups: dict[str, str], tail: str, notice: str, date: str, generic: str) -> DataFrame:
    """id, grp, at, n, text: a text's sentences that affirm a group, joined in order, one row for each date of the group.

    Notice lines are skipped; a match that `tail` follows (a negation, a "may") doesn't count; the generic group is left
    out where a sentence has a specific one; undated sentences go to the group's newest date, or to null if it has none.
    """
    s = F.col("sentence")
    found = F.array_compact(F.array(*[F.when(affirmed(s, p, tail), F.lit(g)) for g, p in groups.items()]))
    specific = F.when(F.size(found) > 1, F.array_remove(found, generic)).otherwise(found)
    at = F.nullif(F.regexp_extract(s, date, 0), F.lit("")).cast("long")
    rows = sentences.filter(~s.rlike(notice)).select("id", "pos", "sentence", F.explode(specific).alias("grp"), at.alias("at"))
    newest = F.max("at").over(Window.partitionBy("id", "grp"))
    rows = rows.withColumn("at", F.coalesce("at", newest))
    parts = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    return rows.groupBy("id", "grp", "at").agg(F.count("*").alias("n"), F.array_join(F.transform(parts, lambda p: p["sentence"]), " ").alias("text"))


def report_lines(lines: DataFrame, by: Sequence[str], pos: str, text: str, goes_on: str) -> DataFrame:
    """by, unit, pos, text: lines joined with the lines after them that only go on (page breaks, brackets, lone dates)."""
    order = Window.partitionBy(*by).orderBy(pos)
    unit = F.sum(F.when(F.col(text).rlike(goes_on), 0).otherwise(1)).over(order)
    parts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    g = lines.withColumn("unit", unit).groupBy(*by, "unit").agg(F.min(pos).alias(pos), parts.alias("s"))
    return g.select(*by, "unit", pos, F.array_join(F.transform("s", lambda p: p["t"]), " ").alias(text))


def report_events(units: DataFrame, by: Sequence[str], pos: str, text: str, start: str, stop: str, kinds: Sequence[tuple[str, str]], causes: Sequence[str]) -> DataFrame:
    """Units from a start line up to the next stop line, with block, kind (of the first rule that matches) and cause (the
    earliest of the words, of those at one place the longest)."""
    t = F.col(text)
    b = blocks(units, by, [pos], t.rlike(start)).filter("block > 0")
    stops = F.sum(F.when(t.rlike(stop), 1).otherwise(0)).over(Window.partitionBy(*by, "block").orderBy(pos))
    b = b.withColumn("__stops", stops).filter("__stops = 0").drop("__stops")
    kind = F.coalesce(*[F.when(t.rlike(p), F.lit(k)) for p, k in kinds])
    words = "|".join(sorted(causes, key=lambda w: (-len(w), w)))
    return b.select("*", kind.alias("kind"), F.nullif(F.regexp_extract(t, f"({words})", 1), F.lit("")).alias("cause"))


def label_templates(keys: DataFrame, labels: DataFrame, top: int) -> DataFrame:
    """label, key, n: counts by the dictionary's label, and the `top` most frequent keys that it lacks (label null).

    keys: key, n; labels: key, label, one row for each key.
    """
    j = keys.join(labels, "key", "left")
    known = j.filter("label IS NOT NULL").groupBy("label").agg(F.sum("n").alias("n")).select("label", F.lit(None).cast("string").alias("key"), "n")
    return known.unionByName(j.filter("label IS NULL").select("label", "key", "n").orderBy(F.desc("n"), "key").limit(top))


def report_sentences(texts: DataFrame, by: Sequence[str], text: str, alone: str) -> DataFrame:
    """by, unit (from 1), sentence: texts cut behind full stops that stand in no open bracket.

    A sentence that begins with a bracket gives it back to the sentence before, and one that `alone` matches (a period
    without a subject) joins it whole; the first sentence of a text keeps both. A bracket that is never closed keeps the
    rest of its text together, a closing one too many counts as none. `by` names a text; null and blank texts have no row.
    """
    names, by = by, [f"key{i}" for i in range(len(by))]
    count = lambda c: F.char_length("s") - F.char_length(F.replace(F.col("s"), F.lit(c), F.lit("")))
    order = Window.partitionBy(*by).orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    p = texts.select(*[F.col(c).alias(k) for c, k in zip(names, by, strict=True)], F.posexplode(F.split(F.col(text), r"\.")).alias("pos", "s"))
    p = p.withColumn("net", count("(") - count(")")).withColumn("run", F.sum("net").over(order))
    # Depth never falls below 0: the running sum less the least it has had.
    depth = F.col("run") - F.least(F.lit(0), F.min("run").over(order))
    p = p.withColumn("depth", depth).withColumn("open", F.coalesce(F.last("depth").over(before), F.lit(0)) > 0)
    p = p.withColumn("unit", F.sum(F.when(F.col("open"), 0).otherwise(1)).over(order))
    parts = lambda: F.array_sort(F.collect_list(F.struct("pos", "s")))
    last = F.max("pos").over(Window.partitionBy(*by))
    g = p.withColumn("end", last).groupBy(*by, "unit").agg(parts().alias("a"), F.max("pos").alias("pos"), F.max("end").alias("end"))
    whole = F.btrim(F.concat(F.array_join(F.transform("a", lambda x: x["s"]), "."), F.when(F.col("pos") < F.col("end"), ".").otherwise("")))
    tail = F.regexp_extract("s", r"^(\([^)]*\)\.?)", 1)
    u = g.select(*by, "unit", whole.alias("s")).filter("s NOT IN ('', '.')").withColumn("tail", tail)
    rest = F.btrim(F.substring(F.col("s"), F.char_length("tail") + 1, F.char_length("s")))
    two = F.array(F.struct(F.lit(0).alias("k"), F.col("tail").alias("s"), F.lit(True).alias("back")), F.struct(F.lit(1).alias("k"), rest.alias("s"), rest.rlike(alone).alias("back")))
    u = u.select(*by, "unit", F.explode(F.filter(two, lambda x: ~x["s"].isin("", "."))).alias("x")).select(*by, F.struct("unit", "x.k").alias("pos"), "x.s", "x.back")
    place, previous = F.row_number().over(order), F.lag("pos").over(order)
    stays = (place == 2) & (F.col("pos.k") == 1) & (previous["unit"] == F.col("pos.unit"))  # behind a bracket that has nowhere to go
    u = u.withColumn("joins", (place > 1) & (F.col("back") | stays)).withColumn("unit", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(order))
    named = [F.col(k).alias(c) for c, k in zip(names, by, strict=True)]
    return u.groupBy(*by, "unit").agg(parts().alias("a")).select(*named, "unit", F.array_join(F.transform("a", lambda x: x["s"]), " ").alias("sentence"))


def periods(sentence: Column, today: Column) -> tuple[Column, Column]:
    """form and days (array of struct<first, last>) of the sentence's period: a range, a list of days, or until a day.

    The first form that matches counts; a range that ends before it begins and an until before today have no days; null
    and an empty array where there is no period.
    """
    number = lambda p, k: F.regexp_extract(sentence, p, k).try_cast("long")
    span, to, some = r"\b[Ff]rom ([0-9]+) to ([0-9]+)", r"\b[Uu]ntil ([0-9]+)", r"\b[Oo]n ([0-9]+(?:, [0-9]+)*(?: and [0-9]+)?)"
    one = lambda a, b: F.struct(a.alias("first"), b.alias("last"))
    form = F.when(sentence.rlike(span), "range").when(sentence.rlike(to), "until").when(sentence.rlike(some), "list")
    listed = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.regexp_extract(sentence, some, 1), F.lit("([0-9]+)")), lambda x: x.try_cast("long"))))
    days = F.when(form == "range", F.array(one(number(span, 1), number(span, 2)))).when(form == "until", F.array(one(today.cast("long"), number(to, 1)))).when(form == "list", F.transform(listed, lambda x: one(x, x)))
    return form, F.coalesce(F.filter(days, lambda x: x["first"] <= x["last"]), F.array().cast("array<struct<first:bigint,last:bigint>>"))
