"""Persons of a dated roster in texts: all names of a version are looked for in one pass over a text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Names of all versions that are sent to every worker at once; a longer roster takes a pass for each so many.
NAMES = 200_000


def version_of_day(texts: DataFrame, roster: DataFrame, day: str, since: str) -> DataFrame:
    """day, version for each day of texts: the newest roster that is not newer; days before the first one have no row."""
    days = texts.select(F.col(day).alias("day")).distinct().filter("day IS NOT NULL").withColumn("v", F.lit(None).cast(roster.schema[since].dataType))
    known = roster.select(F.col(since).alias("v")).distinct().filter("v IS NOT NULL").select(F.col("v").cast(texts.schema[day].dataType).alias("day"), "v")
    # A row for each day and version, not for each text.
    last = F.last("v", ignorenulls=True).over(Window.orderBy("day").rangeBetween(Window.unboundedPreceding, 0))
    both = days.withColumn("asked", F.lit(True)).unionByName(known.withColumn("asked", F.lit(False))).withColumn("version", last)
    return both.filter("asked AND version IS NOT NULL").select(F.col("day").alias(day), "version")


def _automata(rows: list) -> dict:
    """version -> automaton of the names without their last letter, each with the (kind, name) that begin so."""
    heads: dict = defaultdict(lambda: defaultdict(list))
    for version, kind, name in rows:
        heads[version][name[:-1]].append((kind, name))
    out = {}
    for version, of in heads.items():
        out[version] = a = ahocorasick.Automaton()
        for head, people in of.items():
            a.add_word(head, (len(head), people))
        a.make_automaton()
    return out


def _places(automaton, text: str, roles: dict[str, str], gap: int, near: int) -> Iterator[tuple]:
    """(kind, name, at, near): a name's own places, or where it has none, its head with the last letter at most gap further."""
    whole, loose = defaultdict(list), defaultdict(list)
    for end, (n, people) in automaton.iter(text):
        for person in people:
            tail = text.find(person[1][-1], end + 1, end + 1 + gap)
            if tail == end + 1:
                whole[person].append((end + 1 - n, tail + 1))
            elif tail > 0:
                loose[person].append((end + 1 - n, tail + 1))
    for person, spans in [*whole.items(), *((p, s) for p, s in loose.items() if p not in whole)]:
        role = roles.get(person[0])
        for start, stop in spans:
            close = bool(role) and (role in text[max(0, start - near) : start] or role in text[stop : stop + near])
            yield *person, start, close


def mentions(texts: DataFrame, roster: DataFrame, *, key: str, text: str, day: str, since: str, roles: dict[str, str], gap: int = 4, near: int = 12, names: int = NAMES) -> DataFrame:
    """key, kind, name, at, near: all places of persons of the roster in force on the text's day.

    roster has since, kind and name. Names of one letter and null texts, names, kinds and days give no rows; a person who
    is twice in a roster is one. near: the kind's role word is within so many letters before or after the place.
    """
    people = roster.select(F.col(since).alias("version"), "kind", "name").filter("version IS NOT NULL AND kind IS NOT NULL AND char_length(name) > 1").distinct()
    versions = version_of_day(texts, roster, day, since)
    dated = texts.filter(F.col(text).isNotNull()).join(versions, day).select(F.col(key).alias("key"), F.col("version").cast("string").alias("version"), F.col(text).alias("text"))
    people = people.withColumn("version", F.col("version").cast("string"))
    slices = max(1, -(-people.count() // names))
    part = F.pmod(F.xxhash64("kind", "name"), F.lit(slices))
    found = None
    for i in range(slices):
        held = dated.sparkSession.sparkContext.broadcast([tuple(r) for r in people.filter(part == i).collect()])

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            automata = _automata(held.value)
            for batch in batches:
                keys, versions, texts = (batch.column(c) for c in ("key", "version", "text"))
                rows = []
                for n, (v, t) in enumerate(zip(versions.to_pylist(), texts.to_pylist(), strict=True)):
                    if v in automata:
                        rows += [(n, *hit) for hit in _places(automata[v], t, roles, gap, near)]
                at, kind, name, start, close = zip(*rows, strict=True) if rows else ((), (), (), (), ())
                columns = [keys.take(pa.array(at, pa.int64())), pa.array(kind, pa.string()), pa.array(name, pa.string()), pa.array(start, pa.int64()), pa.array(close, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "kind", "name", "at", "near"])

        one = dated.mapInArrow(run, f"key {texts.schema[key].dataType.simpleString()}, kind string, name string, at long, near boolean")
        found = one if found is None else found.unionByName(one)
    return found.withColumnRenamed("key", key)


def one_person(places: DataFrame, key: str) -> DataFrame:
    """key, near, persons, kind, name, at: the person of a text if its best places are all one person's, else nulls.

    Places near their role word are better than all others; persons counts those with one of the best, at is the first.
    """
    p = places.groupBy(key, "kind", "name").agg(F.max("near").alias("near"), F.min(F.struct((~F.col("near")).alias("far"), "at")).alias("s"))
    best = p.groupBy(key, "near").agg(F.count("*").alias("persons"), F.min(F.struct("kind", "name", F.col("s.at").alias("at"))).alias("who"))
    top = best.groupBy(key).agg(F.max_by(F.struct("near", "persons", "who"), "near").alias("t"))
    sole = lambda c: F.when(F.col("t.persons") == 1, F.col(f"t.who.{c}")).alias(c)
    return top.select(key, "t.near", "t.persons", sole("kind"), sole("name"), sole("at"))
