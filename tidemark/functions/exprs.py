"""Column expressions: predicates, codings, bands, lenient parsing, arrays and row statistics. No UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ran(finish: Column, status: Column, also: Sequence[str] = ()) -> Column:
    """Whether a participant took part: it has a finish above 0 or one of the statuses that count as taking part."""
    return F.coalesce(finish > 0, F.lit(False)) | F.coalesce(status.isin(*also), F.lit(False))


def ordinal(col: Column, order: Sequence[str], start: int = 1) -> Column:
    """The place of a category in a list; null for others."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(order, start):
        out = F.when(col == name, i).otherwise(out)
    return out


def margin_to_number(text: Column, words: dict[str, float]) -> Column:
    """A margin as a number: a word, `n`, `a/b` or `n.a/b` (n and a fraction). Null where none fits."""
    t = F.btrim(text)
    num = lambda p, g: F.regexp_extract(t, p, g).try_cast("double")
    mixed, frac = r"^([0-9]+)\.([0-9]+)/([0-9]+)$", r"^([0-9]+)/([0-9]+)$"
    out = F.lit(None).cast("double")
    for word, value in words.items():
        out = F.when(t == word, F.lit(value)).otherwise(out)
    return (
        F.when(t.rlike(r"^[0-9]+$"), t.try_cast("double"))
        .when(t.rlike(frac), F.try_divide(num(frac, 1), num(frac, 2)))
        .when(t.rlike(mixed), num(mixed, 1) + F.try_divide(num(mixed, 2), num(mixed, 3)))
        .otherwise(out)
    )


def clock_minutes(text: Column) -> Column:
    """Minutes since midnight of 'HHMM' or 'HH:MM'; null for anything else or beyond 23:59."""
    digits = F.replace(F.btrim(text), F.lit(":"), F.lit(""))
    ok = F.btrim(text).rlike(r"^[0-9]{2}:?[0-9]{2}$")
    h, m = F.substring(digits, 1, 2).try_cast("int"), F.substring(digits, 3, 2).try_cast("int")
    return F.when(ok & (h < 24) & (m < 60), h * 60 + m)


def clock_seconds(text: Column) -> Column:
    """Seconds of 'm:ss.s' or 'ss.s'."""
    pattern = r"^(?:([0-9]+):)?([0-9]+(?:\.[0-9]+)?)$"
    part = lambda g: F.regexp_extract(text, pattern, g).try_cast("double")
    return F.when(text.rlike(pattern), F.coalesce(part(1), F.lit(0.0)) * 60 + part(2))


def half_up(x: Column, step: float) -> Column:
    """x rounded to a multiple of step, halves up."""
    return F.floor((x + step / 2) / step) * step


def band(x: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """labels[i] for the first cut that x lies below, the last label beyond all; null for null. One label more than cuts."""
    out = F.when(x.isNotNull(), F.lit(labels[-1]))
    for cut, label in reversed(list(zip(cuts, labels, strict=False))):
        out = F.when(x < cut, F.lit(label)).otherwise(out)
    return out


def at(array: Column, index: Column | int) -> Column:
    """array[index] from 0; null beyond its ends."""
    return F.get(array, index)


def mean_of(array: Column) -> Column:
    """Mean of the elements that are not null; null if there are none."""
    some = F.filter(array, lambda x: x.isNotNull())
    total = F.aggregate(some, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(some) > 0, total / F.size(some))


def halves(array: Column, least: int = 2) -> tuple[Column, Column, Column]:
    """Mean of the first half, mean of the second half, last minus smallest; null for arrays shorter than least."""
    n = F.size(array)
    half = F.floor(n / 2).cast("int")
    ok = n >= least
    first, second = mean_of(F.slice(array, 1, half)), mean_of(F.slice(array, half + 1, n - half))
    return F.when(ok, first), F.when(ok, second), F.when(ok, F.element_at(array, -1) - F.array_min(array))


def row_stats(cols: Sequence[Column]) -> dict[str, Column]:
    """Over the columns of a row, nulls skipped: count, mean, population deviation (two at least), slope over x = -1 … -n."""
    pairs = F.filter(
        F.array(*[F.struct(F.lit(-float(i)).alias("x"), c.cast("double").alias("y")) for i, c in enumerate(cols, 1)]),
        lambda p: p["y"].isNotNull(),
    )
    n = F.size(pairs)
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda a, p: a + f(p))
    mean = total(lambda p: p["y"]) / n
    mx = total(lambda p: p["x"]) / n
    var = total(lambda p: (p["y"] - mean) * (p["y"] - mean)) / n
    sxy, sxx = total(lambda p: (p["x"] - mx) * (p["y"] - mean)), total(lambda p: (p["x"] - mx) * (p["x"] - mx))
    return {
        "n": n,
        "mean": F.when(n > 0, mean),
        "std": F.when(n >= 2, F.sqrt(var)),
        "slope": F.when(n >= 2, F.try_divide(sxy, sxx)),
    }


def payout(items: Column, kind: Column | str, combo: Column) -> Column:
    """Yield y of the first item {t, c, y} of this kind and combination; 0 if there is none."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.coalesce(F.get(F.filter(items, lambda p: (p["t"] == kind) & (p["c"] == combo)), 0)["y"], F.lit(0.0))


def tied_share(prizes: Column, rank: Column, ties: Column) -> Column:
    """Mean of the prizes of `ties` places from `rank` on; places beyond the list pay 0."""
    slots = F.slice(prizes, rank, ties)
    return F.aggregate(slots, F.lit(0.0), lambda a, x: a + x) / ties


def fiscal_year(day: Column, first_month: int = 4) -> Column:
    return F.year(day) - F.when(F.month(day) < first_month, 1).otherwise(0)


def week_start(day: Column) -> Column:
    """The Sunday on or before day."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def ordered_groups(text: Column) -> Column:
    """'7,9,(2,10)-11' -> array<struct<id int, rank int>>: groups share a rank, later ranks skip them.

    Null where the text is anything but numbers, commas, dashes and single-level parentheses.
    """
    t = F.regexp_replace(text, r"\s", "")
    group = r"(?:[0-9]+|\([0-9]+(?:,[0-9]+)*\))"
    ok = t.rlike(rf"^{group}(?:[,-]{group})*$")
    groups = F.regexp_extract_all(t, F.lit(rf"({group})"), F.lit(1))
    ids = F.transform(groups, lambda g: F.transform(F.split(F.regexp_replace(g, r"[()]", ""), ","), lambda x: x.cast("int")))
    before = lambda i: F.aggregate(F.slice(ids, 1, i), F.lit(0), lambda a, g: a + F.size(g))
    ranked = F.transform(ids, lambda g, i: F.transform(g, lambda x: F.struct(x.alias("id"), (before(i) + 1).alias("rank"))))
    return F.when(ok, F.flatten(ranked))


def slot(array: Column, name: str) -> Column:
    """One of an array's non-null entries: first, second (of three or more), second_last (of two or more), last."""
    a = F.filter(array, lambda x: x.isNotNull())
    n = F.size(a)
    return {
        "first": F.get(a, 0),
        "second": F.when(n >= 3, F.get(a, 1)),
        "second_last": F.when(n >= 2, F.get(a, n - 2)),
        "last": F.get(a, n - 1),
    }[name]


def first_rule(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first (pattern, label) that text matches."""
    out = F.lit(default).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def text_interval(text: Column) -> tuple[Column, Column]:
    """First and last day of 'YYYY-MM', 'YYYY-MM-DD', 'YYYY-MM~MM' or 'YYYY-MM~YYYY-MM'; nulls for anything else."""
    y, m = F.regexp_extract(text, r"^(\d{4})-(\d{2})", 1), F.regexp_extract(text, r"^(\d{4})-(\d{2})", 2)
    to_month = F.regexp_extract(text, r"~(?:\d{4}-)?(\d{2})$", 1)
    to_year = F.regexp_extract(text, r"~(\d{4})-\d{2}$", 1)
    day = F.regexp_extract(text, r"^\d{4}-\d{2}-(\d{2})$", 1)
    date = lambda y, m, d: F.concat_ws("-", y, m, d).try_cast("date")
    first = F.when(day != "", date(y, m, day)).when(y != "", date(y, m, F.lit("01")))
    until = date(F.when(to_year != "", to_year).otherwise(y), F.when(to_month != "", to_month).otherwise(m), F.lit("01"))
    return first, F.when(day != "", first).otherwise(F.last_day(until))
