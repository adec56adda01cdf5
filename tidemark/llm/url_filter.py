"""URL filters: a broadcast trie over reversed host labels and path segments, the longest rule wins.

Rules of up to TRIE_BYTES, measured as the trie is built or, for a table of rules, beforehand, are broadcast and URLs
don't move. Beyond that, rules and URLs are shuffled by the host's last two labels, and each group's sub-trie judges its
URLs; rules for a single label are judged the same way by that label, for URLs that have no longer match. A host's URLs
are dealt to several groups, each with the rules of that key, where they are many.

Defined results: a null URL or one without ``://`` has an empty host and path and meets no rule; no rule
means the default verdict; rows that repeat are judged alike; an empty table gives an empty result; columns
of the input beside its id and URL are neither read nor returned, so that their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import join_groups, materialise, table


class Rule(NamedTuple):
    """A rule fits its host and all subdomains, where the URL's path starts with its path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Bytes of a trie at most that is broadcast: strings and the dicts and entries that hold them.
TRIE_BYTES = 256_000_000
_NODE_BYTES, _TEXT_BYTES = 240, 60
#: URLs of one key that meet a sub-trie in one group.
GROUP_URLS = 100_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Keys of a node that are no label: its path trie, the open last segments of rules that end there.
_PATHS, _ENDS = 0, 1


def rule_bytes(host: str, path: str) -> int:
    """What a rule can add to a trie at most: a node and a text for each label and segment."""
    return (host.count(".") + path.count("/") + 4) * (_NODE_BYTES + _TEXT_BYTES) + len(host) + len(path)


def build_trie(rules: Iterable[Rule], most: int | None = None) -> dict:
    """Nested dicts: labels from the right, then under _PATHS whole segments; _ENDS has the last, open segment.

    Of two rules with the same host and path, block stands. most: bytes beyond which OverflowError is raised.
    """
    root: dict = {}
    size = 0
    for rule in rules:
        size += rule_bytes(rule.host, rule.path)
        if most is not None and size > most:
            raise OverflowError(f"a trie of more than {most} bytes")
        _insert(root, rule)
    return root


def _insert(root: dict, rule: Rule) -> None:
    node = root
    for label in reversed(rule.host.translate(_LOWER).split(".")):
        node = node.setdefault(label, {})
    node = node.setdefault(_PATHS, {})
    *whole, last = rule.path.split("/")
    for segment in whole:
        node = node.setdefault(segment, {})
    ends = node.setdefault(_ENDS, {})
    if last not in ends or rule.verdict == "block":
        ends[last] = rule


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, without query and fragment."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def _longest_path(node: dict, path: str) -> Rule | None:
    """The rule with the longest path that path starts with, in one walk down the path trie."""
    best = None
    for segment in path.split("/"):
        if ends := node.get(_ENDS):
            for n in range(len(segment), -1, -1):
                if (found := ends.get(segment[:n])) is not None:
                    best = found
                    break
        node = node.get(segment)
        if node is None:
            return best
    return best


def match(trie: dict, host: str, path: str) -> Rule | None:
    """The longest rule: most host labels first, then the longest path."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            return best
        if (paths := node.get(_PATHS)) is not None:
            best = _longest_path(paths, path) or best
    return best


def filter_urls(
    pages: DataFrame, rules: Iterable[Rule] | DataFrame, *, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", trie_bytes: int | None = None,
) -> DataFrame:
    """One row for each row of pages: id, host, path, rule (null: none fits), verdict.

    rules: Rule tuples, or a table host, path, verdict. Up to trie_bytes (TRIE_BYTES) one scan without a shuffle.
    """
    most = TRIE_BYTES if trie_bytes is None else trie_bytes
    if isinstance(rules, DataFrame):
        return _by_table(pages, rules.select("host", "path", "verdict"), id_col, url_col, default, most)
    rules = list(rules)
    try:
        return _by_trie(pages, build_trie(rules, most), id_col, url_col, default)
    except OverflowError:
        table_of = pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        return _by_suffix(pages, table_of, id_col, url_col, default)


def _by_table(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str, most: int) -> DataFrame:
    pieces = F.octet_length(F.regexp_replace("host", "[^.]", "")) + F.octet_length(F.regexp_replace("path", "[^/]", "")) + 4
    size = pieces * (_NODE_BYTES + _TEXT_BYTES) + F.octet_length("host") + F.octet_length("path")
    if (rules.agg(F.sum(size).alias("b")).first()["b"] or 0) <= most:
        return _by_trie(pages, build_trie(Rule(*r) for r in rules.collect()), id_col, url_col, default)
    return _by_suffix(pages, rules, id_col, url_col, default)


_OUT = ["id", "host", "path", "rule", "verdict"]


def _judged(ids: pa.Array, urls: list[str | None], trie: dict, default: str | None) -> pa.RecordBatch:
    parts = [split_url(u) for u in urls]
    found = [match(trie, *p) for p in parts]
    values = [[p[0] for p in parts], [p[1] for p in parts], [r and r.name for r in found], [r.verdict if r else default for r in found]]
    return pa.RecordBatch.from_arrays([ids, *[pa.array(v, pa.string()) for v in values]], _OUT)


def _by_trie(pages: DataFrame, trie: dict, id_col: str, url_col: str, default: str) -> DataFrame:
    held = pages.sparkSession.sparkContext.broadcast(trie)
    kind = pages.select(id_col).schema[0].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = held.value
        for batch in batches:
            yield _judged(batch.column(0), batch.column(1).to_pylist(), root, default)

    out = pages.select(id_col, url_col).mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


def _by_suffix(pages: DataFrame, rules: DataFrame, id_col: str, url_col: str, default: str) -> DataFrame:
    """Two labels first, then, for URLs that none of these rules fits, one label."""
    labels = F.size(F.split("host", "[.]"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    first = materialise(_by_key(urls, rules.filter(labels >= 2), 2), "url-verdicts")
    rest = _by_key(first.filter("verdict IS NULL").select("id", "url"), rules.filter(labels < 2), 1)
    out = first.filter("verdict IS NOT NULL").unionByName(rest).drop("url")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default))).withColumnRenamed("id", id_col)


def _by_key(urls: DataFrame, rules: DataFrame, labels: int) -> DataFrame:
    """id, url, host, path, rule, verdict (null: none fits), by sub-tries of the last labels of the host."""
    kind = urls.schema["id"].dataType.simpleString()
    key = lambda host: F.substring_index(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), ".", -labels)
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    keyed = urls.withColumn("key", key(rest))
    ruled = rules.withColumn("key", key(F.col("host")))
    keys = ruled.select("key").distinct()
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).join(keys, "key", "left_semi")
    counts = materialise(counts.withColumn("groups", F.ceil(F.col("n") / GROUP_URLS).cast("int")), "url-keys")
    asked = join_groups(keyed, counts, ["key"], "n").withColumn("g", F.pmod(F.xxhash64("url"), F.coalesce("groups", F.lit(1))).cast("int"))
    ruled = ruled.join(counts, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), "host", "path", "verdict")
    none = lambda t: F.lit(None).cast(t)
    rules_first = ruled.select("key", "g", F.lit(0).alias("side"), none(kind).alias("id"), none("string").alias("url"), "host", "path", "verdict")
    both = asked.filter("n IS NOT NULL").select("key", "g", F.lit(1).alias("side"), "id", "url", *[none("string").alias(c) for c in ("host", "path", "verdict")])
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rules_first.unionByName(both).repartition(parts, "key", "g").sortWithinPartitions("key", "g", "side")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: dict = {}
        place = None
        for batch in batches:
            keys, groups, sides = (batch.column(c).to_pylist() for c in ("key", "g", "side"))
            at, n = 0, batch.num_rows
            while at < n:
                here, end = (keys[at], groups[at], sides[at]), at + 1
                while end < n and (keys[end], groups[end], sides[end]) == here:
                    end += 1
                part = batch.slice(at, end - at)
                if here[:2] != place:
                    trie, place = {}, here[:2]
                if here[2]:
                    made = _judged(part.column("id"), part.column("url").to_pylist(), trie, None)
                    yield pa.RecordBatch.from_arrays([*made.columns, part.column("url")], [*_OUT, "url"])
                else:
                    for r in zip(*(part.column(c).to_pylist() for c in ("host", "path", "verdict")), strict=True):
                        _insert(trie, Rule(*r))
                at = end

    schema = f"id {kind}, host string, path string, rule string, verdict string, url string"

    def unmatched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _judged(batch.column(0), batch.column(1).to_pylist(), {}, None)
            yield pa.RecordBatch.from_arrays([*made.columns, batch.column(1)], [*_OUT, "url"])

    without = asked.filter("n IS NULL").select("id", "url").mapInArrow(unmatched, schema)
    return both.mapInArrow(judge, schema).unionByName(without)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


_REST = "substr(url, strpos(url, '://') + 3)"
OP5_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE regexp_extract({_REST}, '^[^?#]*') END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
  FROM cut
), rules(host, path, verdict) AS (
  VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}
), fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY len(string_split(r.host, '.')) DESC, length(r.path) DESC) AS k
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.k = 1
"""
QUERIES = {"op5_url_filter": op5_url_filter}
ORACLES = {"op5_url_filter": OP5_SQL}
