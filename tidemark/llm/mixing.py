"""Mixing sources to target weights: hierarchical budgets over domain, language and source, then token-prefixes.

Weights are whole numbers for each node of the tree. From the root down, each node shares its budget among its
children by weight; a child cannot take more than its subtree holds (its tokens times the epochs allowed), and
what it leaves goes to its siblings by weight, until none can take more. Because a parent's own share is bounded
by its subtree beforehand, a shortage is made up by siblings first and reaches an ancestor's siblings only when
the whole family is used up. Each leaf's budget is filled in seeded epochs: every epoch orders the leaf's rows by a
seeded hash, whole epochs come first, and of the last one the longest prefix that fits the budget is taken.

Prefixes are found without sorting a leaf: rows fall by a byte of their hash into ranges, and sums over the ranges give
the one range in which a prefix ends; that range is split again by the next byte until it has few rows, whatever the
leaf's size, and only these are sorted. Splitting reads ids and counts; texts are read once, to select them.

Defined results: a null or empty text has no tokens; a null domain, language or source is the key "?"; nodes that
the weights don't name weigh 1; weight 0 takes nothing; rows tie-break by id and then count as they come, a
repeated row being another row; an empty table gives no rows; other columns are not read by `mix` and are kept by
`mixed_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import materialise, small, table

#: A range in which a prefix ends is split by the next byte of the hash until it has at most so many rows.
SORTED_ROWS = 10_000
_HASH_BYTES = 16


@dataclass(frozen=True)
class MixSpec:
    """Weights by node, the share of all tokens to select, the seed, and how often a row may come at most."""

    domain_weights: dict[str, int] = field(default_factory=dict)
    lang_weights: dict[str, int] = field(default_factory=dict)
    source_weights: dict[str, int] = field(default_factory=dict)
    share: float = 0.5
    seed: str = "mix-1"
    max_epochs: int = 1


#: Production parameters of the registered query and of the pipeline's stage.
SPEC = MixSpec(
    domain_weights={"web": 3, "books": 2, "code": 1},
    lang_weights={"en": 5, "fr": 2, "de": 2, "es": 1},
    source_weights={"src0": 4},
    share=0.75,
    max_epochs=2,
)
#: For the pipeline: no row twice.
ONCE = MixSpec(SPEC.domain_weights, SPEC.lang_weights, SPEC.source_weights, share=0.75, max_epochs=1)
LEVELS = ("domain", "lang", "source")


def token_count(text: Column) -> Column:
    """Fields between spaces and line ends: a count of words that needs no tokenizer."""
    text = F.coalesce(text, F.lit(""))
    without = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(text == "", 0).otherwise(F.octet_length(text) - F.octet_length(without) + 1).cast("long")


def domain_of(source: Column) -> Column:
    """The demo tree's first level: sources are dealt to three domains by their number."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, ("web", "books", "code"))), F.pmod(number, F.lit(3)) + 1)


def _weight(col: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(named, F.col(col)), F.lit(1))


def _share_out(nodes: DataFrame, within: list[str], key: str) -> DataFrame:
    """nodes(…, weight, capacity, budget of the parent) -> with `budget` of each: water-filling among siblings.

    Children are ordered by capacity for weight; those that fill up before the common level keep their capacity,
    the others get weight times the level.
    """
    nodes = nodes.filter("weight > 0 AND capacity > 0")
    order = Window.partitionBy(*within).orderBy(F.col("capacity") / F.col("weight"), key)
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    family = Window.partitionBy(*within)
    level = (F.col("parent_budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(onward)
    out = nodes.withColumn("level", level).withColumn("full", F.col("capacity") <= F.col("weight") * F.col("level"))
    common = F.min(F.when(~F.col("full"), F.struct(F.col("capacity") / F.col("weight"), key, F.col("level")))).over(family)
    out = out.withColumn("common", common["level"])
    return out.withColumn(
        "budget", F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(F.col("weight") * F.col("common"))
    ).drop("level", "full", "common", "parent_budget")


def budgets(leaves: DataFrame, spec: MixSpec) -> DataFrame:
    """domain, lang, source, tokens -> with budget long: tokens that each leaf is to give. One row for each leaf."""
    held = leaves.withColumn("capacity", F.col("tokens") * spec.max_epochs)
    total = held.agg(F.floor(F.sum("tokens") * F.lit(spec.share)).cast("double").alias("parent_budget"))
    weights = (spec.domain_weights, spec.lang_weights, spec.source_weights)
    parent: DataFrame = total.withColumn("root", F.lit(0))
    keys: list[str] = []
    for level, weight in zip(LEVELS, weights, strict=True):
        keys.append(level)
        nodes = held.groupBy(*keys).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weight))
        above = keys[:-1] or ["root"]
        nodes = (nodes if keys[:-1] else nodes.withColumn("root", F.lit(0))).join(parent, above)
        nodes = _share_out(nodes, above, level)
        parent = nodes.select(*keys, F.col("budget").alias("parent_budget"))
    return parent.select(*keys, F.floor("parent_budget").cast("long").alias("budget"))


def _leaf_keys(domain: Column, lang: Column, source: Column) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("?")).alias(n) for n, c in zip(LEVELS, (domain, lang, source), strict=True)]


def mix(
    docs: DataFrame, spec: MixSpec, *, domain: Column, id_col: str = "doc_id", lang_col: str = "lang",
    source_col: str = "source", tokens: Column, keep: list[str] | None = None,
) -> DataFrame:
    """Selected rows: id, domain, lang, source, n_tokens, epoch int (from 0), leaf_budget long.

    keep: columns of docs to return instead, for each selection. Rows move only where a leaf's prefix ends.
    """
    names = [f"__keep{i}" for i in range(len(keep or []))]
    kept = [F.col(c).alias(n) for c, n in zip(keep or [], names, strict=True)]
    leaf = _leaf_keys(domain, F.col(lang_col), F.col(source_col))
    wide = docs.select(F.col(id_col).alias("id"), *leaf, tokens.alias("n_tokens"), *kept)
    rows = materialise(wide.drop(*names), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = materialise(budgets(leaves, spec).join(leaves, list(LEVELS)), "mix-plan")
    # The epoch that a leaf ends in, and what is left for it.
    plan = plan.filter("tokens > 0").withColumn("last", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("last") * F.col("tokens"))
    # A plan has as many rows as the tree has leaves, which the configuration names; its size is checked.
    plan = plan.select(*LEVELS, "budget", "last", "rest")

    def last_epoch(df: DataFrame) -> DataFrame:
        hashed = F.md5(F.concat_ws(":", F.lit(spec.seed), F.col("last"), F.col("id")).cast("binary"))
        return df.join(small(plan), list(LEVELS)).filter("rest > 0").withColumn("hash", hashed)

    # ends: for each leaf the hash prefix (hex) in which its tokens run out, and the tokens of the hashes below it.
    ends = plan.filter("rest > 0").select(*LEVELS, F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("n"))
    head = F.expr("substring(hash, 1, length(prefix))")
    for _ in range(_HASH_BYTES):
        within = last_epoch(rows).join(small(ends.filter(F.coalesce(F.col("n") > SORTED_ROWS, F.lit(True)))), list(LEVELS))
        byte = F.expr("substring(hash, length(prefix) + 1, 2)")
        sums = within.filter(head == F.col("prefix")).groupBy(*LEVELS, "prefix", byte.alias("byte")).agg(
            F.sum("n_tokens").alias("here"), F.count("*").alias("rows"), F.min("rest").alias("rest"), F.min("before").alias("before")
        )
        up_to = F.col("before") + F.sum("here").over(Window.partitionBy(*LEVELS).orderBy("byte"))
        split = sums.withColumn("up_to", up_to).filter("up_to > rest")
        first = F.min_by(F.struct((F.col("up_to") - F.col("here")).alias("before"), "rows"), "byte").alias("end")
        split = split.groupBy(*LEVELS, "prefix").agg(F.min("byte").alias("byte"), first)
        split = split.select(*LEVELS, F.concat("prefix", "byte").alias("prefix"), F.col("end.before").alias("before"), F.col("end.rows").alias("n"))
        ends = materialise(split.unionByName(ends.filter(F.col("n") <= SORTED_ROWS)), "mix-ends")
        if not ends.filter(F.col("n") > SORTED_ROWS).limit(1).count():
            break
    cut = last_epoch(wide).join(small(ends), list(LEVELS))
    order = Window.partitionBy(*LEVELS).orderBy("hash", "id").rowsBetween(Window.unboundedPreceding, 0)
    part = cut.filter(head == F.col("prefix")).withColumn("sum", F.col("before") + F.sum("n_tokens").over(order)).filter("sum <= rest")
    columns = ["id", *LEVELS, "n_tokens", *names, "last", "budget"]
    last = cut.filter(head < F.col("prefix")).select(*columns).unionByName(part.select(*columns)).withColumn("epoch", F.col("last"))
    whole = wide.join(small(plan), list(LEVELS)).filter("last > 0").select(*columns)
    whole = whole.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("last") - 1)))
    out = whole.unionByName(last)
    if keep is not None:
        return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)])
    return out.select(F.col("id").alias(id_col), *LEVELS, "n_tokens", "epoch", F.col("budget").alias("leaf_budget"))


def mixed_documents(docs: DataFrame, spec: MixSpec = ONCE, *, id_col: str = "doc_id") -> DataFrame:
    """docs with all their columns, as often as `mix` selects them."""
    return mix(docs, spec, domain=domain_of(F.col("source")), id_col=id_col, tokens=token_count(F.col("text")), keep=docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, SPEC, domain=domain_of(F.col("source")), tokens=token_count(F.col("text")))


def _sql(spec: MixSpec) -> str:
    def case(col: str, weights: dict[str, int]) -> str:
        return "CASE " + col + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"

    parts = [f"""
rows_in AS (
  SELECT doc_id, coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
         ['web', 'books', 'code'][coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) % 3 + 1] AS domain,
         CASE WHEN coalesce(text, '') = '' THEN 0
              ELSE strlen(text) - strlen(replace(replace(text, ' ', ''), chr(10), '')) + 1 END::BIGINT AS n_tokens
  FROM documents
), leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM rows_in GROUP BY ALL),
l0 AS (SELECT 0 AS root, floor(sum(tokens) * {spec.share})::DOUBLE AS parent_budget FROM leaves)"""]
    keys: list[str] = []
    for n, (level, weights) in enumerate(zip(LEVELS, (spec.domain_weights, spec.lang_weights, spec.source_weights), strict=True), 1):
        above = ", ".join(keys) or "root"
        on = " AND ".join(f"a.{k} = p.{k}" for k in keys) or "true"
        keys.append(level)
        cols = ", ".join(keys)
        parts.append(f"""
n{n} AS (
  SELECT {", ".join(f"a.{k}" for k in keys)}, {"0 AS root, " if n == 1 else ""}a.capacity, {case("a." + level, weights)} AS weight, p.parent_budget
  FROM (SELECT {cols}, sum(tokens)::BIGINT * {spec.max_epochs} AS capacity FROM leaves GROUP BY {cols}) a JOIN l{n - 1} p ON {on}
), f{n} AS (
  SELECT *, (parent_budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM n{n} WHERE weight > 0 AND capacity > 0 WINDOW w AS (PARTITION BY {above} ORDER BY capacity / weight, {level})
), l{n} AS (
  SELECT {cols}, CASE WHEN capacity <= weight * level THEN capacity::DOUBLE ELSE weight * common END AS parent_budget
  FROM (SELECT *, arg_min(level, (capacity / weight, {level})) FILTER (WHERE NOT capacity <= weight * level) OVER (PARTITION BY {above}) AS common FROM f{n})
)""")
    return "WITH " + ",".join(parts) + f""",
plan AS (
  SELECT *, (budget // tokens)::INT AS last, budget - (budget // tokens) * tokens AS rest
  FROM (SELECT domain, lang, source, floor(parent_budget)::BIGINT AS budget FROM l3) JOIN leaves USING (domain, lang, source)
  WHERE tokens > 0
), placed AS (SELECT * FROM rows_in JOIN plan USING (domain, lang, source)),
final AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
            ORDER BY md5('{spec.seed}:' || last || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed WHERE rest > 0
)
SELECT doc_id, domain, lang, source, n_tokens, e.epoch::INT AS epoch, budget AS leaf_budget
FROM placed, range(last) e(epoch)
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, last AS epoch, budget FROM final WHERE upto <= rest
"""


OP6_SQL = _sql(SPEC)
QUERIES = {"op6_mixing": op6_mixing}
ORACLES = {"op6_mixing": OP6_SQL}
